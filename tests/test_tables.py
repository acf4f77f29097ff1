"""Loads, streaks, groups and hashes on small tables, some against brute force."""

import hashlib
import json
import random
from datetime import date, datetime

from pyspark.sql import functions as F

from noticeworks import config
from noticeworks.operators import curation, discovery, fingerprints, loading, lookups, matching, ordering, quality, shaping
from noticeworks.plans import daily_run, quality_run
from noticeworks.streaming import incremental_load


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_insert_rules_treat_null_as_equal(spark):
    schema = "place string, nr string, addr string, arrival int"
    target = spark.createDataFrame([("a", "1", "x", 0), ("a", None, None, 1)], schema)
    batch = spark.createDataFrame(
        [("a", "1", "y", 2), ("a", "2", "y", 4), ("a", "2", "z", 3), ("a", None, None, 5), ("a", None, "q", 7), ("a", None, "q", 6)], schema)
    got = loading.insert_records(target, batch, "nr", ["place", "nr"], ["place", "addr"], ["arrival"])
    assert rows(got, "nr", "addr", "arrival") == [("2", "z", 3), (None, "q", 6)]


def test_merge_overwrites_and_keeps_other_columns(spark):
    target = spark.createDataFrame([(1, "u", "old", "kept"), (None, "u", "n", "k")], "org int, url string, title string, extra string")
    batch = spark.createDataFrame([(1, "u", None, 1), (1, "u", "last", 2), (None, "u", "n2", 3), (2, "v", "new", 4)], "org int, url string, title string, at int")
    got = loading.upsert_merge(target, batch, ["org", "url"], ["at"])
    assert rows(got, "org", "title", "extra") == [(1, "last", "kept"), (2, "new", None), (None, "n", "k"), (None, "n2", None)]


def test_daily_rows_replace_one_day_only(spark, tmp_path):
    schema = "vertical string, source string, run_date date, extracted int"
    path = str(tmp_path / "qc")
    old = spark.createDataFrame([("p", "a", date(2026, 1, 1), 1), ("p", "a", date(2026, 1, 2), 2), ("q", "a", date(2026, 1, 2), 9)], schema)
    loading.overwrite_partitions(old, path, "run_date")
    new = spark.createDataFrame([("p", "a", date(2026, 1, 2), 5)], schema)
    loading.store_daily_qc(spark, new, path, date(2026, 1, 2))
    assert rows(spark.read.parquet(path), "vertical", "run_date", "extracted") == [
        ("p", date(2026, 1, 1), 1), ("p", date(2026, 1, 2), 5), ("q", date(2026, 1, 2), 9)]


def test_zero_streak_counts_missing_days(spark):
    d = lambda n: date(2026, 4, n)
    runs = spark.createDataFrame(
        [("gap", d(6), 4), ("zero", d(5), 3), ("zero", d(9), 0), ("busy", d(9), 2), ("never", d(8), 0), ("old", d(1), 3)],
        "source string, day date, n int")
    got = {r["source"]: (r["zero_days"], r["dates"][0], r["dates"][-1]) for r in quality.zero_streak(runs, d(10)).collect()}
    assert got == {"gap": (4, d(10), d(7)), "zero": (5, d(10), d(6)), "never": (3, d(10), d(8)), "old": (9, d(10), d(2))}


def test_budget_equals_the_loop(spark):
    random.seed(3)
    tasks = [(r, random.randint(1, 3), date(2026, 1, random.randint(1, 5)), i, random.choice([None, 1, 3, 9]), random.randint(0, 6))
             for r in ("hot", "cold") for i in range(60 if r == "hot" else 4)]
    df = spark.createDataFrame(tasks, "run string, priority int, at date, id int, max_cost int, cost int")
    got = ordering.budget_cutoff(df, 40, ["run"], ["priority", "at", "id"], ["priority", "at"])
    want = []
    for run in ("hot", "cold"):
        spent, over = 0, False
        for t in sorted((t for t in tasks if t[0] == run), key=lambda t: (t[1], t[2], t[3])):
            over = over or spent + (t[4] or 0) > 40
            want.append((run, t[3], "budget_exhausted" if over else "run"))
            spent += 0 if over else t[5]
    assert rows(got, "run", "id", "status") == sorted(want, key=repr)


def test_containment_equals_brute_force(spark):
    random.seed(5)
    word = lambda n: "".join(random.choice("ab 1:") for _ in range(n))
    texts = [(i, random.choice("xy"), word(random.randint(0, 30))) for i in range(80)]
    needles = [(i, random.choice("xy"), word(random.randint(1, 6))) for i in range(60)]
    left = spark.createDataFrame(texts, "i int, k string, t string")
    right = spark.createDataFrame(needles, "j int, k string, n string")
    got = rows(matching.containing_pairs(left, "t", right, "n", ["k"]), "i", "j")
    assert got == sorted(((i, j) for i, k, t in texts for j, m, n in needles if k == m and n in t), key=repr)


def test_list_hash_is_one_sum_at_any_size(spark):
    items = [("a", str(i), "2026-01-01") for i in range(50)] + [("b", "1", "2026-01-02")]
    random.seed(1)
    random.shuffle(items)

    def by_hand(entries):
        shas = [hashlib.sha256(e.encode()).hexdigest() for e in entries]
        words = [str(sum(int(x[at:at + 15], 16) for x in shas)) for at in range(0, 64, 15)]
        return hashlib.sha256(":".join([*words, str(len(shas))]).encode()).hexdigest()[:16]

    df = spark.createDataFrame(items, "source string, id string, day string")
    for frame in (df, df.repartition(5)):
        got = {r["source"]: (r["content_hash"], r["items"]) for r in fingerprints.list_content_hash(frame, "source", "id", "day").collect()}
        assert got == {s: (by_hand([f"{i}:{d}" for t, i, d in items if t == s]), sum(t == s for t, _, _ in items)) for s in ("a", "b")}
    many = spark.range(10_000_000).select(F.lit("m").alias("source"), F.col("id").cast("string").alias("id"), F.lit("d").alias("day"))
    large = fingerprints.list_content_hash(many, "source", "id", "day")
    assert "collect" not in large._jdf.queryExecution().toString() and large.first()["items"] == 10_000_000


def test_nothing_is_lost(spark):
    """Rows with nulls in keys and types come out of the operators that split, group and load."""
    from noticeworks.operators import loading, lookups, matching, ordering, shaping

    tasks = spark.createDataFrame([(None, 1, 1, 5, 5), (1, None, 2, 5, 5), (1, 2, 3, 5, 5)], "run int, p int, id int, cost int, max_cost int")
    assert ordering.budget_cutoff(tasks, 7, ["run"], ["p", "id"], ["p"]).count() == 3
    signals = spark.createDataFrame(
        [(1, 1, "t", 7, None, None, None), (2, 2, "t", 7, "permit", None, None), (3, 3, "t", 7, "permit", "A 1:1", None)],
        "signal_id long, arrival long, title string, organization_id long, source_type string, property_designation string, project_id long")
    projects = spark.createDataFrame([], "project_id long, organization_id long, property_designation string")
    assert rows(matching.group_signals(signals, projects), "signal_id", "action") == [(1, "needs_review"), (2, "needs_review"), (3, "new_project")]
    batch = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("a", "x", 3), ("a", "x", 4)], "k string, c string, n int")
    assert rows(loading.insert_ignore(batch.limit(0), batch, ["k", "c"], ["n"]), "n") == [(1,), (2,), (3,)]
    plan = spark.createDataFrame([(1, None), (2, True), (3, False)], "id int, was_verified boolean")
    assert [p.count() for p in shaping.split_verified(plan)] == [2, 1]
    got = spark.createDataFrame([("B 1", "x", "later"), ("b1", "y", "early")], "case_number string, type string, status string")
    want = spark.createDataFrame([("b 1", "x", "early")], "case_number string, type string, status string")
    r = lookups.expected_vs_actual(want, got, ["type", "status"]).first()
    assert r["type_ok"] and not r["status_ok"]
    kinds = spark.createDataFrame([("b1", "g1", "1", "Kallelse"), ("b2", "g2", "1", "Beslut om lov")], "board_id string, id string, type string, name string")
    notice = spark.createDataFrame([("b1", "1")], "board_id string, type_key string")
    assert lookups.type_name_lookup(notice, kinds).first()["type_name"] == "Kallelse"



def test_names_resolve_in_three_steps(spark):
    places = spark.createDataFrame([("Eslöv", "Skåne"), ("Malmö", "Skåne"), ("Åre", "Jämtland")], "name string, county string")
    given = [("Eslövs kommun",), ("MALMÖ STAD",), ("Åre",), ("Okänd",), (None,), ("Malmö",)]
    got = lookups.resolve_canonical_name(spark.createDataFrame(given, "m string"), "m", places, "name")
    assert dict(rows(got, "m", "canonical")) == {
        "Eslövs kommun": "Eslöv", "MALMÖ STAD": "Malmö", "Åre": "Åre", "Okänd": "Okänd", None: None, "Malmö": "Malmö"}


def test_duplicate_plan(spark):
    configs = spark.createDataFrame(
        [(1, "Åmål", True), (2, "åMåL", True), (3, "Habo", True), (4, "Håbo", False), (5, "åRe", False), (6, "Xby", False), (7, "X-by", True)],
        "id int, name string, approved boolean")
    reference = spark.createDataFrame([("Åmål",), ("Habo",), ("Håbo",), ("Åre",)], "name string")
    plan = curation.plan_duplicate_fix(configs, reference)
    assert rows(plan, "id", "action", "new_name") == [(2, "delete", None), (5, "rename", "Åre"), (6, "delete", None)]


def test_best_candidate_prefers_the_first_strong_one(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 1, 2), ("a", 2, 5), ("b", 0, 1), ("b", 1, 1), ("c", 0, 0)], "s string, position int, hits int")
    assert rows(discovery.best_candidate(df, "s"), "s", "position") == [("a", 1), ("b", 0)]


def test_signals_share_new_projects(spark):
    signals = spark.createDataFrame(
        [(1, 1, 10, "permit", "Bygglov — H 1:1", "H 1:1", None), (2, 2, 10, "permit", "Marklov — H 1:1", "H 1:1", None), (3, 3, None, "permit", "B — K 2", "K 2", None),
         (4, 4, 20, "ted", "Skola", None, None), (5, 5, 20, "ted", "Väg", None, None), (6, 6, 30, "permit", "B — Z 1", "Z 1", None)],
        "signal_id int, arrival int, organization_id int, source_type string, title string, property_designation string, project_id long")
    projects = spark.createDataFrame([(7, 30, "Z 1"), (8, None, "K 2")], "project_id long, organization_id int, property_designation string")
    got = matching.group_signals(signals, projects)
    assert rows(got, "signal_id", "action", "project_id", "new_project_title") == [
        (1, "new_project", None, "Bygglov — H 1:1"), (2, "grouped", None, "Bygglov — H 1:1"), (3, "grouped", 8, None),
        (4, "new_project", None, "Skola"), (5, "needs_review", None, None), (6, "grouped", 7, None)]


def test_approval_policies(spark):
    df = spark.createDataFrame([(3, False, None), (0, True, None), (0, False, "HTTP 404"), (0, False, None)], "result_count int, has_keyword boolean, error string")
    strict = discovery.verification_decision(df)
    assert [tuple(r) for r in strict.select("status", "approved").collect()] == [
        ("verified", True), ("needs_browser", False), ("http_error", False), ("failed", False)]
    assert [r[0] for r in discovery.verification_decision(df, approve_browser=True).select("approved").collect()] == [True, True, False, False]


def test_zero_amount_is_kept_on_request(spark):
    df = spark.createDataFrame([("", 0, False)], "a string, n int, b boolean")
    mapping = {"a": "x", "n": "y", "b": "z", "missing": "w"}
    assert shaping.map_fields(df, mapping).first().asDict() == {"x": None, "y": None, "z": None, "w": None}
    assert shaping.map_fields(df, mapping, zero_is_null=False).first()["y"] == 0


def test_a_day_from_records_to_quality(spark):
    places = spark.createDataFrame([("Lund", "Skåne"), ("Åre", "Jämtland")], "name string, county string")
    columns = ("municipality", "case_number", "address", "permit_type", "status", "date", "source_url", "arrival", "lan", "raw_html_hash", "extraction_model")
    target = spark.createDataFrame([], ", ".join(f"{c} {'int' if c == 'arrival' else 'string'}" for c in columns))
    found = spark.createDataFrame(
        [("Lunds kommun", "1", "A 1", "bygglov", "ansökt", "2026-01-01", None, "u1", "h1", 1, datetime(2026, 5, 1)),
         ("Lund", "1", "A 1", "bygglov", "ansökt", "2026-01-01", None, "u1", "h1", 2, datetime(2026, 5, 1)),
         ("ÅRE", None, "", "okänd", "beviljat", None, "own", "u2", "h2", 3, datetime(2026, 5, 1)),
         ("Åre", "9", "B", "marklov", "beviljat", None, None, "u2", None, 4, datetime(2026, 5, 1))],
        "municipality string, case_number string, address string, permit_type string, status string, date string, source_url string, "
        "page_url string, page_hash string, arrival int, created_at timestamp_ntz")
    pages = spark.createDataFrame([("Lund", "u1", True, "<p>" + "x" * 600 + "</p>"), ("Åre", "u2", True, "<p>kort</p>")], "source string, url string, verified boolean, html string")
    stored = spark.createDataFrame([("Lund", "u1", "gammal")], "source string, url string, content_hash string")
    flagged = daily_run.pages_to_read(pages, stored)
    run = daily_run.load(found, target, places, flagged, stored, config.PERMITS, "m", datetime(2026, 4, 22))
    assert rows(run.to_append, "municipality", "case_number", "address", "permit_type", "lan", "source_url") == [
        ("Lund", "1", "A 1", "bygglov", "Skåne", "u1"), ("Åre", None, None, None, "Jämtland", "own")]
    assert rows(run.dropped, "reason", "records") == [("missing_page_hash", 1)]
    assert len(rows(run.hashes, "source", "content_hash")) == 1
    checked = quality_run.run(
        found.withColumn("source", F.col("municipality")), found.withColumn("source", F.lit("Lund")).withColumn("created_at", F.lit("2026-01-01").cast("timestamp_ntz")),
        spark.createDataFrame([("Lund", 1)], "source string, inserted long"), config.PERMITS, date(2026, 5, 1))
    got = {r["source"]: (r["inserted"], r["flags"]) for r in checked.rows.collect()}
    assert got["lund"] == (1, ["stale"]) and got["are"] == (0, ["validation_issues"])


def test_streamed_records_are_added_once(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "t")
    landing.mkdir()
    schema = spark.createDataFrame([], "place string, nr string, addr string, arrival int").schema
    spark.createDataFrame([("a", "1", "x", 0)], schema).write.parquet(target)

    def arrive(name, records):
        (landing / name).write_text("\n".join(json.dumps(r) for r in records))
        stream = incremental_load.read_records(spark, str(landing), schema)
        incremental_load.start_load(stream, target, str(tmp_path / "cp"), "nr", ["place", "nr"], ["place", "addr"], ["arrival"]).awaitTermination(120)

    arrive("1.json", [{"place": "a", "nr": "1", "addr": "x", "arrival": 1}, {"place": "a", "nr": "2", "addr": "x", "arrival": 2}, {"place": "a", "addr": "q", "arrival": 3}])
    arrive("2.json", [{"place": "a", "nr": "2", "addr": "y", "arrival": 4}, {"place": "a", "addr": "q", "arrival": 5}, {"place": "b", "nr": "2", "arrival": 6}])
    assert rows(spark.read.parquet(target), "place", "nr", "arrival") == [("a", "1", 0), ("a", "2", 2), ("a", None, 3), ("b", "2", 6)]


def test_rarest_piece_finds_what_comparing_all_finds_in_few_tries(spark):
    suffix = " i norra hamnens industriområde vid kajen"
    right = spark.createDataFrame([("m", f"kv {i}:1{suffix}", i) for i in range(3000)] + [("m", "x", 1), ("n", "kv 5:1" + suffix, 2), ("m", "nowhere at all", 3)], "k string, needle string, o int")
    texts = [("m", f"a kv {i}:1{suffix}, hus {i % 7}", i) for i in range(0, 3000, 10)] + [("m", "nowhere at al", 1), ("n", "kv 5:1" + suffix, 2), ("m", "", 3), ("m", "xx", 4), ("m", "xx", 5)]
    left = spark.createDataFrame(texts, "k string, t string, id int")
    want = sorted((i, o) for k, t, i in texts for k2, n, o in [("m", f"kv {j}:1{suffix}", j) for j in range(3000)] + [("m", "x", 1), ("n", "kv 5:1" + suffix, 2)] if k == k2 and n in t)
    found = matching.containing_pairs_by_rarest(left, "t", right, "needle", ["k"])
    assert sorted(rows(found, "id", "o")) == want
    tries = matching.rarest_hits(left, "t", right, "needle", ["k"]).count()
    assert tries <= 1.1 * len(want)


def test_duplicates_of_a_hot_name_are_counted_before_the_shuffle(spark):
    configs = spark.createDataFrame([(i, "Habo" if i % 3 else f"n{chr(97 + i % 26)}", True) for i in range(300)] + [(900, None, True)], "id int, name string, approved boolean")
    got = curation.duplicate_groups(configs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_count" in plan
    assert {r["members"] for r in got.where("name = 'Habo'").collect()} == {200}


def test_empty_excerpts_are_not_set_by_default(spark):
    def lengths(texts, **how):
        df = spark.createDataFrame([(t, None, "u", "v") for t in texts], "source_excerpt string, ai_summary string, source_url string, listing string")
        return tuple(quality.excerpt_stats(df.withColumn("n", F.length("source_excerpt")), "listing", **how).select("longest", "shortest").first())

    assert lengths(["", "ab", "abc", None]) == lengths(["", "ab", "abc", None], excerpt_length="n") == (3, 2)
    assert lengths(["", None]) == lengths([None]) == lengths([]) == (0, 0)
    assert lengths(["", "ab"], empty_is_set=True) == (2, 0) and lengths([None], empty_is_set=True) == (None, None)
