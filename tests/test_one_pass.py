"""Loads that count while they write, and page hashes kept by a stream."""

import json
import random
from datetime import date

from pyspark.sql import functions as F

from noticeworks.operators import loading, observed, shaping
from noticeworks.streaming import page_changes

SCHEMA = "place string, nr string, addr string, permit_type string, source_url string, page_hash string, created_at timestamp_ntz, arrival int"


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def records(spark, seed, n):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "b", None]), rng.choice(["1", "2", "3", None]), rng.choice(["x", "y", None]), rng.choice(["t", "t", ""]), rng.choice(["u", "u", None]),
             rng.choice(["h", None]), i) for i in range(n)]
    df = spark.createDataFrame(data, "place string, nr string, addr string, permit_type string, source_url string, page_hash string, arrival int")
    return df.withColumn("created_at", F.lit("2026-05-01").cast("timestamp_ntz")).select(*[c.split()[0] for c in SCHEMA.split(", ")])


def test_one_pass_equals_the_two_loads(spark):
    target, batch = records(spark, 1, 12).where("nr <> '3'"), records(spark, 2, 300)
    key, dedup = ["place", "nr"], ["place", "addr", "source_url"]
    want = loading.insert_records(target, batch, "nr", key, dedup, ["arrival"])
    got = loading.insert_in_one_pass(target, batch, key, ["arrival"], "nr", dedup)
    assert rows(got, *batch.columns) == rows(want, *batch.columns)
    assert rows(loading.insert_in_one_pass(target, batch, key, ["arrival"]), "arrival") == rows(loading.insert_ignore(target, batch, key, ["arrival"]), "arrival")


def test_counts_come_from_the_pass_that_writes(spark, tmp_path):
    records(spark, 2, 300).write.parquet(str(tmp_path / "batch"))
    batch, target = spark.read.parquet(str(tmp_path / "batch")), records(spark, 1, 12)
    checked = shaping.require_technical_fields(batch, "permit_type", "created_at", date(2026, 1, 1))
    load = observed.observed_load(checked, target, "nr", ["place", "nr"], ["place", "addr", "source_url"], ["arrival"])
    plan = load.to_append._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    loading.append(load.to_append, str(tmp_path / "t"))
    counts = load.counts()
    stored = spark.read.parquet(str(tmp_path / "t"))
    reasons = {r["reason"]: r["records"] for r in shaping.drop_reason_counts(checked).collect()}
    assert {r: counts[r] for r in observed.DROP_REASONS} == reasons
    assert counts["offered"] == 300 and counts["inserted"] == stored.count()
    per_source = loading.insert_counts(shaping.storable(checked).fillna("", ["place"]), stored.fillna("", ["place"]), "place").collect()
    assert counts["storable"] == sum(r["offered"] for r in per_source)
    assert counts["skipped"] == sum(r["skipped"] for r in per_source)


def test_relevant_rows_are_counted(spark, tmp_path):
    known = spark.createDataFrame([("n1", 1)], "number string, arrival int")
    fetched = spark.createDataFrame([("n1", 2), ("n2", 3), ("n2", 4), ("x", 5), (None, 6), ("y", None)], "number string, arrival int")
    run = observed.observed_relevant(fetched, (F.col("number") != "x") & (F.col("arrival") < 9), known, ["number"], ["arrival"])
    run.rows.write.parquet(str(tmp_path / "t"))
    assert run.counts() == {"fetched": 6, "relevant": 3, "inserted": 1}


def batch_changes(history):
    """Changed pages of each run by the batch operators' rules."""
    stored, out = {}, []
    for run, pages in history:
        for source, url, verified, new in pages:
            if not (verified and new is not None and stored.get((source, url)) == new):
                out.append((source, url, new, run))
        read = {source for source, *_ in pages}
        stored = {k: h for k, h in stored.items() if k[0] not in read} | {(s, u): h for s, u, _, h in pages if h is not None}
    return sorted(out, key=repr)


def test_stream_of_pages_equals_the_batch_rules(spark, tmp_path):
    rng = random.Random(4)
    pages = [(s, f"u{i}") for s in "ab" for i in range(12)]
    hashes = dict.fromkeys(pages, "h0")
    history = []
    for run in range(1, 6):
        for p in pages:
            hashes[p] = rng.choice([hashes[p], hashes[p], f"h{run}", "h0", None])
        # a source is always read as a whole or not at all; some of its pages may be gone
        history.append((run, [(*p, rng.random() < 0.8, hashes[p]) for p in pages if rng.random() < 0.8]))
    folder = tmp_path / "in"
    folder.mkdir()

    def deliver(name, run, part):
        (folder / name).write_text("".join(json.dumps({"source": s, "url": u, "verified": v, "content_hash": h, "run": run}) + "\n" for s, u, v, h in part))

    def start(checkpoint):
        stream = spark.readStream.schema(page_changes.PAGES).json(str(folder))
        page_changes.start_changes(stream, str(tmp_path / f"out-{checkpoint}"), str(tmp_path / checkpoint)).awaitTermination(200)
        return rows(spark.read.schema(page_changes.CHANGED).parquet(str(tmp_path / f"out-{checkpoint}")), "source", "url", "content_hash", "run")

    # stopped and started again after every run, pages of one run in two deliveries, one of them twice
    for run, part in history:
        deliver(f"{run}a.json", run, part[:9])
        start("stepwise")
        deliver(f"{run}b.json", run, part[9:])
        deliver(f"{run}c.json", run, part[:4])
        got = start("stepwise")
    assert got == batch_changes(history)
    assert start("at-once") == got  # all runs in one micro-batch


def test_stream_state_of_null_flags(spark, tmp_path):
    page = spark.createDataFrame([("a", "u", None, "h", 1), ("a", "u", None, "h", 2), ("a", "v", True, None, 1), ("a", "v", True, None, 2)], page_changes.PAGES)
    page.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(page_changes.PAGES).parquet(str(tmp_path / "in"))
    page_changes.start_changes(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(200)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_stream_state_is_kept_by_cells(spark, tmp_path):
    """Pages of one cell are served together and judged apart, null names and pages that stay away included."""
    history, hashes = [], {}
    rng = random.Random(9)
    pages = [(s, f"u{i}") for s in ("a", "b") for i in range(300)]
    for run in (1, 2, 3):
        hashes |= {p: rng.choice(["x", "y", None]) for p in pages if p not in hashes or rng.random() < 0.5}
        history.append((run, [(*p, rng.random() < 0.9, hashes[p]) for p in pages if rng.random() < 0.9]))
    for run, part in history:
        spark.createDataFrame([(*p, run) for p in part] + [(None, None, True, "n", run)], page_changes.PAGES).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(page_changes.PAGES).parquet(str(tmp_path / "in"))
        query = page_changes.start_changes(stream, str(tmp_path / "out"), str(tmp_path / "cp"), cells=5)
        query.awaitTermination(200)
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 5
    got = rows(spark.read.schema(page_changes.CHANGED).parquet(str(tmp_path / "out")), "source", "url", "content_hash", "run")
    assert got == sorted(batch_changes(history) + [(None, None, "n", 1)], key=repr)
