"""Hash trees, daily state and totals over ranges."""

import glob
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from noticeworks import session
from noticeworks.operators import daily_state, hash_trees, ordering, quality


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def tree(spark, pages, path):
    return hash_trees.build(spark.createDataFrame(pages, "source string, pos long, content string"), str(path))


def test_changes_are_found_by_descending(spark, tmp_path):
    rng = random.Random(6)
    old = {("hot", p): f"c{p}" for p in range(0, 9000, 3)} | {("b", p): "same" for p in range(40)} | {("gone", 5): "x", ("one", 0): "y"}
    new = dict(old)
    del new["gone", 5]
    for p in rng.sample(range(0, 9000, 3), 5):
        new["hot", p] = "other"
    for p in rng.sample(range(0, 9000, 3), 3):
        new.pop(("hot", p), None)
    new["b", 0], new["b", 39], new["hot", 70_000], new["one", 1] = "swapped", None, "far", ""
    a = tree(spark, [(*k, c) for k, c in old.items()], tmp_path / "a")
    b = tree(spark, [(*k, c) for k, c in new.items()], tmp_path / "b")
    want = sorted([(s, p, "added" if (s, p) not in old else "removed" if (s, p) not in new else "changed")
                   for s, p in old.keys() | new.keys() if old.get((s, p), ()) != new.get((s, p), ())])
    assert (a.top, b.top) == (4, 5)
    for left, right, swap in ((a, b, {}), (b, a, {"added": "removed", "removed": "added"})):
        got = rows(hash_trees.changed_positions(left, right), "source", "pos", "change")
        assert got == sorted(((s, p, swap.get(c, c)) for s, p, c in want), key=repr)
    assert hash_trees.changed_positions(a, a).count() == 0


def test_lower_levels_are_read_by_bucket(spark, tmp_path):
    old = [("hot", p, "c") for p in range(0, 200_000, 50)]
    a, b = tree(spark, old, tmp_path / "a"), tree(spark, [*old[1:], ("hot", 0, "d")], tmp_path / "b")
    found = hash_trees.changed_positions(a, b)
    assert rows(found, "source", "pos", "change") == [("hot", 0, "changed")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = [line.split("PartitionFilters: ")[1].split("]")[0] for line in plan.splitlines() if "PartitionFilters: [" in line]
    scans = [f for f in filters if "bucket" in f]
    assert len(scans) == 2 and not any(" IN " in f for f in scans)  # one bucket of each tree
    assert len(glob.glob(str(tmp_path / "a/level=0/*/*.parquet"))) > 20


def test_order_and_odd_pages(spark, tmp_path):
    a = tree(spark, [("s", 0, "x"), ("s", 1, "y"), (None, 1, "z"), ("s", None, "z")], tmp_path / "a")
    b = tree(spark, [("s", 1, "x"), ("s", 0, "y"), ("s", 0, "y")], tmp_path / "b")
    assert a.top == b.top == 1 and rows(a.roots(), "source", "root") != rows(b.roots(), "source", "root")
    c = tree(spark, [("s", 0, None), ("t", 0, "")], tmp_path / "c")
    assert c.top == 0 and len({r[0] for r in c.roots().select("root").collect()}) == 1
    none = tree(spark, [], tmp_path / "none")
    assert none.roots().count() == 0
    assert rows(hash_trees.changed_positions(none, c), "source", "change") == [("s", "added"), ("t", "added")]


OBS = "source string, ts timestamp_ntz, event string"


def observations(spark, days, seed=1, n=60):
    rng = random.Random(seed)
    made = [(rng.choice(["a", "b", "c"]), f"2026-05-{rng.choice(days):02d} 12:00:00", f"e{rng.randrange(40)}") for _ in range(n)]
    return spark.createDataFrame(made, "source string, t string, event string").select("source", F.col("t").cast("timestamp_ntz").alias("ts"), "event")


def test_state_equals_a_full_scan_with_late_and_repeated_runs(spark, tmp_path):
    path = str(tmp_path / "state")
    runs = {"r1": observations(spark, [1, 2, 3], 1), "r2": observations(spark, [4, 5], 2), "late": observations(spark, [2, 5, 6], 3)}
    for run_id in ("r1", "r2", "r2", "late", "r1"):
        daily_state.add_run(runs[run_id], path, run_id, key="event")
    every = runs["r1"].unionByName(runs["r2"]).unionByName(runs["late"]).unionByName(spark.createDataFrame([("a", None, "x")], OBS))
    state = daily_state.read(spark, path)
    assert rows(daily_state.daily_counts(state), "source", "day", "n") == rows(quality.count_per_source_day(every), "source", "day", "n")
    assert rows(quality.source_baseline(daily_state.daily_counts(state)), "source", "avg_records", "last_day", "run_count") == rows(
        quality.source_baseline(quality.count_per_source_day(every)), "source", "avg_records", "last_day", "run_count")
    assert rows(daily_state.distinct_keys(state), "source", "keys") == rows(
        every.where("ts is not null").groupBy("source").agg(F.count_distinct("event").alias("keys")), "source", "keys")


def test_a_run_touches_its_own_days_and_a_reader_the_asked_ones(spark, tmp_path):
    path = str(tmp_path / "state")
    daily_state.add_run(observations(spark, [1, 2, 3]), path, "r1")
    before = set(glob.glob(f"{path}/*/*/*.parquet"))
    daily_state.add_run(observations(spark, [3, 4]), path, "r2")
    after = set(glob.glob(f"{path}/*/*/*.parquet"))
    assert before < after and all("run_id=r2" in f for f in after - before)
    part = daily_state.read(spark, path, first=date(2026, 5, 3), last=date(2026, 5, 3))
    assert {r["run_id"] for r in part.collect()} == {"r1", "r2"}
    scan = part._jdf.queryExecution().executedPlan()
    filters = next(line for line in scan.toString().splitlines() if "PartitionFilters" in line)
    assert "day" in filters.split("PartitionFilters")[1] and len(part.inputFiles()) > 0
    sources = spark.createDataFrame([("a",), ("b",)], "name string")
    assert tuple(daily_state.coverage(daily_state.read(spark, path), sources, date(2026, 5, 5), 2).first()) == (3, 2, 150.0)


@pytest.mark.parametrize("pieces", [1, 7])
def test_one_long_run_is_shared_and_sums_are_right(spark, pieces):
    rng = random.Random(2)
    tasks = [(None if rng.random() < 0.1 else "all", rng.choice([None, 1, 2]), i, rng.choice([None, 1, 2, 5])) for i in range(500)]
    df = spark.createDataFrame(tasks, "run string, priority int, id int, cost int")
    got = ordering.ranged_total(df, ["run"], ["priority", "id"], "cost", "before", pieces)
    want, sums = [], {}
    for run, priority, i, cost in sorted(tasks, key=lambda t: (t[0] or "", -1 if t[1] is None else t[1], t[2])):
        want.append((i, sums.get(run, 0)))
        sums[run] = sums.get(run, 0) + (cost or 0)
    assert rows(got, "id", "before") == sorted(want, key=repr)


def test_every_piece_gets_a_part_of_one_run(spark):
    df = spark.range(10_000).select(F.lit("all").alias("run"), "id", F.lit(1).alias("cost"))
    dealt = df.repartitionByRange(8, "run", "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == 8 and max(r["count"] for r in dealt) < 2_000
    got = ordering.budget_cutoff(df.withColumn("max_cost", F.lit(1)), 6_000, ["run"], ["id"])
    assert got.where("status = 'run'").count() == 6_000


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Cluster:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Cluster)
