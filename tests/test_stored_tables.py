"""Tables laid out by key, and the archive of runs."""

import pytest

from noticeworks.operators import archive, keyed_tables, loading

SCHEMA = "place string, nr string, value string, arrival int, note string"


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.fixture
def laid_out(spark, tmp_path):
    stored = spark.createDataFrame(
        [(f"p{i % 7}", str(i), f"old{i}", i, "n") for i in range(200)] + [(None, "1", "x", 900, "n"), ("p", None, "y", 901, "n")], SCHEMA)
    return stored, keyed_tables.create(stored, str(tmp_path / "t"), ["place", "nr"], 32)


def test_merge_equals_upsert_and_leaves_other_files(spark, laid_out):
    stored, table = laid_out
    batch = spark.createDataFrame(
        [("p3", "3", "new", 1000), ("p3", "3", "newer", 1001), ("q", "7", "added", 1002), (None, "1", "z", 1003), (None, "1", "z", 1003)],
        "place string, nr string, value string, arrival int")
    before = table.files()
    swapped = keyed_tables.merge(table, batch, ["arrival"])
    after = table.files()
    want = loading.upsert_merge(stored, batch, ["place", "nr"], ["arrival"])
    assert rows(table.read(), *stored.columns) == rows(want, *stored.columns)
    assert 1 <= len(swapped) <= 2
    assert all(before[b] == after[b] for b in before if b not in swapped and b != keyed_tables.NO_KEY)
    assert all(not before.get(b, {}).keys() & after[b].keys() for b in swapped)
    assert before[keyed_tables.NO_KEY].items() <= after[keyed_tables.NO_KEY].items()
    parts = [s for s in table.part(swapped)._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in s]
    assert parts and "_bucket" in parts[0].split("PartitionFilters")[1]


def test_merge_repeated_and_empty(spark, laid_out):
    stored, table = laid_out
    batch = spark.createDataFrame([("p1", "1", "again", 1000)], "place string, nr string, value string, arrival int")
    keyed_tables.merge(table, batch, ["arrival"])
    once = rows(table.read(), *stored.columns)
    keyed_tables.merge(table, batch, ["arrival"])
    assert rows(table.read(), *stored.columns) == once
    before = table.files()
    assert keyed_tables.merge(table, batch.limit(0), ["arrival"]) == []
    assert table.files() == before


def test_rewrite_may_empty_a_bucket(spark, laid_out):
    stored, table = laid_out
    gone = stored.where("nr is not null and place is not null")
    keyed_tables.rewrite(table, gone, lambda old: old.join(gone.select("place", "nr"), ["place", "nr"], "left_anti").select(*stored.columns))
    assert rows(table.read(), "arrival") == [(900,), (901,)]
    assert set(table.files()) == {keyed_tables.NO_KEY}


def test_update_and_fix_plan(spark, tmp_path):
    configs = spark.createDataFrame([(i, f"n{i}", i % 2 == 0) for i in range(50)], "id int, name string, approved boolean")
    table = keyed_tables.create(configs, str(tmp_path / "c"), ["id"], 8)
    deletions = spark.createDataFrame([(3,), (4,), (99,)], "id int")
    renames = spark.createDataFrame([(5, "fem"), (98, "x")], "id int, new_name string")
    keyed_tables.apply_fix_plan(table, deletions, renames)
    want = loading.apply_fix_plan(configs, deletions, renames)
    assert rows(table.read(), *configs.columns) == rows(want, *configs.columns)
    updates = spark.createDataFrame([(6, "sex"), (6, "aaa"), (3, "gone")], "id int, name string")
    keyed_tables.update(table, updates, "name")
    assert rows(table.read(), *configs.columns) == rows(loading.update_by_key(want, updates, "id", "name"), *configs.columns)


def test_a_table_is_created_once(spark, laid_out):
    stored, table = laid_out
    with pytest.raises(Exception, match="already exists"):
        keyed_tables.create(stored, table.path, ["place", "nr"], 32)


def test_archive_gives_every_run_back_and_keeps_contents_once(spark, tmp_path):
    path = str(tmp_path / "archive")
    first = spark.createDataFrame(
        [("a", "u1", "<p>å\r\n\x00</p>"), ("a", "u2", ""), ("b", "u1", "<p>å\r\n\x00</p>"), ("b", "u9", None)], "source string, url string, content string")
    found = spark.createDataFrame([("a", "u1", 1, None), ("a", "u1", 2, 0.5)], "source string, url string, pos int, cost double")
    items = archive.page_items(first).unionByName(archive.row_items(found, "source", "url", "pos"))
    archive.archive_run(items, path, "monday")
    archive.archive_run(items, path, "tuesday")
    changed = archive.page_items(first.where("url <> 'u2'").unionByName(spark.createDataFrame([("a", "u2", "now")], first.schema)))
    archive.archive_run(changed, path, "wednesday")
    columns = ["kind", "source", "name", "part", "content"]
    for run_id, given in (("monday", items), ("tuesday", items), ("wednesday", changed)):
        assert rows(archive.rebuild(spark, path, run_id), *columns) == rows(given, *columns)
    assert [r[2] for r in rows(archive.rebuild(spark, path, "monday").where("kind = 'row'"), "kind", "part", "content")] == [
        '{"source":"a","url":"u1","pos":1,"cost":null}', '{"source":"a","url":"u1","pos":2,"cost":0.5}']
    assert rows(archive.run_sizes(spark, path), "run_id", "items", "blobs_added") == [("monday", 5, 4), ("tuesday", 5, 0), ("wednesday", 3, 1)]


def test_a_repeated_run_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "archive")
    items = archive.page_items(spark.createDataFrame([("a", "u", "x"), ("a", "v", "y")], "source string, url string, content string"))
    archive.archive_run(items, path, "r")
    archive.archive_run(items, path, "r")
    assert archive.blobs(spark, path).count() == 2 and archive.manifest(spark, path).count() == 2
    assert archive.rebuild(spark, path, "never").count() == 0
    assert archive.run_sizes(spark, str(tmp_path / "none")).count() == 0


def test_a_run_over_stored_contents_moves_hashes_only(spark, tmp_path):
    """Contents that are stored already are not shuffled; hashes are 32 bytes, not 64 digits."""
    path = str(tmp_path / "archive")
    items = archive.page_items(spark.createDataFrame([("a", f"u{i}", f"text {i % 50}") for i in range(200)], "source string, url string, content string"))
    archive.archive_run(items, path, "r")
    assert archive.blobs(spark, path).count() == 50 and {len(r["hash"]) for r in archive.blobs(spark, path).collect()} == {32}
    again = archive.missing_blobs(items, archive.blobs(spark, path), "s")
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert again.count() == 0 and "LeftSemi, BuildRight" in plan and "LeftAnti" not in plan
