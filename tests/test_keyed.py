"""Tables with file manifests: commits by file, crashes at every step, batches with a journal."""

import json

import pytest
from pyspark.sql import functions as F

from recordloom.operators import commits, journal
from recordloom.operators.batching import BatchRule
from recordloom.operators.commits import commit_delete_files, commit_upsert_files
from recordloom.operators.constraints import FieldRule
from recordloom.operators.journal import BatchError, execute_batches
from recordloom.session import file_names
from recordloom.sources import keyed
from recordloom.sources.keyed import CommitError, KeyedTable


@pytest.fixture
def stored(spark, tmp_path):
    df = spark.range(1, 101).select(F.col("id"), F.concat(F.lit("v"), "id").alias("v"), (F.col("id") % 7).alias("n"))
    return KeyedTable.create(df, str(tmp_path / "data" / "t"), "id", file_rows=10)


def lines(spark, rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows, 1)], "line bigint, id bigint, v string")


def state(table):
    return {row["id"]: row["v"] for row in table.read().collect()}


def test_layout_and_versions(spark, stored):
    assert [tuple(r)[1:] for r in stored.manifest().orderBy("low").collect()] == [(i * 10 + 1, i * 10 + 10, 10) for i in range(10)]
    assert stored.read().columns == ["id", "v", "n"] and stored.read().count() == 100
    source = lines(spark, [(5, "five"), (6, "v6"), (95, "x"), (200, "new"), (150, "other")])
    after, result = commit_upsert_files(stored, source, "a", merge_on="id")
    assert {r["line"]: r["action"] for r in result.collect()} == {1: "updated", 2: "unchanged", 3: "updated", 4: "created", 5: "created"}
    v = after.version
    assert (v.number, v.kept, v.rewritten, v.added, v.dropped, v.rows, v.commits) == (1, 8, 2, 1, 0, 102, ("a",))
    want = {i: f"v{i}" for i in range(1, 101)} | {5: "five", 95: "x", 200: "new", 150: "other"}
    assert state(after) == want and state(KeyedTable.open(spark, stored.path)) == want
    assert state(stored) == {i: f"v{i}" for i in range(1, 101)}, "the older version is still readable"
    assert commit_upsert_files(after, source, "a", merge_on="id") == (after, None)
    before = {r["path"] for r in stored.manifest().collect()}
    assert len(before & {r["path"] for r in after.manifest().collect()}) == 8
    # created records overlap the ranges of files: found in the second layer
    again, result = commit_upsert_files(after, lines(spark, [(150, "o2"), (7, "seven")]), merge_on="id")
    assert (again.version.kept, again.version.rewritten) == (9, 2)
    assert state(again) == want | {150: "o2", 7: "seven"}
    assert again.history().count() == 3
    assert again.vacuum() > 0 and state(KeyedTable.open(spark, stored.path)) == state(again)
    with pytest.raises(FileNotFoundError):
        KeyedTable.open(spark, stored.path, 0)


def test_files_beyond_the_keys_are_not_read(spark, stored):
    for row in stored.manifest().where("low > 40").collect():
        (stored_path := stored.path + "/" + row["path"])
        with open(stored_path, "wb") as file:
            file.write(b"no parquet")
    after, _ = commit_upsert_files(stored, lines(spark, [(5, "five"), (38, "x")]), merge_on="id")
    assert after.version.rewritten == 2 and after.version.kept == 8


def test_merge_on_another_field_and_errors(spark, stored):
    source = spark.createDataFrame([(1, "v3", 9), (2, "v88", 4), (3, "fresh", 5), (4, None, 1)], "line bigint, v string, n bigint")
    after, result = commit_upsert_files(stored, source, merge_on="v", rules=[FieldRule("n", choices=["9", "4", "5"])])
    assert {r["line"]: (r["action"], r["record_id"]) for r in result.collect()} == {
        1: ("updated", 3), 2: ("unchanged", 88), 3: ("created", 101), 4: ("error", None),
    }
    assert (after.version.kept, after.version.rewritten, after.version.added) == (9, 1, 1)
    same, result = commit_upsert_files(after, source.where("line = 2"), merge_on="v")
    assert same == after and result.first()["action"] == "unchanged"


def test_deletes(spark, stored):
    after, n = commit_delete_files(stored, [3, 4, 999])
    assert n == 2 and (after.version.kept, after.version.rewritten) == (9, 1)
    after, n = commit_delete_files(after, lambda w: w.greater_than("id", 80), "d")
    assert n == 20 and (after.version.kept, after.version.rewritten, after.version.dropped, after.version.rows) == (8, 0, 2, 78)
    assert commit_delete_files(after, [1], "d") == (after, None)
    assert commit_delete_files(after, [3])[1] == 0
    assert sorted(state(after)) == [1, 2, *range(5, 81)]
    gone, n = commit_delete_files(after, lambda w: w.greater_than("id", 0))
    assert n == 78 and state(gone) == {} and gone.version.rows == 0
    filled, _ = commit_upsert_files(gone, lines(spark, [(1, "a")]), merge_on="id")
    assert state(filled) == {1: "a"}


def test_a_crash_at_any_step_leaves_the_old_or_the_new_table(spark, stored, monkeypatch):
    source = lines(spark, [(5, "five"), (300, "new")])
    old = state(stored)
    new = old | {5: "five", 300: "new"}
    steps = {(keyed, "write_text"): 0, (keyed, "move_new"): 0, (KeyedTable, "_write"): 0, (KeyedTable, "_publish"): 0}
    for owner, name in steps:
        real = getattr(owner, name)

        def crash(*args, **kwargs):
            raise OSError("the driver died")

        monkeypatch.setattr(owner, name, crash)
        with pytest.raises(OSError):
            commit_upsert_files(stored, source, "c", merge_on="id")
        monkeypatch.setattr(owner, name, real)
        assert state(KeyedTable.open(spark, stored.path)) == old
    real = KeyedTable._publish

    def late(self, *args, **kwargs):
        real(self, *args, **kwargs)
        raise OSError("the driver died after the last step")

    monkeypatch.setattr(KeyedTable, "_publish", late)
    with pytest.raises(OSError):
        commit_upsert_files(stored, source, "c", merge_on="id")
    monkeypatch.setattr(KeyedTable, "_publish", real)
    now = KeyedTable.open(spark, stored.path)
    assert state(now) == new
    assert commit_upsert_files(now, source, "c", merge_on="id")[1] is None
    folders = len(file_names(spark, f"{stored.path}/data"))
    assert now.vacuum(2) > 0 and len(file_names(spark, f"{stored.path}/data")) < folders and state(now) == new


def test_two_writers_from_one_version(spark, stored):
    commit_upsert_files(stored, lines(spark, [(5, "first")]), merge_on="id")
    with pytest.raises(CommitError, match="another commit"):
        commit_upsert_files(stored, lines(spark, [(5, "second")]), merge_on="id")
    assert state(KeyedTable.open(spark, stored.path))[5] == "first"


def test_rows_are_counted_while_written(spark, stored):
    with pytest.raises(CommitError, match="100 rows were written where 99 belong"):
        stored.rewrite([], None, None, 99)
    with pytest.raises(CommitError, match="there is a table"):
        KeyedTable.create(stored.read(), stored.path, "id")
    empty = KeyedTable.create(stored.read().limit(0), stored.path + "-empty", "id")
    assert empty.read().count() == 0 and empty.version.rows == 0


def rule():
    """Three lines a batch."""
    return BatchRule("line", F.lit(10).cast("bigint"), max_bytes=34)


def test_batches_in_order_until_one_is_refused(spark, stored):
    source = lines(spark, [(i, f"new{i}") for i in range(96, 108)])
    bad = F.col("id") == 103
    with pytest.raises(BatchError) as caught:
        execute_batches(stored, source, rule(), "run", refuse=bad, merge_on="id")
    report = {r["batch_number"]: r for r in caught.value.journal.report().collect()}
    assert {n: (r["status"], r["start_line"], r["end_line"]) for n, r in report.items()} == {
        1: ("completed", 1, 3), 2: ("completed", 4, 6), 3: ("failed", 7, 9),
    }
    assert (report[1]["updated"], report[1]["created"], report[2]["created"], report[3]["created"]) == (3, 0, 1, None)
    assert "refused" in report[3]["error"]
    now = KeyedTable.open(spark, stored.path)
    assert state(now)[101] == "new101" and 102 not in state(now)
    done, log = execute_batches(now, source, rule(), "run", merge_on="id")
    assert [r["status"] for r in log.report().collect()] == ["completed"] * 4
    assert log.totals().first()[:5] == (12, 7, 5, 0, 0)
    whole, _ = commit_upsert_files(stored_copy := KeyedTable.create(stored.read(), stored.path + "-2", "id", 10), source, merge_on="id")
    assert state(done) == state(whole) and stored_copy.version.number == 0
    again, _ = execute_batches(done, source, rule(), "run", merge_on="id")
    assert again.version == done.version


def test_the_first_error_is_raised_as_it_is(spark, stored):
    with pytest.raises(CommitError, match="refused line"):
        execute_batches(stored, lines(spark, [(1, "x")]), rule(), "r", refuse=F.lit(True), merge_on="id")
    with pytest.raises(ValueError, match="one sequence"):
        execute_batches(stored, lines(spark, [(1, "x")]), BatchRule("line", F.lit(1), ["v"]), "s", merge_on="id")


@pytest.mark.parametrize("after_the_commit", [False, True])
def test_an_uncertain_batch_is_repeated_without_doubling(spark, stored, after_the_commit):
    source = lines(spark, [(i, f"new{i}") for i in range(98, 107)])
    calls = []

    def unreliable(table, *args, **kwargs):
        calls.append(kwargs["commit_id"])
        if len(calls) == 2:
            if after_the_commit:
                commit_upsert_files(table, *args, **kwargs)
            raise OSError("connection lost")
        return commit_upsert_files(table, *args, **kwargs)

    with pytest.raises(BatchError) as caught:
        execute_batches(stored, source, rule(), "run", commit=unreliable, merge_on="id")
    assert [r["status"] for r in caught.value.journal.report().collect()] == ["completed", "uncertain"]
    now = KeyedTable.open(spark, stored.path)
    assert (102 in state(now)) == after_the_commit
    done, log = execute_batches(now, source, rule(), "run", merge_on="id")
    assert [r["status"] for r in log.report().collect()] == ["completed"] * 3
    assert state(done) == {i: f"v{i}" for i in range(1, 98)} | {i: f"new{i}" for i in range(98, 107)}
    assert done.version.rows == 106 and len(done.version.commits) == 3


def test_a_journal_begun_before_the_crash_is_known(spark, stored, monkeypatch):
    source = lines(spark, [(i, "z") for i in range(1, 6)])
    real, texts = journal.write_text, []

    def dies(spark_, path, text):
        if path.endswith("000000000001.json") and texts:
            raise KeyboardInterrupt
        texts.append(json.loads(text))
        real(spark_, path, text)

    monkeypatch.setattr(journal, "write_text", dies)
    with pytest.raises(KeyboardInterrupt):
        execute_batches(stored, source, rule(), "run", merge_on="id")
    monkeypatch.setattr(journal, "write_text", real)
    done, log = execute_batches(KeyedTable.open(spark, stored.path), source, rule(), "run", merge_on="id")
    assert [r["status"] for r in log.report().collect()] == ["completed"] * 2 and state(done)[5] == "z"


def test_a_crash_inside_publish_is_mended(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "id bigint, v string").write.parquet(path)
    import os

    os.rename(path, f"{path}.{'0' * 32}.old")
    assert commits.commit_delete(spark, path, [5], "id") == 0
    assert spark.read.parquet(path).count() == 1


def test_difference_by_digests_reads_only_changed_ranges(spark, tmp_path):
    from recordloom.operators.changes import table_diff
    from recordloom.operators.digests import changed_ranges, diff_by_digest, digest_tree

    df = spark.range(0, 4000).select("id", (F.col("id") % 9).alias("a"), F.when(F.col("id") % 5 > 0, F.lit("x")).alias("b"))
    before = KeyedTable.create(df, str(tmp_path / "t"), "id", file_rows=100)
    source = spark.createDataFrame([(1, 1205, 7, "y"), (2, 1206, None, "x"), (3, 9000, 1, "new")], "line bigint, id bigint, a bigint, b string")
    after, _ = commit_upsert_files(before, source, merge_on="id")
    after, _ = commit_delete_files(after, [3001])
    trees = [digest_tree(t.read(), "id", leaf_bits=4) for t in (before, after)]
    assert trees[0].agg(F.max("level")).first()[0] == 0, "few leaves need no level above"
    ranges = changed_ranges(*trees)
    assert ranges == [(1200, 1215), (2992, 3007), (8992, 9007)]
    want = sorted(map(tuple, table_diff(before.read(), after.read(), "id").collect()))
    assert len(want) == 4
    for row in before.manifest().where("NOT (low <= 1215 AND high >= 1200) AND NOT (low <= 3007 AND high >= 2992)").collect():
        with open(f"{before.path}/{row['path']}", "wb") as file:
            file.write(b"no parquet")
    found = diff_by_digest(before.read(ranges), after.read(ranges), "id", *trees)
    assert sorted(map(tuple, found.collect())) == want


@pytest.mark.parametrize("most", [1, 3, 256])
def test_digest_trees_of_many_levels(spark, most):
    from recordloom.operators import digests
    from recordloom.operators.changes import table_diff

    before = spark.range(-3000, 3000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("a"), F.lit(None).cast("bigint").alias("b"))
    swapped = F.col("id").isin(-2999, 0, 9, 2500)
    after = before.select("id", F.when(swapped, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swapped, F.col("a")).alias("b"))
    real, digests.FEW_RANGES = digests.FEW_RANGES, 4
    try:
        trees = [digests.digest_tree(df, "id", leaf_bits=1) for df in (before, after.where("id != 77"))]
    finally:
        digests.FEW_RANGES = real
    assert trees[0].agg(F.max("level")).first()[0] >= 2
    ranges = digests.changed_ranges(*trees, most)
    assert 1 <= len(ranges) <= most
    after = after.where("id != 77")
    want = sorted(map(tuple, table_diff(before, after, "id").collect()))
    # a null that moved to another field is a change: 0 and 9 hold values, -2999 and 2500 hold none
    assert [w[0] for w in want] == [0, 9, 77]
    inside = digests.in_ranges(F.col("id"), ranges)
    assert sorted(map(tuple, table_diff(before.where(inside), after.where(inside), "id").collect())) == want
    assert digests.changed_ranges(trees[0], trees[0]) == []
    none = before.limit(0)
    assert digests.changed_ranges(digests.digest_tree(none, "id"), digests.digest_tree(none, "id")) == []
    assert digests.diff_by_digest(none, before, "id", digests.digest_tree(none, "id"), trees[0]).count() == 6000


def test_many_files_are_read_by_folder(spark, tmp_path):
    df = spark.range(1, 601).select(F.col("id"), F.lit("v").alias("v"))
    stored = KeyedTable.create(df, str(tmp_path / "t"), "id", file_rows=5)
    place = str(tmp_path / "t" / "data")
    assert len(file_names(spark, place)) == 1, "all files of one write stand in one folder"
    paths = [r["path"] for r in stored.manifest().orderBy("low").collect()]
    assert len(paths) == 120 and stored._scan(paths)[1] is None
    # one folder is listed, not each file by its name
    listed = stored.read()._jdf.queryExecution().optimizedPlan().toString()
    assert listed.count("Relation") == 1
    roots = stored._scan(paths)[0]._jdf.queryExecution().analyzed().collectLeaves().head().relation().location().rootPaths()
    assert roots.size() == 1
    gaps = [path for i, path in enumerate(paths[20:100]) if i % 4]
    assert {r["id"] for r in stored._read(gaps).collect()} == {i for i in range(101, 501) if (i - 101) // 5 % 4}
    assert {r["id"] for r in stored._read(paths[::10]).collect()} == {i for i in range(1, 601) if (i - 1) // 5 % 10 == 0}
    assert stored.with_files(gaps).groupBy("_file").count().where("count = 5").count() == len(gaps)
    after, n = commit_delete_files(stored, spark.range(101, 501, 5).toDF("id"))
    assert n == 80 and (after.version.kept, after.version.rewritten) == (40, 80)
    assert after._read([r["path"] for r in after.manifest().where("rows = 4").collect()]).count() == 320
    for path in (*paths[:20], *paths[100:]):
        with open(f"{stored.path}/{path}", "wb") as file:
            file.write(b"no parquet")
    assert stored._read(paths[20:100]).agg(F.min("id"), F.max("id"), F.count("id")).first()[:] == (101, 500, 400)


def test_values_of_all_kinds_stay_as_they_are(spark, tmp_path):
    values = """
        SELECT k, date'0001-01-03' AS d, timestamp'1500-01-01 00:00:00.000001' AS t, timestamp_ntz'1969-12-31 23:59:59' AS n,
               cast('12345678901234567.89' AS decimal(38, 2)) AS e, X'00ff' AS b, array(1, null) AS a, map('x', 1.5D) AS m,
               named_struct('p', 'q', 'z', cast(null AS int)) AS s, cast('nan' AS float) AS f, cast(null AS string) AS u
        FROM VALUES ('a'), ('é'), ('Z'), ('😀'), ('ￜ') AS v(k)
    """
    df = spark.sql(values)
    stored = KeyedTable.create(df, str(tmp_path / "t"), "k", file_rows=2)
    assert sorted(map(repr, stored.read().collect())) == sorted(map(repr, df.collect()))
    assert stored.read().schema.simpleString() == df.schema.simpleString()
    ranges = [tuple(r)[1:] for r in stored.manifest().orderBy("low").collect()]
    assert ranges == [("Z", "a", 2), ("é", "ￜ", 2), ("😀", "😀", 1)]
    dated = KeyedTable.create(df.select("d", "u").limit(1), str(tmp_path / "d"), "d")
    assert dated.manifest().first()["low"] == df.first()["d"]


def test_files_larger_than_a_batch(spark, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        stored = KeyedTable.create(spark.range(0, 100), str(tmp_path / "t"), "id", file_rows=30)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [tuple(r)[1:] for r in stored.manifest().orderBy("low").collect()] == [(0, 29, 30), (30, 59, 30), (60, 89, 30), (90, 99, 10)]
    assert stored.read().agg(F.sum("id"), F.count("id")).first()[:] == (4950, 100)
