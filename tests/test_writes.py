import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recordloom.operators.batching import (
    BatchRule,
    BatchSizeError,
    assign_batches,
    payload_bytes,
    plan_batches,
    to_global_lines,
)
from recordloom.operators.changes import (
    changed_tables,
    delete_records,
    filter_ids,
    modified_since,
    table_diff,
)
from recordloom.operators.constraints import FieldRule, check_constraints, check_parts
from recordloom.operators.stats import update_pass, workload_records
from recordloom.operators.upsert import batch_report, check_result, line_errors, upsert


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(
        [(1, "k1", "Ready", 10.0), (2, "k2", "Running", 20.0), (3, "k3", None, None)],
        "id bigint, key string, status string, amount double",
    )


def _source(spark, lines, schema="line bigint, key string, status string, amount string"):
    return spark.createDataFrame(lines, schema)


def _lines(result):
    return {r.line: (r.action, r.record_id, r.errors) for r in result.lines.collect()}


def test_outcomes(spark, records):
    rules = [
        FieldRule("status", choices=["Ready", "Running", "Complete"], required=True),
        FieldRule("key", unique=True),
    ]
    source = _source(
        spark,
        [
            (1, "k1", "Ready", "10"),
            (2, "k2", "Complete", "20"),
            (3, "k9", "Ready", "1.5"),
            (4, "k8", "Nope", "1"),
            (5, "k1", "Running", "1"),
            (6, None, "Ready", "1"),
            (7, "k7", "Ready", "abc"),
            (8, "k6", "", "1"),
            (9, "k5", "Running", None),
        ],
    )
    result = upsert(records, source, "id", "key", rules=rules)
    lines = _lines(result)
    assert lines[1][:2] == ("unchanged", 1) and lines[2][:2] == ("updated", 2)
    assert lines[3][:2] == ("created", 4) and lines[9][:2] == ("created", 5)
    assert lines[4] == ("error", None, ["status: not an allowed choice"])
    assert lines[5] == ("error", None, ["key: already used on line 1"])
    assert lines[6][2] == ["key: the merge key is missing"]
    assert lines[7][2] == ["amount: not a valid double"]
    assert "status: a value is required" in lines[8][2]
    assert tuple(result.summary().first()) == (9, 2, 1, 1, 5, "partial")
    merged = {r.id: tuple(r)[1:] for r in result.merged.collect()}
    assert merged == {
        1: ("k1", "Ready", 10.0), 2: ("k2", "Complete", 20.0), 3: ("k3", None, None),
        4: ("k9", "Ready", 1.5), 5: ("k5", "Running", None),
    }
    assert result.returned(["amount"]).count() == 4
    assert line_errors(result.lines).where("line = 4").count() == 1
    assert check_result(result.lines, 9).count() == 0


def test_same_row_again(spark, records):
    first = upsert(records, _source(spark, [(1, "new", "Ready", "1")]), "id", "key")
    again = upsert(first.merged, _source(spark, [(1, "new", "Ready", "1")]), "id", "key")
    assert _lines(again)[1][:2] == ("unchanged", 4)
    changed = upsert(first.merged, _source(spark, [(1, "new", "Complete", "1")]), "id", "key")
    assert _lines(changed)[1][:2] == ("updated", 4)


def test_without_merge_key_and_empty(spark, records):
    result = upsert(records, _source(spark, [(2, "k1", "a", "1"), (1, "k1", "b", "2")]), "id")
    assert {k: v[:2] for k, v in _lines(result).items()} == {1: ("created", 4), 2: ("created", 5)}
    empty = upsert(records, _source(spark, []), "id", "key")
    assert empty.summary().first().outcome == "success" and empty.merged.count() == 3
    failed = upsert(records, _source(spark, [(1, None, "a", "1")]), "id", "key")
    assert failed.summary().first().outcome == "failed"
    with pytest.raises(ValueError, match="lacks the merge key"):
        upsert(records, _source(spark, []).drop("key"), "id", "key")


def test_unique_and_missing_required(spark, records):
    rules = [FieldRule("status", unique=True), FieldRule("amount", required=True)]
    source = _source(
        spark,
        [(1, "k1", "Running", "1"), (2, "k8", "New", "1"), (3, "k9", "New", "1"), (4, "k2", "Running", "2")],
    )
    lines = _lines(upsert(records, source, "id", "key", rules=rules))
    assert lines[1][0] == "error" and lines[3][0] == "error"
    assert lines[2][0] == "created"
    narrow = source.select("line", "key", "status")
    lines = _lines(upsert(records, narrow, "id", "key", rules=[FieldRule("amount", required=True)]))
    assert lines[2] == ("error", None, ["amount: a value is required"])
    assert lines[1][0] == "updated"


def test_absent_is_not_null(spark, records):
    source = spark.createDataFrame(
        [(1, "k1", None, None, ["key", "status"]), (2, "k2", None, None, ["key", "amount"])],
        "line bigint, key string, status string, amount double, has array<string>",
    )
    merged = upsert(records, source, "id", "key", present="has").merged
    found = {r.id: (r.status, r.amount) for r in merged.collect()}
    assert found[1] == (None, 10.0) and found[2] == ("Running", None)


def test_hot_merge_key(spark, records):
    """A third of all lines share one key: one wins, the rest are line errors."""
    source = spark.range(1, 3001).select(
        F.col("id").alias("line"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), "id")).alias("key"),
    )
    summary = upsert(records, source, "id", "key").summary().first()
    assert (summary.created, summary.failed_lines) == (2001, 999)


def test_workload_replay(spark):
    """Create, replay with every fifth record changed, replay again."""
    records = workload_records(spark.range(30), "id", "run").withColumnRenamed("index", "line")
    target = records.limit(0).drop("line").withColumn("Record ID#", F.lit(0).cast("bigint"))
    first = upsert(target, records, "Record ID#", "Fixture Key")
    assert first.summary().first().created == 30
    second = upsert(first.merged, update_pass(records, 5, "line"), "Record ID#", "Fixture Key")
    facts = second.summary().first()
    assert (facts.updated, facts.unchanged) == (6, 24)
    row = records.where("line = 1").first()
    assert (row["Fixture Key"], row["Amount"], row["Status"]) == ("run-00001", 2.5, "Running")


def _greedy(sizes, limit, envelope):
    """The sequential rule itself."""
    batches, used = [], None
    for line, size in sizes:
        if used is None or used + 2 + size > limit:
            batches.append([line, line, 0, 0])
            used = envelope + size
        else:
            used += 2 + size
        batches[-1][1:] = [line, batches[-1][2] + 1, used]
    return [(i, *b) for i, b in enumerate(batches, 1)]


@pytest.mark.parametrize("limit, block", [(100, 1 << 30), (100, 1), (60, 150)])
def test_batches_against_the_sequential_rule(spark, limit, block):
    rng = random.Random(limit + block)
    rows = []
    for shard, count in (("hot", 90), ("b", 17), ("one", 1)):
        rows += [(shard, 3 * i + 1, rng.choice([1, 7, 20, 20, 50])) for i in range(count)]
    df = spark.createDataFrame(rows, "shard string, line bigint, size bigint")
    rule = BatchRule("line", F.col("size"), ["shard"], 10, limit, block)
    plan = plan_batches(df, rule).collect()
    lines = assign_batches(df, rule).collect()
    for shard in ("hot", "b", "one"):
        sizes = [(line, size) for s, line, size in rows if s == shard]
        got = sorted(tuple(r)[1:] for r in plan if r.shard == shard)
        want = _greedy(sizes, limit, 10)
        assert got == want
        number = {line: n for n, start, end, *_ in want for line, _ in sizes if start <= line <= end}
        assert {r.line: r.batch_number for r in lines if r.shard == shard} == number


def test_equal_sizes_over_many_blocks(spark):
    df = spark.range(1, 121).select(F.col("id").alias("line"), F.lit(9).cast("bigint").alias("size"))
    rule = BatchRule("line", F.col("size"), max_bytes=47, block_bytes=1)
    plan = plan_batches(df, rule).orderBy("batch_number").collect()
    assert [(r.batch_number, *tuple(r)[1:]) for r in plan] == _greedy(
        [(i, 9) for i in range(1, 121)], 47, 0
    )


@pytest.mark.parametrize("block", [1, 256 << 20])
def test_lines_without_a_shard_are_a_shard(spark, block):
    rows = [(s, i, 5 + i % 7) for s in ("a", None, "b") for i in range(1, 60)]
    df = spark.createDataFrame(rows, "shard string, line bigint, size bigint")
    rule = BatchRule("line", F.col("size"), ["shard"], envelope_bytes=3, max_bytes=30, block_bytes=block)
    plan, lines = plan_batches(df, rule).collect(), assign_batches(df, rule).collect()
    assert len(lines) == len(rows)
    batches = {s: [tuple(r)[1:] for r in sorted(plan, key=lambda r: r.batch_number) if r.shard == s] for s in ("a", None, "b")}
    assert batches[None] == batches["a"] == batches["b"] and sum(b[3] for b in batches[None]) == 59


def test_batch_limits(spark):
    df = spark.createDataFrame([(1, "é"), (2, "x" * 50)], "line bigint, text string")
    assert [r[0] for r in df.select(payload_bytes(df, ["text"])).collect()] == [13, 61]
    with pytest.raises(BatchSizeError, match="position 2"):
        plan_batches(df, BatchRule("line", payload_bytes(df, ["text"]), max_bytes=40))
    for bad in (0, True, 1.5):
        with pytest.raises(ValueError):
            BatchRule("line", F.lit(1), max_bytes=bad)
    with pytest.raises(ValueError, match="envelope"):
        BatchRule("line", F.lit(1), envelope_bytes=10, max_bytes=5)
    assert plan_batches(df.limit(0), BatchRule("line", F.lit(1))).count() == 0


def test_batch_report(spark, records):
    source = _source(spark, [(i, f"k{i}", "Ready", "1") for i in range(1, 8)])
    rule = BatchRule("line", F.lit(10).cast("bigint"), max_bytes=40)
    plan, assigned = plan_batches(source, rule), assign_batches(source, rule)
    report = batch_report(upsert(records, source, "id", "key").lines, plan, assigned)
    got = [(r.batch_number, r.start_line, r.end_line, r.created, r.updated) for r in report.collect()]
    assert sorted(got) == [(1, 1, 3, 0, 3), (2, 4, 6, 3, 0), (3, 7, 7, 1, 0)]
    local = spark.createDataFrame([(2, 3), (3, 1)], "batch_number bigint, position bigint")
    rebased = to_global_lines(local, plan, "position")
    assert {r.global_line for r in rebased.collect()} == {6, 7}


def test_diff(spark, rows):
    before = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, None, 3)], "id bigint, s string, n int")
    after = spark.createDataFrame([(1, "a", 1), (2, "B", 9), (4, "d", 4)], "id bigint, s string, n int")
    assert table_diff(before, before, "id").count() == 0
    assert rows(table_diff(before, after, "id")) == [
        (2, "MODIFY", ["s", "n"]),
        (3, "DELETE", []),
        (4, "CREATE", []),
    ]
    assert table_diff(before, after, "id", ["s"]).where("record_id = 2").first()[2] == ["s"]
    detail = table_diff(before, after, "id", ["n"], include_details=True).where("record_id = 4").first()
    assert detail.before is None and detail.after.n == 4


def test_since_floors_to_the_second(spark):
    df = spark.createDataFrame(
        [(1, datetime(2026, 7, 18, 17, 30, 0, 100)), (2, datetime(2026, 7, 18, 17, 29, 59, 999999))],
        "id bigint, at timestamp_ntz",
    )
    found = modified_since(df, "at", "2026-07-18T12:30:00.987654-05:00", "id")
    assert [r.record_id for r in found.collect()] == [1]
    with pytest.raises(ValueError, match="timezone"):
        modified_since(df, "at", datetime(2026, 1, 1), "id")
    report = changed_tables({"t": df}, {"t": "at"}, "2026-07-18T17:30:00Z").first()
    assert tuple(report) == ("t", 1, True)
    with pytest.raises(RuntimeError, match="t"):
        changed_tables({"t": df}, {"t": "at"}, "2026-07-18T17:30:00Z", fail=True)


def test_delete(records):
    result = delete_records(records, [1, 1, 99], "id")
    assert result.number_deleted().first()[0] == 1 and result.kept.count() == 2
    by_status = delete_records(records, lambda w: w.eq("status", "ready"))
    assert by_status.kept.count() == 2
    for bad in (None, 5):
        with pytest.raises(ValueError):
            delete_records(records, bad)
    assert filter_ids(records, "id", [2, 3]).count() == 2
    assert filter_ids(records, "id", range(1, 500)).count() == 3


def test_constraints(spark, records):
    bad = records.union(spark.createDataFrame([(1, "k1", "", 1.0), (None, "k5", "x", 2.0)], records.schema))
    rules = [
        FieldRule("key", unique=True),
        FieldRule("STATUS", required=True, choices=["Ready", "Running", ""]),
    ]
    found = {(r.field, r.rule): r.violations for r in check_constraints(bad, "id", rules).collect()}
    assert found == {
        ("id", "null key"): 1, ("id", "positive key"): 0, ("id", "unique key"): 2,
        ("key", "unique"): 2, ("status", "required"): 2, ("status", "choice"): 1,
    }
    parts = check_parts({"a": records, "b": records.withColumnRenamed("key", "k")}, {"a": 3, "b": 4})
    assert {r.part: (r.same_fields, r.same_count) for r in parts.collect()} == {
        "a": (True, True),
        "b": (False, False),
    }


def test_shared_and_repeated_keys(spark, records):
    """A key on most lines, lines without a key, and a key that two records of the target hold."""
    target = records.unionByName(spark.createDataFrame([(4, "k2", "Ready", 1.0)], records.schema))
    source = _source(spark, [(1, "k2", "Ready", "1")] + [(i, "k1" if i % 3 else None, "Ready", "1") for i in range(2, 60)] + [(60, "k9", "Ready", "1")])
    result = upsert(target, source, "id", "key")
    lines = _lines(result)
    assert len(lines) == 60 and lines[1] == ("error", None, ["key: several records have this key"])
    assert lines[2][:2] == ("updated", 1) and lines[60][:2] == ("created", 5)
    assert all(lines[i] == ("error", None, ["key: already used on line 2"]) for i in range(4, 60) if i % 3)
    assert all(lines[i] == ("error", None, ["key: the merge key is missing"]) for i in range(3, 60, 3))
    assert result.merged.count() == 5


def test_few_and_many_ids_delete_the_same(spark, records, monkeypatch):
    from recordloom.operators import changes

    few = delete_records(records, [1, 3, 99], "id")
    monkeypatch.setattr(changes, "FEW_IDS", 0)
    many = delete_records(records, [1, 3, 99], "id")
    for a, b in ((few.kept, many.kept), (few.deleted, many.deleted)):
        assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str)
    assert few.deleted.count() == 2


def test_commits(spark, records, tmp_path):
    from recordloom.operators import commits

    path = str(tmp_path / "table")
    records.write.parquet(path)
    source = _source(spark, [(1, "k1", "Ready", "11"), (2, "k9", "Ready", "1")])
    first = commits.commit_upsert(spark, path, source, "id", "one", merge_on="key")
    assert {r.action for r in first.collect()} == {"updated", "created"}
    assert commits.commit_upsert(spark, path, source, "id", "one", merge_on="key") is None
    assert spark.read.parquet(path).count() == 4
    assert commits.commit_delete(spark, path, [1, 2], "id", "two") == 2
    assert commits.commit_delete(spark, path, [3], "id", "two") is None
    assert spark.read.parquet(path).count() == 2
    broken = source.withColumn("amount", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        commits.commit_upsert(spark, path, broken, "id", "three", merge_on="key")
    assert spark.read.parquet(path).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["table"]


def test_staged_tables_have_an_owner(spark, records):
    from recordloom.session import exists, scratch_path, stage, staging

    outside = scratch_path(spark, "outside")
    records.write.parquet(outside)
    with staging(spark):
        inside = scratch_path(spark, "inside")
        records.write.parquet(inside)
        staged = stage(records, "kept")
        file = staged.inputFiles()[0]
    assert exists(spark, outside) and not exists(spark, inside) and not exists(spark, file)
