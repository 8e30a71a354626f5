from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordloom.operators.constraints import FieldRule, safe_cast
from recordloom.operators.contract import (
    ConformanceError,
    conform,
    conformance,
    drop_fields,
    publish_conformed,
    with_field_ids,
)
from recordloom.operators.stats import profile, regression_signals, sample_summary
from recordloom.streaming.ingest import (
    ChangeFeed,
    batch_statuses,
    compact,
    compact_log,
    ingest,
    overlay,
    read_log,
)


@pytest.fixture(scope="module")
def orders(spark):
    df = spark.createDataFrame([(1, "10", "a"), (2, "20", "b")], "id bigint, total string, Kind string")
    return with_field_ids(df, {"id": 3, "total": 6})


def _actions(df, rules):
    return {r.field: (r.action, r.offending_rows) for r in conformance(df, rules).collect()}


def test_conformance(orders):
    rules = [
        FieldRule("id", type="bigint"),
        FieldRule("Amount", type="double", field_id=6),
        FieldRule("KIND", required=True, choices=["a"]),
        FieldRule("note"),
        FieldRule("gone", field_id=42),
    ]
    assert _actions(orders, rules) == {
        "id": ("unchanged", 0), "Amount": ("update", 0), "KIND": ("conflict", 1),
        "note": ("create", 0), "gone": ("conflict", 0),
    }
    with pytest.raises(ConformanceError, match="KIND"):
        conform(orders, rules[:3])


def test_conform_converges_and_keeps_identity(spark, orders, tmp_path):
    rules = [
        FieldRule("Amount", type="double", field_id=6, required=True, properties={"b": 1, "a": {"y": 1, "x": 2}}),
        FieldRule("twice", type="double", formula="Amount * 2"),
        FieldRule("empty", type="date"),
    ]
    done = publish_conformed(orders, rules, str(tmp_path / "t"))
    assert done.columns == ["id", "Amount", "Kind", "twice", "empty"]
    assert [r.twice for r in done.orderBy("id").collect()] == [20.0, 40.0]
    assert {a for a, _ in _actions(done, rules).values()} == {"unchanged"}
    assert done.schema["Amount"].metadata["field_id"] == 6
    reordered = [FieldRule("Amount", properties={"a": {"x": 2, "y": 1}})]
    assert _actions(done, reordered) == {"Amount": ("unchanged", 0)}
    assert _actions(done, [FieldRule("twice", formula="Amount * 3")])["twice"][0] == "update"
    assert _actions(done, [FieldRule("Amount", mode="formula")])["Amount"][0] == "conflict"
    assert drop_fields(done, ["empty"]).columns == ["id", "Amount", "Kind", "twice"]
    with pytest.raises(ValueError, match="no such fields"):
        drop_fields(done, ["EMPTY"])


def test_repointed_fields_conflict(orders):
    looked = orders.withMetadata("Kind", {"mode": "summary", "source": "a.b", "where": "x"})
    rule = {"mode": "summary", "source": "a.b", "where": "x"}
    assert _actions(looked, [FieldRule("Kind", **rule)])["Kind"][0] == "unchanged"
    for change in ({"source": "a.c"}, {"where": "y"}, {"mode": "lookup"}):
        assert _actions(looked, [FieldRule("Kind", **{**rule, **change})])["Kind"][0] == "conflict"


def test_safe_cast_is_try_cast(spark):
    texts = ["1", " 12 ", "+5", "-5", "1.0", "1.", "1e3", "0x1", "", "x", "99999999999999999999", "12\x00", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for wanted in ("int", "bigint", "double"):
        both = df.select(F.col("s").try_cast(wanted).alias("a"), safe_cast(F.col("s"), T.StringType(), wanted).alias("b"))
        assert both.where("NOT (a <=> b)").count() == 0


def test_signals(spark):
    def samples(rows):
        return spark.createDataFrame(rows, "m string, v double")

    base = samples([("up", 10.0), ("up", 11.0), ("down", 10.0), ("down", 11.0), ("near", 10.0), ("near", 20.0), ("zero", 0.0)])
    now = samples([("up", 20.0), ("up", 21.0), ("down", 5.0), ("down", 6.0), ("near", 19.0), ("near", 21.0), ("zero", 1.0), ("new", 1.0)])
    got = {r.m: r.classification for r in regression_signals(now, base, ["m"], "v").collect()}
    assert got == {
        "up": "regression_signal", "down": "improvement_signal", "near": "stable",
        "zero": "unavailable", "new": "unavailable",
    }
    better = {r.m: r.classification for r in regression_signals(now, base, ["m"], "v", True).collect()}
    assert better["up"] == "improvement_signal" and better["down"] == "regression_signal"
    for bad in (0, float("inf")):
        with pytest.raises(ValueError):
            regression_signals(now, base, ["m"], "v", threshold_percent=bad)
    one = sample_summary(samples([("a", 0.0)]), ["m"], "v").first()
    assert (one.samples, one.stdev, one.coefficient_of_variation) == (1, 0.0, 0.0)


def test_profile(spark, orders):
    found = {r.column: r for r in profile({"o": orders}, exact=True).collect()}
    assert (found["Kind"].rows, found["Kind"].filled, found["Kind"].distinct_values) == (2, 2, 2)
    assert (found["id"].lowest, found["id"].highest) == ("1", "2")
    assert profile({"o": orders}, skip=1, top=1).first().column == "total"
    with pytest.raises(ValueError):
        profile({"o": orders}, top=0)
    # null isn't a value, of nested columns neither
    nested = spark.createDataFrame([([1],), ([1],), (None,)], "v array<int>")
    assert [profile({"n": nested}, exact=exact).first().distinct_values for exact in (True, False)] == [1, 1]


FEED = ChangeFeed("id", "at", "kind", "seq", "1 hour")
CHANGE = "id bigint, v string, kind string, at timestamp_ntz, seq bigint"


def _at(hour):
    return datetime(2024, 1, 1, hour)


def test_ingest_late_rows_and_replay(spark, tmp_path):
    source, log, marks = (str(tmp_path / name) for name in ("in", "log", "marks"))
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, v string")

    def arrive(rows):
        spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(CHANGE).parquet(source)
        ingest(stream, log, marks, FEED).awaitTermination()

    arrive([(1, "x", "MODIFY", _at(10), 1), (1, "y", "MODIFY", _at(10), 2), (2, None, "DELETE", _at(9), 3)])
    arrive([(3, "late", "MODIFY", _at(8), 4), (4, "new", "CREATE", _at(11), 5)])
    arrive([(4, "newer", "MODIFY", _at(12), 6)])
    schema = spark.createDataFrame([], CHANGE).schema
    changes = read_log(spark, log, schema)
    state = {r.id: r.v for r in overlay(base, changes, FEED).collect()}
    assert state == {1: "y", 3: "c", 4: "newer"}
    assert [r.v for r in read_log(spark, log, schema, "late").collect()] == ["late"]
    facts = [(r.lines, r.late_lines) for r in batch_statuses(spark, log).orderBy("batch_id").collect()]
    assert facts == [(3, 0), (2, 1), (1, 0)]

    from recordloom.streaming.ingest import _write_batch

    again = spark.createDataFrame([(3, "late", "MODIFY", _at(8), 4), (4, "new", "CREATE", _at(11), 5)], CHANGE)
    _write_batch(again, 1, log, FEED)
    assert {r.id: r.v for r in overlay(base, read_log(spark, log, schema), FEED).collect()} == state
    assert compact(base, read_log(spark, log, schema), FEED, str(tmp_path / "t")).count() == 3
    for round_ in range(2):  # the second time there is nothing left to apply
        compacted = compact_log(base, log, schema, FEED, str(tmp_path / f"compacted{round_}"))
        assert {r.id: r.v for r in compacted.collect()} == state
        assert read_log(spark, log, schema).count() == 0
        base = compacted


def test_an_older_change_after_a_compaction_loses(spark, tmp_path):
    source, log, marks = (str(tmp_path / name) for name in ("in", "log", "marks"))
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    schema = spark.createDataFrame([], CHANGE).schema
    half = lambda hour: datetime(2024, 1, 1, hour, 30)

    def arrive(rows):
        spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(source)
        ingest(spark.readStream.schema(CHANGE).parquet(source), log, marks, FEED).awaitTermination()

    arrive([(1, "new", "MODIFY", _at(12), 1), (2, None, "DELETE", _at(12), 2), (3, "x", "CREATE", _at(9), 3)])
    base = compact_log(base, log, schema, FEED, str(tmp_path / "t1"))
    arrive([(1, "older", "MODIFY", half(11), 4), (2, "back", "MODIFY", half(11), 5), (3, "y", "MODIFY", half(11), 6)])
    assert {r.id for r in read_log(spark, log, schema).collect()} == {3}
    base = compact_log(base, log, schema, FEED, str(tmp_path / "t2"))
    assert {r.id: r.v for r in base.collect()} == {1: "new", 3: "y"}
    arrive([(1, "newer", "MODIFY", half(12), 7), (3, "late", "MODIFY", _at(10), 8), (3, "same", "MODIFY", half(11), 6)])
    base = compact_log(base, log, schema, FEED, str(tmp_path / "t3"))
    assert {r.id: r.v for r in base.collect()} == {1: "newer", 3: "y"}
    # only positions that an on-time change could still come before are remembered
    from recordloom.streaming.ingest import _held

    assert {r.key for r in _held(spark, log).collect()} == {1, 2, 3}
    arrive([(9, "z", "CREATE", _at(20), 9)])
    compact_log(base, log, schema, FEED, str(tmp_path / "t4"))
    assert {r.key for r in _held(spark, log).collect()} == {9}


def test_state_of_a_stream_and_its_compaction(spark, tmp_path, monkeypatch):
    from recordloom.streaming import state as module
    from recordloom.streaming.state import compact_state, keep_state, read_state

    source, path, marks = (str(tmp_path / name) for name in ("in", "state", "marks"))
    schema = spark.createDataFrame([], CHANGE).schema

    def arrive(rows):
        spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(source)
        keep_state(spark.readStream.schema(CHANGE).parquet(source), path, marks, FEED).awaitTermination()

    def now():
        return {r.id: r.v for r in read_state(spark, path, schema, FEED).collect()}

    assert now() == {}
    arrive([(1, "a", "MODIFY", _at(10), 1), (2, "b", "MODIFY", _at(11), 2), (1, "same time", "MODIFY", _at(10), 3)])
    arrive([(2, "older", "MODIFY", _at(9), 4), (3, "c", "CREATE", _at(3), 5), (1, None, "DELETE", _at(12), 6)])
    want = {2: "b", 3: "c"}
    assert now() == want

    def crash(*args):
        raise OSError("the driver died")

    for name in ("move_new", "remove"):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, crash)
        with pytest.raises(OSError):
            compact_state(spark, path, schema, FEED)
        monkeypatch.setattr(module, name, real)
        assert now() == want
    compact_state(spark, path, schema, FEED)
    assert now() == want
    arrive([(1, "back", "MODIFY", _at(11), 7), (3, "d", "MODIFY", _at(4), 8), (2, "very old", "MODIFY", _at(1), 9)])
    assert now() == {2: "b", 3: "d"}, "1 stays deleted"
    assert compact_state(spark, path, schema, FEED) == 1 and compact_state(spark, path, schema, FEED) == 0
    assert now() == {2: "b", 3: "d"}


def test_median_of_hot_values(spark):
    from recordloom.operators.ordering import exact_median

    values = [7.5] * 180 + [float(i) for i in range(20)]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 1.0), ("b", 2.0), ("c", 4.0), ("d", None)], "g string, v double")
    small = exact_median(df, ["g"], "v", "m").collect()
    large = exact_median(df, ["g"], "v", "m", small_group=0).collect()
    assert sorted(small) == sorted(large) and dict(map(tuple, small)) == {"a": 7.5, "b": 1.5, "c": 4.0}


def test_null_groups_stay_whatever_their_size(spark):
    df = spark.createDataFrame(
        [(None, 1, 1.0), (None, 1, 3.0), (None, 1, 8.0), ("a", None, 2.0), ("a", 1, 4.0), (None, None, 6.0)], "g string, h int, v double"
    )
    want = {(None, 1): (3, 3.0), ("a", None): (1, 2.0), ("a", 1): (1, 4.0), (None, None): (1, 6.0)}
    for small in (0, 1, 2, 1_000_000):
        found = sample_summary(df, ["g", "h"], "v", small).collect()
        assert {(r.g, r.h): (r.samples, r.median) for r in found} == want
    signals = regression_signals(df, df.withColumn("v", F.col("v") * 10), ["g", "h"], "v").collect()
    assert {(r.g, r.h): r.baseline_median for r in signals} == {key: median * 10 for key, (_, median) in want.items()}


def test_locations_take_the_scheme_of_the_session(spark, tmp_path):
    from recordloom.sources.files import _file_system, qualified

    assert qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert _file_system(qualified(spark, str(tmp_path)))[1] == str(tmp_path)
