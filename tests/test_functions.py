from datetime import UTC, date, datetime

import pytest
from pyspark.sql import functions as F

from recordloom.functions.labels import LabelError, resolve, resolve_all, unique_labels
from recordloom.functions.literals import text_literal, utc_second
from recordloom.functions.predicates import OPERATOR_CODES, RecordFilter, starts_with_or_false, truth
from recordloom.functions.timeranges import date_range


def test_labels():
    labels = ["Status", "STATUS", "Straße", "Name"]
    assert resolve(labels, "Status") == "Status"
    assert resolve(labels, "STRASSE") == "Straße"
    with pytest.raises(LabelError, match="ambiguous.*STATUS.*Status"):
        resolve(labels, "status")
    with pytest.raises(LabelError, match="not found"):
        resolve(labels, "Missing")
    with pytest.raises(LabelError, match="more than once"):
        resolve_all(labels, ["Name", "name"])
    with pytest.raises(LabelError, match="collide"):
        unique_labels(["a", "A"])


def test_text_forms(spark):
    values = [datetime(2026, 7, 18, 14, 5, 59), date(2026, 7, 18), True, 12.5, ["a", 1, False], "A"]
    row = spark.range(1).select(*[text_literal(v).alias(f"c{i}") for i, v in enumerate(values)]).first()
    assert tuple(row) == ("2026-07-18 14:05:00", "2026-07-18", "true", "12.5", "a; 1; false", "A")


def test_text_operators_on_times(spark):
    """A datetime is compared as text of the column's own type."""
    df = spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ'2024-01-01 12:00:00' AS t, array(TIMESTAMP_NTZ'2024-01-01 12:00:00') AS l")
    w = RecordFilter(df)
    noon = datetime(2024, 1, 1, 12, 0, 30)
    for code in ("CT", "SW"):
        assert df.where(w.expr("t", code, noon)).count() == 1
        assert df.where(w.expr("t", "X" + code, noon)).count() == 0
        assert df.where(w.expr("t", code, "2024-01")).count() == 1
        assert df.where(w.expr("l", code, noon)).count() == 1
        assert df.where(w.expr("t", code, datetime(2024, 1, 1, 13))).count() == 0


def test_ranges_follow_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        days = set()
        for zone in ("Pacific/Kiritimati", "Etc/GMT+12"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            days.add(date_range("today"))
        assert len(days) == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_utc_second():
    moment = utc_second("2026-07-18T12:30:00.987654-05:00")
    assert moment == datetime(2026, 7, 18, 17, 30, tzinfo=UTC)
    for bad in ("2026-07-18T12:30:00", "yesterday"):
        with pytest.raises(ValueError):
            utc_second(bad)


@pytest.mark.parametrize(
    "text, start, end",
    [
        ("today", date(2024, 2, 29), date(2024, 3, 1)),
        ("yesterday", date(2024, 2, 28), date(2024, 2, 29)),
        ("this week", date(2024, 2, 26), date(2024, 3, 4)),
        ("last month", date(2024, 1, 1), date(2024, 2, 1)),
        ("next quarter", date(2024, 4, 1), date(2024, 7, 1)),
        ("last 2 years", date(2022, 1, 1), date(2024, 1, 1)),
        ("last 3 days", date(2024, 2, 26), date(2024, 2, 29)),
        ("last 14 months", date(2022, 12, 1), date(2024, 2, 1)),
    ],
)
def test_ranges(text, start, end):
    assert date_range(text, date(2024, 2, 29)) == (start, end)


def test_unknown_range():
    with pytest.raises(ValueError):
        date_range("some day")


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, blanks, case twins, quotes, separators and times around a date bound."""
    return spark.createDataFrame(
        [
            (1, "Alpha", ["a", "b"], 1.0, datetime(2024, 1, 1, 23, 59, 59, 999999), True),
            (2, "alpha", [], 2.0, datetime(2024, 1, 2), False),
            (3, "", ["b"], None, datetime(2024, 1, 2, 23, 59, 59, 999999), None),
            (4, None, None, 4.0, datetime(2024, 1, 3), True),
            (5, "O'Brien; x", ["O'Brien; x"], 5.0, None, False),
            (None, "beta", ["c"], 6.0, datetime(2023, 12, 31), None),
        ],
        "id bigint, name string, tags array<string>, amount double, at timestamp_ntz, on boolean",
    )


CASES = [
    ("EX", "name", "ALPHA"), ("EX", "name", None), ("EX", "name", ""), ("EX", "amount", 2),
    ("EX", "on", True), ("EX", "tags", ["b", "a"]), ("EX", "amount", None),
    ("TV", "name", "alpha"), ("TV", "name", None), ("CT", "name", "O'B"), ("CT", "tags", "O'b"),
    ("SW", "name", "al"), ("HAS", "tags", "b"), ("HAS", "tags", ["a", "c"]), ("HAS", "name", "x"),
    ("IR", "at", (date(2024, 1, 2), date(2024, 1, 3))),
]


@pytest.mark.parametrize("code, label, value", CASES)
def test_complements(edge, code, label, value):
    """An operator and its X form split every table, nulls included."""
    where = RecordFilter(edge)
    total = edge.count()
    found = edge.where(where.expr(label, code, value)).count()
    assert found + edge.where(where.expr(label, f"X{code}", value)).count() == total
    assert found + edge.where(where.not_(where.expr(label, code, value))).count() == total


@pytest.mark.parametrize(
    "code, label, value, ids",
    [
        ("EX", "name", "ALPHA", {1, 2}),
        ("TV", "name", "alpha", {2}),
        ("EX", "name", None, {3, 4}),
        ("EX", "tags", ["b", "a"], {1}),
        ("CT", "name", "o'b", {5}),
        ("SW", "NAME", "AL", {1, 2}),
        ("HAS", "tags", ["a", "O'Brien; x"], {1, 5}),
        ("HAS", "name", "x", {5}),
        ("LT", "amount", 4, {1, 2}),
        ("GTE", "amount", 5, {5, None}),
        ("BF", "at", date(2024, 1, 2), {1, None}),
        ("OBF", "at", date(2024, 1, 2), {1, 2, 3, None}),
        ("AF", "at", date(2024, 1, 2), {4}),
        ("OAF", "at", date(2024, 1, 2), {2, 3, 4}),
        ("AF", "at", datetime(2024, 1, 2, 23, 59, 30), {3, 4}),
    ],
)
def test_predicates(edge, code, label, value, ids):
    assert {row.id for row in edge.where(RecordFilter(edge).expr(label, code, value)).collect()} == ids


@pytest.mark.parametrize(
    "code, label, value, ids",
    [
        ("GT", "n", 1.5, {2, 3}),
        ("LT", "n", 2.5, {1, 2}),
        ("LT", "n", 3_000_000_000, {1, 2, 3}),
        ("EX", "n", "2", {2}),
        ("EX", "n", 2.5, set()),
        ("GTE", "price", 1.1, {2, 3}),
        ("EX", "ratio", 0.1, {1}),
        ("BF", "day", datetime(2024, 1, 2, 12), {1, 2}),
        ("OAF", "day", datetime(2024, 1, 2, 12), {3}),
        ("OAF", "day", date(2024, 1, 2), {2, 3}),
    ],
)
def test_literals_keep_their_value(spark, code, label, value, ids):
    df = spark.sql(
        "SELECT n, CAST(n * 0.55 AS DECIMAL(10,2)) AS price, CAST(n * 0.1 AS FLOAT) AS ratio, "
        "date_add(DATE'2024-01-01', n - 1) AS day FROM VALUES (1), (2), (3) AS t(n)"
    )
    assert {r.n for r in df.where(RecordFilter(df).expr(label, code, value)).collect()} == ids


def test_all_codes_build(edge):
    where = RecordFilter(edge, as_of=date(2024, 1, 2))
    for code in OPERATOR_CODES:
        value = "today" if code.endswith("IR") else date(2024, 1, 2)
        label = "name" if code[-2:] in ("CT", "AS", "SW") else "at"
        edge.where(where.expr(label, code, value)).count()
    with pytest.raises(ValueError, match="unknown operator"):
        where.expr("name", "ZZ", 1)
    with pytest.raises(ValueError):
        where.and_()


def test_precedence_and_prefix(edge):
    where = RecordFilter(edge)
    both = where.and_(
        where.or_(where.eq("id", 1), where.eq("id", 2)), where.not_(where.is_value("name", "alpha"))
    )
    assert [row.id for row in edge.where(both).collect()] == [1]
    prefixed = edge.select(truth(starts_with_or_false(F.col("name"), "al")).alias("p"))
    assert sum(row.p for row in prefixed.collect()) == 1


def test_pushdown(spark, tmp_path):
    """Range predicates reach the scan; complements of nulls cannot."""
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "timestamp_ntz'2024-01-01' AS at").write.parquet(path)
    df = spark.read.parquet(path)
    where = RecordFilter(df)
    picked = df.where(where.and_(where.after("at", date(2024, 1, 1)), where.less_than("id", 5)))
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at" in plan and "LessThan(id,5)" in plan
