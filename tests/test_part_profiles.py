import pytest
from pyspark.sql import functions as F

from recordloom.operators.part_profiles import PartProfiles

ROWS = "part string, id bigint, x double, tags array<string>, name string"


def test_parts_are_merged_and_read_again_alone(spark, tmp_path):
    rows = [("a", i, float(i), [str(i % 3)], f"n{i % 10}") for i in range(1000)]
    rows += [("b", i, -float(i), None, None) for i in range(500)] + [(None, -5, None, ["z"], "n0")]
    df = spark.createDataFrame(rows, ROWS)
    kept = PartProfiles.create(spark, str(tmp_path / "p"), df.schema, "part")
    assert [(r.rows, r.distinct_values, r.quantiles) for r in kept.report().collect()] == [(0, 0, None)] * 4
    kept.update(df)
    found = {r["column"]: r for r in PartProfiles.open(spark, str(tmp_path / "p")).report().collect()}
    assert (found["id"].rows, found["id"].filled, found["id"].lowest, found["id"].highest) == (1501, 1501, "-5", "999")
    # numbers are compared as numbers: as text -5 would come before -499
    assert (found["x"].filled, found["x"].lowest, found["x"].highest) == (1500, "-499.0", "999.0")
    assert abs(found["x"].distinct_values - 1499) < 75 and abs(found["x"].quantiles[1] - 250) < 45
    assert (found["name"].distinct_values, found["name"].quantiles) == (10, None)
    assert (found["tags"].filled, found["tags"].distinct_values, found["tags"].lowest) == (1001, 4, None)

    # part b shrinks, the null part goes, and only their rows are read: others would fail
    fails = F.when(F.col("part") == "a", F.raise_error(F.lit("read"))).otherwise(F.lit(7.0)).cast("double")
    changed = df.where("part = 'a' OR part = 'b' AND id < 2").withColumn("x", fails)
    kept.update(changed, ["b", None])
    parts = {(r.part, r["column"]): r for r in kept.report(per_part=True).collect()}
    assert [parts[p, "x"].rows for p in ("a", "b", None)] == [1000, 2, 0]
    assert (parts["b", "x"].distinct_values, parts["b", "x"].quantiles) == (1, [7.0] * 3)
    assert (parts[None, "x"].quantiles, parts[None, "id"].lowest) == (None, None)
    merged = {r["column"]: r for r in kept.report(quantiles=[0.0, 1.0]).collect()}
    assert (merged["x"].rows, merged["x"].lowest, merged["x"].quantiles) == (1002, "0.0", [0.0, 999.0])


def test_zeros_and_nan(spark, tmp_path):
    df = spark.createDataFrame([("a", v) for v in (0.0, -0.0, float("nan"), None)], "part string, x double")
    kept = PartProfiles.create(spark, str(tmp_path / "p"), df.schema, "PART")
    kept.update(df)
    row = kept.report().first()
    assert (row.rows, row.filled, row.distinct_values, row.quantiles) == (4, 3, 2, [0.0] * 3)
    only = spark.createDataFrame([("a", float("nan"))], df.schema)
    kept.update(only, ["a", "a"])
    assert (kept.report().first().rows, kept.report().first().quantiles) == (1, None)


def test_refused(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "part string, id bigint")
    kept = PartProfiles.create(spark, str(tmp_path / "p"), df.schema, "part")
    with pytest.raises(ValueError):
        kept.update(df.drop("id"))
    with pytest.raises(ValueError):
        kept.report(quantiles=[1.5])
    with pytest.raises(FileExistsError):
        PartProfiles.create(spark, str(tmp_path / "p"), df.schema, "part")
    with pytest.raises(FileNotFoundError):
        PartProfiles.open(spark, str(tmp_path / "q"))
