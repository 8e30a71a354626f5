import pytest
from pyspark.sql import functions as F

from recordloom.operators.ordering import exact_median, global_rank, running_sum, sorted_slices
from recordloom.operators.query import (
    assign_pages,
    group_equal,
    iter_keyset_pages,
    keyset_page,
    page_facts,
    run_query,
)
from recordloom.operators import query as query_module
from recordloom.plans.reports import Report, run_report


@pytest.fixture(scope="module")
def people(spark):
    return spark.range(1, 1202).select(
        F.col("id").alias("Record ID#"),
        F.concat(F.lit("n"), (F.col("id") % 7).cast("string")).alias("Name"),
    )


def test_paging(people, rows):
    names = ["Record ID#"]
    first = run_query(people, names, top=892, key="record id#")
    rest = run_query(people, names, skip=892, key="Record ID#")
    assert first.count() == 892 and rest.count() == 309
    assert first.intersect(rest).count() == 0
    assert run_query(people, names, skip=5000, key="Record ID#").count() == 0
    assert run_query(people, names, top=0, key="Record ID#").count() == 1201
    for bad in (-1, True, "3"):
        with pytest.raises(ValueError):
            run_query(people, names, skip=bad)
        with pytest.raises(ValueError):
            run_query(people, names, top=bad)
    with pytest.raises(ValueError, match="ASC or DESC"):
        run_query(people, names, sort_by=[("Name", "up")])
    with pytest.raises(ValueError, match="skip needs"):
        run_query(people, names, skip=1)


def test_ranked_page_equals_heap(people, monkeypatch):
    sort = [("Name", "DESC")]
    expected = run_query(people, ["Name", "Record ID#"], None, sort, None, 100, 50, "Record ID#").collect()
    monkeypatch.setattr(query_module, "TOP_K_LIMIT", 10)
    ranked = run_query(people, ["Name", "Record ID#"], None, sort, None, 100, 50, "Record ID#").collect()
    assert ranked == expected and len(expected) == 50


def test_keyset(people):
    page = keyset_page(people, "Record ID#", ["Name"], cursor=1190, page_size=10)
    assert [row["Record ID#"] for row in page.collect()] == list(range(1191, 1201))
    sizes = [page.count() for page in iter_keyset_pages(people, "Record ID#", page_size=500)]
    assert sizes == [500, 500, 201]
    limited = [p.count() for p in iter_keyset_pages(people, "Record ID#", page_size=500, record_limit=600)]
    assert limited == [500, 100]
    assert list(iter_keyset_pages(people, "Record ID#", record_limit=0)) == []
    with pytest.raises(ValueError):
        keyset_page(people, "Record ID#", page_size=0)


def test_page_facts_and_assignment(people, rows):
    facts = page_facts(people, ["Name"], skip=1000, top=1000).first()
    assert tuple(facts) == (1, 201, 1201, 1000)
    pages = rows(assign_pages(people, "Record ID#", 500))
    assert pages == [(1, 1, 500, 500, 1201), (2, 501, 1000, 500, 701), (3, 1001, 1201, 201, 201)]


def test_grouping(people):
    assert run_query(people, ["Name"], group_by=["name"]).count() == 7
    with pytest.raises(ValueError, match="grouped"):
        run_query(people, ["Record ID#"], group_by=["Name"])
    counted = group_equal(people, ["Name"], [F.count("*").alias("n")])
    assert sum(row.n for row in counted.collect()) == 1201


def test_report(people):
    report = Report("r", "People", ["Name"], [("Name", "EX", "N1"), ("Name", "EX", "n2")], "any")
    assert run_report({"people": people}, report).count() == 172 * 2
    with pytest.raises(ValueError):
        Report("r", "People", [], match="some")


def test_global_order_on_a_hot_group(spark):
    """One group holds a third of the rows; ranks and sums are still exact."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"),
        "id",
        (F.col("id") % 11).alias("v"),
    )
    ranked = global_rank(df, [F.col("v").desc(), "id"], "rank").collect()
    expected = sorted(ranked, key=lambda r: (-r["v"], r["id"]))
    assert [r["rank"] for r in expected] == list(range(1, 3001))
    slices = sorted_slices(df, ["g", "id"], "test")
    sums = {(r.g, r.id): r.total for r in running_sum(slices, ["g"], "v", "total").collect()}
    local = df.toPandas().sort_values(["g", "id"])
    local["total"] = local.groupby("g")["v"].cumsum() - local["v"]
    assert sums == {(r.g, r.id): r.total for r in local.itertuples()}
    small = exact_median(df, ["g"], "v", "m").collect()
    large = exact_median(df, ["g"], "v", "m", small_group=1).collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, large))


def test_ranks_start_no_python_workers(people):
    """The rows before each slice reach the plan as they are; rows of Python objects go through workers that stay in the executors."""
    ranked = global_rank(people, ["Record ID#"], "rank")
    assert "ExistingRDD" not in ranked._jdf.queryExecution().executedPlan().toString()
    assert global_rank(people.limit(0), ["Record ID#"], "rank").collect() == []


@pytest.mark.parametrize("ranked", [False, True])
def test_no_single_partition_for_whole_tables(people, ranked):
    """Neither a full sort nor a rank sends all rows through one task."""
    if ranked:
        df = global_rank(people, ["Record ID#"], "rank")
    else:
        df = run_query(people, ["Name"], sort_by=[("Name", "ASC")], key="Record ID#")
    assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()


def test_large_limits_without_an_order(spark, monkeypatch):
    """Beyond the limit for one task any rows are taken in parallel, as many as asked for."""
    from recordloom.operators import query

    monkeypatch.setattr(query, "TOP_K_LIMIT", 10)
    df = spark.range(1000).repartition(7)
    for top, want in ((5, 5), (11, 11), (400, 400), (5000, 1000)):
        found = run_query(df, ["id"], top=top)
        assert found.count() == want == found.distinct().count()


def test_grouped_page_facts(people):
    facts = page_facts(people, ["Name"], group_by=["Name"]).first()
    assert facts.total_records == people.select("Name").distinct().count()


def test_pages_by_index(spark, tmp_path):
    from recordloom.operators.page_index import PageIndex

    df = spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 7).alias("v")).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = PageIndex.create(df, [F.col("v").desc(), "id"], str(tmp_path / "p"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = [r.id for r in df.orderBy(F.col("v").desc(), "id").collect()]
    assert PageIndex.open(spark, str(tmp_path / "p")).count() == 1000
    assert index._files().count() > 1
    for skip, top in ((0, 1), (0, 1000), (137, 300), (999, 5), (1000, 5), (2500, 1), (421, 1)):
        page = index.page(skip, top)
        rows = {r["_rank"]: r.id for r in page.collect()}
        assert rows == {skip + i + 1: x for i, x in enumerate(want[skip : skip + top])}
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "hashpartitioning" not in plan and "rangepartitioning" not in plan
    # a page reads the files that hold it, no others
    first = index._files().orderBy("first").first()
    for row in index._files().where(F.col("first") > 0).collect():
        with open(f"{index.path}/rows/{row['file']}", "wb") as file:
            file.write(b"no parquet")
    assert index.page(0, first["rows"]).count() == first["rows"]
    empty = PageIndex.create(df.limit(0), ["id"], str(tmp_path / "e"))
    assert empty.count() == 0 and empty.page(0, 5).collect() == []
    with pytest.raises(ValueError):
        index.page(-1, 5)
    with pytest.raises(FileNotFoundError):
        PageIndex.open(spark, str(tmp_path / "none"))
