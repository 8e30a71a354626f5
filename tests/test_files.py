import hashlib
import json
import os
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from recordloom.functions.labels import LabelError
from recordloom.operators.attachments import (
    archive,
    archive_name,
    as_base64,
    attachment_jobs,
    clean_name,
    delete_version,
    download_jobs,
    fetch,
    latest_version,
    raise_failures,
    select_versions,
    status_counts,
    version_problems,
)
from recordloom.sources.cells import WireField, check_json_lines, from_wire, line_kinds, to_wire, wire_fields
from recordloom.sources.export import export_csv, read_csv, read_json_lines, write_json_lines
from recordloom.sources.files import decode_body, hash_files, list_files, total_bytes
from recordloom.sources.snapshot import (
    Capture,
    Manifest,
    SnapshotError,
    TableEntry,
    manifest_problems,
    open_snapshot,
    take_snapshot,
    unsafe,
)

CELL = "struct<fileName:string,versions:array<struct<versionNumber:int,fileName:string,size:bigint>>>"


@pytest.fixture(scope="module")
def projects(spark):
    return spark.createDataFrame(
        [
            (10, "Alpha", ("cell.txt", [(2, "../current?.txt", 7), (1, None, 3)])),
            (11, "Beta", ("", [(1, "", 5)])),
            (12, "Gamma", ("x", [])),
            (13, "Delta", ("x", None)),
            (14, "Epsilon", None),
        ],
        f"`Record ID#` bigint, Name string, File {CELL}",
    )


@pytest.fixture(scope="module")
def contents(spark):
    rows = [(10, 8, 1, b"one"), (10, 8, 2, b"current"), (11, 8, 1, b"beta\x00")]
    schema = "record_id bigint, field_id int, version_number int, content binary"
    return spark.createDataFrame([(*r[:3], bytearray(r[3])) for r in rows], schema)


def test_wire_records(spark, rows):
    fields = [WireField(3, "Record ID#", "bigint"), WireField(6, "Name")]
    lines = spark.createDataFrame(
        [('{"3":{"value":1},"6":{"value":"Alpha"}}',), ('{"3":{"value":2}}',), ('{"3":{"value":3},"6":{}}',)],
        "value string",
    )
    assert rows(from_wire(lines, fields)) == [(1, "Alpha"), (2, None), (3, None)]
    for bad in ('{"3":{"value":1},"9":{"value":1}}', "[1]", "oops", '{"3":{"value":1}} x', '{"3":{"value":1}}}'):
        with pytest.raises(PySparkException):
            from_wire(spark.createDataFrame([(bad,)], "value string"), fields).collect()
    for wrong in ([WireField(3, "A"), WireField(6, "A")], [WireField(3, "A"), WireField(3, "B")]):
        with pytest.raises(LabelError):
            from_wire(lines, wrong)
    table = spark.createDataFrame([(1, float("nan"))], "id bigint, v double")
    with pytest.raises(PySparkException, match="finite"):
        table.select(to_wire(table, wire_fields(table, "id"))).collect()


def test_json_lines(spark):
    lines = {
        '{"a": 1}': "object", ' {"a":1,"a":2} ': "object", "[1]": "other", "null": "other", '"x"': "other",
        "12": "other", "": "invalid", "{": "invalid", '{"a":1} x': "invalid", "1, 2": "invalid",
        "1] [2": "invalid", "{'a':1}": "invalid", "12 more": "invalid",
    }
    df = spark.createDataFrame(list(lines.items()), "line string, kind string")
    assert df.where(line_kinds(F.col("line")) != F.col("kind")).collect() == []
    assert tuple(check_json_lines(df, "line").first()) == (6, 7, 4)


def test_latest_and_selection(projects):
    latest = projects.select("`Record ID#`", latest_version(F.col("File"), 8).alias("v"))
    found = {r[0]: r.v and tuple(r.v) for r in latest.collect()}
    assert found == {
        10: (2, "../current?.txt"), 11: (1, "fid8_v1.bin"), 12: None, 13: None, 14: None,
    }
    for mode, want in (("all", [1, 2]), ("latest", [2]), ("none", [])):
        numbers = projects.where("Name = 'Alpha'").select(select_versions(F.col("File"), mode).alias("v"))
        assert [v.versionNumber for v in numbers.first().v] == want
    with pytest.raises(ValueError):
        select_versions(F.col("File"), "some")


def test_names(spark):
    long = "é" * 150 + ".txt"
    names = ["../current?.txt", " a<b>.txt. ", "\x01\x7f", "...", 'x:"/\\|?*y', long, " b　"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    found = df.select(
        clean_name(F.col("n")).alias("d"), archive_name(F.col("n"), F.lit(8), F.lit(2)).alias("a")
    ).collect()
    assert [r.d for r in found][:2] == ["..current.txt", "ab.txt."]
    assert [r.a for r in found][:5] == ["current.txt", "ab.txt", "fid8_v2.bin", "fid8_v2.bin", "xy"]
    assert found[5].a == "é" * 100 and found[6].a == "b"


def test_version_problems(spark, rows):
    df = spark.createDataFrame(
        [(1, ("a", [(1, "x", 1), (1, "y", 1)])), (2, ("a", [(0, "x", 1)])), (3, ("a", [(1, "x", 1)]))],
        f"id bigint, f {CELL}",
    )
    assert rows(version_problems(df, "id", {"f": 8})) == [
        (1, 8, "repeated version number"),
        (2, 8, "invalid version number"),
    ]


def test_archive_and_index(spark, projects, contents, tmp_path):
    jobs = attachment_jobs(projects, "Record ID#", {"file": 8}, "p")
    index = archive(jobs, contents, str(tmp_path)).orderBy("record_id", "version_number").collect()
    assert [(r.record_id, r.version_number) for r in index] == [(10, 1), (10, 2), (11, 1)]
    assert index[1].path == "tables/p/attachments/10/8/2/current.txt"
    assert (tmp_path / index[1].path).read_bytes() == b"current"
    assert index[2].sha256 == hashlib.sha256(b"beta\x00").hexdigest() and index[2].bytes == 5
    with pytest.raises(PySparkException, match="no content"):
        archive(jobs, contents.limit(0), str(tmp_path / "other"))


def test_stored_names_stay_visible(spark, tmp_path):
    df = spark.createDataFrame([(1, ("_x.txt", [(1, None, 1)]))], f"id bigint, f {CELL}")
    contents = spark.createDataFrame(
        [(1, 8, 1, bytearray(b"x"))], "record_id bigint, field_id int, version_number int, content binary"
    )
    index = archive(attachment_jobs(df, "id", {"f": 8}, "t"), contents, str(tmp_path))
    assert {r.path for r in list_files(spark, str(tmp_path)).collect()} == {index.first().path}
    assert index.first().file_name == "_x.txt"


def test_statuses(spark, projects, contents, tmp_path):
    jobs = download_jobs(projects, "Record ID#", {"File": 8})
    assert {r.path for r in jobs.collect()} == {"10_..current.txt", "11_fid8_v1.bin"}
    (tmp_path / "11_fid8_v1.bin").write_bytes(b"kept")
    existing = list_files(spark, str(tmp_path))
    statuses = fetch(jobs, contents, str(tmp_path), existing)
    assert dict(status_counts(statuses).collect()) == {"downloaded": 1, "skipped": 1}
    raise_failures(statuses)
    assert (tmp_path / "11_fid8_v1.bin").read_bytes() == b"kept"
    failing = fetch(jobs, contents.where("record_id = 11"), str(tmp_path / "b"), existing.limit(0))
    assert dict(status_counts(failing).collect()) == {"downloaded": 1, "failed": 1}
    with pytest.raises(RuntimeError, match="1 attachments failed"):
        raise_failures(failing)
    both = download_jobs(projects, "Record ID#", {"File": 8}, with_field_id=True)
    assert "10_8_..current.txt" in {r.path for r in both.collect()}


def test_copy_from_uri(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a b+%41.bin").write_bytes(b"payload")
    uri = list_files(spark, str(tmp_path / "in")).first().uri
    jobs = spark.createDataFrame([(1, 8, 1, "out.bin")], "record_id bigint, field_id int, version_number int, path string")
    source = spark.createDataFrame([(1, 8, 1, uri)], "record_id bigint, field_id int, version_number int, uri string")
    row = archive(jobs, source, str(tmp_path / "out")).first()
    assert row.bytes == 7 and (tmp_path / "out" / "out.bin").read_bytes() == b"payload"


def test_delete_version_and_base64(projects, contents):
    left = delete_version(projects, "Record ID#", 10, "File", 0).where("Name = 'Alpha'").first()
    assert [v.versionNumber for v in left.File.versions] == [1]
    with pytest.raises(ValueError):
        delete_version(projects, "Record ID#", 10, "File", -1)
    found = {r.record_id: r.base64 for r in as_base64(projects, "Record ID#", {"File": 8}, contents).collect()}
    assert found[10] == "Y3VycmVudA==" and found[12] is None and len(found) == 5


def test_bodies_and_digests(spark, tmp_path):
    df = spark.createDataFrame([("aGk=",), ("not base64",), ("",), ("abc",)], "b string")
    assert [bytes(r[0]) for r in df.select(decode_body(F.col("b"))).collect()] == [b"hi", b"not base64", b"", b"abc"]
    for name, size in (("small", 10), ("big", 3_000_000)):
        (tmp_path / name).write_bytes(os.urandom(size))
    files = hash_files(spark, str(tmp_path), whole=1000).collect()
    found = {r.path: (r.sha256, r.bytes, r.lines) for r in files}
    for name in ("small", "big"):
        body = (tmp_path / name).read_bytes()
        assert found[name] == (hashlib.sha256(body).hexdigest(), len(body), body.count(b"\n"))
    assert total_bytes(list_files(spark, str(tmp_path))).first().total_bytes == 3_000_010


def test_csv(spark, projects, tmp_path):
    plain = projects.select("`Record ID#`", "Name")
    path = export_csv(plain, "projects", str(tmp_path), "Record ID#", on=date(2026, 7, 18), single_file=True)
    assert path.endswith("projects_2026-07-18.csv")
    part = next(p for p in os.listdir(path) if p.startswith("part-"))
    text = open(f"{path}/{part}").read().splitlines()
    assert text[:2] == ["Record ID#,Name", "10,Alpha"] and len(text) == 6
    again = export_csv(plain, "projects", str(tmp_path), "Record ID#", on=date(2026, 7, 18), record_limit=2)
    assert again == path and spark.read.option("header", True).csv(path).count() == 2
    nothing = {"where": lambda w: w.eq("Name", "none")}
    assert export_csv(plain, "none", str(tmp_path), "Record ID#", **nothing) == ""
    assert export_csv(plain, "none", str(tmp_path), "Record ID#", record_limit=0) == ""
    broken = plain.withColumn("Name", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(PySparkException):
        export_csv(broken, "projects", str(tmp_path), "Record ID#", on=date(2026, 7, 18))
    assert spark.read.option("header", True).csv(path).count() == 2
    assert sorted(os.listdir(tmp_path)) == ["projects_2026-07-18.csv"]


def test_csv_keeps_every_value(spark, tmp_path):
    values = ["  padded  ", 'say "hi"', "a\nb", "c\r\nd", "e\rf", "", None, "x,y", "\\", '\\"', '"', "\t", "é\u2028"]
    df = spark.createDataFrame(list(enumerate(values)), "id bigint, text string")
    path = export_csv(df, "texts", str(tmp_path), "id")
    assert sorted(read_csv(spark, path, df.schema).collect()) == sorted(df.collect(), key=lambda r: r.id)


def test_json_lines_refuse_nested_numbers_that_json_lacks(spark, tmp_path):
    for n, value in enumerate(("array(double('NaN'))", "named_struct('x', array(float('inf')))", "map('k', double('NaN'))")):
        bad = spark.sql(f"SELECT 1L AS id, {value} AS v")
        with pytest.raises(PySparkException):
            write_json_lines(bad, str(tmp_path / f"bad{n}"), "id")
    good = spark.sql("SELECT 1L AS id, array(1.5D, null) AS v, CAST(null AS struct<x: double>) AS s, map('k', 2.5D) AS m")
    write_json_lines(good, str(tmp_path / "good"), "id")
    assert read_json_lines(spark, str(tmp_path / "good"), good.schema).collect() == good.collect()


def test_json_lines_are_deterministic(spark, tmp_path):
    df = spark.createDataFrame(
        [(2, None, datetime(2024, 1, 1, 0, 0, 0, 1)), (1, "é", None)], "id bigint, b string, a timestamp_ntz"
    )
    write_json_lines(df, str(tmp_path / "x"), "id")
    lines = [r.value for r in spark.read.text(str(tmp_path / "x")).collect()]
    assert '{"a":null,"b":"é","id":1}' in lines
    assert read_json_lines(spark, str(tmp_path / "x"), df.schema).exceptAll(df).count() == 0
    nan = spark.createDataFrame([(1, float("inf"))], "id bigint, v double")
    with pytest.raises(PySparkException):
        write_json_lines(nan, str(tmp_path / "y"), "id")


@pytest.fixture
def snapshot(spark, projects, contents, tmp_path):
    table = Capture(projects, "Record ID#", "Projects", {"File": 8}, contents)
    plain = Capture(projects.select("`Record ID#`", "Name").limit(0), "Record ID#", "Empty")
    return take_snapshot({"p": table, "e": plain}, str(tmp_path / "snap"), {"dataset": "demo"})


def _without_sidecars(snapshot):
    """Local disks keep checksum sidecars that would stop the read; shared stores have none."""
    for folder, _, names in os.walk(snapshot.root):
        for name in names:
            if name.endswith(".crc"):
                os.remove(f"{folder}/{name}")
    return snapshot.root


def _kinds(snapshot):
    return {r["check"] for r in snapshot.issues().collect()}


def test_snapshot_round_trip(spark, snapshot, projects, tmp_path):
    opened = open_snapshot(spark, snapshot.root)
    assert opened.issues().collect() == []
    facts = opened.verify().first()
    assert facts.artifact_count == opened.manifest.artifact_count
    assert opened.table("PROJECTS").exceptAll(projects).count() == 0
    assert opened.table("p").count() == 5 and opened.table("Empty").count() == 0
    counts = {t.id: (t.record_count, t.attachment_count) for t in opened.manifest.tables}
    assert counts == {"p": (5, 3), "e": (0, 0)}
    with pytest.raises(SnapshotError):
        opened.table("missing")
    with pytest.raises(FileExistsError):
        take_snapshot({"p": Capture(projects, "Record ID#")}, snapshot.root, {"a": "b"})
    assert os.listdir(tmp_path) == ["snap"]


def test_tampering_is_reported_together(snapshot):
    root = _without_sidecars(snapshot)
    records = f"{root}/tables/p/records"
    part = next(p for p in sorted(os.listdir(records)) if p.startswith("part-") and os.path.getsize(f"{records}/{p}"))
    with open(f"{records}/{part}", "a") as stream:
        stream.write('[1]\n{"3":\n')
    os.rename(f"{root}/tables/p/attachments/10/8/1/cell.txt", f"{root}/stray.bin")
    found = _kinds(snapshot)
    assert {"hash differs", "byte count differs", "item count differs", "invalid JSON"} <= found
    assert {"non-object line", "missing", "untracked"} <= found
    with pytest.raises(SnapshotError, match="missing: 1"):
        snapshot.verify()


def test_changed_manifest(snapshot):
    path = f"{_without_sidecars(snapshot)}/manifest.json"
    payload = json.loads(open(path).read())
    payload["source"] = {"dataset": "other"}
    with open(path, "w") as stream:
        json.dump(payload, stream)
    assert _kinds(snapshot) == {"manifest changed"}


def _inventory_lines(root):
    folder = f"{root}/inventory"
    return {f"{folder}/{p}": open(f"{folder}/{p}").read().splitlines() for p in os.listdir(folder) if p.startswith("part-")}


def test_inventory_is_bound_to_the_manifest(snapshot):
    """A file removed together with its inventory line is noticed."""
    root = _without_sidecars(snapshot)
    os.remove(f"{root}/tables/p/fields.json")
    for path, lines in _inventory_lines(root).items():
        with open(path, "w") as stream:
            stream.writelines(line + "\n" for line in lines if "p/fields.json" not in line)
    found = _kinds(snapshot)
    assert {"artifact count differs from the manifest", "total bytes differ from the manifest"} <= found
    assert {"inventory differs from the manifest", "table needs one field list"} <= found
    with pytest.raises(SnapshotError):
        snapshot.verify()


def test_broken_inventory_line_is_an_issue(snapshot):
    root = _without_sidecars(snapshot)
    path = next(iter(_inventory_lines(root)))
    with open(path, "a") as stream:
        stream.write("{broken\n")
    assert _kinds(snapshot) == {"unreadable inventory line"}


def test_failed_snapshot_leaves_nothing(projects, tmp_path):
    with pytest.raises(ValueError, match="no contents"):
        take_snapshot({"p": Capture(projects, "Record ID#", None, {"File": 8})}, str(tmp_path / "s"), {"a": "b"})
    assert os.listdir(tmp_path) == []


def test_manifest_rules():
    good = dict(
        snapshot_id="12345678-1234-5678-1234-567812345678", source={"a": "b"},
        started_at="2026-07-18T17:30:00Z", completed_at="2026-07-18T17:30:01Z",
        options={"attachment_versions": "all"}, consistent=True, changed_tables=(),
        tables=(TableEntry("t", "T", 1, 0),), artifact_count=1, total_bytes=1, inventory_digest="",
    )
    assert manifest_problems(Manifest(**good)) == []
    for change in (
        {"format": "other"}, {"format_version": 2}, {"snapshot_id": "x"}, {"source": {"a": ""}},
        {"started_at": "2026-07-18T17:30:00"}, {"completed_at": "2026-07-18T17:29:00Z"},
        {"options": {"attachment_versions": "some"}}, {"changed_tables": ("t",)},
        {"consistent": False, "changed_tables": ("x",)},
        {"tables": (TableEntry("t", "T", 1, 0), TableEntry("t", "U", 1, 0))},
        {"tables": (TableEntry("t", "T", -1, 0),)},
    ):
        assert len(manifest_problems(Manifest(**{**good, **change}))) == 1, change


def test_unsafe_paths(spark):
    paths = {"a/b.txt": False, "a..b": False, "/a": True, "a/../b": True, "..": True, "a\\b": True,
             "a//b": True, "./a": True, "a/": True, "": True, None: True}
    df = spark.createDataFrame(list(paths.items()), "p string, bad boolean")
    assert df.where(unsafe(F.col("p")) != F.col("bad")).collect() == []


def _files_below(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).rglob("*") if p.is_file() and not p.name.endswith(".crc"))


def test_failed_copies_leave_nothing_behind(spark, projects, contents, tmp_path):
    jobs = attachment_jobs(projects, "Record ID#", {"File": 8}, "t")
    places = contents.select("record_id", "field_id", "version_number", F.lit(f"file:{tmp_path}/nowhere").alias("uri"))
    statuses = fetch(jobs, places, str(tmp_path / "out"), jobs.select("path").limit(0))
    assert {r.status for r in statuses.collect()} == {"failed"} and _files_below(tmp_path / "out") == []
    with pytest.raises(Exception, match="nowhere|No such file"):
        archive(jobs, places, str(tmp_path / "again"))
    assert _files_below(tmp_path / "again") == []


def test_large_files_are_copied_alone(spark, tmp_path, monkeypatch):
    from recordloom.operators import attachments

    monkeypatch.setattr(attachments, "PACK_BYTES", 1000)
    monkeypatch.setattr(attachments, "FILE_COST", 1)
    rows = [(i, 8, 1, 5000 if i == 3 else 99, f"u{i}") for i in range(30)]
    work = spark.createDataFrame(rows, "record_id bigint, field_id int, version_number int, size bigint, uri string")
    packed = attachments._packed(work).select("record_id", F.spark_partition_id().alias("task")).collect()
    by_task = {}
    for row in packed:
        by_task.setdefault(row.task, set()).add(row.record_id)
    assert sum(map(len, by_task.values())) == 30 and len(by_task) >= 3
    assert max(len(ids) for ids in by_task.values()) <= 11
    assert min(by_task[row.task] for row in packed if row.record_id == 3) <= {0, 1, 2, 3}


def test_base64_by_place(spark, projects, contents, tmp_path):
    jobs = attachment_jobs(projects, "Record ID#", {"File": 8}, "t")
    index = archive(jobs, contents, str(tmp_path))
    keys = ["record_id", "field_id", "version_number"]
    places = index.select(*keys, F.concat(F.lit(f"file:{tmp_path}/"), "path").alias("uri"))
    gone = places.withColumn("uri", F.when(F.col("record_id") == index.first()["record_id"], F.concat("uri", F.lit(".gone"))).otherwise(F.col("uri")))
    want = {(r.record_id, r.field_id): r.base64 for r in as_base64(projects, "Record ID#", {"File": 8}, contents).collect()}
    assert {(r.record_id, r.field_id): r.base64 for r in as_base64(projects, "Record ID#", {"File": 8}, places).collect()} == want
    found = {(r.record_id, r.field_id): r.base64 for r in as_base64(projects, "Record ID#", {"File": 8}, gone).collect()}
    lost = index.first()["record_id"]
    assert found == {key: None if key[0] == lost else value for key, value in want.items()}


def test_relationships_and_reports_of_a_snapshot(spark, tmp_path):
    from recordloom.operators.relations import Summary
    from recordloom.plans.derivation import Relationship
    from recordloom.plans.reports import Report

    tables = {
        "p": Capture(spark.createDataFrame([(1, "a")], "id bigint, n string"), "id"),
        "c": Capture(spark.createDataFrame([(1, 1, 2.5)], "id bigint, p bigint, v double"), "id"),
    }
    relation = Relationship("r", "p", "c", "id", "p", ("n",), (Summary("SUM", "v", "total", "v > 1", ("v",)),), "parent")
    report = Report("x", "c", ("id", "v"), (("v", "GT", 1), ("id", "EX", 1)), "any", (("v", "DESC"),), key="id", labels={"v": "V"})
    snapshot = take_snapshot(tables, str(tmp_path / "s"), {}, relationships=[relation], reports=[report])
    again = open_snapshot(spark, str(tmp_path / "s"))
    assert again.relationships() == [relation] and again.reports() == [report]
    kinds = {(r.table_id, r.kind): r.item_count for r in again.inventory().collect() if r.kind != "records"}
    assert kinds == {
        ("p", "fields"): 2, ("p", "relationships"): 0, ("p", "reports"): 0, ("c", "fields"): 3, ("c", "relationships"): 1, ("c", "reports"): 1,
    }
    assert snapshot.issues().count() == 0
    for crc in (tmp_path / "s").rglob("*.json.crc"):
        crc.unlink()
    (tmp_path / "s" / "tables" / "c" / "reports.json").write_text('{"details": [1, 2]}')
    (tmp_path / "s" / "tables" / "c" / "relationships.json").write_text('{"a": 1}')
    (tmp_path / "s" / "tables" / "p" / "reports.json").write_text("[")
    found = {(r.check, r.path) for r in again.issues().collect()}
    assert {
        ("item count differs", "tables/c/reports.json"), ("expected array missing", "tables/c/relationships.json"),
        ("invalid JSON", "tables/p/reports.json"), ("hash differs", "tables/c/reports.json"),
    } <= found
    unkept = Relationship("r", "p", "c", "id", "p", (), (Summary("SUM", "v", "t", lambda w: w.greater_than("v", 1)),))
    with pytest.raises(SnapshotError, match="no text"):
        take_snapshot(tables, str(tmp_path / "t"), {}, relationships=[unkept])
    with pytest.raises(SnapshotError, match="aren't captured"):
        take_snapshot({"c": tables["c"]}, str(tmp_path / "t"), {}, relationships=[relation])
    assert take_snapshot(tables, str(tmp_path / "u"), {}).relationships() == []


def test_broken_versions_stop_a_capture(spark, tmp_path):
    cell = "struct<fileName: string, versions: array<struct<versionNumber: int, fileName: string, size: bigint>>>"
    df = spark.createDataFrame([(1, ("f", [(1, "a", 1), (1, "b", 1)]))], f"id bigint, f {cell}")
    contents = spark.createDataFrame([(1, 8, 1, b"x")], "record_id bigint, field_id int, version_number int, content binary")
    with pytest.raises(SnapshotError, match="record 1, field 8: repeated version number"):
        take_snapshot({"t": Capture(df, "id", file_fields={"f": 8}, contents=contents)}, str(tmp_path / "s"), {})
    assert not (tmp_path / "s").exists()


def test_many_files_are_listed_and_digested_by_few_tasks(spark, tmp_path, monkeypatch):
    from recordloom.sources import files

    for i in range(300):
        (tmp_path / f"d{i % 9}" / "e").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"d{i % 9}" / "e" / f"a b+%{i}.txt").write_bytes(b"x\n" * i)
    for name in ("_hidden", ".hid", "_metadata", "_k=1", "x._COPYING_"):
        (tmp_path / name).write_bytes(b"y")
        (tmp_path / "d1" / name).write_bytes(b"")
        (tmp_path / "d0" / f"{name}.d").mkdir()
        (tmp_path / "d0" / f"{name}.d" / "z").write_bytes(b"zz")
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
    want = {tuple(r) for r in scan.select("path", "length").collect()}
    for many in (256, 4):
        monkeypatch.setattr(files, "MANY_FOLDERS", many)
        listed = list_files(spark, str(tmp_path))
        assert {(r.uri, r.bytes) for r in listed.collect()} == want
        assert {f"file:{tmp_path}/{r.path}" for r in listed.collect()} == {uri for uri, _ in want}
    digested = hash_files(spark, str(tmp_path))
    assert digested.rdd.getNumPartitions() == 1
    assert digested.agg(F.sum("lines")).first()[0] == sum(range(300))
    one = list_files(spark, str(tmp_path / "d0" / "e" / "a b+%9.txt")).first()
    assert one.uri == f"file:{tmp_path}/d0/e/a b+%9.txt" and one.bytes == 18
    with pytest.raises(FileNotFoundError):
        list_files(spark, str(tmp_path / "nowhere"))


def test_contents_are_handed_on_together(tmp_path, monkeypatch):
    import pandas as pd

    from recordloom.operators import attachments

    for i in range(5):
        (tmp_path / str(i)).write_bytes(b"x" * i)
    rows = pd.DataFrame({"record_id": range(6), "uri": [f"file:{tmp_path}/{i}" for i in range(5)] + [None]})
    want = [(i, b"x" * i) for i in range(5)] + [(5, None)]
    for most, parts in ((100, 1), (3, 4)):
        monkeypatch.setattr(attachments, "HELD_BYTES", most)
        read = list(attachments._reader(iter([rows])))
        assert len(read) == parts
        assert [(r.record_id, r.content) for part in read for r in part.itertuples()] == want


def test_copies_stand_portion_by_portion(spark, tmp_path, monkeypatch):
    import base64

    import catalog

    catalog.load()
    from catalog import attachments as queries
    from recordloom.operators import attachments

    texts = {i: "" if i % 20 == 0 else f"text {i}\n" * (i % 7 + 1) for i in range(120)}
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    documents = [(i, text, "en" if i % 3 else None, "s", len(text)) for i, text in texts.items()]
    spark.createDataFrame(documents, columns).write.parquet(f"{tmp_path}/documents.parquet")
    roots, standing, folders = [], [], []

    def counted(jobs, contents, root):
        standing.append(sum(len(_files_below(r)) for r in roots))
        roots.append(root)
        index = archive(jobs, contents, root)
        folders.append(sum(p.is_dir() for p in Path(root).rglob("*")))
        return index

    monkeypatch.setattr(queries, "archive", counted)
    monkeypatch.setattr(attachments, "STANDING_FILES", 60)
    monkeypatch.setattr(attachments, "FEW_FOLDERS", 4)
    want = {i: (hashlib.sha256(t.encode()).hexdigest(), len(t), base64.b64encode(t.encode()).decode(), 120) for i, t in texts.items()}
    found = queries.copy_by_uri(spark, str(tmp_path)).collect()
    assert len(found) == 120 and {r.record_id: tuple(r)[1:] for r in found} == want
    # two portions; the files of one are gone when the next is written, and its sources have no folders of their own
    assert len(roots) == 4 and standing[2] == 0 and standing[1] + standing[3] == 120
    assert max(folders[0], folders[2]) <= 4
    assert not Path(roots[0]).exists() and not Path(roots[1]).exists()


def test_paths_in_few_folders_are_distinct(spark, projects, contents, tmp_path):
    from recordloom.operators import attachments

    jobs = attachment_jobs(projects, "Record ID#", {"File": 8}, "p")
    flat = attachments.in_few_folders(jobs)
    paths = [r.path for r in flat.collect()]
    assert len(set(paths)) == len(paths) == jobs.count() and all(p.count("/") == 1 for p in paths)
    index = archive(flat, contents, str(tmp_path / "a"))
    assert _files_below(tmp_path / "a") == sorted(paths)
    (tmp_path / "kept").write_bytes(b"kept")
    away = index.select(F.lit("tables/../../kept/1/8/1/x").alias("path"))
    attachments.remove_archive(index.select("path").union(away), str(tmp_path / "a"))
    assert not (tmp_path / "a").exists() and (tmp_path / "kept").exists()


def test_empty_files_are_listed_on_request(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for name, body in (("a", b""), ("b", b"x\n"), ("_c", b"")):
        (tmp_path / "d" / name).write_bytes(body)
    assert {r.path for r in list_files(spark, str(tmp_path)).collect()} == {"d/b"}
    assert {(r.path, r.bytes) for r in list_files(spark, str(tmp_path), empty=True).collect()} == {("d/a", 0), ("d/b", 2)}
    digests = {r.path: r.sha256 for r in hash_files(spark, str(tmp_path), empty=True).collect()}
    assert digests == {"d/a": hashlib.sha256(b"").hexdigest(), "d/b": hashlib.sha256(b"x\n").hexdigest()}
    one = list_files(spark, str(tmp_path / "d" / "a"), empty=True).first()
    assert one.bytes == 0


def test_portions_keep_keys_together(spark):
    from recordloom.session import staged_portions

    df = spark.createDataFrame([(i % 50 if i else None, f"v{i}") for i in range(400)], "k int, v string")
    portions = [[tuple(r) for r in p.collect()] for p in staged_portions(df, "k", 7, "portions")]
    assert len(portions) == 7 and sorted(sum(portions, []), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    keys = [{k for k, _ in p} for p in portions]
    assert sum(map(len, keys)) == len(set().union(*keys))
    assert [p for p in staged_portions(df, "k", 1, "portions")] == [df]
