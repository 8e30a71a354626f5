"""Versioned attachments. Every document is a file cell whose lines are its versions."""

from pyspark.sql import functions as F

from recordloom.operators import attachments
from recordloom.operators.attachments import (
    archive,
    archive_name,
    as_base64,
    attachment_jobs,
    clean_name,
    delete_version,
    download_jobs,
    fetch,
    in_few_folders,
    latest_rows,
    latest_version,
    remove_archive,
    select_versions,
    status_counts,
    version_problems,
)
from recordloom.session import scratch_path, stage, staged_portions
from recordloom.sources.files import hash_files, list_files

from . import query, table

_CELLS = """
    WITH d AS (SELECT doc_id, lang, string_split(text, chr(10)) AS lines FROM documents),
    v AS (SELECT doc_id, lang, len(lines) AS n, i AS version, lines[i] AS line
          FROM d, unnest(range(1, len(lines) + 1)) AS u(i)),
    f AS (SELECT *, coalesce(nullif(CASE WHEN version % 2 = 0 THEN NULL ELSE line END, ''),
                             nullif(CASE WHEN lang = 'en' THEN '' ELSE lang || '.txt' END, ''),
                             'fid8_v' || version || '.bin') AS file_name
          FROM v)
"""


def _cells(spark, sf_dir):
    """Version i of a document is its line i, newest first; even versions have no own name."""
    lines = F.split("text", "\n")
    numbered = F.transform(
        lines,
        lambda line, i: F.struct(
            (i + 1).alias("versionNumber"),
            F.when((i + 1) % 2 == 1, line).alias("fileName"),
            F.octet_length(line).cast("bigint").alias("size"),
        ),
    )
    own = F.when(F.col("lang") == "en", F.lit("")).otherwise(F.concat("lang", F.lit(".txt")))
    cell = F.struct(own.alias("fileName"), F.reverse(numbered).alias("versions"))
    return table(spark, sf_dir, "documents").select("doc_id", cell.alias("file"))


@query(
    "attach_latest",
    _CELLS
    + """
    SELECT doc_id, version::INTEGER AS version_number, file_name FROM f WHERE version = n
    """,
)
def attach_latest(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    return cells.select("doc_id", latest_version(F.col("file"), 8).alias("v")).select("doc_id", "v.*")


@query(
    "attach_all",
    _CELLS + "SELECT doc_id, version::INTEGER AS version_number, strlen(line)::BIGINT AS size FROM f",
)
def attach_all(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    versions = cells.select("doc_id", F.explode(select_versions(F.col("file"))).alias("v"))
    return versions.select("doc_id", F.col("v.versionNumber").alias("version_number"), "v.size")


@query(
    "attach_order",
    _CELLS
    + """
    SELECT doc_id, string_agg(version::VARCHAR, ',' ORDER BY version) AS versions FROM f GROUP BY doc_id
    """,
)
def attach_order(spark, sf_dir):
    numbers = F.transform(select_versions(F.col("file")), lambda v: v["versionNumber"].cast("string"))
    return _cells(spark, sf_dir).select("doc_id", F.array_join(numbers, ",").alias("versions"))


_CLEAN = r"""regexp_replace({0}, '[<>:"/\\|?*]', '', 'g')"""
_STRIPPED = r"""regexp_replace(regexp_replace({0}, '[\x00-\x1f\x7f]', '', 'g'), '^\s+|\s+$', '', 'g')"""
_ARCHIVE = f"""
    , c AS (SELECT *, regexp_replace({_STRIPPED.format(_CLEAN.format('file_name'))}, '^\\.+|\\.+$', '', 'g') AS clean
            FROM f),
    m AS (SELECT *, CASE WHEN clean = '' THEN 'fid8_v' || version || '.bin' ELSE clean END AS made FROM c),
    cut AS (SELECT *, CASE WHEN strlen(made) <= 200 THEN made ELSE
              substring(made, 1, list_max(list_filter(range(1, 201),
                  lambda i: strlen(substring(made, 1, i)) <= 200))) END AS short
            FROM m),
    named AS (SELECT *, CASE WHEN starts_with(short, '_') THEN 'file' || short ELSE short END AS stored
              FROM cut)
"""


@query(
    "attach_jobs",
    _CELLS
    + _ARCHIVE
    + """
    SELECT doc_id AS record_id, 8::INTEGER AS field_id, version::INTEGER AS version_number, file_name,
           strlen(line)::BIGINT AS size,
           'tables/docs/attachments/' || doc_id || '/8/' || version || '/' || stored AS path
    FROM named
    """,
)
def attach_jobs(spark, sf_dir):
    return attachment_jobs(_cells(spark, sf_dir), "doc_id", {"file": 8}, "docs")


@query(
    "attach_latest_jobs",
    _CELLS
    + _ARCHIVE
    + """
    SELECT doc_id AS record_id, version::INTEGER AS version_number, stored
    FROM named WHERE version = n
    """,
)
def attach_latest_jobs(spark, sf_dir):
    jobs = attachment_jobs(_cells(spark, sf_dir), "doc_id", {"file": 8}, "docs", "latest")
    stored = F.regexp_extract("path", r"^tables/docs/attachments/\d+/8/\d+/([\s\S]*)$", 1)
    return jobs.select("record_id", "version_number", stored.alias("stored"))


_DOWNLOAD = rf"""
    , c AS (SELECT *, regexp_replace({_CLEAN.format('file_name')}, '^\s+|\s+$', '', 'g') AS clean FROM f)
    SELECT doc_id AS record_id, version::INTEGER AS version_number, {{0}}
           CASE WHEN clean = '' THEN 'attachment.bin' ELSE clean END AS path
    FROM c WHERE version = n
"""


@query("attach_downloads", _CELLS + _DOWNLOAD.format("doc_id || '_' ||"))
def attach_downloads(spark, sf_dir):
    jobs = download_jobs(_cells(spark, sf_dir), "doc_id", {"file": 8})
    return jobs.select("record_id", "version_number", "path")


@query("attach_table_downloads", _CELLS + _DOWNLOAD.format("doc_id || '_8_' ||"))
def attach_table_downloads(spark, sf_dir):
    jobs = download_jobs(_cells(spark, sf_dir), "doc_id", {"file": 8}, with_field_id=True)
    return jobs.select("record_id", "version_number", "path")


@query(
    "filename_clean",
    rf"""
    WITH c AS (SELECT page_id, regexp_replace({_CLEAN.format('url')}, '^\s+|\s+$', '', 'g') AS n FROM pages)
    SELECT page_id, CASE WHEN n = '' THEN 'attachment.bin' ELSE n END AS download_name,
           CASE WHEN n = '' THEN 'fid8_v1.bin' ELSE n END AS archived_name
    FROM c
    """,
)
def filename_clean(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id",
        clean_name(F.col("url")).alias("download_name"),
        archive_name(F.col("url"), F.lit(8), F.lit(1)).alias("archived_name"),
    )


@query(
    "attach_latest_rows",
    """
    SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text
    FROM conversations GROUP BY conv_id
    """,
)
def attach_latest_rows(spark, sf_dir):
    """Versions kept as rows: the turns of a conversation."""
    return latest_rows(table(spark, sf_dir, "conversations"), ["conv_id"], "turn")


@query(
    "version_problems",
    """
    WITH d AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda s: length(s)) AS n FROM documents)
    SELECT doc_id AS record_id, 8::INTEGER AS field_id, 'invalid version number' AS problem
    FROM d WHERE list_min(n) < 1
    UNION ALL SELECT doc_id, 8, 'repeated version number' FROM d WHERE len(n) <> len(list_distinct(n))
    """,
)
def problems(spark, sf_dir):
    """Version numbers taken from line lengths: some are zero, some repeat."""
    versions = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(
            F.length(line).alias("versionNumber"),
            line.alias("fileName"),
            F.octet_length(line).cast("bigint").alias("size"),
        ),
    )
    cell = F.struct(F.lit("a.txt").alias("fileName"), versions.alias("versions"))
    cells = table(spark, sf_dir, "documents").select("doc_id", cell.alias("file"))
    return version_problems(cells, "doc_id", {"file": 8})


@query(
    "attach_delete",
    """
    SELECT doc_id, len(string_split(text, chr(10))) - CASE WHEN doc_id = 3 THEN 1 ELSE 0 END AS versions
    FROM documents
    """,
)
def attach_delete(spark, sf_dir):
    """One record loses its latest version, all others keep theirs."""
    left = delete_version(_cells(spark, sf_dir), "doc_id", 3, "file", 0)
    return left.select("doc_id", F.size("file.versions").cast("bigint").alias("versions"))


def _contents(documents):
    """The stored bytes: a document's text is the content of its only version."""
    name = F.concat("lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit("?.txt"))
    versions = F.array(
        F.struct(
            F.lit(1).alias("versionNumber"),
            name.alias("fileName"),
            F.octet_length("text").cast("bigint").alias("size"),
        )
    )
    cell = F.struct(F.lit(None).cast("string").alias("fileName"), versions.alias("versions"))
    contents = documents.select(
        F.col("doc_id").alias("record_id"),
        F.lit(8).alias("field_id"),
        F.lit(1).alias("version_number"),
        F.encode("text", "utf-8").alias("content"),
        "source",
    )
    return documents.select("doc_id", cell.alias("file")), contents


@query(
    "attach_base64",
    """
    SELECT d.doc_id AS record_id, 8::INTEGER AS field_id,
           CASE WHEN l.doc_id IS NOT NULL THEN base64(encode(text)) END AS base64
    FROM documents d LEFT JOIN labels l USING (doc_id)
    """,
)
def attach_base64(spark, sf_dir):
    """Contents are stored for labelled documents only."""
    cells, contents = _contents(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("record_id"))
    stored = contents.join(labels, "record_id", "left_semi")
    found = as_base64(cells, "doc_id", {"file": 8}, stored)
    return found.withColumn("base64", F.regexp_replace("base64", "\r\n", ""))


@query(
    "attach_archive",
    """
    SELECT doc_id AS record_id, 8::INTEGER AS field_id, 1::INTEGER AS version_number,
           'tables/docs/attachments/' || doc_id || '/8/1/' || lang || doc_id || '.txt' AS path,
           sha256(text) AS sha256, strlen(text)::BIGINT AS bytes
    FROM documents
    """,
)
def attach_archive(spark, sf_dir):
    """Write every document as a file; the index has its digest."""
    cells, contents = _contents(table(spark, sf_dir, "documents"))
    jobs = attachment_jobs(cells, "doc_id", {"file": 8}, "docs")
    index = archive(jobs, contents, scratch_path(spark, "archive"))
    return index.select("record_id", "field_id", "version_number", "path", "sha256", "bytes")


@query(
    "attach_status",
    """
    WITH s AS (SELECT CASE WHEN quality = 1 THEN 'skipped' WHEN l.doc_id IS NULL THEN 'failed'
                           ELSE 'downloaded' END AS status
               FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT status, count(*) AS files FROM s GROUP BY status
    """,
)
def attach_status(spark, sf_dir):
    """Good documents are there already, unlabelled ones have no content, the rest is written."""
    cells, contents = _contents(table(spark, sf_dir, "documents"))
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "record_id")
    jobs = download_jobs(cells, "doc_id", {"file": 8})
    existing = jobs.join(labels.where("quality = 1"), "record_id", "left_semi")
    stored = contents.join(labels, "record_id", "left_semi")
    return status_counts(fetch(jobs, stored, scratch_path(spark, "fetch"), existing))


@query(
    "copy_by_uri",
    """
    SELECT doc_id AS record_id, sha256(text) AS sha256, strlen(text)::BIGINT AS bytes, base64(encode(text)) AS base64,
           (SELECT count(*) FROM documents) AS files
    FROM documents
    """,
)
def copy_by_uri(spark, sf_dir):
    """Documents written as files and copied from there by their places, digested and read back.

    Portion by portion: the files of one are removed before the next is written.
    """
    documents = table(spark, sf_dir, "documents")
    rows, size = documents.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    portions = max(-(-rows // attachments.STANDING_FILES), -(-size // attachments.STANDING_BYTES))
    out, files, archives = scratch_path(spark, "copied"), 0, []
    for portion in staged_portions(documents, "doc_id", portions, "documents"):
        for index, root in archives:
            remove_archive(index, root)
        found, archives = _copied(spark, portion, out)
        files += found
    return spark.read.parquet(out).withColumn("files", F.lit(files).cast("bigint"))


def _copied(spark, documents, out):
    """Copy some documents and add to ``out`` what was read where the digests agree.

    Returns the number of files digested, and index and root of both archives. The first is in few folders.
    """
    cells, contents = _contents(documents)
    jobs = attachment_jobs(cells, "doc_id", {"file": 8}, "docs")
    first, second = scratch_path(spark, "archive"), scratch_path(spark, "archive")
    sources = in_few_folders(jobs)
    written = archive(sources, contents, first)
    listed = list_files(spark, first, empty=True)
    placed = listed.join(sources, "path").select("record_id", "field_id", "version_number", "uri")
    copied = archive(jobs, placed, second)
    digests = stage(hash_files(spark, second, empty=True).select("path", F.col("sha256").alias("found")), "digests")
    read = as_base64(cells, "doc_id", {"file": 8}, placed).withColumn("base64", F.regexp_replace("base64", "\r\n", ""))
    same = copied.join(digests, "path").where("sha256 = found").join(read, ["record_id", "field_id"])
    same.select("record_id", "sha256", "bytes", "base64").write.mode("append").parquet(out)
    return digests.count(), [(written, first), (copied, second)]
