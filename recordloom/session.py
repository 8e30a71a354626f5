"""Session helpers: the shared scratch folder and staged (written) tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_RETIRED = re.compile(r"\.[0-9a-f]{32}\.old")
_CHECKPOINT_SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}
_staged: list[str] = []

#: Tasks that write a portion.
PORTION_TASKS = 16


def local_session(app: str = "recordloom", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: executors on other
    machines could not read it.
    """
    configured = spark.conf.get(_CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_SETTING} to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="recordloom-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder; ``drop_staged`` removes what is put there."""
    path = f"{scratch_root(spark)}/recordloom/{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so later jobs see one fixed set of rows.

    Used instead of caching wherever a plan is read more than once: the files survive
    lost executors and cut the lineage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", 0).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_portions(df: DataFrame, by: str, count: int, name: str) -> Iterator[DataFrame]:
    """The rows in ``count`` portions, those of equal ``by`` in one.

    Written once, so that a portion reads its own files only; a single portion is ``df`` itself.
    """
    if count <= 1:
        yield df
        return
    placed = df.withColumn("_portion", F.pmod(F.xxhash64(by), F.lit(count)))
    path = scratch_path(df.sparkSession, name)
    dealt = placed.repartition(count * PORTION_TASKS, "_portion", F.pmod(F.hash(by), F.lit(PORTION_TASKS)))
    dealt.write.option("maxRecordsPerFile", 0).partitionBy("_portion").parquet(path)
    written = df.sparkSession.read.schema(placed.schema).parquet(path)
    for portion in range(count):
        yield written.where(F.col("_portion") == portion).select(*df.columns)


def drop_staged(spark: SparkSession) -> int:
    """Remove everything this process staged; frames built on it become unreadable."""
    removed = 0
    while _staged:
        removed += int(remove(spark, _staged.pop()))
    return removed


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside this block when it ends.

    For operations whose results are written within it: frames built on staged tables are
    unreadable afterwards.
    """
    before = len(_staged)
    try:
        yield
    finally:
        for path in _staged[before:]:
            remove(spark, path)
        del _staged[before:]


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.delete(target, True)


def publish(spark: SparkSession, staged: str, final: str) -> None:
    """Move a fully written folder to its final name, keeping the old one until then."""
    fs, source = _file_system(spark, staged)
    _, target = _file_system(spark, final)
    _, retired = _file_system(spark, f"{final}.{uuid.uuid4().hex}.old")
    replaced = fs.exists(target)
    if target.getParent() is not None:
        fs.mkdirs(target.getParent())
    if replaced and not fs.rename(target, retired):
        raise OSError(f"could not set aside {final}")
    if not fs.rename(source, target):
        if replaced:
            fs.rename(retired, target)
        raise OSError(f"could not publish {final}")
    if replaced:
        fs.delete(retired, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small metadata file through the cluster's file system."""
    fs, target = _file_system(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """Read one small metadata file through the cluster's file system."""
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def file_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it isn't there."""
    fs, target = _file_system(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(target)] if fs.exists(target) else []


def move_new(spark: SparkSession, path: str, final: str) -> bool:
    """Move one file or folder to a name that must be free; false if it is taken.

    The last step of a commit. Both names are in one folder of a file system whose renames are atomic and don't replace.
    """
    fs, source = _file_system(spark, path)
    _, target = _file_system(spark, final)
    fs.mkdirs(target.getParent())
    try:
        return not fs.exists(target) and fs.rename(source, target)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise


def recover(spark: SparkSession, final: str) -> bool:
    """Put a table back that a crash inside ``publish`` left set aside; true if there was one."""
    fs, target = _file_system(spark, final.rstrip("/"))
    if fs.exists(target) or target.getParent() is None or not fs.exists(target.getParent()):
        return False
    name = target.getName()
    aside = [s.getPath() for s in fs.listStatus(target.getParent()) if _RETIRED.fullmatch(s.getPath().getName().removeprefix(name))]
    return bool(aside) and fs.rename(aside[0], target)
