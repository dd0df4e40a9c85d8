"""Session settings, the shared work folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_folders: dict[str, str] = {}


def local_session(cores: int | str = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rivulet")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local`` master may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="rivulet-")
    return _local_folders[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage; later plans start from the copy.

    The rows stay in their partitions and order, but with adaptive execution the planner no longer
    knows the partitioning. Where a join should reuse it, take ``BucketedCopy``.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``; none when it does not exist."""
    store, target = _file_system(spark, path)
    return [s.getPath().getName() for s in store.listStatus(target) if s.isDirectory()] if store.exists(target) else []


def make_folder(spark: SparkSession, path: str) -> None:
    """Create ``path`` if it is missing, so that a stream can wait for files in it."""
    store, target = _file_system(spark, path)
    store.mkdirs(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete what a job of this session wrote under ``path``."""
    store, target = _file_system(spark, path)
    store.delete(target, True)


@contextmanager
def configured(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """What is started inside has the setting; afterwards it is as before."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def lean_shuffles(spark: SparkSession):
    """The shuffle files of a job or micro-batch started inside go when it ends, not at some later collection."""
    return configured(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def write_once(df: DataFrame, path: str) -> None:
    """Write ``df``, which is not used again, to ``path``."""
    with lean_shuffles(df.sparkSession):
        df.write.parquet(path)


class BucketedCopy:
    """``df`` as a table in the shared folder, bucketed by ``keys`` into as many buckets as a shuffle has.

    A join or aggregation on ``keys`` reads ``table`` without a shuffle, as often as it is used. With
    ``spread`` the rows are shuffled by the keys first, so that each bucket is one file; rows that lie
    by the keys already need not be. ``first`` names columns to sort by before the keys, for filters that skip
    row groups. ``drop`` removes table and files once nothing reads them any more.
    """

    def __init__(self, df: DataFrame, *keys: str, spread: bool = True, first: tuple[str, ...] = ()):
        self.spark = df.sparkSession
        self.name = f"rivulet_{uuid.uuid4().hex}"
        self.path = fresh_path(self.spark, "buckets")
        width = shuffle_width(self.spark)
        rows = df.repartition(width, *keys) if spread else df
        (
            rows.write.format("parquet")
            .bucketBy(width, *keys)
            .sortBy(*first, *keys)
            .option("path", self.path)
            .saveAsTable(self.name)
        )
        self.table = self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_folder(self.spark, self.path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Mark ``df`` for broadcast only when its rows and bytes, counted, prove it small; otherwise leave the choice open.

    Bytes are those of the rows as JSON, about what a table of short columns takes in memory.
    """
    width = F.octet_length(F.to_json(F.struct("*")))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def ordered_for_join(df: DataFrame, *order: str) -> DataFrame:
    """``df``, spread by the key of a join that follows, with the rows of a task sorted by ``order``.

    Spark drops a sort below a join; it cannot see that the test after the sort is always true, so the sort stays.
    """
    return df.sortWithinPartitions(*order).where(F.monotonically_increasing_id() >= 0)


def spread_if_narrow(scan: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread a plain ``scan`` whose files split into fewer tasks than there are cores.

    Large inputs have enough splits and are left alone. Only for scans: asking a plan with shuffles
    for its partitions would run them.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, *keys) if scan.rdd.getNumPartitions() < cores else scan


def literal_table(spark: SparkSession, column: str, values: list, sql_type: str) -> DataFrame:
    """A one-column table from a parameter list; one row per item, repeats kept."""
    items = F.array(*[F.lit(v).cast(sql_type) for v in values])
    return spark.range(1).select(F.explode(items).alias(column))
