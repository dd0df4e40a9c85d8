"""Micro-batch outputs that survive a rerun of the same batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rivulet.functions.text import flatten_newlines
from rivulet.operators.bursts import late_drop_partials, merged_windows
from rivulet.operators.ordering import first_rows, running_total_before
from rivulet.runtime import cut_lineage, delete_folder, subfolders

REPORT_SCHEMA = "batch_id BIGINT, rerun BOOLEAN, total_size BIGINT"


class BatchTable:
    """``foreachBatch`` target: every batch is one folder of a table, overwritten when it runs again."""

    def __init__(
        self, path: str, schema: str, shape: Callable[[DataFrame], DataFrame] | None = None, keep: int | None = None
    ):
        """``keep``: how many of the newest batches stay; a complete-mode query needs two (one may run again)."""
        self.path, self.schema, self.shape, self.keep = path, schema, shape, keep

    def folder(self, batch_id: int) -> str:
        return f"{self.path}/rows/batch_id={batch_id}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = self.shape(batch) if self.shape else batch
        rows.write.mode("overwrite").parquet(self.folder(batch_id))
        for old in self.batches(batch.sparkSession)[: -self.keep] if self.keep else []:
            delete_folder(batch.sparkSession, self.folder(old))

    def rows(self, spark: SparkSession) -> DataFrame:
        """All batches, with ``batch_id``; empty when no batch has run."""
        schema = f"{self.schema}, batch_id BIGINT"
        if not self.batches(spark):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.path}/rows")

    def batches(self, spark: SparkSession) -> list[int]:
        """Ids of the stored batches, from the names of their folders."""
        names = subfolders(spark, f"{self.path}/rows")
        return sorted(int(name.removeprefix("batch_id=")) for name in names if name.startswith("batch_id="))

    def latest(self, spark: SparkSession) -> DataFrame:
        """The rows of the newest batch: the whole result of a complete-mode query."""
        stored = self.batches(spark)
        if not stored:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(self.folder(stored[-1]))


class ReportSink(BatchTable):
    """Writes the full batch and a report row: batch id, whether it ran before, total size.

    The size is counted on the written files, so the batch is not computed twice.
    """

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rerun = str(batch_id) in subfolders(batch.sparkSession, f"{self.path}/reports")  # also after a restart
        super().__call__(batch, batch_id)
        spark = batch.sparkSession
        written = spark.read.schema(self.schema).parquet(self.folder(batch_id))
        report = written.agg(F.count(F.lit(1)).alias("total_size")).select(
            F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(rerun).alias("rerun"), "total_size"
        )
        report.write.mode("overwrite").parquet(f"{self.path}/reports/{batch_id}")

    def reports(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(REPORT_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{self.path}/reports")


class Drained:
    """For targets that have enough at some time: they set ``full``."""

    full = False

    def drain(self, query: StreamingQuery, poll_s: float = 0.5) -> None:
        """Wait until the query ends or enough rows are stored, then stop it."""
        while not query.awaitTermination(poll_s):
            if self.full:
                query.stop()
                return


class FirstRows(Drained, BatchTable):
    """Keeps rows until ``n`` are stored; the batch that crosses the line is trimmed in time order."""

    def __init__(self, path: str, schema: str, n: int, time: str = "ts", id: str = "event_id"):
        super().__init__(path, schema)
        self.n, self.time, self.id = n, time, id

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        earlier = self.rows(batch.sparkSession).where(F.col("batch_id") < batch_id).count()
        room = self.n - earlier
        if room <= 0:
            self.full = True
            return
        stored = cut_lineage(batch)
        size = stored.count()
        kept = stored if size <= room else first_rows(stored, room, self.time, [self.id]).select(*batch.columns)
        super().__call__(kept, batch_id)
        self.full = size >= room


class LateDropWindows(BatchTable):
    """Tumbling windows over rows that arrive in time, decided record by record over all micro-batches.

    Spark's own watermark moves between micro-batches only. Here each batch is put in arrival ``order`` and
    every row is judged by the latest time that arrived before it, in its own batch or an earlier one;
    the latter is one stored number per batch. Stored are the windows' partial counts of each batch.
    """

    def __init__(self, path: str, delay_s: int, size_s: int, order: list[str]):
        super().__init__(path, "window_s BIGINT, action STRING, start_s BIGINT, end_s BIGINT, cnt BIGINT")
        self.delay_s, self.size_s, self.order = delay_s, size_s, order

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = self._latest(spark).where(F.col("batch_id") < batch_id).agg(F.max("latest_s")).scalar()
        super().__call__(late_drop_partials(batch, self.delay_s, self.size_s, self.order, seen), batch_id)
        latest = batch.agg(F.max("ts_s").alias("latest_s"))
        latest.write.mode("overwrite").parquet(f"{self.path}/latest/batch_id={batch_id}")

    def _latest(self, spark: SparkSession) -> DataFrame:
        schema = "latest_s BIGINT, batch_id BIGINT"
        if not subfolders(spark, f"{self.path}/latest"):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.path}/latest")

    def windows(self, spark: SparkSession, min_count: int = 0, closed: bool = False) -> DataFrame:
        """The windows of more than ``min_count`` rows so far; if ``closed``, only those that no row can reach any more."""
        rows = self.rows(spark)
        if closed:
            latest = self._latest(spark).agg(F.max("latest_s")).scalar()
            rows = rows.where((F.col("window_s") + self.size_s) * 1000 - 1 <= (latest - self.delay_s) * 1000)
        return merged_windows(rows, min_count)


class LineFiles:
    """Delimited text lines in files that roll over by bytes, each row once.

    A batch is a folder of its own, overwritten when it runs again, and counts only once it is in the commit
    list; readers take committed batches. In a batch the lines are in ``order`` (which is unique), and a
    new file begins with the line before which ``max_bytes`` bytes were written since the file began, so a
    file is longer than that by one line at most. Newlines in text become spaces.
    """

    COMMIT = "batch_id BIGINT, n_lines BIGINT, n_bytes BIGINT"

    def __init__(self, path: str, order: list[str], sep: str = "|", max_bytes: int = 5_000_000):
        self.path, self.order, self.sep, self.max_bytes = path, order, sep, max_bytes

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        fields = [
            F.coalesce(flatten_newlines(F.col(name).cast("string")), F.lit("")) for name in batch.columns
        ]
        lines = batch.select(*self.order, F.concat_ws(self.sep, *fields).alias("_line"))
        sized = lines.withColumn("_bytes", (F.octet_length("_line") + 1).cast("bigint"))
        placed = cut_lineage(running_total_before(sized, "_bytes", self.order, "_before"))
        rolled = placed.withColumn("file", F.floor(F.col("_before") / self.max_bytes))
        folder = f"{self.path}/lines/batch_id={batch_id}"
        (
            rolled.repartition("file").sortWithinPartitions("file", "_before")
            .select("file", F.col("_line").alias("value"))
            .write.mode("overwrite").partitionBy("file").text(folder)
        )
        commit = placed.agg(
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.count(F.lit(1)).alias("n_lines"), F.coalesce(F.sum("_bytes"), F.lit(0)).alias("n_bytes"),
        )
        commit.write.mode("overwrite").parquet(f"{self.path}/commits/{batch_id}")

    def commits(self, spark: SparkSession) -> DataFrame:
        if not subfolders(spark, f"{self.path}/commits"):
            return spark.createDataFrame([], self.COMMIT)
        return spark.read.schema(self.COMMIT).option("recursiveFileLookup", "true").parquet(f"{self.path}/commits")

    def lines(self, spark: SparkSession) -> DataFrame:
        """``batch_id, file, value`` of the committed batches."""
        schema = "value STRING, batch_id BIGINT, file BIGINT"
        done = [n for n in subfolders(spark, f"{self.path}/commits") if subfolders(spark, f"{self.path}/lines/batch_id={n}")]
        if not done:
            return spark.createDataFrame([], schema)
        folders = [f"{self.path}/lines/batch_id={n}" for n in sorted(done, key=int)]
        return spark.read.schema(schema).option("basePath", f"{self.path}/lines").text(folders)


class CollectedLines(Drained, LineFiles):
    """The first ``n`` rows by time, as lines ``place|…``; the batch that crosses the line is trimmed in time order.

    How many rows earlier batches gave is read from the commit list.
    """

    def __init__(self, path: str, n: int, time: str = "ts", id: str = "event_id", **options):
        super().__init__(path, ["pos"], **options)
        self.n, self.time, self.id = n, time, id

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self.commits(batch.sparkSession).where(F.col("batch_id") < batch_id)
        earlier = before.agg(F.coalesce(F.sum("n_lines"), F.lit(0))).first()[0]
        room = max(0, self.n - earlier)
        if room:
            kept = cut_lineage(first_rows(cut_lineage(batch), room, self.time, [self.id]))
            super().__call__(kept.select((F.col("pos") + earlier).alias("pos"), *batch.columns), batch_id)
            room -= kept.count()
        self.full = room == 0
