"""Snapshot streams: exactly-once landing, first-write-wins upserts, running endpoints, daily summaries.

Every job takes a streaming DataFrame, so the same code runs on files, a message log or a test
source, and every sink can be replayed: a repeated batch overwrites its own output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from countertide.operators.history import COUNTERS, endpoints
from countertide.operators.ingest import new_rows
from countertide.sources.landing import with_date

# The retention of the stored series: nothing that would be kept is ever too late to be landed.
LATENESS = "60 days"
BATCH = "batch"
RUNS = "_runs"
FAN = 8  # batches, or runs, that are merged into a longer run


def snapshot_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None, fmt: str = "parquet"
) -> DataFrame:
    """New files of a folder as a stream. Times without zone are cast, because watermarks need a zone."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stream = reader.load(path)
    naive = [f.name for f in schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return stream.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else stream


def _started(writer: DataStreamWriter, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def land_snapshots(
    stream: DataFrame, path: str, checkpoint: str, lateness: str = LATENESS, available_now: bool = True
) -> StreamingQuery:
    """Append each (video_id, time) once, under one folder per date.

    The state holds the keys of the last ``lateness`` only, and the file sink commits per batch. Rows later than that are
    dropped; :func:`land_every_snapshot` lands those too.
    """
    unique = stream.withWatermark("time", lateness).dropDuplicates(["video_id", "time"])
    writer = with_date(unique).writeStream.format("parquet").outputMode("append").partitionBy("date")
    return _started(writer.option("path", path), checkpoint, available_now)


def land_every_snapshot(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append each (video_id, time) once, however late it comes, under one folder per date and batch.

    There is no watermark and no state. A batch is compared with what earlier batches stored of the dates that it holds,
    by the two key columns alone, so a row that is months late costs a look at its own date. Of rows with one key in a
    batch the least stays. A batch that runs again overwrites its own folders and ignores those of later batches.
    """
    schema = stream.schema
    known = StructType([schema["video_id"], schema["time"]]).add("date", "date").add(BATCH, "long")

    def insert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        days = [r[0] for r in batch.select(F.to_date("time")).distinct().collect()]  # no more than the calendar has
        single = batch.groupBy("video_id", "time").agg(F.min(F.struct("*")).alias("_row")).select("_row.*")
        if _exists(spark, path):
            held = F.col("date").isin([d for d in days if d]) | (F.col("date").isNull() if None in days else F.lit(False))
            stored = spark.read.schema(known).parquet(path).filter(held & (F.col(BATCH) < batch_id))
            stored = stored.select(F.col("video_id").alias("_id"), F.col("time").alias("_time"))
            same = F.col("video_id").eqNullSafe(F.col("_id")) & F.col("time").eqNullSafe(F.col("_time"))
            single = single.join(stored, same, "left_anti")
        fresh = with_date(single).withColumn(BATCH, F.lit(batch_id).cast("long")).hint("rebalance", "date")
        writer = fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("date", BATCH).parquet(path)

    return _started(stream.writeStream.foreachBatch(insert), checkpoint, available_now)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def upsert_items(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = ("video_id",),
    prefer: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Insert-if-absent per micro-batch.

    Each batch owns one folder and only compares itself with earlier ones, so running a batch again
    after a failure gives the same table.
    """
    schema = stream.schema

    def insert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id == 0:
            stored = spark.createDataFrame([], schema)
        else:
            stored = read_batches(spark, path, schema).filter(F.col(BATCH) < batch_id)
        order = F.col(prefer) if prefer else None
        fresh = new_rows(stored, batch, keys, order).select(*schema.names)
        fresh.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return _started(stream.writeStream.foreachBatch(insert), checkpoint, available_now)


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table behind a batch-wise sink, with the batch number."""
    return spark.read.schema(StructType([*schema.fields]).add(BATCH, "long")).parquet(path)


def track_endpoints(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    measures: Sequence[str] = COUNTERS,
    available_now: bool = True,
    fan: int = FAN,
) -> StreamingQuery:
    """First and last counters per item, kept as state of one row per item; changed rows per batch go to the sink.

    Each ``fan`` batches are merged into a run that holds the newest row of an item, each ``fan`` runs into a longer one,
    and so on; so a row is rewritten once a level, and readers need ``fan`` runs a level at most. Batches and runs never
    change once they are written, and a repeated batch writes the same ones again.
    """
    changed = endpoints(stream, measures=measures)
    schema = changed.schema

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
        span = fan
        while (batch_id + 1) % span == 0:
            first = batch_id + 1 - span
            parts = _covering(_stored_runs(batch.sparkSession, path), first, batch_id, shorter_than=span)
            newest = _newest(_read_runs(batch.sparkSession, path, schema, parts))
            newest.write.mode("overwrite").parquet(f"{path}/{RUNS}/{first}-{batch_id}")
            span *= fan

    return _started(changed.writeStream.outputMode("update").foreachBatch(store), checkpoint, available_now)


def _stored_runs(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(first, last batch) of all batches and of the runs whose write has ended."""
    api = spark._jvm.org.apache.hadoop.fs
    root = api.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def ended(folder: str) -> list[str]:
        at = api.Path(folder)
        names = [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []
        return [n for n in names if files.exists(api.Path(f"{folder}/{n}/_SUCCESS"))]

    batches = [int(n.partition("=")[2]) for n in ended(path) if n.startswith(f"{BATCH}=")]
    runs = [tuple(int(x) for x in n.split("-")) for n in ended(f"{path}/{RUNS}")]
    return [(b, b) for b in batches] + runs


def _covering(stored: list[tuple[int, int]], first: int = 0, last: int | None = None, shorter_than: int | None = None) -> list[tuple[int, int]]:
    """The fewest batches and runs that hold all batches from ``first`` to ``last``: runs of ``fan`` powers nest, so the longest is taken."""
    last = max((b for _, b in stored), default=-1) if last is None else last
    fitting = [(a, b) for a, b in stored if b <= last and (shorter_than is None or b - a + 1 < shorter_than)]
    longest: dict[int, int] = {}
    for a, b in fitting:
        longest[a] = max(b, longest.get(a, b))
    out = []
    while first <= last:
        if first not in longest:
            raise ValueError(f"batch {first} is not stored")
        out.append((first, longest[first]))
        first = longest[first] + 1
    return out


def _read_runs(spark: SparkSession, path: str, schema: StructType, parts: Sequence[tuple[int, int]]) -> DataFrame:
    full = StructType([*schema.fields]).add(BATCH, "long")
    out = spark.createDataFrame([], full)
    single = [f"{path}/{BATCH}={a}" for a, b in parts if a == b]
    merged = [f"{path}/{RUNS}/{a}-{b}" for a, b in parts if a < b]
    if single:
        out = out.unionByName(spark.read.schema(full).option("basePath", path).parquet(*single))
    return out.unionByName(spark.read.schema(full).parquet(*merged)) if merged else out


def _newest(versions: DataFrame) -> DataFrame:
    return versions.groupBy("video_id").agg(F.max_by(F.struct("*"), BATCH).alias("_row")).select("_row.*")


def current_endpoints(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest version of each item from the runs that :func:`track_endpoints` stored."""
    return _newest(_read_runs(spark, path, schema, _covering(_stored_runs(spark, path)))).select(*schema.names)


def drop_merged(spark: SparkSession, path: str, before: int) -> int:
    """Delete batches and runs that lie in a longer run of batches below ``before``; returns how many.

    Readers list what they read when they start, so ``before`` should be a batch that was stored before the oldest
    running reader began, and never one that the stream may still repeat. Ended writes are told by their ``_SUCCESS`` file.
    """
    stored = _stored_runs(spark, path)
    api = spark._jvm.org.apache.hadoop.fs
    files = api.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    needed = set(_covering([(a, b) for a, b in stored if b < before], last=None)) if stored else set()
    gone = [(a, b) for a, b in stored if b < before and (a, b) not in needed]
    for a, b in gone:
        files.delete(api.Path(f"{path}/{BATCH}={a}" if a == b else f"{path}/{RUNS}/{a}-{b}"), True)
    return len(gone)


def daily_summary(
    stream: DataFrame, path: str, checkpoint: str, lateness: str = "10 minutes", available_now: bool = True
) -> StreamingQuery:
    """Count and mean log counters per day, for drift over time; a day is final once the watermark passed it."""
    writer = summary_of_windows(stream.withWatermark("time", lateness)).writeStream.format("parquet")
    return _started(writer.outputMode("append").option("path", path), checkpoint, available_now)


def summary_of_windows(df: DataFrame) -> DataFrame:
    """The aggregation of :func:`daily_summary`, for batch tables too."""
    daily = df.groupBy(F.window("time", "24 hours").alias("w")).agg(
        F.count(F.lit(1)).alias("snapshots"),
        *[F.avg(F.log1p(F.col(c).cast("double"))).alias(f"mean_log_{c}") for c in COUNTERS],
    )
    return daily.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "snapshots",
        *[f"mean_log_{c}" for c in COUNTERS],
    )
