"""Readers for landed JSON and Parquet, and partitioned writers of the stored tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countertide.sources import schemas


def read_raw_items(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed items with the fixed nested schema; no inference pass over the files."""
    return spark.read.format(fmt).schema(schemas.RAW_ITEM).load(path)


def read_search_pages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.format(fmt).schema(schemas.SEARCH_PAGE).load(path)


def read_trending_pages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.format(fmt).schema(schemas.TRENDING_PAGE).load(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def with_date(df: DataFrame, time: str = "time") -> DataFrame:
    """Add the ``date`` column that partitions stored time series."""
    return df.withColumn("date", F.to_date(time))


def _by_date(df: DataFrame) -> DataFrame:
    """Rows gathered per date before a partitioned write.

    The rebalance hint lets the adaptive planner split a busy date over many tasks and files and
    merge quiet dates, instead of every task writing a small file for every date.
    """
    return with_date(df).hint("rebalance", "date")


def append_stats(batch: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append snapshots under one folder per date; of repeated (video_id, time) pairs, in the batch or stored, one stays.

    Of the stored rows only the dates between the first and the last one of the batch are read.
    """
    unique = batch.dropDuplicates(["video_id", "time"])
    first, last = unique.agg(F.to_date(F.min("time")), F.to_date(F.max("time"))).first()
    try:
        stored = read_table(batch.sparkSession, path, fmt)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        day = F.col("date").cast("date")
        known = stored.filter(day.between(F.lit(first), F.lit(last)) | day.isNull()).select(
            F.col("video_id").alias("_id"), F.col("time").alias("_time")
        )
        same = F.col("video_id").eqNullSafe(F.col("_id")) & F.col("time").eqNullSafe(F.col("_time"))
        unique = unique.join(known, same, "left_anti")
    _by_date(unique).write.mode("append").format(fmt).partitionBy("date").save(path)


def overwrite_dates(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace only the dates that occur in ``df``, so a repeated run leaves the same table."""
    writer = _by_date(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.format(fmt).partitionBy("date").save(path)
