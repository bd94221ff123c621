"""Retention that frees space: expired dates of a stored series are withdrawn from readers first and deleted later.

A withdrawal is an empty file under ``_retention`` whose name holds the time of the decision and the first date that is
kept; Spark's readers skip folders that start with an underscore. Readers that begin after it leave the older dates out
by partition pruning. Readers that began before it may still have listed their files, so folders go only when a
withdrawal is older than the grace that the longest reader needs. Both steps can be repeated, and a sweep that was cut
off is finished by the next one.

Defined results: a missing or empty table has nothing to withdraw; rows without a date never expire; rows of a withdrawn
date that come late are not read and go with the next sweep.
"""

from __future__ import annotations

import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "_retention"
_STAMP = "%Y%m%dT%H%M%S"


def _folder(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path as its object."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    files, folder = _folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def withdrawals(spark: SparkSession, path: str) -> list[tuple[dt.datetime, dt.date]]:
    """(time of the decision, first date that is kept), in order of time."""
    told = (name.split("_") for name in _names(spark, f"{path}/{LOG}"))
    return sorted((dt.datetime.strptime(at, _STAMP), dt.date.fromisoformat(first)) for at, first in told)


def withdraw(spark: SparkSession, path: str, asof: dt.datetime, days: int = 60) -> dt.date:
    """Hide the dates all of whose rows are older than ``days`` before ``asof``; returns the first date that is kept."""
    first = (asof - dt.timedelta(days=days)).date()
    files, entry = _folder(spark, f"{path}/{LOG}/{asof.strftime(_STAMP)}_{first.isoformat()}")
    files.mkdirs(entry.getParent())
    files.createNewFile(entry)  # false where the same decision is there already
    return first


def first_kept(spark: SparkSession, path: str, decided_by: dt.datetime | None = None) -> dt.date | None:
    """The latest first date of all withdrawals, or of those decided up to a time: a date that went never comes back."""
    return max((first for at, first in withdrawals(spark, path) if decided_by is None or at <= decided_by), default=None)


def read_kept(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The stored series without withdrawn dates."""
    stored = spark.read.format(fmt).load(path)
    first = first_kept(spark, path)
    if first is None:
        return stored
    return stored.filter(F.col("date").isNull() | (F.col("date") >= F.lit(first)))


def sweep(spark: SparkSession, path: str, asof: dt.datetime, grace: dt.timedelta = dt.timedelta(days=1)) -> list[dt.date]:
    """Delete the folders of dates that were withdrawn at least ``grace`` before ``asof``; returns their dates."""
    first = first_kept(spark, path, asof - grace)
    gone = []
    for name in sorted(_names(spark, path)) if first else []:
        day = _date_of(name)
        if day and day < first:
            files, folder = _folder(spark, f"{path}/{name}")
            files.delete(folder, True)
            gone.append(day)
    return gone


def _date_of(name: str) -> dt.date | None:
    column, _, value = name.partition("=")
    try:
        return dt.date.fromisoformat(unquote(value)) if column == "date" else None
    except ValueError:  # the folder of rows without a date
        return None
