"""Tables written to the cluster's shared folder, used to cut lineage and to freeze a physical layout.

A frozen table survives the loss of executors, and unlike a row checkpoint it keeps column
pruning and predicate pushdown for whatever reads it next.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for local masters without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    already = context.getCheckpointDir()
    if already:
        return already.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _own_dirs:
        _own_dirs[context.applicationId] = tempfile.mkdtemp(prefix="countertide-")
    return _own_dirs[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/countertide/{label}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a reader over the written files."""
    return read_back(df.sparkSession, write_once(df, label), df.schema)


def write_once(df: DataFrame, label: str) -> str:
    """Write ``df`` to a path of its own and return the path.

    What the write shuffled is removed from the executors' disks with its end, as readers start from the written files;
    otherwise it would lie there until the driver collects its garbage.
    """
    path = fresh_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return path


@contextmanager
def frozen_while(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """A frozen table that is deleted with the end of the block: rows that a fit reads several times and nothing reads after it.

    Unlike cached rows they take no memory of the executors between two passes.
    """
    spark = df.sparkSession
    path = write_once(df, label)
    try:
        yield read_back(spark, path, df.schema)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def short_batches(spark: SparkSession, rows: int, size: str = "8m") -> Iterator[None]:
    """Jobs that run in the block hand at most ``rows`` rows of about ``size`` at once to Python, and leave no shuffle files."""
    with _settings(spark, {ARROW_ROWS: str(rows), ARROW_BYTES: size}), shuffles_removed(spark):
        yield


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Jobs that run in the block remove what they shuffled with their end, not with the driver's next garbage collection."""
    return _settings(spark, {CLEAN_SHUFFLES: "true"})


@contextmanager
def _settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def read_back(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
