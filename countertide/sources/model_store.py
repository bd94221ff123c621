"""Versioned models in a shared folder, and the manifest log that names the serving version.

A version is a written table, one row a tree, with a checksum, and never changes. Promotion adds the next numbered manifest:
it is written aside and renamed to its number, which fails if another writer took that number first. The manifest with the
highest number serves, so readers see either the old or the new version, never half of one. The file system must rename
atomically (a local disk, HDFS).
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countertide.operators import gates
from countertide.operators.boosting import Boosted, Tree


class UnreadableModel(Exception):
    """A stored version that is missing, damaged or not what its checksum says."""


class ManifestConflict(Exception):
    """Another writer promoted a version in the meantime."""


@dataclass(frozen=True)
class Manifest:
    number: int
    version: str
    previous: str | None


class ModelStore:
    """Versions and manifests of the models under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def save(self, name: str, model: Boosted) -> str:
        """Write a version and return its name. Nothing serves it yet."""
        version = uuid.uuid4().hex
        head = json.loads(model.to_json()) | {"trees": []}
        digest = hashlib.sha256(model.to_json().encode()).hexdigest()
        rows = [(-1, json.dumps({"head": head, "trees": len(model.trees), "sha256": digest}))]
        rows += [(k, json.dumps(t.plain())) for k, t in enumerate(model.trees)]
        self.spark.createDataFrame(rows, "place int, content string").coalesce(1).write.parquet(f"{self.root}/{name}/versions/{version}")
        return version

    def load(self, name: str, version: str) -> Boosted:
        try:
            rows = self.spark.read.schema("place int, content string").parquet(f"{self.root}/{name}/versions/{version}").collect()
            parts = {r["place"]: json.loads(r["content"]) for r in rows}
            head = parts.pop(-1)
            trees = [Tree(**parts[k]).plain() for k in range(head["trees"])]
            model = Boosted.from_json(json.dumps(head["head"] | {"trees": trees}))
        except Exception as bad:  # whatever a damaged file raises
            raise UnreadableModel(f"{name}/{version}: {type(bad).__name__}") from bad
        if hashlib.sha256(model.to_json().encode()).hexdigest() != head["sha256"]:
            raise UnreadableModel(f"{name}/{version}: other content than was saved")
        return model

    def serving(self, name: str) -> Manifest | None:
        """The manifest with the highest number."""
        files, folder = self._files(), self._path(name, "manifests")
        if not files.exists(folder):
            return None
        numbers = [int(n) for n in (s.getPath().getName() for s in files.listStatus(folder)) if n.isdigit()]
        if not numbers:
            return None
        stream = files.open(self._path(name, "manifests", f"{max(numbers):010d}"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return Manifest(max(numbers), **json.loads(text))

    def promote(self, name: str, version: str, seen: Manifest | None) -> Manifest:
        """Let ``version`` serve, provided that ``seen`` is still what serves."""
        files = self._files()
        new = Manifest(seen.number + 1 if seen else 0, version, seen.version if seen else None)
        aside, place = self._path(name, "aside", uuid.uuid4().hex), self._path(name, "manifests", f"{new.number:010d}")
        files.mkdirs(place.getParent())
        stream = files.create(aside)
        stream.write(bytearray(json.dumps({"version": new.version, "previous": new.previous}).encode()))
        stream.close()
        if files.exists(place):
            files.delete(aside, False)
            raise ManifestConflict(f"{name}: manifest {new.number} is taken")
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark._sc._gateway.new_array(options, 1)
        none[0] = options.NONE
        try:
            context.rename(aside, place, none)
        except Exception as taken:
            files.delete(aside, False)
            raise ManifestConflict(f"{name}: manifest {new.number} is taken") from taken
        return new


def gate_stored(store: ModelStore, name: str, challenger: str, test: DataFrame, score, metric: str, min_gain: float = 0.0) -> DataFrame:
    """Compare a saved version with the serving one on the same written test rows, and let the better one serve.

    ``score(model, test)`` gives a one-row metric table. A challenger that cannot be read or scored changes nothing; a champion that
    is missing, cannot be read or fails on these rows is replaced. One row: metric, scores, gain, promoted, reason.
    """
    seen = store.serving(name)
    try:
        new = _once(score(store.load(name, challenger), test))
    except Exception:
        kept = seen.version if seen else None
        empty = store.spark.range(1).select(
            F.lit(metric).alias("metric"), *[F.lit(None).cast("double").alias(c) for c in ("new_score", "old_score", "gain")]
        )
        return empty.select("*", F.lit(False).alias("promoted"), F.lit("challenger_failed").alias("reason"), F.lit(kept).cast("string").alias("serving"))
    old, reason = None, "no_champion"
    if seen:
        try:
            old, reason = _once(score(store.load(name, seen.version), test)), "compared"
        except UnreadableModel:
            reason = "champion_unreadable"
        except Exception:  # most often inputs that the rows no longer have
            reason = "champion_failed"
    verdict = _once(gates.champion_gate(new, old, metric, min_gain))
    if verdict.head()["promoted"]:
        store.promote(name, challenger, seen)
    return verdict.withColumns({"reason": F.lit(reason), "serving": F.lit(store.serving(name).version)})


def _once(table: DataFrame) -> DataFrame:
    """A one-row table with its values held, so that later changes of files do not reach it."""
    return table.sparkSession.createDataFrame(table.limit(1).collect(), table.schema)
