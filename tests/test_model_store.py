"""Stored models: versions, manifests, and which model serves after a gate."""

from __future__ import annotations

import glob

import pytest

from countertide.operators import boosting, metrics
from countertide.operators.boosting import Boosted, Setting
from countertide.sources.model_store import Manifest, ManifestConflict, ModelStore, UnreadableModel, gate_stored


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(float(k % 7), float(k % 7 > 3)) for k in range(70)], "a double, y double")


@pytest.fixture(scope="module")
def fitted(rows):
    return {n: boosting.fit_boosted(rows, ("a",), "y", [Setting(n, 2, 0.5)])[0] for n in (0, 1, 5)}


def score(model, df):
    return metrics.regression_metrics(model.transform(df, "p"), "y", "p")


@pytest.fixture()
def store(spark, tmp_path):
    return ModelStore(spark, f"file://{tmp_path}/models")


def gate(store, version, rows, metric="rmse", **more):
    return gate_stored(store, "m", version, rows, score, metric, **more).head()


def test_versions_come_back_unchanged(store, fitted):
    version = store.save("m", fitted[5])
    assert store.load("m", version) == fitted[5] and store.serving("m") is None
    assert isinstance(store.load("m", version), Boosted)


def test_first_model_serves_and_better_ones_replace_it(store, fitted, rows):
    first = store.save("m", fitted[1])
    got = gate(store, first, rows)
    assert got.promoted and got.reason == "no_champion" and got.old_score == 0.0 and got.serving == first
    worse = gate(store, store.save("m", fitted[0]), rows)
    assert not worse.promoted and worse.reason == "compared" and worse.serving == first and worse.gain < 0
    better = store.save("m", fitted[5])
    got = gate(store, better, rows)
    assert got.promoted and got.gain > 0 and store.serving("m") == Manifest(1, better, first)
    again = gate(store, store.save("m", fitted[5]), rows, min_gain=0.01)
    assert not again.promoted and again.gain == 0.0


def damage(store, version):
    path = store.root.removeprefix("file://") + f"/m/versions/{version}"
    for f in glob.glob(f"{path}/*.parquet"):
        with open(f, "r+b") as file:
            file.seek(20)
            file.write(b"\0" * 40)
    for f in glob.glob(f"{path}/.*.crc"):
        with open(f, "r+b") as file:
            file.write(b"\0" * 8)


def test_corrupt_champion_is_replaced(store, fitted, rows):
    old = store.save("m", fitted[5])
    gate(store, old, rows)
    damage(store, old)
    with pytest.raises(UnreadableModel):
        store.load("m", old)
    new = store.save("m", fitted[0])
    got = gate(store, new, rows)
    assert got.promoted and got.reason == "champion_unreadable" and got.serving == new


def test_missing_champion_version_is_replaced(store, fitted, rows):
    store.promote("m", "never-saved", None)
    got = gate(store, store.save("m", fitted[0]), rows)
    assert got.promoted and got.reason == "champion_unreadable"


def test_champion_that_needs_other_inputs_is_replaced(store, fitted, rows, spark):
    wide = boosting.fit_boosted(rows.withColumnRenamed("a", "gone"), ("gone",), "y", [Setting(1)])[0]
    gate(store, store.save("m", wide), rows.withColumnRenamed("a", "gone"))
    got = gate(store, store.save("m", fitted[0]), rows)
    assert got.promoted and got.reason == "champion_failed"


@pytest.mark.parametrize("kind", ["corrupt", "missing"])
def test_failing_challenger_changes_nothing(store, fitted, rows, kind):
    old = store.save("m", fitted[1])
    gate(store, old, rows)
    new = store.save("m", fitted[5]) if kind == "corrupt" else "never-saved"
    if kind == "corrupt":
        damage(store, new)
    got = gate(store, new, rows)
    assert not got.promoted and got.reason == "challenger_failed" and got.new_score is None
    assert store.serving("m").version == old


def test_two_writers_cannot_take_one_number(store, fitted):
    a, b = store.save("m", fitted[0]), store.save("m", fitted[1])
    seen = store.serving("m")
    store.promote("m", a, seen)
    with pytest.raises(ManifestConflict):
        store.promote("m", b, seen)
    assert store.serving("m") == Manifest(0, a, None)
