"""Each integrity check on a table made to fail or to pass it."""

from __future__ import annotations

import hashlib
import random

import pytest

from countertide.operators import integrity_suite as suite


def verdicts(df, **more):
    return {(r.check, r.column): r for r in suite.integrity_suite(df, "y", ["id"], **more).collect()}


@pytest.fixture(scope="module")
def rows():
    r = random.Random(1)
    return [(k, r.choice(["red", "blue", "green"]), float(r.random()), k % 2) for k in range(200)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, s string, x double, y int")


def test_a_sound_table_passes(spark, rows):
    got = verdicts(frame(spark, rows))
    assert {c for c, _ in got} == {*suite.LIMITS, "mixed_types"}
    assert all(r.status == "passed" for r in got.values()), [k for k, r in got.items() if r.status != "passed"]


@pytest.mark.parametrize(
    "check, values",
    [
        ("mixed_nulls", [None, " NaN "]),
        ("mixed_types", ["12", "-3.5"] * 5),
        ("special_characters", ["!!", "?"]),
        ("string_mismatch", ["Red", "re-d"]),
        ("length_outliers", ["blue" * 50] * 4),
    ],
)
def test_bad_strings_fail_their_check(spark, rows, check, values):
    bad = [(k, v, x, y) for (k, _, x, y), v in zip(rows, values)]
    got = verdicts(frame(spark, [*bad, *rows[len(values) :]]))
    assert got[check, "s"].status == "failed"
    others = {c for (c, _), r in got.items() if r.status == "failed"} - {check, "string_mismatch", "length_outliers"}
    assert not others


def test_leaks_are_found_and_few_rows_are_skipped(spark, rows):
    leak = [(k, s, y + 0.01 * (k % 3), y) for k, s, _, y in rows]
    assert verdicts(frame(spark, leak))["predictive_power", "x"].value > 0.95
    sorted_ids = [(k, s, x, int(k > 100)) for k, s, x, _ in rows]
    assert verdicts(frame(spark, sorted_ids))["identifier_label", "id"].status == "failed"
    few = verdicts(frame(spark, leak[:40]))
    assert {r.status for r in few.values()} == {"skipped"} and few["predictive_power", "x"].value is not None


def test_power_equals_a_plain_version(spark, rows):
    r = random.Random(4)
    data = [(k, s if k % 9 else None, x, r.choice([None, 0, 1, 1]) if k % 5 else None) for k, s, x, _ in rows]
    got = {x.feature: x.value for x in suite.predictive_power(frame(spark, data), "y", ["s"], ["id"]).collect()}
    known = [(int(hashlib.md5(str(k).encode()).hexdigest()[:8], 16) % 3, s, y) for k, s, _, y in data if y is not None]
    model = naive = 0.0
    for fold, s, y in known:
        others = [v for f, _, v in known if f != fold]
        near = [v for f, c, v in known if f != fold and c == s]
        model += (y - sum(near) / len(near)) ** 2
        naive += (y - sum(others) / len(others)) ** 2
    assert got["s"] == pytest.approx(max(0.0, 1 - model / naive))


def test_empty_table(spark, rows):
    got = verdicts(frame(spark, rows).limit(0))
    assert all(r.status == "skipped" for r in got.values())
