"""Boosted trees against a plain version, over blocks of any size, with categories, folds and odd values."""

from __future__ import annotations

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from countertide.operators import boosting, metrics, models
from countertide.operators.boosting import Boosted, Setting

NAN = float("nan")


@pytest.fixture(scope="module")
def table(spark):
    r = random.Random(5)
    rows = []
    for i in range(400):
        a, b = r.choice([0.0, 1.0, 2.5, 3.0, 7.0, NAN, None]), r.gauss(0, 1)
        y = (a if a is not None and a == a else -2.0) + (3.0 if b > 0.4 else 0.0) + r.gauss(0, 0.2)
        rows.append((i, a, b, r.choice(["x", "y", None]), y, int(y > 2), i % 3, r.choice([1.0, 1.0, 2.5])))
    return spark.createDataFrame(rows, "id long, a double, b double, c string, y double, label int, fold int, w double").cache()


def plain_margins(x, borders, y, w, keep, s, base):
    """One row and one node at a time, in floating point."""
    bins = [[sum(v > e for e in edge) if v is not None and v == v else 0 for v, edge in zip(row, borders)] for row in x]
    margin = [base] * len(x)

    def slope(i):
        if s.loss == "logistic":
            p = 1 / (1 + math.exp(-margin[i]))
            return w[i] * (p - y[i]), w[i] * p * (1 - p)
        miss = margin[i] - y[i]
        g = max(-1.0, min(1.0, miss)) if s.loss == "huber" else (miss > 0) - (miss < 0) if s.loss == "absolute" else miss
        return w[i] * g, w[i]

    def score(rows, gh):
        g, h = sum(gh[i][0] for i in rows), sum(gh[i][1] for i in rows)
        return g * g / (h + s.leaf_penalty)

    for _ in range(s.rounds):
        gh = [slope(i) for i in range(len(x))]
        leaves = [list(range(len(x)))]
        finished = []
        for _ in range(s.depth):
            cuts = []
            for rows in leaves:
                best = []
                for f in range(len(borders)):
                    for b in range(boosting.BINS - 1):
                        left, right = [i for i in rows if bins[i][f] <= b], [i for i in rows if bins[i][f] > b]
                        small = min(sum(keep[i] for i in left), sum(keep[i] for i in right)) < s.min_rows
                        used = [[i for i in part if keep[i]] for part in (left, right, rows)]
                        gain = score(used[0], gh) + score(used[1], gh) - score(used[2], gh)
                        best.append((-1.0 if small and not s.symmetric else gain, -f, -b, left, right))
                cuts.append(best)
            if s.symmetric:
                total = [sum(c[k][0] for c in cuts) for k in range(len(cuts[0]))]
                at = max(range(len(total)), key=lambda k: (round(total[k], 7), -k))
                leaves = [part for c in cuts for part in c[at][3:]] if total[at] > 1e-6 else leaves
                continue
            following = []
            for rows, best in zip(leaves, cuts):
                at = max(range(len(best)), key=lambda k: (round(best[k][0], 7), -k))
                if best[at][0] > 1e-6:
                    following += best[at][3:]
                else:
                    finished.append(rows)
            leaves = following
        for rows in leaves + finished:
            used = [i for i in rows if keep[i]]
            g, h = sum(gh[i][0] for i in used), sum(gh[i][1] for i in used)
            for i in rows:
                margin[i] -= s.rate * g / (h + s.leaf_penalty)
    return margin


CASES = [
    Setting(4, 3, 0.5, 1.0, 1, "squared", symmetric=True),
    Setting(3, 2, 0.5, 5.0, 1, "huber", symmetric=True),
    Setting(3, 3, 0.4, 1.0, 20, "huber"),
    Setting(2, 2, 0.4, 1.0, 5, "absolute"),
    Setting(3, 2, 0.3, 1.0, 10, "logistic", fold=1),
]


@pytest.mark.parametrize("setting", CASES, ids=lambda s: f"{s.loss}{'-symmetric' * s.symmetric}")
def test_equals_plain_version(spark, table, setting):
    logistic = setting.loss == "logistic"
    part = table.limit(90).cache()
    model = boosting.fit_boosted(part, ("a", "b"), "label" if logistic else "y", [setting], weight="w", fold="fold")[0]
    rows = part.collect()
    y = [float(r.label if logistic else r.y) for r in rows]
    want = plain_margins([(r.a, r.b) for r in rows], model.borders, y, [r.w for r in rows], [r.fold != setting.fold for r in rows], setting, model.base)
    got = {r.id: r.margin for r in model.transform(part).select("id", "margin").collect()}
    assert max(abs(got[r.id] - m) for r, m in zip(rows, want)) < 1e-4


@pytest.mark.parametrize("block_rows", [37, 150, 1000])
def test_trees_do_not_depend_on_blocks(table, block_rows):
    """One block in a task, or many blocks and jobs by level with margins written in between: the same trees."""
    settings = [Setting(12, 3, 0.3, 1.0, 2, "logistic", fold=f) for f in (-1, 0, 2)] + [Setting(5, 6, 0.3, 1.0, 1, "logistic")]
    one = boosting.fit_boosted(table, ("a", "b"), "label", settings, weight="w", fold="fold", block_rows=10_000)
    many = boosting.fit_boosted(table.repartition(5), ("a", "b"), "label", settings, weight="w", fold="fold", block_rows=block_rows)
    assert [m.to_json() for m in one] == [m.to_json() for m in many]
    assert [len(m.trees) for m in one] == [12, 12, 12, 5]


def test_bounded_open_nodes_give_the_same_trees(table, monkeypatch):
    wide = boosting.fit_boosted(table, ("a", "b"), "y", [Setting(2, 8, 0.5, 0.1, 1, "squared")])
    monkeypatch.setattr(boosting, "OPEN_NODES", 3)
    assert wide[0].to_json() == boosting.fit_boosted(table, ("a", "b"), "y", [Setting(2, 8, 0.5, 0.1, 1, "squared")])[0].to_json()


def test_ordered_means_do_not_see_their_own_row(spark, table):
    got = boosting.ordered_means(table, "c", "y", ["id"], 1.5).orderBy("id").collect()
    turn = {r.id: r.t for r in table.select("id", F.xxhash64(F.concat_ws("|", F.col("id").cast("string"))).alias("t")).collect()}
    rows = table.collect()
    for r, g in zip(rows, got):
        before = [o.y for o in rows if o.c == r.c and (turn[o.id], o.id) < (turn[r.id], r.id)]
        assert g.c == pytest.approx((sum(before) + 1.5) / (len(before) + 1), abs=1e-8)
    means = boosting.category_means(table, "c", "y", 1.5)
    mine = [r.y for r in rows if r.c is None]
    assert set(means) == {"x", "y", ""} and means[""] == pytest.approx((sum(mine) + 1.5) / (len(mine) + 1))


def test_categories_serve_unknown_values_by_the_prior(spark, table):
    model = boosting.fit_boosted(table, ("a", "c"), "y", [Setting(3, 2, 0.5)], category="c", key=["id"])[0]
    asked = spark.createDataFrame([(1, 1.0, "never seen"), (2, None, None)], "id long, a double, c string")
    assert model.encoded(asked).orderBy("id").first()["_in_c"] == model.prior
    again = Boosted.from_json(model.to_json())
    assert again == model and again.transform(asked).collect() == model.transform(asked).collect()


def test_empty_and_constant_tables(spark, table):
    none = boosting.fit_boosted(table.limit(0), ("a", "b"), "y", [Setting(3)])[0]
    assert none.transform(table).filter("margin = 0.0").count() == 400
    flat = table.withColumns({"a": F.lit(1.0), "b": F.lit(None).cast("double")})
    same = boosting.fit_boosted(flat, ("a", "b"), "y", [Setting(3, 2, 1.0, 0.0)])[0]
    assert all(t.feature == [-1] for t in same.trees)
    assert same.transform(flat).first().margin == pytest.approx(table.agg(F.avg("y")).first()[0], abs=1e-5)
    assert same.importances.tolist() == [0.0, 0.0]


def test_metrics_of_frozen_predictions_equal_sql(spark, table, tmp_path):
    model = boosting.fit_boosted(table, ("a", "b"), "y", [Setting(30, 4, 0.2, 1.0, 1, "huber", symmetric=True)])[0]
    path = str(tmp_path / "p.parquet")
    model.transform(table).withColumn("split", F.when(F.col("id") % 4 == 0, "test").otherwise("train")).write.parquet(path)
    got = {r.split: r for r in metrics.regression_metrics(spark.read.parquet(path), "y", "margin", by=["split"]).collect()}
    sql = f"""SELECT split, avg(abs(y - margin)), sqrt(avg((y - margin) ** 2)), 1 - sum((y - margin) ** 2) / (var_pop(y) * count(*))
    FROM '{path}/*.parquet' GROUP BY split"""
    for split, mae, rmse, r2 in duckdb.sql(sql).fetchall():
        assert (got[split].mae, got[split].rmse, got[split].r2) == pytest.approx((mae, rmse, r2))
    assert got["test"].r2 > 0.9


def test_search_scores_all_settings_and_folds_at_once(spark, table):
    space = {"maxIter": (2, 6), "maxDepth": (1, 3), "minInstancesPerNode": (1, 40)}
    rows = table.select(F.coalesce("a", F.lit(0.0)).alias("caps_ratio"), F.col("b").alias("hour_sin"), F.col("label").alias("is_clickbait"))
    small = models.train_clickbait(rows, space=space, n_settings=5, folds=3, block_rows=60)
    whole = models.train_clickbait(rows, space=space, n_settings=5, folds=3)
    assert small.model == whole.model
    assert {r.split: r.f1 for r in whole.metrics.collect()}["test"] > 0.85


def test_held_out_f1_equals_counts_by_hand(spark, table):
    ready = table.withColumns({"_label": F.col("label").cast("double"), "_fold": F.col("fold")})
    fits = boosting.fit_boosted(ready, ("a", "b"), "_label", [Setting(3, 2, 0.3, loss="logistic", fold=f) for f in (0, 1)], fold="_fold")
    got = models.held_out_f1(ready, fits, [0, 1])
    for fit, fold, f1 in zip(fits, (0, 1), got):
        rows = fit.transform(ready.filter(F.col("_fold") == fold)).select("label", "prediction").collect()
        hit = sum(r.label == 1 and r.prediction == 1 for r in rows)
        assert f1 == pytest.approx(2 * hit / (sum(r.label for r in rows) + sum(r.prediction for r in rows)))
    assert models.held_out_f1(ready.filter("label = 7"), fits, [0, 1]) == [0.0, 0.0]


@pytest.mark.parametrize("block_rows", [60, 10_000])
def test_search_leaves_trees_where_they_grow(spark, table, monkeypatch, block_rows):
    """The f1 of all settings and folds is counted at the rows; the driver gets the trees of the chosen setting only."""
    ready = table.withColumns({"_label": F.col("label").cast("double"), "_fold": F.col("fold")})
    settings = [Setting(r, 4, 0.3, 1.0, 2, "logistic", fold=f) for r in (3, 12) for f in (0, 1)]
    fits = boosting.fit_boosted(ready, ("a", "b"), "_label", settings, weight="w", fold="_fold")
    search = boosting.prepare(ready, ("a", "b"), "_label", "logistic", weight="w", fold="_fold", block_rows=block_rows)
    assert search.held_out_f1(settings) == models.held_out_f1(ready, fits, [s.fold for s in settings])
    asked = []
    kept = boosting.fit_blocks
    monkeypatch.setattr(boosting, "fit_blocks", lambda blocks, n, settings, width: asked.append(len(settings)) or kept(blocks, n, settings, width))
    rows = table.select(F.coalesce("a", F.lit(0.0)).alias("caps_ratio"), F.col("b").alias("hour_sin"), F.col("label").alias("is_clickbait"))
    models.train_clickbait(rows, space={"maxIter": (2, 6), "maxDepth": (1, 3)}, n_settings=3, folds=2, block_rows=block_rows)
    assert asked == [1]


@pytest.mark.parametrize("open_nodes", [2, 512])
@pytest.mark.parametrize("setting", [Setting(1, 9, 0.3, 1.0, 2), Setting(1, 4, 0.3, 1.0, 1, "huber", symmetric=True)])
def test_rows_end_where_their_tree_sends_them(monkeypatch, open_nodes, setting):
    monkeypatch.setattr(boosting, "OPEN_NODES", open_nodes)
    r = np.random.default_rng(3)
    bins = r.integers(0, 64, (3000, 5)).astype(np.uint8)
    block = boosting.Block(bins, bins[:, 0] % 7 + r.normal(size=3000), np.ones(3000), np.zeros(3000, np.int32), np.zeros((1, 3000)))
    tree, at = boosting._grow_on(boosting.columns_of(bins), block.sums(setting, block.margin[0]), setting, 64)
    small = tree.packed()
    assert (tree.levels() is not None) == (setting.symmetric and open_nodes > 2)
    assert small == tree and boosting.Tree.from_bytes(tree.to_bytes()) == tree and len(tree.to_bytes()) == 27 * len(tree.feature)
    for row, leaf, other in zip(bins, at, small.nodes(bins)):
        node = 0
        while tree.feature[node] >= 0:
            node = (tree.left if row[tree.feature[node]] <= tree.border[node] else tree.right)[node]
        assert node == leaf == other


@pytest.mark.parametrize("size", [1.0, 1e5])
def test_sums_of_histograms_are_exact(size):
    """Added up together with the counts or, where they are too large for that, apart."""
    r = np.random.default_rng(4)
    n = 70_000
    bins, at = r.integers(0, 8, (n, 2)).astype(np.uint8), r.integers(0, 3, n)
    used = (r.random(n) < 0.8).astype(float)
    g = np.rint((r.random(n) - 0.5) * size * (1 << 20)) * used
    for h in (used * (1 << 20), np.rint(r.random(n) * (1 << 18)) * used):
        got = boosting.histograms(boosting.columns_of(bins), at, [g, h, used], 3, 8)
        want = np.zeros((3, 3, 2, 8), np.int64)
        for k, s in enumerate((g, h, used)):
            for f in range(2):
                np.add.at(want[k, :, f], (at, bins[:, f]), s.astype(np.int64))
        assert np.array_equal(got, want)


def test_closed_nodes_before_the_first_open_one():
    """Rows may rest at closed nodes whose numbers lie below all open ones of their level."""
    r = np.random.default_rng(0)
    for n in range(40, 200, 8):
        bins = r.integers(0, 12, (n, 7)).astype(np.uint8)
        block = boosting.Block(bins, (r.random(n) < 0.4).astype(float), np.ones(n), (np.arange(n) % 3).astype(np.int32), np.zeros((1, n)))
        setting, trees = Setting(10, 5, 0.3, 1.0, 10, "logistic", fold=1), []
        margin = boosting._fit_block(block, setting, 64, trees.append)
        assert np.array_equal(margin, sum(np.array(t.value)[t.nodes(bins)] for t in trees))


@pytest.mark.parametrize("loss", ["huber", "logistic"])
def test_halves_and_joined_features_give_the_same_symmetric_trees(monkeypatch, loss):
    """Below the root at most half of the rows are added up, and features of few combinations in one go."""
    r = np.random.default_rng(3)
    hour, day = r.integers(0, 24, 900), r.integers(0, 7, 900)
    bins = np.column_stack([hour, hour * 7 % 24, day, day > 4, r.integers(0, 64, 900), np.zeros(900), r.integers(0, 3, 900)]).astype(np.uint8)
    y = (bins[:, 4] / 20 + r.normal(size=900) > 1.5).astype(float)
    block = boosting.Block(bins, y, r.choice([0.0, 1.0, 2.5], 900), np.zeros(900, np.int32), np.zeros((1, 900)))
    setting = Setting(6, 6, 0.3, 1.0, 1, loss, symmetric=True)
    plain: list[boosting.Tree] = []
    want = boosting._fit_block(block, setting, 64, plain.append)
    cells: list[int] = []
    kernel = boosting.histograms

    def counted(columns, at, sums, nodes, width):
        cells.append(columns.size)
        return kernel(columns, at, sums, nodes, width)

    monkeypatch.setattr(boosting, "histograms", counted)
    monkeypatch.setattr(boosting, "ROWS_TO_JOIN", 1)
    halves: list[boosting.Tree] = []
    got = boosting._fit_block(block, setting, 64, halves.append)
    assert [t.packed() for t in halves] == [t.packed() for t in plain] and (got == want).all()
    assert len(boosting.joint_cells(boosting.columns_of(bins))) <= 4
    assert sum(cells) <= 6 * 3.5 * 900 * 4  # six trees: the root and five levels of halves, four groups of features
    model = Boosted(tuple("abcdefg"), [[]] * 7, [t.packed() for t in plain], 0.0, loss)
    levels = [t.levels() for t in model.trees]
    assert None not in levels and (model.margin(bins, levels) == want).all() and (model.margin(bins) == want).all()


@pytest.mark.parametrize("block_rows", [1 << 20, 90])
def test_large_fits_stay_a_table_and_score_alike(spark, table, monkeypatch, block_rows):
    settings = [Setting(8, 5, 0.3, 1.0, 2, "logistic"), Setting(3, 2, 0.3, 1.0, 2, "logistic")]
    fit = lambda: boosting.fit_boosted(table, ("a", "b"), "label", settings, weight="w", block_rows=block_rows)
    kept = fit()[0]
    assert isinstance(kept.trees, list)
    want = {r.id: (r.margin, r.prediction) for r in kept.transform(table).collect()}
    monkeypatch.setattr(boosting, "TREE_BYTES", max(sum(len(t.to_bytes()) for t in kept.trees) // 3, 400))
    monkeypatch.setattr(boosting, "CELLS", 50)
    stored, small = fit()
    assert isinstance(stored.trees, boosting.StoredTrees) and isinstance(small.trees, list)
    assert len(stored.trees) == 8 and list(stored.trees) == list(kept.trees) and stored.trees[-1] == kept.trees[7]
    assert len(set(stored.trees.part_of_turn())) > 1
    # A fit that is a table is never sent to the workers whole.
    monkeypatch.setattr(Boosted, "_walked", None)
    got = {r.id: (r.margin, r.prediction) for r in stored.transform(table.drop("c")).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] == (pytest.approx(want[k][0], abs=1e-12), want[k][1]) for k in want)
    assert stored.importances.tolist() == pytest.approx(kept.importances.tolist())
