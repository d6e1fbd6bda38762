"""Boosted trees against a plain NumPy version of the same fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandcast.operators.boosting import Boosted, BoostParams, bin_edges, fit_boosted, predict_boosted
from demandcast.sources.storage import Storage

PARAMS = BoostParams(n_trees=3, max_depth=3, step_size=0.3, row_fraction=1.0, column_fraction=1.0, min_child_weight=4.0, gamma=0.2, l2=2.0, max_bins=8, store_every=2)


def plain_fit(x, y, w, edges, p):
    """Predictions of the training rows."""
    bins = np.stack([np.searchsorted(np.array(e), x[:, f], side="left") if e else np.zeros(len(x), int) for f, e in enumerate(edges)], axis=1)
    pred = np.full(len(y), (w * y).sum() / w.sum())
    for _ in range(p.n_trees):
        g, node = w * (pred - y), np.zeros(len(y), dtype=int)
        for _ in range(p.max_depth):
            after = node.copy()
            for n in np.unique(node):
                own, best = node == n, None
                gt, ht = g[own].sum(), w[own].sum()
                for f in range(x.shape[1]):
                    for b in np.unique(bins[own, f]):
                        left = own & (bins[:, f] <= b)
                        gl, hl = g[left].sum(), w[left].sum()
                        if min(hl, ht - hl) < p.min_child_weight:
                            continue
                        gain = 0.5 * (gl**2 / (hl + p.l2) + (gt - gl) ** 2 / (ht - hl + p.l2) - gt**2 / (ht + p.l2)) - p.gamma
                        if gain > 0 and (best is None or float(f"{gain:.9e}") > best[0]):
                            best = (float(f"{gain:.9e}"), f, b)
                if best:
                    after[own] = 2 * n + 1 + (bins[own, best[1]] > best[2])
            if (after == node).all():
                break
            node = after
        for n in np.unique(node):
            own = node == n
            pred[own] -= p.step_size * g[own].sum() / (w[own].sum() + p.l2)
    return pred


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(0, 1, (240, 3)), 2)
    y = np.round(np.where(x[:, 0] > 0.2, 2.0, 0.0) + x[:, 1] * (x[:, 2] > 0) + rng.normal(0, 0.1, 240), 3)
    w = np.round(rng.uniform(0.2, 2, (240, 2)), 2)
    rows = [(n, *map(float, x[n]), float(y[n]), *map(float, w[n])) for n in range(240)]
    return x, y, w, spark.createDataFrame(rows, "n int, a double, b double, c double, y double, w0 double, w1 double").repartition(3)


def test_fits_equal_numpy_and_single_fits(spark, sample, tmp_path):
    """Two weightings on one scan; the stored node table gives the same predictions as the one in memory."""
    x, y, w, rows = sample
    names, storage = ["a", "b", "c"], Storage(spark)
    edges = bin_edges(rows, names, PARAMS.max_bins)
    both = fit_boosted(rows, names, F.col("y"), [F.col("w0"), F.col("w1")], storage, PARAMS)
    both.save(spark, str(tmp_path / "model"))
    stored = Boosted.load(spark, str(tmp_path / "model"))
    alone = fit_boosted(rows, names, F.col("y"), [F.col("w1")], Storage(spark), PARAMS)
    out = predict_boosted(both, rows, 0, "p0")
    out = predict_boosted(stored, out, 1, "p1")
    out = predict_boosted(alone, out, 0, "p2").orderBy("n").toPandas()
    assert any(n[3] is not None for n in both.nodes) and stored.nodes == both.nodes
    np.testing.assert_allclose(out["p0"], plain_fit(x, y, w[:, 0], edges, PARAMS), atol=1e-9)
    np.testing.assert_allclose(out["p1"], plain_fit(x, y, w[:, 1], edges, PARAMS), atol=1e-9)
    np.testing.assert_allclose(out["p2"], out["p1"], atol=1e-9)


def test_nothing_to_fit(spark, sample):
    rows = sample[3]
    model = fit_boosted(rows.limit(0), ["a", "b"], F.col("y"), [F.col("w0")], Storage(spark), PARAMS)
    assert {r.prediction for r in predict_boosted(model, rows).collect()} == {0.0}
    assert not model.nodes
