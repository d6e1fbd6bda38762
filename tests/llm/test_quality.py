import numpy as np
import pytest
from pyspark.sql import functions as F

from demandcast.llm import quality
from demandcast.llm.queries import QUERIES
from tests.llm.conftest import AWKWARD

SF_DIR = "/root/testdata/sf0.01"


def noisy(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 5))
    logit = 4 * np.sin(6 * x[:, 0]) + 5 * ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.5)) - 2.5
    return x, (rng.random(n) < 1 / (1 + np.exp(-logit))).astype(float), logit


def test_learns_shapes_and_a_pair():
    x, y, _ = noisy(6_000, 0)
    model = quality.fit_additive(x, y)
    assert (1, 2) in model.pairs
    test, truth, logit = noisy(3_000, 1)
    best = ((logit > 0) == truth).mean()
    assert ((model.score(test) > 0.5) == truth).mean() > best - 0.03


def test_score_is_the_sum_of_table_entries():
    x, y, _ = noisy(500, 2)
    model = quality.fit_additive(x, y, cycles=5, pair_cycles=3)
    for row in x[:20]:
        total = model.intercept
        bins = [int((e <= v).sum()) for e, v in zip(model.edges, row)]
        total += sum(t[b] for t, b in zip(model.main, bins))
        total += sum(t[model.coarse[f][bins[f]], model.coarse[g][bins[g]]] for (f, g), t in model.pairs.items())
        assert model.logit(row[None, :])[0] == pytest.approx(total)


def test_rows_in_any_order_give_the_same_model():
    x, y, _ = noisy(400, 3)
    a, b = quality.fit_additive(x, y), quality.fit_additive(x, y)
    assert all(np.array_equal(p, q) for p, q in zip(a.main, b.main))


@pytest.mark.parametrize("y", [np.zeros(0), np.zeros(4), np.ones(4)])
def test_no_rows_or_one_class(y):
    model = quality.fit_additive(np.ones((len(y), 3)), y)
    score = model.score(np.array([[0.0, 1.0, 2.0]]))
    assert 0 < score[0] < 1 and (not len(y) or (score[0] > 0.5) == bool(y[0]))


def test_features_of_awkward_texts():
    found = quality.features_of([t or "" for _, t in AWKWARD])
    assert found.shape == (len(AWKWARD), len(quality.FEATURES)) and np.isfinite(found).all()
    assert not found[0].any() and not found[1].any()


def test_scores_of_awkward_rows(awkward, no_docs, spark):
    labels = spark.createDataFrame(
        [(i, int(i % 2 == 0), 0) for i in range(17)] + [(3, 0, 0), (3, 1, 0), (4, None, 0), (None, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    model = quality.fit_quality(awkward, labels)
    rows = quality.score_quality(awkward, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 < r.score < 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert quality.score_quality(no_docs, model).count() == 0
    kept = quality.drop_low_quality(awkward, model)
    assert kept.columns == awkward.columns and kept.count() == sum(r.predicted for r in rows)
    assert quality.fit_quality(no_docs, labels).main[0].sum() == 0


def test_the_bound_holds(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    assert quality.fit_quality(docs, labels, max_rows=50).score(np.zeros((1, len(quality.FEATURES)))).shape == (1,)


def test_held_out_accuracy(spark):
    rows = QUERIES["op10_quality"](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    held = rows.join(labels, "doc_id").where("held_out")
    found = held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")), F.count("*")).first()
    assert found[1] > 40 and found[0] >= 0.95
    assert rows.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
