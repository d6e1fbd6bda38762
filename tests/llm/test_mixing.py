import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from check import compare, connect
from demandcast.llm import mixing
from demandcast.llm.oracles import ORACLES
from demandcast.llm.queries import QUERIES
from tests.llm.conftest import AWKWARD, SF_DIR


def by_hand(docs, weights, share):
    """Sizes, targets and what is taken, from the definition."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in docs]
    point = [int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16) for i, _, _ in docs]
    total = defaultdict(int)
    for n, (_, _, s) in enumerate(docs):
        total[s] += size[n]
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    left, open_, target = share * sum(size), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 2 * total[s]}
        if not over:
            target.update({s: weight[s] * level for s in open_})
            break
        target.update({s: 2.0 * total[s] for s in over})
        left -= sum(2 * total[s] for s in over)
        open_ -= over
    taken = [0] * len(docs)
    for s in order:
        own = [n for n, d in enumerate(docs) if d[2] == s]
        once = target[s] >= total[s]
        budget, spent = target[s] - total[s] if once else target[s], 0
        extra = set()
        for p in sorted({point[n] for n in own}):
            same = [n for n in own if point[n] == p]
            more = sum(size[n] for n in same)
            if spent + more <= budget or budget - spent > spent + more - budget:
                extra |= set(same)
            spent += more
            if spent > budget:
                break
        for n in own:
            taken[n] = size[n] * (once + (n in extra))
    return {s: target[s] for s in order}, total, size, taken


@pytest.mark.parametrize("share", [0.3, 1.0, 1.5, 2.0])
def test_matches_a_plain_version(awkward, store, share):
    docs = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    target, total, size, taken = by_hand(docs, [3, 1, 2], share)
    rows = mixing.take_shares(awkward, mixing.repeating_weights(awkward, [3, 1, 2]), store, share).collect()
    assert len(rows) == len(AWKWARD)
    ours = sorted((str(r.doc_id), r.size, r.taken, str(r.source), r.source_size) for r in rows)
    assert ours == sorted((str(d[0]), size[n], taken[n], str(d[2]), total[d[2]]) for n, d in enumerate(docs))
    for r in rows:
        assert r.target == pytest.approx(target[r.source])
        assert r.taken <= 2 * r.size


def test_a_smaller_budget_takes_a_subset(awkward, store, spark):
    from demandcast.sources.storage import Storage

    weights = mixing.repeating_weights(awkward, [1])
    some = {r.row for r in mixing.take_shares(awkward, weights, store, 0.4).where("taken > 0").collect()}
    more = {r.row for r in mixing.take_shares(awkward, weights, Storage(spark), 0.8).where("taken > 0").collect()}
    assert some <= more


def test_mixed_rows_are_repeated(awkward, store):
    weights = mixing.repeating_weights(awkward, [3, 1, 2])
    mixed = mixing.mix_sources(awkward, weights, store, 2.0)
    assert mixed.columns == awkward.columns
    assert mixed.count() == 2 * len(AWKWARD) - awkward.where(mixing.word_count() == 0).count()


def test_empty_table(no_docs, store):
    weights = mixing.repeating_weights(no_docs, [3, 1, 2])
    assert mixing.take_shares(no_docs, weights, store).count() == 0


def test_weights_by_code_point(make_docs):
    docs = make_docs([(n, "x") for n in range(10)]).withColumn(
        "source", F.element_at(F.array(*[F.lit(x) for x in ("b", "a", "é", "Z", "z")], F.lit(None)), (F.col("doc_id") % 6 + 1).cast("int"))
    )
    found = {r.source: r.weight for r in mixing.repeating_weights(docs, [3, 1, 2]).collect()}
    assert found == {"Z": 3, "a": 1, "b": 2, "z": 3, "é": 1, None: 2}


def test_matches_sql(spark):
    ours = QUERIES["op7_mixing"](spark, SF_DIR).toPandas()
    theirs = connect(SF_DIR).sql(ORACLES["op7_mixing"]).df()
    ours["target"], theirs["target"] = ours.target.round(6), theirs.target.round(6)
    assert compare(ours, theirs) == ""
