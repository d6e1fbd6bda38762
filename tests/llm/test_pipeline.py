import hashlib

import numpy as np

import corpus_pipeline as cp
from demandcast.llm import quality
from demandcast.llm.common import read_table
from tests.llm.conftest import AWKWARD
from tests.llm.test_mixing import by_hand
from tests.llm.test_packing import check
from tests.llm.test_simhash import by_hand as simhash_by_hand
from tests.llm.test_simhash import components

SF_DIR = "/root/testdata/sf0.001"


def test_against_a_plain_version(spark):
    rows = cp.run(spark, SF_DIR).collect()
    docs = read_table(spark, SF_DIR, "documents")
    model = quality.fit_quality(docs, read_table(spark, SF_DIR, "labels"))
    held = [(d.doc_id, d.text or "", d.source) for d in docs.collect()]
    held = [d for d, s in zip(held, model.score(quality.features_of([t for _, t, _ in held]))) if s >= 0.3]
    last = {hashlib.sha256(t.encode()).digest(): max(i for i, x, _ in held if x == t) for _, t, _ in held}
    held = [d for d in held if last[hashlib.sha256(d[1].encode()).digest()] == d[0]]
    prints = [simhash_by_hand(t) for _, t, _ in held]
    held = [d for d, c in zip(held, components(prints, [i for i, _, _ in held], 2)) if c == d[0]]
    _, _, size, taken = by_hand(held, cp.SOURCE_WEIGHTS, cp.SOURCE_SHARE)
    mixed = [(i, t) for (i, t, _), s, k in zip(held, size, taken) if s for _ in range(k // s)]
    check(rows, mixed)
    for r in rows:
        assert len(np.frombuffer(r.ids, "<u2")) == r.length


def test_stages_keep_the_columns_of_awkward_rows(awkward, no_docs, spark):
    for docs in (awkward, no_docs):
        for name, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, SF_DIR)
            assert out.columns == docs.columns, name
            assert out.count() <= 2 * len(AWKWARD)
