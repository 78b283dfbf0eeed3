"""Null and repeated ids: every row has its own result."""

from __future__ import annotations

import hashlib
import tempfile
import zlib
from collections import Counter

import numpy as np
import pytest

from skyvane.llm import decontaminate, packing, quality, sharding, substring_dedup, token_codes, toxicity
from skyvane.llm._tokens import default_path

WINDOW = " ".join(f"word{k}" for k in range(20))
ITEM = "which river runs through the old town of zarnik near the northern border"
ROWS = [(None, "alpha beta gamma"), (None, "alpha beta gamma"), (None, None), (None, f"so {ITEM} indeed"), (7, f"so {ITEM} indeed"),
        (7, f"so {ITEM} indeed"), (7, "quite another text"), (7, ""), (3, f"a {WINDOW} b"), (3, f"a {WINDOW} b"), (3, f"c {WINDOW}"),
        (5, f"{WINDOW} d"), (None, f"e {WINDOW}"), (None, f"f {WINDOW} g"), (2, " ")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)


def ids(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_path()).encode(text or "", add_special_tokens=False).ids


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers(spark, docs, module):
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(9)] + [(None, 1, 1), (7, 0, 0)], "doc_id long, quality int, toxic int")
    got = module.classify(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in ROWS)
    assert all(0 <= r.score <= 1 and r.predicted is not None for r in got)
    # equal texts score alike, so no id has more scores than texts
    for d in (None, 7, 3):
        assert len({r.score for r in got if r.doc_id == d}) <= len({t or "" for i, t in ROWS if i == d})


def test_margin_does_not_depend_on_the_batch():
    rnd = np.random.default_rng(1)
    model = quality.Model(rnd.normal(size=quality.DIM), 1.0, 0.0)
    row = rnd.integers(0, quality.DIM, 57)
    alone = model.margin(np.array([0, 57]), row)
    before = [rnd.integers(0, quality.DIM, n) for n in (1000, 0, 31)]
    cells = np.concatenate([*before, row, row])
    got = model.margin(np.concatenate([[0], np.cumsum([1000, 0, 31, 57, 57])]), cells)
    assert got[1] == 0 and got[3] == got[4] == alone[0]
    assert model.margin(np.array([0]), row[:0]).shape == (0,)


def test_token_codes(spark, docs):
    path = tempfile.mkdtemp(prefix="ids-") + "/t"
    token_codes.write(docs, path)
    got = token_codes.documents(spark, path).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, len(ids(t)) + 1, crc([*ids(t), 1])) for d, t in ROWS)
    spans = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.start, r.n_tokens))]
    assert order == sorted(order, key=lambda d: (d is None, d or 0))


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(1, ITEM), (1, ITEM), (None, ITEM), (2, None)], "item_id long, text string")
    got = decontaminate.contaminated(docs, bench).collect()
    leaks = [d for d, t in ROWS if t and ITEM in t]
    assert Counter((r.doc_id, r.item_id) for r in got) == Counter((d, i) for d in leaks for i in (1, 1, None))
    clean = [tuple(r) for r in decontaminate.clean(docs, bench).collect()]
    assert Counter(clean) == Counter((d, t) for d, t in ROWS if not (t and ITEM in t))


def test_sharding(docs):
    got = sharding.assign(docs, 4).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in ROWS)
    for d in (None, 7, 3):
        assert len({r.shard for r in got if r.doc_id == d}) == 1
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_packing(spark, docs):
    got = packing.pack(docs, tempfile.mkdtemp(prefix="ids-") + "/p").collect()
    total = Counter()
    for d, t in ROWS:
        total[d] += len(ids(t)) + 1
    have = Counter()
    for r in got:
        have[r.doc_id] += r.length
    assert have == total
    assert Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == Counter((d, len(ids(t)) + 1) for d, t in ROWS)


def test_substring_dedup(docs):
    """Of the documents with the window the one of least id keeps it; rows of one id, null among them, keep theirs from each other."""
    got = substring_dedup.deduplicate(docs).collect()
    want = Counter()
    for d, t in ROWS:
        words = (t or "").split()
        grams = lambda s: {tuple(w[k:k + 13]) for w in [s.split()] for k in range(len(w) - 12)}
        low = lambda i: (i is None, i or 0)
        smaller = set().union(*[grams(u or "") for i, u in ROWS if low(i) < low(d)])
        gone = {k + j for k in range(len(words) - 12) if tuple(words[k:k + 13]) in smaller for j in range(13)}
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        want[(d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
