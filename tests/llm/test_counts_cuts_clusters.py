"""Centroids, fill-in-middle and token counts against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from skyvane.llm import centroids, fill_in_middle, token_counts

from .fixtures import awkward_docs, awkward_texts, empty_docs

DOCS = "doc_id long, text string, n long, form string, _d string, n_tokens string"


def same_ids(spark):
    """Null and repeated ids, with the same and with other texts."""
    rows = [(None, "alpha beta", 1, "a", "b", "c"), (None, None, 1, "a", "b", "c"), (None, "alpha beta", 1, "a", "b", "c"),
            (7, "gamma delta <S> x", 1, "a", "b", "c"), (7, "one two", 1, "a", "b", "c"), (7, "one two", 1, "a", "b", "c")]
    return spark.createDataFrame(rows, DOCS), [(r[0], r[1] or "") for r in rows]


# -- token counts

@pytest.fixture(scope="module")
def pieces():
    return token_counts.Pieces(token_counts.default_path(), chunk=48, overlap=8)


def test_chunks_join_to_the_whole_encoding(pieces):
    rnd = random.Random(5)
    parts = ["a", "b", " ", "  ", "\n", "1", "漢", "é", "🤦", "▁", "the ", "e" * 30, " " * 50, "\x00", "ab" * 20, "-" * 33, "word "]
    for _ in range(800):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(20, 160)))
        if len(text) > pieces.chunk:
            assert pieces.long_text(text).tolist() == pieces.lib.encode(text)


def test_overlaps_widen_where_tokens_do_not_meet(pieces):
    before = pieces.widened
    for text in (" " * 1000 + "x", "a" * 777, "x" + "=" * 1500 + " y", "ab " * 400):
        assert pieces.long_text(text).tolist() == pieces.lib.encode(text)
    assert pieces.widened > before


def test_widening_stays_near_linear(pieces):
    sent = []
    old = pieces._ids
    pieces._ids = lambda texts: sent.extend(len(t) for t in texts) or old(texts)
    try:
        pieces.long_text(" " * 60_000)
    finally:
        del pieces._ids
    assert sum(sent) < 8 * 60_000


def test_models_outside_the_proof_are_encoded_whole():
    from types import SimpleNamespace as N
    spec = lambda kinds, **n: N(trainer_spec=N(model_type=2, treat_whitespace_as_suffix=False),
                                pieces=[N(type=k) for k in kinds],
                                normalizer_spec=N(**{"precompiled_charsmap": b"", "remove_extra_whitespaces": False,
                                                     "escape_whitespaces": True, **n}))
    assert token_counts.chunkable(spec([1, 2, 3, 6]))
    assert not token_counts.chunkable(spec([1, 2, 4, 6]))
    assert not token_counts.chunkable(spec([1, 6], precompiled_charsmap=b"x"))
    assert not token_counts.chunkable(spec([1, 6], remove_extra_whitespaces=True))


def counted(df, **kw):
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"])
                   for r in token_counts.token_counts(df, **kw).collect()))


def test_token_counts(spark):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_path())
    ids, rows = same_ids(spark)
    for df, texts in ((awkward_docs(spark), [(3 * i + 1, t or "") for i, t in enumerate(awkward_texts())]), (ids, rows)):
        want = sorted((d is None, d or 0, len(t.encode()), len(lib.encode(t)), len(lib.encode(t)) > 100) for d, t in texts)
        assert counted(df, limit=100) == want
    assert token_counts.token_counts(empty_docs(spark)).count() == 0


def test_token_counts_of_a_tokenizers_file(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    ids, rows = same_ids(spark)
    assert [r[3] for r in counted(ids, path=path)] == [r[3] for r in sorted(
        (d is None, d or 0, len(t.encode()), len(lib.encode(t, add_special_tokens=False).ids)) for d, t in rows)]


# -- fill in middle

def brute_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    plain = not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90
    form = "plain" if plain else "spm" if h[3] % 100 < 20 else "psm"
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    return (doc_id, n, form, None if plain else p, None if plain else m, out, text)


def key(row):
    return tuple("" if v is None else str(v) for v in row)


def test_fill_in_middle(spark):
    from pyspark.sql import functions as F
    ids, rows = same_ids(spark)
    marks = [(100 + i, t) for i, t in enumerate(
        ["<", "<P", "a<P>b", "x <S", "<M", "P>", "S> <", "<S><S", "ab<", "<P <S <M", "a\nb\r\n\t", "🤦🏼‍♂️ é́", "Zz9_Zz", "  "] * 8)]
    marked = spark.createDataFrame([(d, t, 1, "a", "b", "c") for d, t in marks], DOCS)
    forms = set()
    for df, texts in ((awkward_docs(spark), [(3 * i + 1, t) for i, t in enumerate(awkward_texts())]), (ids, rows), (marked, marks)):
        out = fill_in_middle.transform(df)
        out = out.select("doc_id", "n", "form", "prefix", "middle", "output",
                         fill_in_middle.restore(F.col("output"), F.col("form")).alias("restored"))
        got = [tuple(r) for r in out.collect()]
        assert sorted(got, key=key) == sorted((brute_fim(d, t) for d, t in texts), key=key)
        forms |= {r[2] for r in got}
    assert forms == {"plain", "psm", "spm"}
    assert fill_in_middle.transform(empty_docs(spark)).count() == 0


# -- centroids

VECTORS = "vec_id long, embedding array<float>, label int, cluster string, vector string, digest string"


def brute_clusters(rows, k, rounds, dim):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v):
            ints = [int(np.floor(256 * float(np.float32(x)))) for x in v]
            kept.append((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), ints, i))
    cs = [v for _, v, _ in sorted(kept, key=lambda r: r[:2])[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))

    for _ in range(rounds):
        groups = {}
        for _, v, _ in kept:
            groups.setdefault(near(v)[1], []).append(v)
        cs = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if j in groups else c for j, c in enumerate(cs)]
    return sorted((i is None, i or 0, near(v)[1], near(v)[0]) for _, v, i in kept), cs


def vectors(n, dim, seed):
    rnd = random.Random(seed)
    rows = [(i, [rnd.choice([-0.5, -0.25, 0.0, 0.125, 0.5, 1 / 3]) for _ in range(dim)]) for i in range(n)]
    rows += [(i, rows[0][1]) for i in range(n, n + n // 2)]                     # a third are copies
    rows += [(None, rows[3][1]), (None, [0.1] * dim), (5, rows[5][1]), (5, [0.2] * dim), (900, None), (901, [0.1] * (dim - 1)),
             (902, [0.1] * (dim - 1) + [None]), (903, [float("nan")] * dim), (904, [float("inf")] + [0.0] * (dim - 1)), (905, [])]
    return rows


@pytest.mark.parametrize("n,k,dim", [(90, 7, 4), (60, 12, 64), (6, 16, 4)])
def test_clusters_equal_brute_force(spark, n, k, dim):
    rows = vectors(n, dim, n)
    df = spark.createDataFrame([(i, v, 1, "c", "v", "d") for i, v in rows], VECTORS).repartition(4)
    c = centroids.fit(df, k=k, rounds=3, dim=dim)
    got = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["cluster"], r["distance"])
                 for r in centroids.assign(df, c, dim=dim).collect())
    want, cs = brute_clusters(rows, k, 3, dim)
    assert got == want
    assert c.by_number().tolist() == cs


def test_search_is_exact_with_ties_and_rejects():
    rnd = np.random.default_rng(3)
    for scale in (2, 50, 1 << 20):
        cs = rnd.integers(-scale, scale, (40, 16))
        cs[5] = cs[9] = cs[30]
        x = rnd.integers(-scale, scale, (700, 16))
        x[:40] = cs
        x[100:400] = cs[rnd.integers(0, 40, 300)] + rnd.integers(-1, 2, (300, 16))
        d = ((x[:, None] - cs[None]) ** 2).sum(2)
        who, best, done = centroids.nearest(x, centroids.Centroids.of(cs))
        assert (who == d.argmin(1)).all() and (best == d.min(1)).all()
        assert done < d.size
    # vectors near their centroid, centroids of different mean: nearly all is rejected unseen
    cs = np.arange(40)[:, None] * 100 + rnd.integers(-5, 6, (40, 16))
    x = cs[rnd.integers(0, 40, 1000)] + rnd.integers(-5, 6, (1000, 16))
    assert centroids.nearest(x, centroids.Centroids.of(cs))[2] < 2000


def test_no_vectors(spark):
    df = spark.createDataFrame([(1, None, 1, "c", "v", "d")], VECTORS)
    assert centroids.fit(df) is None
    assert centroids.assign(df, None).count() == 0
    assert centroids.assign(df.limit(0), centroids.fit(df.limit(0))).count() == 0


def test_components_beyond_the_limit_are_an_error():
    import pyarrow as pa
    with pytest.raises(ValueError):
        centroids.integers(pa.array([[1e30, 0.0]]), 2, 256)
