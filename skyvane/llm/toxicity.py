"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words (lower-cased runs of letters and digits) and their prefixes of 4
to 8 bytes, which stand for stems; a term that occurs twice or three times in a
document also counts as its own terms "x2" and "x3". The vocabulary is what tells toxic from other
training rows: Spark counts, over all training rows, in how many documents of
each class a term occurs; terms of enough toxic documents and a clear log-odds ratio stay.

The index holds the labelled examples as distinct TF-IDF vectors with the toxic
and other documents behind each: postings by term in blocks of ``BLOCK_DOCS`` vectors
with each block's largest weight. A query adds up the block maxima of its terms
and scores only blocks whose bound reaches the k-th best cosine, so the result
equals a full scan. Neighbours vote with their cosine; the votes are shrunk to the
training share, which calibrates them, and the neighbours are the evidence.

Bounds: the vocabulary is at most ``VOCABULARY`` terms; the index is fitted on at most
``SAMPLE`` labelled rows of least hash that hold a term (rows that hold none
all have the same empty vector: they are counted, over all rows, not sampled).

Defined cases: null, empty and term-free texts have the empty vector and score the
toxic share of such training rows; documents without labels or with a null label are scored
and not learned from; without toxic training rows every score is the smoothed share; ties
in the cosine all vote (equal vectors are one entry); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyvane.llm._tables import begin, of_least_hash, read, small
from skyvane.llm._text import NON_WORD, U64, blocks, buffers, doc_groups, fold_case, hash_at, mix, prefix_sums, spans
from skyvane.llm.quality import fold_of
from skyvane.session import materialize

PREFIXES = (4, 5, 6, 7, 8)
VOCABULARY = 4096
SAMPLE = 50_000
BLOCK_DOCS = 64
NEIGHBOURS = 12
FOLDS = 3
HELD = 1
THRESHOLD = 0.7
MIN_SHARE = 0.002        # of the toxic training rows, and at least MIN_DOCS of them
MIN_DOCS = 4
LOG_ODDS = 2.0
PRIOR = 0.5              # votes of the training share
EVIDENCE = 3
_TIMES = {2: U64(0xA0761D6478BD642F), 3: U64(0xE7037ED1A0B428DB)}


def term_cells(data: np.ndarray, off: np.ndarray, keep: np.ndarray | None = None):
    """(document, term, count) of a group of documents, sorted by document and term.

    ``keep``: sorted terms without count marks; others are left out early."""
    docs, terms = [], []
    table = None
    if keep is not None:
        table = np.zeros(1 << 20, bool)
        table[(keep & U64((1 << 20) - 1)).astype(np.int64)] = True
    for lo, hi in blocks(data, off, NON_WORD):
        part = fold_case(data[lo:hi])
        k0, k1 = np.searchsorted(off, lo, "right"), np.searchsorted(off, hi, "left")
        s, e = spans(part, off[k0:k1] - lo, NON_WORD)
        if not len(s):
            continue
        doc = np.searchsorted(off, s + lo, "right") - 1
        sums = prefix_sums(part)
        for n in (0, *PREFIXES):
            use = slice(None) if n == 0 else np.flatnonzero(e - s > n)
            h = hash_at(sums, s[use], e[use] if n == 0 else s[use] + n)
            d = doc[use]
            if table is not None:
                hit = np.flatnonzero(table[(h & U64((1 << 20) - 1)).astype(np.int64)])
                h, d = h[hit], d[hit]
                if len(h):
                    at = np.minimum(np.searchsorted(keep, h), len(keep) - 1)
                    hit = keep[at] == h
                    h, d = h[hit], d[hit]
            docs.append(d)
            terms.append(h)
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64)
    d, t = np.concatenate(docs), np.concatenate(terms)
    o = np.lexsort((t, d))
    d, t = d[o], t[o]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(new)
    return d[at], t[at], np.diff(np.append(at, len(d)))


def with_times(doc, term, count):
    """Add the marks for terms that occur twice and three times."""
    parts = [(doc, term, count)]
    for n, salt in _TIMES.items():
        m = count >= n
        parts.append((doc[m], mix(term[m] ^ salt), count[m]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _count_terms(rows: DataFrame, keep: np.ndarray | None) -> DataFrame:
    """(term, n): in how many of the rows' documents each term occurs; tasks add up what they hold first."""
    shared = rows.sparkSession.sparkContext.broadcast(keep)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        size = 0

        def merged():
            t, inv = np.unique(np.concatenate(held), return_inverse=True)
            return t, np.bincount(inv, np.concatenate(counts)).astype(np.int64)

        for b in it:
            data, off = buffers(b.column(0))
            for lo, hi in doc_groups(off):
                _, t, _ = with_times(*term_cells(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], shared.value))
                t, n = np.unique(t, return_counts=True)
                held.append(t)
                counts.append(n.astype(np.int64))
                size += len(t)
            if size > 2_000_000:
                t, n = merged()
                if len(t) > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(n)], names=["term", "n"])
                    t, n = t[:0], n[:0]
                held, counts, size = [t], [n], len(t)
        if held:
            t, n = merged()
            yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(n)], names=["term", "n"])

    return rows.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Sorted terms (marks included), their idf, and the sorted plain terms to look for in texts."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray, plain: np.ndarray) -> None:
        o = np.argsort(terms)
        self.terms, self.idf, self.plain = terms[o], idf[o], np.sort(plain)

    def vectors(self, data: np.ndarray, off: np.ndarray):
        """Unit TF-IDF vectors as CSR (pointers, term numbers, weights); no term: an empty row."""
        n = len(off) - 1
        if not len(self.terms):
            return np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)
        d, t, c = with_times(*term_cells(data, off, self.plain))
        at = np.minimum(np.searchsorted(self.terms, t), len(self.terms) - 1)
        m = self.terms[at] == t
        d, at, c = d[m], at[m], c[m]
        o = np.lexsort((at, d))
        d, at, c = d[o], at[o], c[o]
        w = (1.0 + np.log(c)) * self.idf[at]
        norm = np.sqrt(np.bincount(d, w * w, minlength=n))
        return np.searchsorted(d, np.arange(n + 1)), at, w / np.maximum(norm[d], 1e-30)


def choose_terms(rows: DataFrame, size: int = VOCABULARY) -> tuple[Vocabulary, int, int]:
    """Informative terms over all training rows; also the numbers of toxic and other rows.

    A term must occur in a minimum share of the toxic rows, so the candidates are at most
    (terms of an average document) / MIN_SHARE, whatever the corpus size."""
    by = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    pos, neg = by.get(1, 0), by.get(0, 0)
    none = Vocabulary(np.zeros(0, U64), np.zeros(0), np.zeros(0, U64))
    if not pos or not neg:
        return none, pos, neg
    least = max(MIN_DOCS, int(MIN_SHARE * pos))
    toxic = rows.filter("label = 1")
    cand = _count_terms(toxic, None).filter(F.col("n") >= least).toPandas()
    if not len(cand):
        return none, pos, neg
    terms = cand["term"].to_numpy().view(U64)
    order = np.argsort(terms)
    terms, n1 = terms[order], cand["n"].to_numpy()[order]
    # plain terms among the candidates: marks are found through their term
    other = _count_terms(rows.filter("label = 0"), terms)
    known = rows.sparkSession.sparkContext.broadcast(terms)

    def among(it):
        for b in it:
            t = b.column(0).to_numpy().view(U64)
            at = np.minimum(np.searchsorted(known.value, t), len(known.value) - 1)
            yield b.filter(pa.array(known.value[at] == t))

    seen = other.mapInArrow(among, "term long, n long").toPandas()         # at most the candidates
    n0 = np.zeros(len(terms), np.int64)
    if len(seen):
        n0[np.searchsorted(terms, seen["term"].to_numpy().view(U64))] = seen["n"]
    odds = np.log((n1 + 0.5) / (pos + 1)) - np.log((n0 + 0.5) / (neg + 1))
    z = odds / np.sqrt(1 / (n1 + 0.5) + 1 / (n0 + 0.5))
    good = np.flatnonzero(odds >= LOG_ODDS)
    good = good[np.lexsort((terms[good], -z[good]))][:size]
    chosen = terms[good]
    idf = np.log((pos + neg + 1) / (n1[good] + n0[good] + 1)) * np.minimum(odds[good], 6.0)
    marks = np.isin(chosen, np.concatenate([mix(terms ^ salt) for salt in _TIMES.values()]))
    plain = chosen[~marks]
    for salt in _TIMES.values():
        plain = np.union1d(plain, terms[np.isin(mix(terms ^ salt), chosen)])
    return Vocabulary(chosen, idf, plain), pos, neg


class BlockMaxIndex:
    """Inverted index of unit vectors with the largest weight of every (term, block)."""

    def __init__(self, n_terms: int, ptr: np.ndarray, term: np.ndarray, weight: np.ndarray) -> None:
        self.n = len(ptr) - 1
        doc = np.repeat(np.arange(self.n), np.diff(ptr))
        o = np.lexsort((doc, term))
        self.doc, self.weight = doc[o], weight[o]
        self.first = np.searchsorted(term[o], np.arange(n_terms + 1))
        self.blocks = -(-max(1, self.n) // BLOCK_DOCS)
        # where each block of each term's postings begins, and its maximum
        key = term[o] * self.blocks + self.doc // BLOCK_DOCS
        self.cell, at = np.unique(key, return_index=True)
        self.cell_at = np.append(at, len(key))
        self.cell_max = np.maximum.reduceat(self.weight, at) if len(at) else np.zeros(0)
        self.cell_first = np.searchsorted(self.cell, np.arange(n_terms + 1) * self.blocks)

    def search(self, term: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k entries of largest cosine above 0 and all that tie with the last: (entries, cosines)."""
        cells = [np.arange(self.cell_first[t], self.cell_first[t + 1]) for t in term]
        size = np.array([len(c) for c in cells])
        if not size.sum():
            return np.zeros(0, np.int64), np.zeros(0)
        cells, w = np.concatenate(cells), np.repeat(weight, size)
        block = self.cell[cells] % self.blocks
        bound = np.bincount(block, w * self.cell_max[cells], minlength=self.blocks)
        score = np.zeros(self.n)

        def visit(which: np.ndarray) -> None:
            m = which[block]
            c, cw = cells[m], w[m]
            n = self.cell_at[c + 1] - self.cell_at[c]
            at = np.repeat(self.cell_at[c] - np.cumsum(n) + n, n) + np.arange(n.sum())
            score.__iadd__(np.bincount(self.doc[at], self.weight[at] * np.repeat(cw, n), minlength=self.n))

        order = np.argsort(-bound, kind="stable")
        head = order[:max(4, -(-2 * k // BLOCK_DOCS))]
        first = np.zeros(self.blocks, bool)
        first[head] = True
        visit(first)
        floor = np.partition(score, -k)[-k] if self.n >= k else 0.0
        rest = (bound >= floor - 1e-12) & (bound > 0) & ~first     # no other block can reach the k-th best
        if rest.any():
            visit(rest)
            floor = np.partition(score, -k)[-k] if self.n >= k else 0.0
        hit = np.flatnonzero((score > 0) & (score >= floor - 1e-12))
        o = np.lexsort((hit, -score[hit]))
        return hit[o], score[hit[o]]


class Model:
    def __init__(self, vocabulary, index, pos, neg, example, base, empty) -> None:
        self.vocabulary, self.index = vocabulary, index
        self.pos, self.neg, self.example = pos, neg, example
        self.base, self.empty = base, empty

    def one(self, term: np.ndarray, weight: np.ndarray) -> tuple[float, list]:
        """Calibrated score and evidence (example document, cosine, toxic share) of one vector."""
        if not len(term):
            return self.empty, []
        hit, cos = self.index.search(term, weight, NEIGHBOURS)
        if not len(hit):
            return self.empty, []
        cos = np.minimum(cos, 1.0)
        # distance weights: an equal vector counts fully, a far one little
        w = cos ** 4 / (0.1 + (1.0 - cos))
        many = np.sqrt(self.pos[hit] + self.neg[hit]) / (self.pos[hit] + self.neg[hit])
        a, b = float((w * many * self.pos[hit]).sum()), float((w * many * self.neg[hit]).sum())
        share = (a + PRIOR * self.base) / (a + b + PRIOR)
        return share, [(int(self.example[h]), float(c), float(self.pos[h] / (self.pos[h] + self.neg[h])))
                       for h, c in zip(hit[:EVIDENCE].tolist(), cos[:EVIDENCE].tolist())]


def train(rows: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit from (doc_id, text, label in 0/1)."""
    spark = rows.sparkSession
    vocabulary, pos, neg = choose_terms(rows)
    base = (pos + 1) / (pos + neg + 2)
    nothing = np.zeros(0, np.int64)
    if not len(vocabulary.terms):
        return Model(vocabulary, BlockMaxIndex(0, np.zeros(1, np.int64), nothing, np.zeros(0)),
                     nothing, nothing, nothing, base, base)
    shared = spark.sparkContext.broadcast(vocabulary)

    def vectors(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            data, off = buffers(b.column(1))
            for lo, hi in doc_groups(off):
                ptr, term, w = shared.value.vectors(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                term, w = term.astype("<i4"), np.round(w, 9).astype("<f8")
                cut = list(zip(ptr[:-1].tolist(), ptr[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo),
                     pa.array([term[x:y].tobytes() for x, y in cut], pa.binary()),
                     pa.array([w[x:y].tobytes() for x, y in cut], pa.binary())], names=["doc_id", "label", "terms", "weights"])

    vec = materialize(rows.select("doc_id", "text", "label").mapInArrow(
        vectors, "doc_id long, label int, terms binary, weights binary"), "toxicity-vectors")
    none = {r["label"]: r["n"] for r in vec.filter(F.length("terms") == 0).groupBy("label").agg(
        F.count("*").alias("n")).collect()}
    p0, n0 = none.get(1, 0), none.get(0, 0)
    empty = (p0 + base) / (p0 + n0 + 1)
    few = of_least_hash(vec.filter(F.length("terms") > 0), F.col("doc_id"), sample, pos + neg - p0 - n0)
    got = (few.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
           .groupBy("terms", "weights").agg(F.min("doc_id").alias("doc_id"), F.sum("label").alias("pos"),
                                            F.sum(1 - F.col("label")).alias("neg")).toPandas())
    got = got.sort_values(["terms", "weights"], kind="stable")
    terms = [np.frombuffer(x, "<i4") for x in got["terms"]]
    ptr = np.concatenate([[0], np.cumsum([len(x) for x in terms])]).astype(np.int64)
    term = np.concatenate(terms).astype(np.int64) if terms else nothing
    weight = np.concatenate([np.frombuffer(x, "<f8") for x in got["weights"]]) if terms else np.zeros(0)
    return Model(vocabulary, BlockMaxIndex(len(vocabulary.terms), ptr, term, weight), got["pos"].to_numpy(),
                 got["neg"].to_numpy(), got["doc_id"].fillna(-1).to_numpy(), base, empty)


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, score, evidence) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # bounded by VOCABULARY and SAMPLE

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in it:
            data, off = buffers(b.column(1))
            out = []
            for lo, hi in doc_groups(off):
                ptr, term, w = m.vocabulary.vectors(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
                out += [m.one(term[x:y], w[x:y]) for x, y in zip(ptr[:-1].tolist(), ptr[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([s for s, _ in out], pa.float64()),
                 pa.array([[dict(doc_id=i, cosine=c, toxic_share=t) for i, c, t in e] for _, e in out],
                          pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic_share", pa.float64())])))],
                names=["doc_id", "score", "evidence"])

    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return ids.mapInArrow(run, "doc_id long, score double, evidence array<struct<doc_id:long,cosine:double,toxic_share:double>>")


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """(doc_id, text, label); the held-out fold never joins. Labels are a few bytes a row:
    while their number allows, they are sent to the texts."""
    use = labels.filter(F.col(label).isin(0, 1) & (fold_of("doc_id", FOLDS) != HELD)).select(
        "doc_id", F.col(label).cast("int").alias("label"))
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(small(use), "doc_id")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence for every document."""
    begin(docs.sparkSession)
    rows = materialize(training_rows(docs, labels), "toxicity-train")
    return score(docs, train(rows)).select(
        "doc_id", (fold_of("doc_id", FOLDS) == HELD).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
