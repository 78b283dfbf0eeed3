"""Substring dedup by recompression.

Recompression shortens every text in rounds. The first round replaces each run of one
word by a run symbol; every round replaces each pair "left symbol, right symbol" by a pair symbol; which
symbols count as left or right in a round follows from the symbol alone. Names are
hashes of what they stand for, so a name is global: Spark never has to hand out
numbers, and equal substrings get equal interior symbols in every document.

A symbol of the last round depends on the words under it and on a known context (its
neighbours wherever they could have changed a pairing). If a window of ``WINDOW``
words occurs in two documents, every symbol whose context lies inside the window
occurs in both. So:

1. Spark counts in how many documents each high-level symbol occurs (round one of the
   exchange); a symbol of a single document rules out all windows around its context.
2. The windows that are left are named by 88 bits beside their bucket and matched exactly (round two): the smallest
   document of each window is known everywhere.
3. Words covered by a window that also starts in a smaller document are removed.

Nothing is lost by the first round: a window without interior symbols (long runs) is simply not
ruled out. Texts stay in chunks of about ``CHUNK`` bytes. A chunk sends each bucket of
hashes one packed record and gets back one bit per hash, so a passage that a third of
all documents share costs one entry per chunk, and no document moves to its hash.

Defined cases: null and word-free texts have no words and the hash of the empty string; "smaller
document" means smaller doc_id (null ids are largest; rows of one id never remove
from each other); a text shorter than a
window is kept whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyvane.llm._tables import begin, read
from skyvane.llm._text import U64, Words, buffers, mix
from skyvane.session import materialize, scratch_path

WINDOW = 13
ROUNDS = 3
CHUNK = 4 << 20
BUCKET_BYTES = 8 << 20        # stored text per bucket of the exchange
NO_ID = (1 << 63) - 1
_K1, _K2 = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)
FAR = 1 << 40
_SIDE = mix(np.arange(1, 17, dtype=np.uint64) * _K2)
BROADCAST_BYTES = 64 << 20


def _runs(name: np.ndarray, doc: np.ndarray):
    """Runs of one word as run symbols; the words that end a run are its context."""
    head = np.ones(len(name), bool)
    head[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(head)
    length = np.diff(np.append(at, len(name)))
    run = length > 1
    new = name[at]
    new[run] = mix(new[run] * _K1 + length[run].astype(U64) * _K2 + U64(1))
    d = doc[at]
    before = np.zeros(len(at), bool)
    before[1:] = d[1:] == d[:-1]
    after = np.append(before[1:], False)
    return new, d, np.where(before, at - 1, -FAR), np.where(after, at + length + 1, FAR)


def recompress(words: np.ndarray, first: np.ndarray, rounds: int = ROUNDS):
    """Symbols after ``rounds`` rounds over the documents ``words[first[d]:first[d+1]]``.

    Returns (name, lo, hi): the name and its context, the word range on which it depends;
    a context that reaches over a document's edge is beyond every window."""
    n = len(words)
    name = words.copy()
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    lo, hi = np.arange(n), np.arange(1, n + 1)
    for r in range(rounds):
        if not len(name):
            break
        if r == 0:                       # later rounds leave runs as they are: equal neighbours never pair
            name, doc, lo, hi = _runs(name, doc)
        # pairs: left symbols take a right symbol behind them
        right = (mix(name ^ _SIDE[r]) & U64(1)).astype(bool)
        same = np.zeros(len(name), bool)
        same[1:] = doc[1:] == doc[:-1]
        joins = np.zeros(len(name), bool)                  # this symbol is taken by the one before it
        joins[1:] = same[1:] & right[1:] & ~right[:-1]
        before = np.where(same, np.insert(lo[:-1], 0, 0), -FAR)
        has_next = np.append(same[1:], False)
        after = np.where(has_next, np.append(hi[1:], 0), FAR)
        # left over: a right symbol depends on what stands before it, a left one on what follows
        lo2 = np.where(right, np.minimum(lo, before), lo)
        hi2 = np.where(right, hi, np.maximum(hi, after))
        keep = np.flatnonzero(~joins)
        takes = np.append(joins[1:], False)[keep]
        nxt = np.minimum(keep + 1, len(name) - 1)
        new = name[keep].copy()
        new[takes] = mix(name[keep][takes] * _K1 + name[nxt][takes] * _K2 + U64(3 * r + 2))
        lo = np.where(takes, np.minimum(lo[keep], lo[nxt]), lo2[keep])
        hi = np.where(takes, np.maximum(hi[keep], hi[nxt]), hi2[keep])
        name, doc = new, doc[keep]
    return name, lo, hi


def window_starts(first: np.ndarray, n_words: int, window: int = WINDOW) -> np.ndarray:
    """Which words start a window inside their document."""
    ok = np.zeros(n_words, bool)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= window:
            ok[a:b - window + 1] = True
    return ok


def rule_out(ok: np.ndarray, lo: np.ndarray, hi: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Windows that hold none of the given contexts."""
    fits = (hi - lo <= window) & (lo >= 0)
    a, b = np.maximum(0, hi[fits] - window), lo[fits] + 1    # starts of the windows around each context
    step = np.zeros(len(ok) + 1, np.int64)
    np.add.at(step, a, 1)
    np.add.at(step, np.minimum(b, len(ok)), -1)
    return ok & (np.cumsum(step)[:-1] == 0)


def window_hash(words: np.ndarray, at: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Names of the windows that start at ``at``: 64 bits and, from other operations, 24 more."""
    x, y = np.zeros(len(at), U64), np.zeros(len(at), U64)
    for j in range(window):
        w = words[at + j]
        x = x * _K1 + w
        y = (y ^ w) * _K2
        y ^= y >> U64(29)
    return mix(x), mix(y) & U64(0xFFFFFF)


# -- chunks

def _pack(data: np.ndarray) -> bytes:
    import zstandard
    return zstandard.ZstdCompressor(level=3).compress(data.tobytes())


def _unpack(blob: bytes, dtype=np.uint8) -> np.ndarray:
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype)


def _make_chunks(it: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    task, number = TaskContext.get().partitionId(), 0
    ids: list[np.ndarray] = []
    parts: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    total = 0

    def flush() -> pa.RecordBatch:
        doc = np.concatenate(ids)
        return pa.RecordBatch.from_arrays(
            [pa.array([(task << 32) + number], pa.int64()), pa.array([doc.astype("<i8").tobytes()], pa.binary()),
             pa.array([len(doc)], pa.int64()), pa.array([np.concatenate(sizes).astype("<i8").tobytes()], pa.binary()),
             pa.array([_pack(np.concatenate(parts))], pa.binary())],
            names=["chunk", "docs", "n_docs", "bytes", "texts"])

    for b in it:
        if not b.num_rows:
            continue
        doc = b.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
        data, off = buffers(b.column(1))
        lo = 0
        while lo < len(doc):
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size - total, "right")) - 1)
            hi = min(hi, len(doc))
            ids.append(doc[lo:hi])
            parts.append(data[off[lo]:off[hi]])
            sizes.append(np.diff(off[lo:hi + 1]))
            total += int(off[hi] - off[lo])
            lo = hi
            if total >= size:
                yield flush()
                ids, parts, sizes, total, number = [], [], [], 0, number + 1
    if ids:
        yield flush()


class Chunk:
    """The documents of a chunk as words."""

    def __init__(self, docs: bytes, sizes: bytes, texts: bytes, spans: bool = False) -> None:
        self.docs = np.frombuffer(docs, "<i8")
        self.data = _unpack(texts)
        self.off = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, "<i8"))]).astype(np.int64)
        w = Words(self.data, self.off, keep_spans=spans)
        self.words, self.first, self.start, self.end = w.hash, w.first, w.start, w.end
        self.doc_of = np.repeat(np.arange(len(self.docs)), np.diff(self.first))
        # rows of one id count as one document
        self.distinct = np.unique(self.docs, return_inverse=True)[1][self.doc_of] if len(self.words) else self.doc_of

    def symbols(self):
        """Sorted distinct names, whether each occurs in several documents of the chunk, and the
        name's number for each symbol with its context."""
        name, lo, hi = recompress(self.words, self.first)
        base = np.clip(np.where(lo >= 0, lo, hi - 1), 0, max(0, len(self.words) - 1))
        # only symbols whose context fits a window can rule one out
        fits = (hi - lo <= WINDOW) & (lo >= 0)
        name, lo, hi, base = name[fits], lo[fits], hi[fits], base[fits]
        doc = self.distinct[base] if len(name) else base
        keys, inv = np.unique(name, return_inverse=True)
        if not len(keys):
            return keys, np.zeros(0, bool), inv, lo, hi
        least = np.full(len(keys), np.iinfo(np.int64).max)
        most = np.full(len(keys), -1)
        np.minimum.at(least, inv, doc)
        np.maximum.at(most, inv, doc)
        return keys, most > least, inv, lo, hi

    def windows(self, shared: np.ndarray):
        """Windows left by the shared flags of ``symbols()``: (sorted names x, y; smallest id of each name;
        place of each window, its name's number)."""
        keys, _, inv, lo, hi = self.symbols()
        single = ~shared[inv] if len(keys) else np.zeros(0, bool)
        ok = rule_out(window_starts(self.first, len(self.words)), lo[single], hi[single])
        at = np.flatnonzero(ok)
        x, y = window_hash(self.words, at)
        x, y, inv = distinct_names(x, y)
        least = np.full(len(x), NO_ID)
        if len(x):
            np.minimum.at(least, inv, self.docs[self.doc_of[at]])
        return x, y, least, at, inv


def distinct_names(x: np.ndarray, y: np.ndarray):
    """Sorted distinct pairs (x, y) and each pair's number among them."""
    o = np.lexsort((y, x))
    x, y = x[o], y[o]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    inv = np.empty(len(x), np.int64)
    inv[o] = np.cumsum(new) - 1
    return x[new], y[new], inv


def _bucket(x: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of sorted hashes: their top bits, so a bucket is a slice."""
    return ((x >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def _slices(x: np.ndarray, buckets: int):
    b = _bucket(x, buckets)
    cut = np.flatnonzero(np.diff(b)) + 1
    lo = np.concatenate([[0], cut])
    for p, q in zip(lo.tolist(), np.append(cut, len(x)).tolist()):
        if q > p:
            yield int(b[p]), p, q


def _low40(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _low88(x: np.ndarray, y: np.ndarray) -> bytes:
    return np.concatenate([x.astype("<u8").view(np.uint8).reshape(-1, 8),
                           y.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :3]], 1).tobytes()


def _from88(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    w = np.frombuffer(b, np.uint8).reshape(-1, 11)
    y = np.zeros((len(w), 8), np.uint8)
    y[:, :3] = w[:, 8:]
    return np.ascontiguousarray(w[:, :8]).view("<u8").ravel(), y.view("<u8").ravel()


def _from40(b: bytes) -> np.ndarray:
    w = np.zeros((len(b) // 5, 8), np.uint8)
    w[:, :5] = np.frombuffer(b, np.uint8).reshape(-1, 5)
    return w.view("<u8").ravel()


_RECORD = "bucket long, chunk long, keys binary, extra binary"
_REPLY = "chunk long, bucket long, bits binary"


def _records(chunk: int, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int64()), pa.array([chunk] * len(rows), pa.int64()), pa.array(cols[1], pa.binary()),
         pa.array(cols[2], pa.binary())], names=["bucket", "chunk", "keys", "extra"])


def _exchange(records: DataFrame, answer) -> DataFrame:
    """Group packed records by bucket (bounded by BUCKET_BYTES) and reply bits to every chunk, packed per chunk."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def done() -> pa.RecordBatch:
            bits = answer([(k, e) for _, k, e in rows])
            return pa.RecordBatch.from_arrays(
                [pa.array([c for c, _, _ in rows], pa.int64()), pa.array([now] * len(rows), pa.int64()),
                 pa.array([np.packbits(x).tobytes() for x in bits], pa.binary())], names=["chunk", "bucket", "bits"])

        for b in it:
            for bucket, chunk, keys, extra in zip(*[b.column(i).to_pylist() for i in range(4)]):
                if bucket != now:
                    if rows:
                        yield done()
                    now, rows = bucket, []
                rows.append((chunk, keys, extra))
        if rows:
            yield done()

    replies = records.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _REPLY)
    return replies.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "bits"))).alias("replies"))


def _replies(table: DataFrame) -> DataFrame:
    """Reply bits, broadcast only if their counted size allows: then the texts stay where they are."""
    size = table.agg(F.sum(F.expr("aggregate(replies, 0L, (n, r) -> n + length(r.bits))"))).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def _shared_names(parts: list[tuple[bytes, bytes]]) -> list[np.ndarray]:
    """Which names occur in several documents: of one chunk, or of two."""
    keys = [_from40(k) for k, _ in parts]
    many = [np.unpackbits(np.frombuffer(e, np.uint8), count=len(k)).astype(bool) for k, (_, e) in zip(keys, parts)]
    every, inv, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    shared = count > 1
    np.logical_or.at(shared, inv, np.concatenate(many))
    return np.split(shared[inv], np.cumsum([len(k) for k in keys])[:-1])


def _smaller_elsewhere(parts: list[tuple[bytes, bytes]]) -> list[np.ndarray]:
    """Which windows start in a smaller document of another chunk."""
    names = [_from88(k) for k, _ in parts]
    docs = [_unpack(e, "<i8") for _, e in parts]
    x, _, inv = distinct_names(*(np.concatenate(v) for v in zip(*names)))
    all_docs = np.concatenate(docs)
    least = np.full(len(x), NO_ID)
    np.minimum.at(least, inv, all_docs)
    return np.split(least[inv] < all_docs, np.cumsum([len(d) for d in docs])[:-1])


def _bits(keys: np.ndarray, buckets: int, replies) -> np.ndarray:
    """The replied bit of every sorted key."""
    out = np.zeros(len(keys), bool)
    got = {r["bucket"]: r["bits"] for r in (replies or [])}
    for bucket, p, q in _slices(keys, buckets):
        out[p:q] = np.unpackbits(np.frombuffer(got[bucket], np.uint8), count=q - p).astype(bool)
    return out


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", chunk: int = CHUNK,
                bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept text of every document."""
    spark = begin(docs.sparkSession)
    path = scratch_path(spark, "text-chunks")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows.mapInArrow(lambda it: _make_chunks(it, chunk), "chunk long, docs binary, n_docs long, bytes binary, texts binary"
                    ).write.option("compression", "none").parquet(path)
    chunks = spark.read.parquet(path)
    # About 1.5 million symbols a bucket; a task holds one bucket at a time.
    stored = chunks.agg(F.sum(F.length("texts"))).first()[0] or 0
    buckets = max(8, -(-stored // bucket_bytes))

    def symbols(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for c, d, s, t in zip(*[b.column(x).to_pylist() for x in ("chunk", "docs", "bytes", "texts")]):
                keys, many, *_ = Chunk(d, s, t).symbols()
                out = [(k, _low40(keys[p:q]), np.packbits(many[p:q]).tobytes()) for k, p, q in _slices(keys, buckets)]
                if out:
                    yield _records(c, out)

    shared = materialize(_exchange(chunks.mapInArrow(symbols, _RECORD), _shared_names), "shared-symbols")

    def windows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for c, d, s, t, r in zip(*[b.column(x).to_pylist() for x in ("chunk", "docs", "bytes", "texts", "replies")]):
                chunk = Chunk(d, s, t)
                x, y, least, _, _ = chunk.windows(_bits(chunk.symbols()[0], buckets, r))
                out = [(k, _low88(x[p:q], y[p:q]), _pack(least[p:q].astype("<i8"))) for k, p, q in _slices(x, buckets)]
                if out:
                    yield _records(c, out)

    known = chunks.join(_replies(shared), "chunk", "left")
    smaller = materialize(_exchange(known.mapInArrow(windows, _RECORD), _smaller_elsewhere), "smaller-windows")

    def remove(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for d, s, t, r, r2 in zip(*[b.column(x).to_pylist() for x in ("docs", "bytes", "texts", "replies", "smaller")]):
                x = Chunk(d, s, t, spans=True)
                names, _, least, at, inv = x.windows(_bits(x.symbols()[0], buckets, r))
                elsewhere = _bits(names, buckets, r2)
                # a smaller document holds the window: in another chunk, or in this one
                gone = elsewhere[inv] | (least[inv] < x.docs[x.doc_of[at]]) if len(at) else np.zeros(0, bool)
                step = np.zeros(len(x.words) + 1, np.int64)
                np.add.at(step, at[gone], 1)
                np.add.at(step, at[gone] + WINDOW, -1)
                keep = np.cumsum(step)[:-1] == 0
                raw, out = x.data.tobytes(), []
                for i, (a, e) in enumerate(zip(x.first[:-1].tolist(), x.first[1:].tolist())):
                    k = a + np.flatnonzero(keep[a:e])
                    text = b" ".join([raw[p:q] for p, q in zip(x.start[k].tolist(), x.end[k].tolist())])
                    out.append((int(x.docs[i]), e - a, e - a - len(k), hashlib.sha256(text).hexdigest(), text.decode()))
                cols = list(zip(*out))
                ids = np.array(cols[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64(), mask=ids == NO_ID), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                     pa.array(cols[3], pa.string()), pa.array(cols[4], pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return known.join(_replies(smaller).withColumnRenamed("replies", "smaller"), "chunk", "left").mapInArrow(
        remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(read(spark, sf_dir, "documents")).drop("kept_text")


OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM p),
m AS (SELECT s, min(doc_id) AS least FROM g GROUP BY s),
gone AS (SELECT DISTINCT g.doc_id, g.i + t.j AS i FROM g JOIN m USING (s), range(13) t(j) WHERE m.least < g.doc_id),
u AS (SELECT d.doc_id, unnest(d.w) AS word, unnest(range(1, len(d.w) + 1)) AS i FROM d),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM u ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
