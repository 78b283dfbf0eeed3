"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased runs of letters and digits; Unicode punctuation, symbols and spaces part them, and each
character of a script without spaces (Chinese, Japanese, Thai, Lao, Khmer, Myanmar) is a word. The seeds of an item
are its rare three-word grams: those that at most ``RARE_ITEMS`` different items hold. A phrase that many items share
("which of the following") says nothing about which of them a text copies, and each of its
places would bring all of them; it is a seed only for an item without any rare gram, which takes its rarest ones, ties
together. So a text's work grows with its own length, not with the number of items. Document counts
play no part: an edit lowers the counts of the grams it breaks, so by them the grams of a
hot group of edited copies are the common ones and the broken grams the rare ones. The stretch around the seeds
that a document meets is aligned with the item if it can reach the threshold at all:
a word that the item lacks costs at least one point and any other wins at most
``MATCH``, so the best sum of a run of words bounds the alignment, and nothing is lost there.
Local alignment of words (match 2, mismatch -1, gap -1) finds paraphrased and edited copies. A
document is contaminated if the score reaches ``THRESHOLD`` of the item's own, or
that of ``LONG_MATCH`` matched words for long items. A copy that has no rare gram of its item left is not met.

The benchmark's seeds are sent to the tasks in shards of about ``SHARD_WORDS`` words;
a larger benchmark takes several passes over the documents, each written before the next shard is read, instead of
a larger broadcast. Seeds met are expanded to their items for ``HITS`` at a time. Equal items are searched for once.

Defined cases: null and empty texts are clean; items of fewer than ``MIN_WORDS`` words have too few grams
for edited copies and are found as whole items only, word for word; items of fewer than ``GRAM`` words
(null and empty ones too) can't identify a copy and are not searched for; equal items are
all reported; repeated and null document ids stay separate rows of the search (one
result row each); empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyvane.llm._tables import begin, read
from skyvane.llm._text import NON_WORD, U64, Words, buffers, doc_groups, fold_case, ngram_hash
from skyvane.session import materialize

GRAM = 3
MIN_WORDS = 8
THRESHOLD = 0.5
LONG_MATCH = 20
MATCH, MISMATCH, GAP = 2, -1, -1
RARE_ITEMS = 32
SHARD_WORDS = 2_000_000
HITS = 1_000_000
_BITS = U64((1 << 22) - 1)


def _classes() -> np.ndarray:
    """By code point under 0x20000 (further ones are Chinese): 0 part of a word, 1 separator, 2 a word of its own."""
    out = np.zeros(0x20001, np.uint8)
    out[0x20000] = 2
    for c in range(0xA0, 0x20000):
        if unicodedata.category(chr(c))[0] in "PSZ" or c in (0x200B, 0x2060, 0xFEFF):
            out[c] = 1
    for a, b in ((0x0E00, 0x0F00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x2E80, 0x3000), (0x3005, 0x3008), (0x3031, 0x3036),
                 (0x3040, 0x3130), (0x31F0, 0x3200), (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xF900, 0xFB00), (0xFF66, 0xFFA0),
                 (0x1B000, 0x1B170)):
        part = out[a:b]
        part[part == 0] = 2
    return out


_CLASS = _classes()


def segment(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets in lower case, Unicode separators made spaces and characters that are words set apart by spaces."""
    data = fold_case(data)
    lead = np.flatnonzero(data >= 0xC2)
    if not len(lead):
        return data, off
    x = data[lead].astype(np.int64)
    size = 2 + (x >= 0xE0) + (x >= 0xF0)
    ok = lead + size <= len(data)
    lead, x, size = lead[ok], x[ok], size[ok]
    code = x & (0x7F >> size)
    for j in range(1, 4):
        m = size > j
        code[m] = code[m] << 6 | data[lead[m] + j] & 0x3F
    kind = _CLASS[np.minimum(code, 0x20000)]
    for j in range(4):
        data[lead[(kind == 1) & (size > j)] + j] = 32
    own = np.flatnonzero(kind == 2)
    if not len(own):
        return data, off
    # a space before and after; one that falls on a document's border may lie on either side of it
    cuts = np.union1d(lead[own], lead[own] + size[own])
    return np.insert(data, cuts, np.uint8(32)), off + np.searchsorted(cuts, off, "left")


class Items:
    """Benchmark items as word hashes, and their grams."""

    def __init__(self, ids: list, texts: list) -> None:
        col = pa.array(texts, pa.string())
        data, off = buffers(col)
        w = Words(*segment(data, off), NON_WORD)
        n = np.diff(w.first)
        keep = np.flatnonzero(n >= MIN_WORDS).tolist()
        self.short = {}                                # words of a short item: hashes of whole items (sorted) and their ids
        for k in range(GRAM, MIN_WORDS):
            few = np.flatnonzero(n == k)
            if len(few):
                whole = np.array([ngram_hash(w.hash[w.first[i]:w.first[i] + k], k)[0] for i in few], U64)
                o = np.argsort(whole, kind="stable")
                self.short[k] = (whole[o], [ids[i] for i in few[o]])
        same: dict[bytes, int] = {}                    # equal items are one, with all their ids
        self.ids, self.words = [], []
        for i in keep:
            words = w.hash[w.first[i]:w.first[i + 1]]
            k = same.setdefault(words.tobytes(), len(self.words))
            if k == len(self.words):
                self.words.append(words)
                self.ids.append([])
            self.ids[k].append(ids[i])
        grams = [ngram_hash(x, GRAM) for x in self.words]
        self.item = np.repeat(np.arange(len(grams)), [len(g) for g in grams]).astype(np.int64)
        self.place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        self.gram = np.concatenate(grams) if grams else np.zeros(0, U64)


class Seeds:
    """Lookup of the items' seeds: a bit table first, then the sorted grams."""

    def __init__(self, items: Items) -> None:
        o = np.lexsort((items.item, items.gram))
        gram, item, place = items.gram[o], items.item[o], items.place[o]
        keep = rare_grams(gram, item)
        self.gram, self.item, self.place = gram[keep], item[keep], place[keep]
        self.bits = bit_table(self.gram)
        self.ids, self.words, self.short = items.ids, items.words, items.short
        self.length = np.array([len(x) for x in items.words], np.int64)
        self.sorted = [np.unique(x) for x in items.words]


def rare_grams(gram: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Which of the (gram, item) rows, in this order, are seeds."""
    if not len(gram):
        return np.zeros(0, bool)
    first = np.ones(len(gram), bool)
    first[1:] = gram[1:] != gram[:-1]
    other = first.copy()
    other[1:] |= item[1:] != item[:-1]
    number = np.cumsum(first) - 1
    holders = np.bincount(number, weights=other)[number]             # different items that hold the row's gram
    least = np.full(int(item.max()) + 1, np.inf)
    np.minimum.at(least, item, np.floor(np.log2(holders)))
    return (holders <= RARE_ITEMS) | (np.floor(np.log2(holders)) <= least[item]) & (least[item] >= np.log2(RARE_ITEMS))


def bit_table(grams: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << 22, bool)
    table[(grams & _BITS).astype(np.int64)] = True
    return table


def smith_waterman(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment of two word-hash rows: (score, end in text, start in text, matches).

    Row by row; the linear gap along a row is a running maximum."""
    n = len(text)
    ramp = np.arange(n + 1) * -GAP
    prev = np.zeros(n + 1, np.int64)
    begin_prev = np.arange(n + 1)          # where the best path into each cell began
    hits_prev = np.zeros(n + 1, np.int64)
    best = (0, 0, 0, 0)
    for x in item:
        same = text == x
        diag = prev[:-1] + np.where(same, MATCH, MISMATCH)
        up = prev[1:] + GAP
        take_up = up > diag
        cell = np.where(take_up, up, diag)
        start = np.where(take_up, begin_prev[1:], begin_prev[:-1])
        hits = np.where(take_up, hits_prev[1:], hits_prev[:-1] + same)
        fresh = cell <= 0
        cell = np.concatenate([[0], np.where(fresh, 0, cell)])
        start = np.concatenate([[0], np.where(fresh, np.arange(1, n + 1), start)])
        hits = np.concatenate([[0], np.where(fresh, 0, hits)])
        raised = cell + ramp
        run = np.maximum.accumulate(raised)
        src = np.maximum.accumulate(np.where(raised == run, np.arange(n + 1), 0))   # the cell a gap run comes from
        cell = run - ramp
        prev, begin_prev, hits_prev = cell, start[src], hits[src]
        j = int(cell.argmax())
        if cell[j] > best[0]:
            best = (int(cell[j]), j, int(begin_prev[j]), int(hits_prev[j]))
    return best


def reach(item: np.ndarray, text: np.ndarray) -> int:
    """An upper bound of the alignment score of a text with an item's sorted words: the best run of
    words where those of the item win MATCH and each other word loses a point."""
    k = np.minimum(np.searchsorted(item, text), len(item) - 1)
    total = np.concatenate([[0], np.cumsum(np.where(item[k] == text, MATCH, max(MISMATCH, GAP)))])
    return int((total - np.minimum.accumulate(total)).max())


def find(data: np.ndarray, off: np.ndarray, seeds: Seeds) -> list[tuple]:
    """(document, item id, score, matched words, seeds met, first word, end word) of contaminated documents."""
    w = Words(*segment(data, off), NON_WORD)
    rows = _whole(w, seeds)
    g = ngram_hash(w.hash, GRAM)
    if not len(g) or not len(seeds.gram):
        return rows
    at = np.flatnonzero(seeds.bits[(g & _BITS).astype(np.int64)])
    lo, hi = np.searchsorted(seeds.gram, g[at], "left"), np.searchsorted(seeds.gram, g[at], "right")
    n = hi - lo
    at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
    doc = np.searchsorted(w.first, at, "right") - 1
    inside = at + GRAM <= w.first[doc + 1]
    at, lo, n, doc = at[inside], lo[inside], n[inside], doc[inside]
    a = 0
    while a < len(at):                                 # whole documents, about HITS at a time
        total = np.cumsum(n[a:])
        b = a + max(1, int(np.searchsorted(total, HITS, "right")))
        if b < len(at):
            start = int(np.searchsorted(doc, doc[b]))
            b = start if start > a else int(np.searchsorted(doc, doc[b], "right"))
        rows += _align(w, seeds, at[a:b], lo[a:b], n[a:b], doc[a:b])
        a = b
    return rows


def _whole(w: Words, seeds: Seeds) -> list[tuple]:
    """Rows of the short items that stand word for word in a document: the first place of each."""
    rows = []
    for k, (whole, ids) in seeds.short.items():
        g = ngram_hash(w.hash, k)
        at = np.flatnonzero(np.isin(g, whole))
        doc = np.searchsorted(w.first, at, "right") - 1
        inside = at + k <= w.first[doc + 1]
        at, doc = at[inside], doc[inside]
        _, first = np.unique(np.stack([doc.astype(U64), g[at]]), axis=1, return_index=True)
        for a, d in zip(at[first].tolist(), doc[first].tolist()):
            lo, hi = np.searchsorted(whole, g[a], "left"), np.searchsorted(whole, g[a], "right")
            f = a - int(w.first[d])
            rows += [(d, ids[i], 1.0, k, k - GRAM + 1, f, f + k) for i in range(lo, hi)]
    return rows


def _align(w: Words, seeds: Seeds, at: np.ndarray, lo: np.ndarray, n: np.ndarray, doc: np.ndarray) -> list[tuple]:
    """Aligned rows of the met grams: places ``at`` of documents ``doc`` and their ``n`` seeds from ``lo``."""
    seed = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
    at, doc = np.repeat(at, n), np.repeat(doc, n)
    item, place = seeds.item[seed], seeds.place[seed]
    o = np.lexsort((at, item, doc))
    at, doc, item, place = at[o], doc[o], item[o], place[o]
    length = seeds.length[item]
    new = np.ones(len(at), bool)                       # hits of one document and item that lie near each other
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (at[1:] - at[:-1] > 2 * length[1:])
    cut = np.append(np.flatnonzero(new), len(at))
    best: dict[tuple[int, int], tuple] = {}
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        d, i = int(doc[a]), int(item[a])
        words, m = seeds.words[i], len(seeds.words[i])
        least = min(THRESHOLD * MATCH * m, MATCH * LONG_MATCH)
        x = max(int(w.first[d]), int(at[a]) - 3 * m)   # an alignment takes m words and fewer than 2 m put in
        y = min(int(w.first[d + 1]), int(at[b - 1]) + 3 * m + GRAM)
        if reach(seeds.sorted[i], w.hash[x:y]) < least:
            continue
        score, end, start, hits = smith_waterman(words, w.hash[x:y])
        if score >= least:
            f = x - int(w.first[d])
            met = len(set(place[a:b].tolist()))
            row = (score / (MATCH * m), hits, met, f + start, f + end)
            if (d, i) not in best or row[0] > best[d, i][0]:
                best[d, i] = row
    return [(d, name, *best[d, i]) for d, i in sorted(best) for name in seeds.ids[i]]


def seed_shards(benchmark: DataFrame, shard_words: int = SHARD_WORDS) -> Iterator[Seeds]:
    """The seed tables, one per shard of the benchmark; each is built when it is asked for. Equal items share a
    shard."""
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    words = rows.agg(F.sum(F.octet_length("text") / 4)).first()[0] or 0       # four bytes a word at least, nearly always
    shards = max(1, int(-(-words // shard_words)))
    for k in range(shards):
        part = rows.filter(F.pmod(F.xxhash64("text"), F.lit(shards)) == k).toPandas()
        part = part.sort_values(["item_id", "text"], kind="stable")
        items = Items(part["item_id"].astype(object).where(part["item_id"].notna(), None).tolist(),
                      [t if isinstance(t, str) else None for t in part["text"]])
        if items.ids or items.short:
            yield Seeds(items)


HIT = ("doc_id long, item_id long, score double, matched_words int, seeds int, "
       "first_word long, end_word long, contaminated boolean")


def contaminated(docs: DataFrame, benchmark: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per contaminated document and item: the best alignment."""
    spark = begin(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def search(seeds: Seeds) -> DataFrame:
        shared = spark.sparkContext.broadcast(seeds)

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in it:
                data, off = buffers(b.column(1))
                names = b.column(0)
                for lo, hi in doc_groups(off):
                    hits = find(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], shared.value)
                    if hits:
                        cols = list(zip(*hits))
                        yield pa.RecordBatch.from_arrays(
                            [names.take(pa.array(np.array(cols[0]) + lo)), pa.array(cols[1], pa.int64()),
                             pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int32()),
                             pa.array(cols[5], pa.int64()), pa.array(cols[6], pa.int64()), pa.array([True] * len(hits))],
                            names=[c.split()[0] for c in HIT.split(", ")])

        return rows.mapInArrow(run, HIT)

    found = None
    for seeds in seed_shards(benchmark, shard_words):
        found = search(seeds) if found is None else materialize(found, "hits").unionByName(search(seeds))
    return spark.createDataFrame([], HIT) if found is None else found


def clean(docs: DataFrame, benchmark: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The documents without those that hold a copy of an item, all columns kept."""
    spark = begin(docs.sparkSession)

    def drop(docs: DataFrame, seeds: Seeds) -> DataFrame:
        shared = spark.sparkContext.broadcast(seeds)

        def flag(text: pa.Array) -> pa.Array:
            data, off = buffers(text)
            out = np.zeros(len(text), bool)
            for lo, hi in doc_groups(off):
                for hit in find(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], shared.value):
                    out[lo + hit[0]] = True
            return pa.array(out)

        return docs.filter(~F.arrow_udf(flag, "boolean")(F.col("text").cast("string")))

    passes = 0
    for seeds in seed_shards(benchmark, shard_words):
        docs = drop(materialize(docs, "clean-so-far") if passes else docs, seeds)
        passes += 1
    return docs


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
