"""MinHash near-dedup with b-bit signatures.

A document is its set of five-word shingles (hashes). Equal sets are one class. Each
class gets ``HASHES`` minima: ``BANDS`` bands of ``ROWS`` minima give bucket keys, and the low
``BITS`` bits of all minima are packed into a signature. Candidates meet in a
bucket; XOR and bit counts of two signatures estimate their similarity, corrected for
chance agreement of the kept bits; what passes is confirmed on the full sets.

No bucket is expanded into all its pairs:

1. Every class is compared with the smallest class of each of its buckets; the ``STARS`` best
   are confirmed, and connected components are built from the confirmed links.
2. Only buckets that still hold several components go on. Inside them, classes outside
   the bucket's largest component are compared with all classes of other components by
   signature; a large bucket is dealt out in blocks of ``BLOCK`` classes. What passes is not sent on
   pair by pair: classes are placed by their largest bucket, in blocks of ``MEMBERS``; a class asks for
   each block in which it has a candidate, and is counted there against all full sets at once. One link
   to each other component it reaches goes out.

So each pair of one bucket is either compared or already in one component: components are
those of all links between candidates. A pair at similarity 0.75 shares no bucket with
probability (1 - 0.75^3)^32 = 2e-8; the estimate's cut-off is the one that loses such a pair
with at most the same probability (:func:`cut_off`).

Defined cases: null and word-free texts have the empty set and link with nothing; a text of fewer
than five words is one shingle; equal ids stay separate rows (``kept`` compares the id with the
component's smallest); a null id is larger than any other; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyvane.llm._tables import begin, numbered, read, small
from skyvane.llm._text import U64, Words, buffers, doc_groups, mix, ngram_hash
from skyvane.session import materialize

SHINGLE = 5
HASHES, BANDS, ROWS, BITS = 128, 32, 3, 4
LINK_NUM, LINK_DEN = 75, 100


def cut_off(similarity: float, loss: float) -> float:
    """The estimated similarity that a pair of this similarity misses with probability ``loss`` at most: its equal
    minima are binomial, by similarity and by chance agreement of the kept bits."""
    chance = 2.0 ** -BITS
    p = similarity + (1 - similarity) * chance
    below, equal = 0.0, 0
    while below + (term := math.comb(HASHES, equal) * p ** equal * (1 - p) ** (HASHES - equal)) <= loss:
        below, equal = below + term, equal + 1
    return (equal / HASHES - chance) / (1 - chance)


#: Estimated similarity that sends a pair to confirmation.
PASS = cut_off(LINK_NUM / LINK_DEN, (1 - (LINK_NUM / LINK_DEN) ** ROWS) ** BANDS) - 1e-9
STARS = 3
BLOCK = 2048
MEMBERS = 256
NO_ID = (1 << 63) - 1

_FACTORS = np.random.default_rng(5).integers(1, 1 << 63, HASHES, dtype=np.uint64) * U64(2) + U64(1)
_SECOND = U64(0xD6E8FEB86659FD93)
_BAND_SALT = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def shingle_sets(data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document."""
    w = Words(data, off, lower=True)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        h = w.hash[a:b]
        out.append(np.unique(ngram_hash(h, min(SHINGLE, len(h)))) if len(h) else h)
    return out


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that do not depend on order: equal sets have equal keys."""
    return (int(mix(s).sum(dtype=U64).view(np.int64)), int(mix(s * _SECOND + U64(1)).sum(dtype=U64).view(np.int64)))


def minima(s: np.ndarray) -> np.ndarray:
    best = np.full(HASHES, ~U64(0))
    for k in range(0, len(s), 512):
        np.minimum(best, (s[k:k + 512, None] * _FACTORS[None, :]).min(0), out=best)
    return best


def band_keys(m: np.ndarray) -> np.ndarray:
    r = m[:BANDS * ROWS].reshape(BANDS, ROWS)
    acc = _BAND_SALT.copy()
    for j in range(ROWS):
        acc = mix(acc * U64(0x9E3779B97F4A7C15) + r[:, j])
    return acc


def pack_bits(m: np.ndarray) -> bytes:
    """The low four bits of each minimum, two to a byte."""
    low = (mix(m) & U64(15)).astype(np.uint8)
    return (low[0::2] | (low[1::2] << np.uint8(4))).tobytes()


def estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Collision-corrected similarity of packed signatures (rows of 64-bit words)."""
    d = x ^ y
    d |= d >> U64(1)
    d |= d >> U64(2)
    differ = np.bitwise_count(d & U64(0x1111111111111111)).sum(-1, dtype=np.int64)
    chance = 2.0 ** -BITS
    return ((HASHES - differ) / HASHES - chance) / (1 - chance)


def _sig_rows(col: pa.Array) -> np.ndarray:
    data, _ = buffers(col)
    return np.frombuffer(data.tobytes(), U64).reshape(-1, HASHES * BITS // 64)


def text_print(text: str) -> Column:
    """A hash of the text by which, with its id, a row is found again without being shingled."""
    return F.xxhash64(F.col(text).cast("string")).alias("print")


def signatures(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, print, n, h1, h2, bands, sig): one row per document; ``print`` is a hash of its text."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            data, off = buffers(b.column(2))
            n, h1, h2, bands, sigs = [], [], [], [], []
            for lo, hi in doc_groups(off):
                for s in shingle_sets(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]):
                    n.append(len(s))
                    x, y = set_key(s)
                    h1.append(x)
                    h2.append(y)
                    m = minima(s) if len(s) else None
                    bands.append(band_keys(m).tobytes() if len(s) else b"")
                    sigs.append(pack_bits(m) if len(s) else b"")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 pa.array(bands, pa.binary()), pa.array(sigs, pa.binary())],
                names=["doc_id", "print", "n", "h1", "h2", "bands", "sig"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_print(text), F.col(text).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, print long, n long, h1 long, h2 long, bands binary, sig binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over the edges (a, b). Labels spread along edges and jump
    to their label's label; every round is a durable table, and the driver sees one count."""
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                       "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("comp")), "labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), F.col("comp").alias("heard")), "b").groupBy(
            F.col("a").alias("node")).agg(F.min("heard").alias("heard"))
        low = labels.join(heard, "node").select("node", "comp", F.least("comp", "heard").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("comp").alias("up"))
        new = materialize(low.join(up, "low").select(
            "node", F.least("low", "up").alias("comp"), (F.least("low", "up") < F.col("comp")).alias("changed")), "labels")
        labels = new.select("node", "comp")
        if not new.filter("changed").limit(1).count():
            return labels


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    pairs = materialize(pairs.select("a", "b"), "pairs")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")).join(small(pairs), "a")
    ends = materialize(pairs.select("b").distinct(), "pair-ends")
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")).join(small(ends), "b")

    def linked(x: pa.Array, y: pa.Array) -> pa.Array:
        out = []
        for p, q in zip(x, y):
            p, q = (np.frombuffer(v.as_buffer(), "<u8") for v in (p, q))
            both = len(np.intersect1d(p, q, assume_unique=True))
            out.append(LINK_DEN * both >= LINK_NUM * (len(p) + len(q) - both))
        return pa.array(out, pa.bool_())

    return materialize(left.join(right, "b").filter(F.arrow_udf(linked, "boolean")("sa", "sb")).select("a", "b"), "confirmed")


def _full_sets(docs: DataFrame, need: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(node, shingles): the full set (sorted hashes) of each needed class, from its keeper's whole text. Rows of the
    same id, null ids among them, are told apart by the text's hash, so a row meets at most its own class
    (and, should two hashes be equal, is told apart by the set's key)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            data, off = buffers(b.column(0))
            h1, h2, node = (b.column(i).to_pylist() for i in (1, 2, 3))
            out = []
            for lo, hi in doc_groups(off):
                for i, s in enumerate(shingle_sets(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]), lo):
                    if set_key(s) == (h1[i], h2[i]):
                        out.append((node[i], s.astype("<u8").tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.int64()), pa.array([s for _, s in out], pa.binary())],
                                                 names=["node", "shingles"])

    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("first_id"), text_print(text), F.col(text).cast("string").alias("text"))
    found = rows.join(small(need), ["first_id", "print"]).select("text", "h1", "h2", "node").mapInArrow(run, "node long, shingles binary")
    return materialize(found, "shingle-sets").dropDuplicates(["node"])


_ASK = "node long, asks array<struct<place:long,part:int>>"


def _cross(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, block): compare each group's probes with its targets of other components.
    Gives, per probe, the placed blocks that it must be counted against."""
    names = ["key", "block", "node", "comp", "n", "probe", "target", "place", "part"]
    kind = pa.list_(pa.struct([("place", pa.int64()), ("part", pa.int32())]))

    def groups():
        """Whole groups, several at a time: (columns, signatures); the last, open one is carried over."""
        held: list = []
        for b in it:
            if not b.num_rows:
                continue
            part = [b.column(c).to_numpy(zero_copy_only=False) for c in names] + [_sig_rows(b.column("sig"))]
            held = [np.concatenate([x, y]) for x, y in zip(held, part)] if held else part
            last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
            if len(last):
                cut = int(last[-1]) + 1
                yield [x[:cut] for x in held]
                held = [x[cut:] for x in held]
        if held:
            yield held

    for key, block, node, comp, n, probe, target, place, part, sig in groups():
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (block[1:] != block[:-1])
        cut = np.append(np.flatnonzero(new), len(key))
        probes, asks = [], []
        for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
            t = lo + np.flatnonzero(target[lo:hi])
            for p in (lo + np.flatnonzero(probe[lo:hi])).tolist():
                # two probes meet twice: the smaller one asks
                ok = (comp[t] != comp[p]) & (100 * np.minimum(n[t], n[p]) >= 75 * np.maximum(n[t], n[p])) & (
                    ~probe[t] | (node[t] > node[p]))
                hit = t[ok]
                hit = hit[estimate(sig[hit], sig[p]) >= PASS]
                if len(hit):
                    probes.append(node[p])
                    asks.append([{"place": x, "part": y} for x, y in sorted(set(zip(place[hit].tolist(), part[hit].tolist())))])
        if asks:
            yield pa.RecordBatch.from_arrays([pa.array(probes, pa.int64()), pa.array(asks, kind)], names=["node", "asks"])


class _Block:
    """The full sets of a placed block as one inverted list, for counting a set against all of them."""

    def __init__(self, nodes: list[int], comps: list[int], sets: list[np.ndarray]) -> None:
        self.nodes, self.comps = np.array(nodes), np.array(comps)
        self.size = np.array([len(x) for x in sets])
        owner = np.repeat(np.arange(len(sets)), self.size)
        shingle = np.concatenate(sets)
        o = np.argsort(shingle, kind="stable")
        self.shingle, self.owner = shingle[o], owner[o]

    def links(self, s: np.ndarray, comp: int) -> list[int]:
        """Of each other component, the smallest member whose set reaches the threshold with ``s``."""
        lo, hi = np.searchsorted(self.shingle, s, "left"), np.searchsorted(self.shingle, s, "right")
        n = hi - lo
        at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(self.owner[at], minlength=len(self.nodes))
        hit = (LINK_DEN * both >= LINK_NUM * (self.size + len(s) - both)) & (self.comps != comp)
        best: dict[int, int] = {}
        for c, x in zip(self.comps[hit].tolist(), self.nodes[hit].tolist()):
            best[c] = min(x, best.get(c, x))
        return list(best.values())


def _count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (place, part, asking): a block's members come first, then the sets counted against them."""
    now, nodes, comps, sets, block = None, [], [], [], None
    for b in it:
        out = []
        cols = [b.column(c).to_pylist() for c in ("place", "part", "asking", "node", "comp")]
        for place, part, asking, node, comp, raw in zip(*cols, b.column("shingles")):
            if (place, part) != now:
                now, nodes, comps, sets, block = (place, part), [], [], [], None
            s = np.frombuffer(raw.as_buffer(), "<u8")
            if not asking:
                nodes.append(node)
                comps.append(comp)
                sets.append(s)
                continue
            if nodes and block is None:
                block = _Block(nodes, comps, sets)
            out += [(max(node, x), min(node, x)) for x in (block.links(s, comp) if block else [])]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())],
                                             names=["a", "b"])


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    rows, named = _classified(docs, text, doc_id)
    lowest = named.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    final = named.join(lowest, "comp").select("h1", "h2", "n", "component_id")
    out = rows.select("doc_id", "h1", "h2", "n").join(final, ["h1", "h2", "n"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("component_id") != NO_ID, F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def representatives(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(first_id, print) of one document of each component: the smallest id (:data:`NO_ID` for a null one), then the
    smallest text hash. Texts without words belong to no component."""
    _, named = _classified(docs, text, doc_id)
    return named.groupBy("comp").agg(F.min(F.struct("first_id", "print")).alias("r")).select("r.*")


def _classified(docs: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """(a signature row per document, every class of equal sets with its component)."""
    begin(docs.sparkSession)
    rows = numbered(signatures(docs, text, doc_id), "near-signatures")
    # Equal sets: one class, carried by its row of smallest id.
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("first_id"), F.col("rid").alias("node"), "print", "bands", "sig"))
    classes = materialize(rows.filter("n > 0").groupBy("h1", "h2", "n").agg(first.alias("f")).select("h1", "h2", "n", "f.*"),
                          "near-classes")
    keys = F.arrow_udf(lambda col: pa.array([np.frombuffer(x, "<i8") for x in col.to_pylist()], pa.list_(pa.int64())),
                       "array<long>")
    member = classes.select("node", F.explode(keys("bands")).alias("key"))
    shared = member.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("centre")).filter("size > 1")
    buckets = materialize(member.join(shared, "key"), "near-buckets")

    sig = classes.select("node", "n", "sig")
    near = F.arrow_udf(lambda x, y: pa.array(estimate(_sig_rows(x), _sig_rows(y))), "double")
    star = buckets.filter("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    star = (star.join(sig.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa")), "a")
            .join(sig.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb")), "b")
            .filter(100 * F.least("na", "nb") >= 75 * F.greatest("na", "nb"))
            .select("a", "b", near("sa", "sb").alias("est")).filter(F.col("est") >= PASS))
    best = star.groupBy("a").agg(F.slice(F.sort_array(F.collect_list(F.struct("est", "b")), False), 1, STARS).alias("best"))
    pairs = best.select("a", F.explode("best").alias("p")).select("a", F.col("p.b").alias("b"))

    need = materialize(buckets.select("node").distinct().join(classes.select("node", "first_id", "print", "h1", "h2"), "node"), "needed")
    sets = _full_sets(docs, need, text, doc_id)
    links = _confirm(pairs, sets)
    comps = components(links)

    # What is left: buckets that hold several components.
    home = buckets.groupBy("node").agg(F.max(F.struct("size", "key")).alias("m")).select("node", F.col("m.key").alias("place"))
    members = materialize(home.join(comps, "node", "left").select("node", "place", F.coalesce("comp", "node").alias("comp")),
                          "near-members")
    parts = members.groupBy("place").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("parts"))
    placed = materialize(members.join(parts, "place").select(
        "node", "comp", "place", F.pmod(F.xxhash64("node", F.lit(1)), "parts").cast("int").alias("part")), "near-placed")
    known = materialize(buckets.select("key", "node", "size").join(placed, "node"), "near-known")
    per = known.groupBy("key", "comp").agg(F.count("*").alias("c"))
    mixed = per.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("m"), F.count("*").alias("kinds")).filter("kinds > 1")
    left = known.join(mixed.select("key", F.col("m.comp").alias("main")), "key").join(sig, "node").select(
        "key", "node", "comp", "place", "part", "n", "sig", (F.col("comp") != F.col("main")).alias("probe"),
        F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = left.withColumn("own", own).withColumn(
        "block", F.explode(F.when(F.col("probe"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own")))
    ).withColumn("target", F.col("block") == F.col("own"))
    asked = (dealt.select("key", "block", "node", "comp", "n", "probe", "target", "place", "part", "sig")
             .repartition("key", "block").sortWithinPartitions("key", "block").mapInArrow(_cross, _ASK)
             .groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("asks"))).alias("asks"))
             .select("node", F.inline("asks")))
    asked = materialize(asked.join(placed.select("node", "comp"), "node"), "near-asked")
    wanted = materialize(asked.select("place", "part").distinct(), "near-wanted")
    held = sets.join(small(materialize(placed.join(small(wanted), ["place", "part"]), "near-held")), "node").select(
        "place", "part", F.lit(False).alias("asking"), "node", "comp", "shingles")
    askers = sets.join(small(asked), "node").select("place", "part", F.lit(True).alias("asking"), "node", "comp", "shingles")
    links2 = materialize(held.unionByName(askers).repartition("place", "part").sortWithinPartitions("place", "part", "asking")
                         .mapInArrow(_count, "a long, b long"), "near-links")
    comps = components(links.unionByName(links2))

    return rows, classes.select("node", "h1", "h2", "n", "first_id", "print").join(comps, "node", "left").withColumn(
        "comp", F.coalesce("comp", "node"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))
