"""Token ids as directly addressable codes.

Each id is cut into chunks, lowest bits first. Level 0 holds the first chunk of
every id, level l+1 the next chunk of those ids whose continuation bit at level l
is set; a rank directory over each bitmap tells where an id goes on. So any
token is read with one probe a level, without decoding its neighbours. Chunk
widths (of 4, 8, 12 and 16 bits) are those of least size for the segment's own ids.

A file is one row of a Spark-written table: the bytes of a segment of whole
documents in ascending ``doc_id`` order (commits are atomic, a lost executor's
attempt leaves nothing). Layout, little endian::

    b"DAC1"  u32 levels  u64 ids  u64 documents
    per level: u32 width  u32 reserved  u64 entries
    documents: i64 doc_id, u8 is-null, i64 ids before the document (documents + 1 of them)
    per level: chunks packed by width | bitmap | u32 ranks, one per 512 entries

(sections are padded to 8 bytes; the last level has no bitmap and no ranks).

Defined cases: null text is the empty document, which still has its end id; null
``doc_id`` sorts last; repeated ids stay separate rows; an empty table gives an
empty file table; extra columns are ignored; a document of any length is one segment row at least.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyvane.llm._tables import begin, read
from skyvane.llm._text import buffers
from skyvane.llm._tokens import default_path, token_groups
from skyvane.session import materialize, scratch_path

WIDTHS = (4, 8, 12, 16)
RANK = 512
SEGMENT_IDS = 1 << 18


def _pad(b: bytes) -> bytes:
    return b + bytes(-len(b) % 8)


def _pack(v: np.ndarray, width: int) -> bytes:
    if width == 16:
        return v.astype("<u2").tobytes()
    if width == 8:
        return v.astype(np.uint8).tobytes()
    if width == 4:
        v = np.append(v, 0).astype(np.uint8) if len(v) % 2 else v.astype(np.uint8)
        return (v[0::2] | (v[1::2] << 4)).tobytes()
    v = np.append(v, 0).astype(np.uint32) if len(v) % 2 else v.astype(np.uint32)
    w = v[0::2] | (v[1::2] << np.uint32(12))            # two entries in three bytes
    return np.stack([w & 255, (w >> 8) & 255, w >> 16], 1).astype(np.uint8).tobytes()


def _packed_bytes(n: int, width: int) -> int:
    return {16: 2 * n, 8: n, 4: (n + 1) // 2, 12: 3 * ((n + 1) // 2)}[width]


def _unpack(b: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The entries at places ``at`` of a packed level."""
    if width == 16:
        return b[2 * at].astype(np.uint32) | (b[2 * at + 1].astype(np.uint32) << np.uint32(8))
    if width == 8:
        return b[at].astype(np.uint32)
    if width == 4:
        return (b[at >> 1] >> ((at & 1) * 4).astype(np.uint8)).astype(np.uint32) & np.uint32(15)
    p = 3 * (at >> 1)
    w = b[p].astype(np.uint32) | (b[p + 1].astype(np.uint32) << np.uint32(8)) | (b[p + 2].astype(np.uint32) << np.uint32(16))
    return (w >> ((at & 1) * 12).astype(np.uint32)) & np.uint32(4095)


def best_widths(ids: np.ndarray) -> list[int]:
    """Chunk widths of least total size: dynamic program over the histogram of bit lengths."""
    bits = np.zeros(len(ids), np.int64)
    x = ids.astype(np.uint64)
    for k in (16, 8, 4, 2, 1):
        big = x >= (np.uint64(1) << np.uint64(k))
        bits[big] += k
        x = np.where(big, x >> np.uint64(k), x)
    bits += 1
    longer = [int((bits > b).sum()) for b in range(33)]   # ids that need more than b bits
    top = max(4, int(bits.max(initial=1)))
    best: dict[int, tuple[float, list[int]]] = {}
    for done in range(top + 15, -1, -1):
        if done >= top:
            best[done] = (0.0, [])
            continue
        n = longer[done] if done else len(ids)
        best[done] = min(((n * w + (n * 33 / 32 if done + w < top else 0) + best[done + w][0], [w, *best[done + w][1]])
                          for w in WIDTHS), key=lambda c: c[0])
    return best[0][1]


def encode_segment(doc_ids: list, first: np.ndarray, ids: np.ndarray) -> bytes:
    widths = best_widths(ids)
    heads, body, v = [], [], ids.astype(np.uint64)
    for level, w in enumerate(widths):
        heads.append(struct.pack("<IIQ", w, 0, len(v)))
        body.append(_pad(_pack(v & np.uint64((1 << w) - 1), w)))
        if level == len(widths) - 1:
            break
        rest = v >> np.uint64(w)
        go = rest > 0
        ranks = np.concatenate([[0], np.cumsum(np.add.reduceat(go, np.arange(0, len(go), RANK)))])[:-1] if len(go) else []
        body.append(_pad(np.packbits(go, bitorder="little").tobytes()))
        body.append(_pad(np.asarray(ranks, "<u4").tobytes()))
        v = rest[go]
    return (b"DAC1" + struct.pack("<IQQ", len(widths), len(ids), len(doc_ids)) + b"".join(heads)
            + np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
            + _pad(bytes(int(d is None) for d in doc_ids)) + np.asarray(first, "<i8").tobytes() + b"".join(body))


class Segment:
    """Random access to one file's tokens and documents."""

    def __init__(self, data: bytes) -> None:
        if data[:4] != b"DAC1":
            raise ValueError("not a segment of directly addressable codes")
        levels, self.n, docs = struct.unpack_from("<IQQ", data, 4)
        at = 24
        self.levels = []
        heads = []
        for _ in range(levels):
            heads.append(struct.unpack_from("<IIQ", data, at))
            at += 16
        self.doc_ids = np.frombuffer(data, "<i8", docs, at)
        at += 8 * docs
        self.null = np.frombuffer(data, np.uint8, docs, at).astype(bool)
        at += docs + -docs % 8
        self.first = np.frombuffer(data, "<i8", docs + 1, at)
        at += 8 * (docs + 1)
        raw = np.frombuffer(data, np.uint8)

        def take(n: int) -> np.ndarray:
            nonlocal at
            out = raw[at:at + n]
            at += n + -n % 8
            return out

        for level, (w, _, n) in enumerate(heads):
            chunks = take(_packed_bytes(n, w))
            if level == levels - 1:
                self.levels.append((w, chunks, None, None))
            else:
                bitmap = take((n + 7) // 8)
                self.levels.append((w, chunks, bitmap, take(4 * (-(-n // RANK))).view("<u4")))

    def _rank(self, bitmap: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Set bits before each place: the directory plus the bits of one block."""
        block = at // RANK
        inside = np.arange(RANK // 8)
        byte = block[:, None] * (RANK // 8) + inside[None, :]
        full = (at % RANK)[:, None] - inside[None, :] * 8       # bits of each byte that lie before
        val = np.where(byte < len(bitmap), bitmap[np.minimum(byte, len(bitmap) - 1)], 0).astype(np.uint16)
        mask = (np.uint16(1) << np.clip(full, 0, 8).astype(np.uint16)) - np.uint16(1)
        return ranks[block].astype(np.int64) + np.bitwise_count(val & mask).sum(1, dtype=np.int64)

    def tokens(self, at) -> np.ndarray:
        """The ids at any places of the segment."""
        at = np.asarray(at, np.int64)
        out = np.zeros(len(at), np.uint32)
        live, shift = np.arange(len(at)), 0
        for w, chunks, bitmap, ranks in self.levels:
            out[live] |= _unpack(chunks, at, w) << np.uint32(shift)
            if bitmap is None:
                break
            go = ((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
            live, at, shift = live[go], at[go], shift + w
            if not len(live):
                break
            at = self._rank(bitmap, ranks, at)
        return out

    def all(self) -> np.ndarray:
        """Every id in order: the levels are streams, so no directory is needed."""
        def level(k: int) -> np.ndarray:
            w, chunks, bitmap, _ = self.levels[k]
            n = self.n if k == 0 else int(np.unpackbits(self.levels[k - 1][2], bitorder="little").sum())
            v = _unpack(chunks, np.arange(n), w)
            if bitmap is not None:
                go = np.unpackbits(bitmap, count=n, bitorder="little").astype(bool)
                v[go] |= level(k + 1) << np.uint32(w)
            return v
        return level(0) if self.n else np.zeros(0, np.uint32)


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 1, text: str = "text",
          doc_id: str = "doc_id", segment_ids: int = SEGMENT_IDS) -> None:
    """Encode whole texts in ascending doc_id order into segment files under ``path``."""
    begin(docs.sparkSession)
    tokenizer = tokenizer or default_path()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, number = TaskContext.get().partitionId(), 0
        held_docs: list = []
        held_ids: list[np.ndarray] = []
        total = 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held_ids)
            first = np.concatenate([[0], np.cumsum([len(x) for x in held_ids])])
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([len(held_docs)], pa.int64()), pa.array([encode_segment(held_docs, first, ids)], pa.binary())],
                names=["range", "segment", "n_ids", "n_docs", "data"])

        for b in it:
            names = b.column(0).to_pylist()
            for lo, ids, first in token_groups(buffers(b.column(1)), tokenizer):
                for i in range(len(first) - 1):
                    held_docs.append(names[lo + i])
                    held_ids.append(np.append(ids[first[i]:first[i + 1]], np.uint32(end_id)))
                    total += len(held_ids[-1])
                    if total >= segment_ids:
                        yield flush()
                        held_docs, held_ids, total, number = [], [], 0, number + 1
        if held_docs:
            yield flush()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order)
     .mapInArrow(run, "range int, segment int, n_ids long, n_docs long, data binary")
     .write.option("compression", "zstd").parquet(path))


def directory(spark: SparkSession, path: str) -> DataFrame:
    """Per segment file: range, segment, start (ids of all files before it), n_ids. Range
    totals (one row a task of the writer) give the bases; no window spans all segments."""
    seg = spark.read.parquet(path).select("range", "segment", "n_ids")
    base = seg.groupBy("range").agg(F.sum("n_ids").alias("n")).select("range", F.coalesce(
        F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = Window.partitionBy("range").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return seg.join(F.broadcast(base), "range").select(   # one row a writer task: bounded by the shuffle width
        "range", "segment", "n_ids",
        (F.col("base") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).cast("long").alias("start"))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids_crc32 of every document."""
    begin(spark)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for r, k, data in zip(*[b.column(i).to_pylist() for i in range(3)]):
                s = Segment(data)
                raw = s.all().astype("<u4").tobytes()
                first = s.first.tolist()
                n = len(first) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, r, np.int32)), pa.array(np.full(n, k, np.int32)),
                     pa.array(s.doc_ids.astype(np.int64), mask=s.null), pa.array(s.first[:-1].astype(np.int64)),
                     pa.array(np.diff(s.first).astype(np.int64)),
                     pa.array([zlib.crc32(memoryview(raw)[4 * x:4 * y]) for x, y in zip(first, first[1:])], pa.int64())],
                    names=["range", "segment", "doc_id", "inside", "n_tokens", "ids_crc32"])

    rows = spark.read.parquet(path).select("range", "segment", "data").mapInArrow(
        run, "range int, segment int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(directory(spark, path), ["range", "segment"]).select(
        "doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, path: str, places: DataFrame, place: str = "place", stretch: int = SEGMENT_IDS) -> DataFrame:
    """place, token: random access to global token places (null outside the corpus). A place finds its segment by
    the stretch of ``stretch`` places it lies in, an equi-join; only segments that hold a wanted place are
    read from there on, and each is opened once for all its places."""
    begin(spark)
    dirs = directory(spark, path).filter("n_ids > 0").withColumn("end", F.col("start") + F.col("n_ids"))
    dirs = dirs.select("range", "segment", "start", "end", F.explode(F.sequence(
        F.floor(F.col("start") / stretch), F.floor((F.col("end") - 1) / stretch))).alias("stretch"))
    wanted = places.select(F.col(place).cast("long").alias("place")).withColumn("stretch", F.floor(F.col("place") / stretch))
    at = wanted.join(dirs, (wanted["stretch"] == dirs["stretch"]) & (F.col("place") >= F.col("start")) & (F.col("place") < F.col("end")),
                     "left").select("place", "range", "segment", "start")
    at = materialize(at, "token-places")
    hit = at.filter("range is not null")
    files = spark.read.parquet(path).select("range", "segment", "data").join(
        hit.select("range", "segment").distinct(), ["range", "segment"], "left_semi")

    def run(key, left, right):
        import pandas as pd
        if not len(left):
            return pd.DataFrame({"place": [], "token": []})
        token = Segment(right["data"].iloc[0]).tokens((left["place"] - left["start"]).to_numpy()) if len(right) else None
        return pd.DataFrame({"place": left["place"], "token": token})

    found = hit.groupBy("range", "segment").cogroup(files.groupBy("range", "segment")).applyInPandas(run, "place long, token long")
    return found.unionByName(at.filter("range is null").select("place", F.lit(None).cast("long").alias("token")))


def op6_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    begin(spark)
    path = scratch_path(spark, "token-codes")
    write(read(spark, sf_dir, "documents"), path)
    return documents(spark, path)
