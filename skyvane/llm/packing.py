"""Hierarchical multi-length packing of documents into token sequences.

Whole windows of the longest tier are cut from long documents first. What is
left of a document goes to the shortest context tier that holds it. Tiers are
packed from the longest down, best fit; the gap that a sequence leaves is filled
with pieces of shorter tiers, whole ones first, then a cut one. A remainder that
nothing fills is cut into power-of-two sequences, so no sequence needs padding. Sequences of a
tier are dealt to step groups of equal token counts.

Each task packs its own documents in buffers of ``BUFFER`` ids, so memory is
bounded and nothing is shuffled; the pieces are one durable table (recomputation
can't mix two packings) and per-task totals number the sequences globally.

Defined cases: null text is the empty document (its end id alone); repeated or null
``doc_id`` values stay separate documents; a document longer than a buffer is cut like
any other; an empty table gives no sequences; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyvane.llm._tables import begin, read
from skyvane.llm._text import buffers
from skyvane.llm._tokens import default_path, token_groups
from skyvane.session import scratch_path

TIERS = (512, 1024, 2048, 4096)
BUFFER = 1 << 20
STEP_TOKENS = 1 << 16
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, tier int, offset long, "
          "task int, seq long, step long, ids binary")


class Packer:
    """Packs pieces (document number, start, length) of one task; hands out sequences
    as (tier, [pieces]) with nothing to pad."""

    def __init__(self, tiers=TIERS) -> None:
        self.tiers = sorted(tiers)
        self.top = self.tiers[-1]
        self.rest: list[list[tuple[int, int, int]]] = [[] for _ in self.tiers]   # (length, document, start), sorted

    def _route(self, length: int) -> int:
        return bisect_right(self.tiers, length - 1)

    def _add(self, doc: int, start: int, length: int) -> None:
        insort(self.rest[self._route(length)], (length, doc, start))

    def add(self, doc: int, n: int) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        at = 0
        while n - at >= self.top:
            yield self.top, [(doc, at, self.top)]
            at += self.top
        if n > at:
            self._add(doc, at, n - at)

    def _fit(self, below: int, gap: int) -> tuple[int, int, int] | None:
        """The longest waiting piece of the tiers under ``below`` that fits the gap."""
        for t in range(min(below, len(self.tiers)) - 1, -1, -1):
            k = bisect_right(self.rest[t], (gap, 1 << 62, 0)) - 1
            if k >= 0:
                return self.rest[t].pop(k)
        return None

    def flush(self) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        for t in range(len(self.tiers) - 1, -1, -1):
            size = self.tiers[t]
            while self.rest[t]:
                length, doc, start = self.rest[t].pop()
                seq, gap = [(doc, start, length)], size - length
                while gap:
                    got = self._fit(t + 1 if t == 0 else t, gap)
                    if got is None:                    # cut the shortest waiting piece to the gap
                        k = next((k for k in range(t + (t == 0)) if self.rest[k]), None)
                        if k is None:
                            break
                        length, doc, start = self.rest[k].pop(0)
                        self._add(doc, start + gap, length - gap)
                        got = (gap, doc, start)
                    seq.append((got[1], got[2], got[0]))
                    gap -= got[0]
                if not gap:
                    yield size, seq
                else:                                  # nothing is left to fill it: power-of-two sequences
                    yield from self._binary(seq)

    @staticmethod
    def _binary(seq):
        left = sum(p[2] for p in seq)
        queue = list(seq)
        while left:
            size = 1 << (left.bit_length() - 1)
            part, need = [], size
            while need:
                doc, start, length = queue.pop(0)
                use = min(length, need)
                part.append((doc, start, use))
                if use < length:
                    queue.insert(0, (doc, start + use, length - use))
                need -= use
            left -= size
            yield size, part


def pack(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, tiers=TIERS,
         step_tokens: int = STEP_TOKENS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Write the packed pieces (with their ids) under ``path`` and read them with global numbers:
    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group, ids."""
    spark = begin(docs.sparkSession)
    tokenizer = tokenizer or default_path()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        packer, held, waiting = Packer(tiers), {}, 0
        seq = steps = 0
        open_steps: dict[int, tuple[int, int]] = {}       # tier -> (step, tokens still free in it)
        out: list[tuple] = []

        def emit(sequences) -> None:
            nonlocal seq, steps
            for tier, pieces in sequences:
                step, free = open_steps.get(tier, (0, 0))
                if free < tier:
                    step, free = steps, max(step_tokens, tier)
                    steps += 1
                open_steps[tier] = (step, free - tier)
                offset = 0
                for doc, start, length in pieces:
                    name, ids = held[doc]
                    raw = ids[start:start + length].astype("<u4").tobytes()
                    out.append((name, start, length, zlib.crc32(raw), len(ids), tier, offset, task, seq, step, raw))
                    offset += length
                seq += 1

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out))
            out.clear()
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              names=[c.split()[0] for c in PIECES.split(", ")])

        number = 0
        for b in it:
            names = b.column(0).to_pylist()
            for lo, ids, first in token_groups(buffers(b.column(1)), tokenizer):
                for i in range(len(first) - 1):
                    x = np.append(ids[first[i]:first[i + 1]], np.uint32(end_id))
                    held[number] = (names[lo + i], x)
                    emit(packer.add(number, len(x)))
                    number += 1
                    waiting += len(x)
                if waiting >= BUFFER:
                    emit(packer.flush())
                    held.clear()
                    waiting = 0
                if len(out) > 2000:
                    yield batch()
        emit(packer.flush())
        if out:
            yield batch()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows.mapInArrow(run, PIECES).write.option("compression", "zstd").parquet(path)
    table = spark.read.parquet(path)
    totals = table.groupBy("task").agg((F.max("seq") + 1).alias("n"), (F.max("step") + 1).alias("m"))
    w = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)     # one row a task
    base = totals.select("task", *[F.coalesce(F.sum(c).over(w), F.lit(0)).cast("long").alias(b)
                                   for c, b in (("n", "seq0"), ("m", "step0"))])
    return table.join(F.broadcast(base), "task").select(                      # one row a task of the scan
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("seq") + F.col("seq0")).alias("sequence_id"),
        "offset", "tier", (F.col("step") + F.col("step0")).alias("step_group"), "ids")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    begin(spark)
    return pack(read(spark, sf_dir, "documents"), scratch_path(spark, "packed")).drop("ids")
