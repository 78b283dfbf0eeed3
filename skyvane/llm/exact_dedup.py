"""Exact dedup with a cuckoo-filter index of live digests.

The index is a set of buckets. Each bucket keeps the live digests (the stored
keys, a Spark-written table) and a packed cuckoo filter over them; a digest's
bucket is fixed by its first bytes. A lookup asks the filter first; only a hit
is verified against the bucket's stored keys, so a miss costs two probes and a
false positive never merges different texts. An insertion that finds no free
slot resizes the filter from the stored keys. Deleting the last document of a
digest frees its slot.

``deduplicate`` runs a whole corpus through such buckets in one shuffle: tasks
first fold their own copies (a digest leaves a task once per batch, so a group that
holds a third of all rows is small on the wire), and a bucket task streams its
digests through the filter.

Defined cases: null text counts as empty; equal ``doc_id`` rows are told apart by a
row number, so one row of a group stays; null ``doc_id`` sorts after all numbers;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyvane.llm._tables import begin, numbered, read, small
from skyvane.session import materialize

SPACES = r"[\x20\x09-\x0D]+"
SLOTS = 4           # fingerprints of a cuckoo bucket
KICKS = 200         # displacements tried before a resize
NO_ID = (1 << 63) - 1


def normalised(text: Column | str) -> Column:
    """The text whose equality counts: white-space runs become one space, null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), SPACES, " ")


class CuckooFilter:
    """Partial-key cuckoo filter with 16-bit fingerprints and four slots a bucket.

    ``keys`` are the stored 16-byte digests of what is live; the filter is resized
    from them, because fingerprints alone can't be rehashed.
    """

    def __init__(self, capacity: int = 64) -> None:
        n = 1
        while n * SLOTS * 0.85 < capacity:
            n *= 2
        self.n = n
        self.table = np.zeros((n, SLOTS), np.uint16)
        self.resizes = 0
        self._turn = 0

    @staticmethod
    def fingerprint(key: bytes) -> int:
        return int.from_bytes(key[8:10], "little") or 1

    def _home(self, key: bytes) -> int:
        return int.from_bytes(key[:8], "little") & (self.n - 1)

    def _other(self, i: int, fp: int) -> int:
        return (i ^ (fp * 0x5BD1E995)) & (self.n - 1)

    def __contains__(self, key: bytes) -> bool:
        fp, i = self.fingerprint(key), self._home(key)
        return fp in self.table[i].tolist() or fp in self.table[self._other(i, fp)].tolist()

    def _put(self, fp: int, i: int) -> bool:
        for b in (i, self._other(i, fp)):
            row = self.table[b]
            free = np.flatnonzero(row == 0)
            if len(free):
                row[free[0]] = fp
                return True
        trail = []
        for _ in range(KICKS):
            self._turn = (self._turn + 1) % SLOTS
            old = int(self.table[i, self._turn])
            trail.append((i, self._turn, old))
            self.table[i, self._turn] = fp
            fp, i = old, self._other(i, old)
            free = np.flatnonzero(self.table[i] == 0)
            if len(free):
                self.table[i, free[0]] = fp
                return True
        for b, slot, old in reversed(trail):        # undo, so that nothing is lost
            self.table[b, slot] = old
        return False

    def insert(self, key: bytes, stored) -> None:
        """Add ``key``; on overflow double the table and refill it from ``stored`` (the live keys, ``key`` left out)."""
        if self._put(self.fingerprint(key), self._home(key)):
            return
        stored = list(stored)
        while True:
            self.n *= 2
            self.table = np.zeros((self.n, SLOTS), np.uint16)
            self.resizes += 1
            if all(self._put(self.fingerprint(k), self._home(k)) for k in [*stored, key]):
                return

    def delete(self, key: bytes) -> bool:
        fp, i = self.fingerprint(key), self._home(key)
        for b in (i, self._other(i, fp)):
            at = np.flatnonzero(self.table[b] == fp)
            if len(at):
                self.table[b, at[0]] = 0
                return True
        return False

    def pack(self) -> bytes:
        return self.n.to_bytes(8, "little") + self.table.tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> "CuckooFilter":
        f = cls()
        f.n = int.from_bytes(data[:8], "little")
        f.table = np.frombuffer(data[8:], np.uint16).reshape(f.n, SLOTS).copy()
        return f


class Bucket:
    """Live digests of one bucket behind their filter: digest -> [keeper id, its row, copies]."""

    def __init__(self, rows=(), packed: bytes | None = None) -> None:
        self.keys: dict[bytes, list[int]] = {bytes(k): [int(i), int(r), int(n)] for k, i, r, n in rows}
        self.filter = CuckooFilter.unpack(packed) if packed else CuckooFilter(2 * len(self.keys) + 64)
        if not packed:
            done: list[bytes] = []
            for k in self.keys:
                self.filter.insert(k, done)
                done.append(k)

    def add(self, key: bytes, doc: int, row: int, copies: int = 1) -> bool:
        """True if the digest was not live before."""
        if key in self.filter:
            held = self.keys.get(key)               # verification: a hit may be a false positive
            if held is not None:
                if (doc, row) < (held[0], held[1]):
                    held[0], held[1] = doc, row
                held[2] += copies
                return False
        self.filter.insert(key, self.keys)
        self.keys[key] = [doc, row, copies]
        return True

    def remove(self, key: bytes, copies: int = 1) -> bool:
        """Take copies away; True if the digest is no longer live."""
        held = self.keys.get(key) if key in self.filter else None
        if held is None:
            return False
        held[2] -= copies
        if held[2] > 0:
            return False
        self.filter.delete(key)
        del self.keys[key]
        return True


def digests(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text_sha256) of every row, hashed in the JVM."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.sha2(F.encode(normalised(text), "UTF-8"), 256).alias("text_sha256"))


def _fold(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies within a task's batch become one record each: digest, smallest (id, row), count."""
    for b in it:
        if not b.num_rows:
            continue
        sha = b.column("text_sha256").to_pylist()
        doc = b.column("doc_id").fill_null(NO_ID).to_pylist()
        seen: dict[str, list[int]] = {}
        for k, d, r in zip(sha, doc, b.column("rid").to_pylist()):
            held = seen.get(k)
            if held is None:
                seen[k] = [d, r, 1]
            else:
                if (d, r) < (held[0], held[1]):
                    held[0], held[1] = d, r
                held[2] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([bytes.fromhex(k) for k in seen], pa.binary()),
             *[pa.array([v[j] for v in seen.values()], pa.int64()) for j in range(3)]],
            names=["digest", "keep", "keep_row", "copies"])


def _run_buckets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive grouped by bucket; one bucket is in memory at a time."""
    def out(bucket: int, x: Bucket) -> pa.RecordBatch:
        rows = list(x.keys.items())
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket] * len(rows), pa.int32()), pa.array([k for k, _ in rows], pa.binary()),
             *[pa.array([v[j] for _, v in rows], pa.int64()) for j in range(3)]],
            names=["bucket", "digest", "keep", "keep_row", "copies"])

    now, state = None, Bucket()
    for b in it:
        for bucket, key, doc, row, n in zip(*[b.column(c).to_pylist() for c in (
                "bucket", "digest", "keep", "keep_row", "copies")]):
            if bucket != now:
                if state.keys:
                    yield out(now, state)
                now, state = bucket, Bucket()
            state.add(key, doc, row, n)
    if state.keys:
        yield out(now, state)


BUCKET_DIGESTS = 20_000


def _bucket_of(n_buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(n_buckets)).cast("int")


def bucketed(folded: DataFrame, n_buckets: int) -> DataFrame:
    """Stream folded digests through the cuckoo buckets: one row per live digest."""
    return (folded.withColumn("bucket", _bucket_of(n_buckets))
            .repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(_run_buckets, "bucket int, digest binary, keep long, keep_row long, copies long"))


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                bucket_digests: int = BUCKET_DIGESTS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = begin(docs.sparkSession)
    rows = numbered(digests(docs, text, doc_id), "exact-digests")
    n_buckets = max(8, -(-rows.count() // bucket_digests))
    folded = rows.mapInArrow(_fold, "digest binary, keep long, keep_row long, copies long")
    groups = bucketed(folded, n_buckets).select(
        F.lower(F.hex("digest")).alias("text_sha256"), "keep", "keep_row", "copies")
    return rows.join(groups, "text_sha256", "left").select(
        "doc_id", F.when(F.col("keep") != NO_ID, F.col("keep")).alias("keep_id"),
        F.col("copies").alias("group_size"), (F.col("rid") == F.col("keep_row")).alias("kept"), "text_sha256")


class DigestIndex:
    """The index over time: insert or delete batches of documents.

    State is three Spark-written tables, replaced by each change: ``members`` (digest, doc_id, copies), the live documents
    themselves; ``live`` (digest, keep, copies), one row per live digest with its smallest live id; and the packed
    cuckoo filter of each bucket. A digest enters its bucket's filter when its first document comes and leaves it
    with its last one, so only buckets with such a digest are opened. The bucket count follows the
    live digests: when there are twice as many as the buckets are meant for, they are
    dealt anew from the stored digests. Deleting a document that is not in the index changes nothing.
    """

    FILTERS = "bucket int, packed binary"
    MEMBERS = "digest binary, doc_id long, copies long"
    LIVE = "digest binary, keep long, copies long"

    def __init__(self, spark: SparkSession, n_buckets: int = 8, bucket_digests: int = BUCKET_DIGESTS) -> None:
        self.spark, self.n_buckets, self.bucket_digests = begin(spark), n_buckets, bucket_digests
        self.members = spark.createDataFrame([], self.MEMBERS)
        self.live = spark.createDataFrame([], self.LIVE)
        self.filters = spark.createDataFrame([], self.FILTERS)

    def _change(self, docs: DataFrame, sign: int) -> "DigestIndex":
        moved = digests(docs).groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("n")).select(
            F.unhex("text_sha256").alias("digest"), "doc_id", (F.col("n") * sign).alias("copies"))
        members = materialize(self.members.unionByName(moved).groupBy("digest", "doc_id").agg(
            F.sum("copies").alias("copies")).filter("copies > 0"), "index-members")
        live = materialize(members.groupBy("digest").agg(
            F.min("doc_id").alias("keep"), F.sum("copies").alias("copies")), "index-live")
        n = live.count()
        if n > 2 * self.n_buckets * self.bucket_digests:
            while self.n_buckets * self.bucket_digests < n:
                self.n_buckets *= 2
            changes, filters = live.select("digest", F.lit(1).alias("part")), self.spark.createDataFrame([], self.FILTERS)
        else:
            born = live.join(self.live, "digest", "left_anti").select("digest", F.lit(1).alias("part"))
            gone = self.live.join(live, "digest", "left_anti").select("digest", F.lit(2).alias("part"))
            changes, filters = born.unionByName(gone), self.filters
        changes = materialize(changes.withColumn("bucket", _bucket_of(self.n_buckets)), "index-changes")
        touched = small(materialize(changes.select("bucket").distinct(), "index-touched"))
        stored = self.live.select("digest", F.lit(0).alias("part")).withColumn("bucket", _bucket_of(self.n_buckets)).join(
            touched, "bucket", "left_semi")
        if filters is not self.filters:
            stored = stored.limit(0)                            # dealt anew: nothing is stored yet
        rows = stored.unionByName(changes).unionByName(
            filters.join(touched, "bucket", "left_semi").withColumn("part", F.lit(3)), allowMissingColumns=True)

        def run(key, group):
            import pandas as pd
            of = {p: group[group["part"] == p] for p in range(4)}
            packed = of[3]["packed"].iloc[0] if len(of[3]) else None
            keys = {bytes(k): None for k in of[0]["digest"]}
            f = CuckooFilter.unpack(packed) if packed is not None else CuckooFilter(2 * len(of[1]) + 64)
            for k in map(bytes, of[2]["digest"]):
                f.delete(k)
                keys.pop(k, None)
            for k in map(bytes, of[1]["digest"]):
                f.insert(k, keys)
                keys[k] = None
            return pd.DataFrame([(key[0], f.pack())], columns=["bucket", "packed"])

        changed = rows.groupBy("bucket").applyInPandas(run, self.FILTERS)
        self.filters = materialize(filters.join(touched, "bucket", "left_anti").unionByName(changed), "index-filters")
        self.members, self.live = members, live
        return self

    def insert(self, docs: DataFrame) -> "DigestIndex":
        return self._change(docs, 1)

    def delete(self, docs: DataFrame) -> "DigestIndex":
        return self._change(docs, -1)

    def duplicates(self, docs: DataFrame) -> DataFrame:
        """Documents whose text is live: doc_id and the smallest live id of that text. The filters let only
        possible hits through to the comparison with the stored digests."""
        def hits(key, group):
            import pandas as pd
            packed = group[group["part"] == 1]["packed"]
            asked = group[group["part"] == 0]
            if not len(packed) or not len(asked):
                return pd.DataFrame({"digest": []})
            f = CuckooFilter.unpack(packed.iloc[0])
            return pd.DataFrame({"digest": [k for k in asked["digest"] if bytes(k) in f]})

        # equal questions of a batch are asked once, so a bucket is asked by distinct texts and ids only
        asked = digests(docs).select(F.unhex("text_sha256").alias("digest"), "doc_id").groupBy("digest", "doc_id").agg(
            F.count(F.lit(1)).alias("times"))
        asked = materialize(asked, "index-asked")
        one = asked.select("digest").distinct().withColumn("bucket", _bucket_of(self.n_buckets)).withColumn("part", F.lit(0))
        both = one.unionByName(self.filters.withColumn("part", F.lit(1)), allowMissingColumns=True)
        found = both.groupBy("bucket").applyInPandas(hits, "digest binary")
        known = found.join(self.live, "digest").select("digest", F.col("keep").alias("keep_id"))
        each = asked.join(known, "digest").select("doc_id", "keep_id", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("_i"))
        return each.drop("_i")


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(read(spark, sf_dir, "documents"))


OP4_SQL = r"""
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
"""
