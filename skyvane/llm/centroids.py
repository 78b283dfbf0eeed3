"""K-means on integer vectors with the equal-average equal-variance nearest-centroid search.

Centroids are sorted by component sum. With s the component sums, v the
deviations (length of the vector less its mean) and d the dimension,

    |x - c|^2  >=  (s_x - s_c)^2 / d  +  (v_x - v_c)^2 .

A vector starts at the centroid of nearest sum and scans outwards, nearer side first. The sum term alone
ends its scan (every centroid further out is worse); both terms reject single
centroids. What is left gets its exact integer distance. The sum test is done in whole numbers, the
deviation test in floats with a margin above their rounding, and only a strictly worse
bound rejects, so ties (smaller number wins) are exact too.

Every round is one pass: tasks add up their vectors per centroid and send k rows, Spark adds those,
and the driver holds k centroids. Vectors are never shuffled or collected, and a lost
task is only run again. Start centroids are the k smallest digests of ids; a bound on the digest, from the
counted rows, keeps the candidates to a few times k.

Defined cases: a vector that is null, of another dimension or with a null or non-finite component is left out;
a null id hashes as the empty string; rows that repeat an id are separate vectors (equal digests are ordered by their
integers); with fewer than k vectors each is a centroid; an empty table gives an empty result; extra columns are
ignored. Integers beyond +-2**24 are an error, as distances could pass a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyvane.llm._tables import begin, read
from skyvane.session import materialize

LIMIT = 1 << 24
FAR = 1 << 62
BLOCK = 4096


def integers(col: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(kept rows, their integer vectors) of a list column."""
    n = pc.list_value_length(col).fill_null(-1).to_numpy(zero_copy_only=False)
    whole = np.flatnonzero(n == dim)
    x = col.take(pa.array(whole)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(whole), dim)
    finite = np.isfinite(x).all(1)
    x = np.floor(x[finite] * scale)
    if len(x) and np.abs(x).max() > LIMIT:
        raise ValueError(f"components beyond {LIMIT / scale} are not supported")
    return whole[finite], x.astype(np.int64)


@dataclass
class Centroids:
    """Centroids in order of their sums, ready for the search."""

    number: np.ndarray
    vectors: np.ndarray
    sums: np.ndarray
    deviations: np.ndarray

    @classmethod
    def of(cls, vectors: np.ndarray) -> Centroids:
        """``vectors[i]`` is centroid i."""
        sums = vectors.sum(1)
        order = np.argsort(sums, kind="stable")
        return cls(order, vectors[order], sums[order], deviation(vectors[order]))

    def by_number(self) -> np.ndarray:
        out = np.empty_like(self.vectors)
        out[self.number] = self.vectors
        return out


def deviation(x: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - x.mean(1, keepdims=True)) ** 2).sum(1))


def nearest(x: np.ndarray, c: Centroids) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (smallest number of ties) and squared distance of each row; exact distances computed."""
    n, k, d = len(x), len(c.sums), x.shape[1]
    who, best, done = np.full(n, k, np.int64), np.full(n, 1 << 56, np.int64), 0
    for at in range(0, n, BLOCK):
        part = slice(at, min(n, at + BLOCK))
        done += _scan(x[part], c, who[part], best[part], k, d)
    return who, best, done


def _scan(x, c, who, best, k, d) -> int:
    s, v = x.sum(1), deviation(x)
    right = np.searchsorted(c.sums, s)
    left = right - 1
    live, done = np.arange(len(x)), 0
    while len(live):
        l, r = left[live], right[live]
        to_l = np.where(l >= 0, s[live] - c.sums[np.maximum(l, 0)], FAR)
        to_r = np.where(r < k, c.sums[np.minimum(r, k - 1)] - s[live], FAR)
        go_left = to_l <= to_r
        gap, j = np.where(go_left, to_l, to_r), np.where(go_left, l, r)
        on = gap < FAR
        on[on] = gap[on] ** 2 <= d * best[live[on]]
        live, j, gap, go_left = live[on], j[on], gap[on], go_left[on]
        left[live[go_left]] -= 1
        right[live[~go_left]] += 1
        off = v[live] - c.deviations[j]
        margin = 1 + 1e-12 * (v[live] ** 2 + c.deviations[j] ** 2 + gap.astype(float) ** 2)
        near = gap.astype(float) ** 2 / d + off * off <= best[live] + margin
        i, j = live[near], j[near]
        diff = x[i] - c.vectors[j]
        dist = np.einsum("ij,ij->i", diff, diff)
        done += len(i)
        number = c.number[j]
        better = (dist < best[i]) | ((dist == best[i]) & (number < who[i]))
        best[i[better]], who[i[better]] = dist[better], number[better]
    return done


def _vectors(df: DataFrame, col: str, *others) -> DataFrame:
    return df.select(F.col(col).alias("vector"), *others)


def start(df: DataFrame, k: int, dim: int, scale: int, seed: int, col: str, key: str) -> np.ndarray:
    """The k kept vectors of smallest digest of ``seed:id``, in digest order."""
    spark = df.sparkSession
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(len(integers(b.column(0), dim, scale)[0]) for b in it)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    def keep(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows, x = integers(b.column(0), dim, scale)
            yield pa.RecordBatch.from_arrays(
                [b.column(1).take(pa.array(rows)), pa.array(list(x), pa.list_(pa.int64()))], names=["digest", "vector"])

    n = _vectors(df, col).mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0
    share = 4 * k / n if n else 1
    while True:
        rows = _vectors(df, col, digest.alias("digest"))
        if share < 1:
            rows = rows.filter(F.col("digest") < f"{int(share * (1 << 64)):016x}")
        top = rows.mapInArrow(keep, "digest string, vector array<long>").orderBy("digest", "vector").limit(k).collect()
        if len(top) == min(k, n) or share >= 1:
            return np.array([r["vector"] for r in top], np.int64).reshape(len(top), dim)
        share *= 8


def step(df: DataFrame, c: Centroids, dim: int, scale: int, col: str) -> Centroids:
    """One round: assign, then move every non-empty centroid to the floored mean of its vectors."""
    k = len(c.sums)

    def add(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for b in it:
            _, x = integers(b.column(0), dim, scale)
            if len(x):
                who, _, _ = nearest(x, c)
                n += np.bincount(who, minlength=k)
                order = np.argsort(who, kind="stable")
                has, first = np.unique(who[order], return_index=True)
                total[has] += np.add.reduceat(x[order], first, axis=0)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(n[used]), pa.array(list(total[used]), pa.list_(pa.int64()))],
            names=["cluster", "n", "total"])

    parts = _vectors(df, col).mapInArrow(add, "cluster int, n long, total array<long>")
    sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[
        F.sum(F.col("total")[j]).alias(f"s{j}") for j in range(dim)]).collect()          # at most k rows
    out = c.by_number()
    for r in sums:
        out[r["cluster"]] = [r[f"s{j}"] // r["n"] for j in range(dim)]
    return Centroids.of(out)


def fit(df: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2,
        col: str = "embedding", key: str = "vec_id") -> Centroids | None:
    """Centroids after ``rounds`` rounds; None without any vector."""
    begin(df.sparkSession)
    first = start(df, k, dim, scale, seed, col, key)
    if not len(first):
        return None
    c = Centroids.of(first)
    for _ in range(rounds):
        c = step(df, c, dim, scale, col)
    return c


def assign(df: DataFrame, c: Centroids | None, dim: int = 64, scale: int = 256,
           col: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id, cluster, distance (squared) of every kept vector."""

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows, x = integers(b.column(0), dim, scale)
            if len(rows):
                who, dist, _ = nearest(x, c)
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).take(pa.array(rows)), pa.array(who, pa.int32()), pa.array(dist)],
                    names=["vec_id", "cluster", "distance"])

    rows = _vectors(df, col, F.col(key).alias("vec_id"))
    schema = rows.select("vec_id").schema.add("cluster", "integer").add("distance", "long")
    return rows.mapInArrow(place, schema)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    c = fit(vectors)
    placed = materialize(assign(vectors, c), "clusters")
    names = [] if c is None else [
        (i, hashlib.sha256(",".join(map(str, row.tolist())).encode()).hexdigest()) for i, row in enumerate(c.by_number())]
    digests = spark.createDataFrame(names, "cluster int, centroid_sha256 string")
    inertia = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = inertia.agg(F.sum("cluster_inertia")).first()[0]
    # k rows, whatever the table holds
    facts = F.broadcast(inertia.join(F.broadcast(digests), "cluster"))
    return placed.join(facts, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256")


def _sql(k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2) -> str:
    near = """a{i} AS MATERIALIZED (
  SELECT r, min(struct_pack(d := list_sum(list_transform(list_zip(e, ce), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c := c)) AS b
  FROM v, c{i} GROUP BY r)"""
    move = """c{j} AS MATERIALIZED (
  SELECT o.c, coalesce(m.ce, o.ce) AS ce FROM c{i} o LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS ce FROM (
      SELECT b.c AS c, p, CAST(sum(e[p]) AS BIGINT) AS s, count(*) AS n
      FROM v JOIN a{i} USING (r), range(1, {end}) t(p) GROUP BY 1, 2) GROUP BY c) m ON o.c = m.c)"""
    parts = [f"""v AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY h, e) AS r FROM (
    SELECT vec_id, sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h,
           list_transform(embedding, lambda x: TRY_CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings WHERE len(embedding) = {dim}
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}))""",
             f"c0 AS MATERIALIZED (SELECT CAST(r - 1 AS INTEGER) AS c, e AS ce FROM v WHERE r <= {k})"]
    for i in range(rounds):
        parts += [near.format(i=i), move.format(i=i, j=i + 1, end=dim + 1)]
    parts.append(near.format(i=rounds))
    return f"""WITH {", ".join(parts)}
SELECT vec_id, b.c AS cluster, CAST(b.d AS BIGINT) AS distance,
       CAST(sum(b.d) OVER (PARTITION BY b.c) AS BIGINT) AS cluster_inertia, CAST(sum(b.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(ce, ',')) AS centroid_sha256
FROM v JOIN a{rounds} USING (r) JOIN c{rounds} ON c{rounds}.c = b.c"""


OP11_SQL = _sql()
