"""Exact top-k by inner product with norm buckets.

Vectors are grouped by length, longest first, in buckets of bounded size. A bounded seed of vectors gives each query a
lower bound of its k-th score; by Cauchy-Schwarz a bucket whose longest vector cannot reach it is never visited. Inside
a bucket the bound becomes a local cosine threshold: if that is low, candidates are cut by length alone, if high, by
their partial product over the query's largest coordinates plus the most that the rest can add. What survives is
verified by the exact integer product. Queries and candidates meet in blocks of bounded size.

Scores are exact integers of any size: sums that doubles cannot hold are added up as Python integers. A result beyond a
long, or a component whose square no double holds (1e150 and more), is an error that names the row.

Defined cases: vectors that are null or hold null or non-finite components take no part; shorter vectors count as
padded with zeros; rows of equal vec_id are one query (one of them) but separate candidates, none a candidate of its
own id; ties go to the smaller vec_id; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.common import by_bucket, partitions, zstandard

ROWS, SEEDS, COORDINATES, QUERIES = 8192, 2048, 8, 256
#: Components from here on have squares that sums of doubles may not hold.
HUGE = 1e150
_MOVE = pa.schema([("p", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary())])


def quantised(vectors: DataFrame, scale: float, id_col: str, vec_col: str) -> DataFrame:
    """vec_id, v (array<double> of floor(scale * x)), n2 (squared length) of vectors that take part."""
    part = lambda c: c.cast("double") * scale
    # doubles from 2**53 on are whole; floor goes through bigint, which would cut them
    whole = lambda c: F.when(F.abs(part(c)) < 2.0**53, F.floor(part(c)).cast("double")).otherwise(part(c))
    fine = F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & F.forall(F.col(vec_col), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    huge = F.exists(F.col(vec_col), lambda c: F.abs(part(c)) >= HUGE)
    error = F.raise_error(F.concat(F.lit("a component is too large for exact scores: vec_id "), F.col(id_col).cast("string"))).cast("array<double>")
    v = vectors.where(fine).select(F.col(id_col).cast("long").alias("vec_id"), F.when(huge, error).otherwise(F.transform(F.col(vec_col), whole)).alias("v"))
    return v.withColumn("n2", F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    v = batch.column("v")
    n = v.value_lengths().to_numpy()
    out = np.zeros((len(v), int(n.max()) if len(n) else 0))
    out[np.arange(out.shape[1]) < n[:, None]] = v.flatten().to_numpy()
    return out


def _pack(ids: np.ndarray, v: np.ndarray, bound: np.ndarray | None = None) -> bytes:
    head = np.array([len(ids), v.shape[1]], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + ids.tobytes() + (np.zeros(len(ids)) if bound is None else bound).tobytes() + np.ascontiguousarray(v).tobytes())


def _unpack(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, bounds, vs = [], [], []
    for b in blobs:
        raw = zstandard.ZstdDecompressor().decompress(b)
        n, d = np.frombuffer(raw, np.int64, 2).tolist()
        ids.append(np.frombuffer(raw, np.int64, n, 16))
        bounds.append(np.frombuffer(raw, np.float64, n, 16 + 8 * n))
        vs.append(np.frombuffer(raw, np.float64, n * d, 16 + 16 * n).reshape(n, d))
    wide = max(v.shape[1] for v in vs)
    return np.concatenate(ids), np.concatenate(bounds), np.concatenate([np.pad(v, ((0, 0), (0, wide - v.shape[1]))) for v in vs])


def products(c: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer products as doubles where these hold them, else as Python integers."""
    c = c[:, : len(q)]
    q = q[: c.shape[1]]
    if len(c) and np.sqrt((c * c).sum(axis=1).max() * (q * q).sum()) >= 2.0**52:
        big = [int(x) for x in q]
        return np.array([sum(int(a) * b for a, b in zip(row, big, strict=True)) for row in c], object)
    return c @ q


def kth_best(seed_ids: np.ndarray, seed_v: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> np.ndarray:
    """For each query a score that its k-th best does not fall below, from the seeds other than itself."""
    least = np.full(len(ids), -np.inf)
    if len(seed_ids) <= k:
        return least
    wide = max(seed_v.shape[1], v.shape[1])
    s, q = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (seed_v, v))
    for low in range(0, len(ids), 512):
        part = q[low : low + 512] @ s.T
        part[ids[low : low + 512, None] == seed_ids[None, :]] = -np.inf
        best = np.partition(part, part.shape[1] - k, axis=1)[:, part.shape[1] - k]
        # a sum of doubles may be off by its rounding
        slack = 1e-12 * np.sqrt((q[low : low + 512] ** 2).sum(axis=1) * (s * s).sum(axis=1).max())
        least[low : low + 512] = np.where(slack < 0.25, np.floor(best + 0.5), best - slack)
    return least


def best(ids: np.ndarray, c: np.ndarray, n: np.ndarray, own: int, q: np.ndarray, least: float, k: int):
    """Up to k candidates (ids, scores) of one bucket, in descending length n, whose score may reach least."""
    length = float(np.sqrt((q * q).sum()))
    slack = 1e-9 * max(1.0, abs(least)) + 1e-6
    reach = length * float(n[0])
    if least > -np.inf and reach < least - slack:
        return ids[:0], np.empty(0)
    cosine = least / reach if reach > 0 else -1.0
    if least > 0 and length > 0:
        stop = int(np.searchsorted(-n, -(least - slack) / length, "right"))
    else:
        stop = len(ids)
    live = np.arange(stop)
    if cosine > 0.5 and stop > 4 * k:
        top = np.argsort(-np.abs(q))[:COORDINATES]
        top = top[top < c.shape[1]]
        part = c[:stop][:, top]
        rest = np.sqrt(np.maximum(n[:stop] ** 2 - (part * part).sum(axis=1), 0))
        most = part @ q[top] + rest * np.sqrt(max(length**2 - float((q[top] ** 2).sum()), 0.0))
        live = live[most >= least - slack - 1e-9 * reach]
    score = products(c[live], q)
    ok = (score >= least) & (ids[live] != own)
    live, score = live[ok], score[ok]
    order = np.lexsort((ids[live], np.array(-score, np.float64)))
    if score.dtype == object:
        order = np.array(sorted(range(len(live)), key=lambda i: (-score[i], ids[live][i])), int)
    return ids[live][order[:k]], score[order[:k]]


def top_k(vectors: DataFrame, queries: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer products of each row that satisfies queries (a condition
    on vec_id) with all other rows."""
    spark = vectors.sparkSession
    rows = quantised(vectors, scale, id_col, vec_col)
    asked = rows.where(queries).dropDuplicates(["vec_id"])
    n, nq = rows.count(), asked.count()
    buckets = max(1, -(-n // ROWS))
    longest = rows.orderBy(F.desc("n2"), "vec_id").limit(SEEDS)
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEEDS)
    seed = longest.unionByName(drawn).dropDuplicates(["vec_id"]).toArrow().combine_chunks()  # 2 * SEEDS rows
    seed_ids, seed_v = (seed.column("vec_id").to_numpy(), _matrix(seed.to_batches()[0])) if seed.num_rows else (np.empty(0, np.int64), np.empty((0, 0)))
    # bounds of length between classes; a class takes buckets by its counted rows, so that many vectors of one length, or
    # a quantile that is a little off, make more buckets and not larger ones
    cuts = rows.approxQuantile("n2", [i / buckets for i in range(1, buckets)], 0.002) if buckets > 1 else []
    edge = np.unique(np.array(cuts))[::-1]

    def classed(n2: np.ndarray) -> np.ndarray:
        return np.searchsorted(-edge, -n2, "left")

    top = rows.select("n2").mapInArrow(lambda it: (pa.RecordBatch.from_arrays([pa.array(classed(b.column("n2").to_numpy()).astype(np.int32)), b.column("n2")], names=["class", "n2"]) for b in it), "class int, n2 double")
    reach, many = np.full(len(edge) + 1, -1.0), np.ones(len(edge) + 1, np.int64)
    for r in top.groupBy("class").agg(F.max("n2").alias("most"), F.count(F.lit(1)).alias("rows")).collect():  # one row for each class of lengths
        reach[r["class"]], many[r["class"]] = np.sqrt(r["most"]), -(-r["rows"] // ROWS)
    first = np.concatenate([[0], np.cumsum(many)[:-1]])
    buckets = int(many.sum())
    # few buckets are searched by blocks of fewer queries, so that every core has some
    cores = spark.sparkContext.defaultParallelism
    blocks = max(1, -(-nq // ROWS), min(-(-nq // QUERIES), -(-2 * cores // buckets)))

    def deal_candidates(batches):
        for b in batches:
            ids, v, n2 = b.column("vec_id").to_numpy(), _matrix(b), b.column("n2").to_numpy()
            c = classed(n2)
            bucket = first[c] + (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % many[c]
            for x in np.unique(bucket):
                blob = _pack(ids[bucket == x], v[bucket == x])
                yield pa.RecordBatch.from_arrays([pa.array(x * blocks + np.arange(blocks), pa.int64()), pa.array(np.zeros(blocks, np.int32)), pa.array([blob] * blocks, pa.binary())], schema=_MOVE)

    def deal_queries(batches):
        for b in batches:
            ids, v, n2 = b.column("vec_id").to_numpy(), _matrix(b), b.column("n2").to_numpy()
            least = kth_best(seed_ids, seed_v, ids, v, k)
            block = (ids.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(33)).astype(np.int64) % blocks
            for c in range(len(reach)):
                need = np.sqrt(n2) * reach[c] >= least - 1e-6 - 1e-9 * np.abs(least)
                for y in np.unique(block[need]):
                    mine = need & (block == y)
                    blob = _pack(ids[mine], v[mine], least[mine])
                    p = (first[c] + np.arange(many[c])) * blocks + y
                    yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(np.ones(len(p), np.int32)), pa.array([blob] * len(p), pa.binary())], schema=_MOVE)

    def search(batches):
        for blobs in by_bucket(batches).values():
            sides = [[b for kind, b in blobs if kind == side] for side in (0, 1)]
            if not all(sides):
                continue
            ids, _, c = _unpack(sides[0])
            order = np.lexsort((ids, -(c * c).sum(axis=1)))
            ids, c = ids[order], np.asfortranarray(c[order])
            length = np.sqrt((c * c).sum(axis=1))
            found = []
            for own, least, q in zip(*_unpack(sides[1]), strict=True):
                got, score = best(ids, c, length, int(own), q, float(least), k)
                if score.dtype == object:
                    far = [j for j, x in zip(got, score, strict=True) if not -(1 << 63) <= x < 1 << 63]
                    if far:
                        raise OverflowError(f"the score of vec_id {own} and {far[0]} is beyond a long")
                found.append((np.full(len(got), own), got, score.astype(np.int64)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], names=["query_id", "vec_id", "score"])

    move = "p long, kind int, blob binary"
    dealt = rows.mapInArrow(deal_candidates, move).unionByName(asked.mapInArrow(deal_queries, move))
    found = dealt.repartition(max(1, min(4 * partitions(spark), 3 * buckets * blocks)), "p").mapInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


OP5_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
WHERE rank <= 20
"""
