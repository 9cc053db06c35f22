"""Shared pieces of the training-data operators: words, hashes, packed exchanges, scratch tables, components."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_SQL = "[^\\x20\\x09-\\x0D]+"
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
        x = (x ^ (x >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


#: A random-looking 64-bit value for each byte.
BYTE_HASH = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_POW: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _POW.get(base)
    if have is None or len(have) < n:
        out, filled = np.empty(1 << max(12, (n - 1).bit_length()), U64), 1
        out[0] = 1
        with np.errstate(over="ignore"):
            while filled < len(out):
                out[filled : 2 * filled] = out[:filled] * U64(pow(base, filled, 1 << 64))
                filled *= 2
        have = _POW[base] = out
    return have[:n]


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in UTF-8 bytes."""
    if not len(raw):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gap = SPACE[raw]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    edge = np.concatenate([[0] if not gap[0] else [], edge, [len(raw)] if not gap[-1] else []]).astype(np.int64)
    return edge[0::2], edge[1::2]


def word_hashes(raw: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of UTF-8 bytes, with its start and end. lower: A-Z count as a-z."""
    starts, ends = word_spans(raw)
    if not len(starts):
        return np.empty(0, U64), starts, ends
    if lower:
        raw = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    at = np.arange(len(raw), dtype=np.int64)
    first = np.zeros(len(raw), np.int64)
    first[starts] = starts
    at -= np.maximum.accumulate(first)
    gap = SPACE[raw]
    at[gap] = 0
    with np.errstate(over="ignore"):
        value = BYTE_HASH[raw] * powers(0xD6E8FEB86659FD93, int(at.max()) + 1)[at]
        value[gap] = 0
        sums = np.add.reduceat(value, starts)
        return mix(sums + (ends - starts).astype(U64)), starts, ends


def pack(*columns: np.ndarray) -> bytes:
    """Equally long integer columns in one compressed block; slowly changing ones are stored as differences."""
    body = [np.asarray([len(columns[0])], np.int64).tobytes()]
    for c in columns:
        body.append(np.ascontiguousarray(c).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(body))


def unpack(blob: bytes, *kinds: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that all executors share. A session must name one: other machines cannot read a
    driver's own folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/attesta-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df written as a table in the shared folder and read again: lineage ends here, lost executors cost nothing."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_bucket(batches: Iterator[pa.RecordBatch], key: str = "p") -> dict[int, list[tuple]]:
    """All rows of this partition, by bucket; rows hold packed blocks, so this is the compressed size."""
    found: dict[int, list[tuple]] = {}
    for b in batches:
        names = [n for n in b.schema.names if n != key]
        cols = [b.column(n).to_pylist() for n in names]
        for k, *row in zip(b.column(key).to_pylist(), *cols, strict=True):
            found.setdefault(k, []).append(tuple(row))
    return found


def lean(spark: SparkSession, mb: int = 8) -> None:
    """Arrow batches of at most mb, where the session allows larger ones: a batch of texts is held several times over,
    in the JVM, on the way and in Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).lower()
    number, unit = re.match(r"(\d+)([kmgt]?)", now).groups()
    if int(number) * 1024 ** ("kmgt".index(unit) + 1 if unit else 0) > mb << 20:
        spark.conf.set(key, f"{mb << 20}")


def tidy() -> None:
    """Gives freed memory back to the system, for idle Python workers live on beside the next stage's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another libc


def batches_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def runs(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals [start, start + count) of documents, with touching and overlapping ones joined."""
    if not len(doc):
        return doc, start, count
    o = np.lexsort((start, doc))
    doc, start, end = doc[o], start[o], (start + count)[o]
    # ends may nest, so the running maximum within a document decides where a new run begins
    rank = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))
    span = int(end.max()) + 2
    reach = np.maximum.accumulate(end + rank * span) - rank * span
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(doc) - 1]])
    return doc[first], start[first], reach[last] - start[first]


class Union:
    """Union-find over 0..n-1 that keeps the smallest member as root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


#: Edges that one task joins in memory, at 16 bytes each.
ONE_TASK = 1_000_000


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, root) of all nodes of this partition's edges (a, b)."""
    parts = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    if parts:
        a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
        ids, name = np.unique(np.concatenate([a, b]), return_inverse=True)
        forest = Union(len(ids))
        for x, y in zip(name[: len(a)].tolist(), name[len(a) :].tolist(), strict=True):
            forest.join(x, y)
        root = np.array([forest.find(x) for x in range(len(ids))], np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[root])], names=["id", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(id, root), a row for each end of edges (a, b) with a <> b: root is the smallest id in reach. Up to `ONE_TASK`
    edges are joined in one task. More go through large star and small star in turn until nothing changes; each round
    is written to the shared folder, so no lineage grows and no node gathers its edges."""
    edge = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    if edge.count() <= ONE_TASK:
        return edge.repartition(1).mapInArrow(_joined, "id long, root long")
    edge, before = edge.toDF("u", "v"), None
    while True:
        both = edge.unionByName(edge.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(low, "u").select(F.explode(ends).alias("e")).select("e.u", "e.v")
        edge = stored(small.where("u <> v").distinct())
        now = edge.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edge.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("root"))
    return edge.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)

