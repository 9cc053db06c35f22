"""The distributed flow shared by the two substring removers: scan, settle, contest, cover.

Texts cross the network twice at most, and only as wide as (doc_id, text): once for documents that hold contested
stretches, once to cut the result. Everything else that moves is packed stretches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import batches_of, by_bucket, pack, partitions, runs, stored, tidy, unpack
from attesta.llm.windows import KINDS, compacted, contest, merge_join, packed, settle, several, stretches, unpacked

MOVE = "p int, kind int, blob binary"
FOUND = "kind int, doc long, start long, count long, gram long, offset int, p int, blob binary"
STRETCHES, INTERVALS, CONTESTED, RUN = 0, 1, 2, 3
_MOVE = pa.schema([("p", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])
_FOUND = pa.schema([("kind", pa.int32()), ("doc", pa.int64()), ("start", pa.int64()), ("count", pa.int64()), ("gram", pa.int64()), ("offset", pa.int32()), ("p", pa.int32()), ("blob", pa.binary())])
#: Bytes of stretches, unpacked, that a range is to hold.
RANGE_BYTES = 8 << 20
Tokens = Callable[[bytes], np.ndarray]


def texts(batch: pa.RecordBatch, id_col: str = "doc_id", text_col: str = "text") -> Iterator[tuple[int, bytes]]:
    """Document ids and UTF-8 texts; rows without an id are left out, a null text is empty."""
    data = batch.column(text_col).cast(pa.large_binary())
    for doc, raw in zip(batch.column(id_col).to_pylist(), data, strict=True):
        if doc is not None:
            yield doc, raw.as_buffer().to_pybytes() if raw.is_valid else b""


def scan(docs: DataFrame, tokens: Tokens, w: int, k: int, same_doc: bool, splitters: np.ndarray) -> DataFrame:
    """Stretches of all documents, packed by range of leading tokens, and intervals already settled inside a batch."""

    def run(batches):
        for n, b in enumerate(batches):
            cols = stretches(((d, tokens(t)) for d, t in texts(b)), w, k)
            kept, out = settle(cols, same_doc)
            p, kind, blob = [], [], []
            if len(out[0]):
                p.append(-1 - n)
                kind.append(INTERVALS)
                blob.append(pack(*(np.asarray(c, np.int64) for c in out)))
            bucket = np.searchsorted(splitters, kept[0], "right")
            cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else []
            for a, z in zip(cut[:-1], cut[1:], strict=True):
                p.append(int(bucket[a]))
                kind.append(STRETCHES)
                blob.append(packed([c[a:z] for c in kept]))
            yield batches_of(_MOVE, p=p, kind=kind, blob=blob)
        tidy()

    return docs.select("doc_id", "text").mapInArrow(run, MOVE)


def split_points(docs: DataFrame, tokens: Tokens, w: int, k: int, buckets: int, sample: int = 512) -> np.ndarray:
    """Splitters between ranges of leading tokens, from the stretches of a bounded sample of documents. They only
    balance the ranges: any splitters give the same result. There are so many ranges, `buckets` at least, that by the
    sample's stretches a document none holds more than `RANGE_BYTES`, however large the input."""
    rows = docs.count()
    share = min(1.0, 2 * sample / max(1, rows))
    got = docs.select("doc_id", "text").where("doc_id is not null").sample(share, 7).limit(sample).toArrow()
    keys = np.sort(np.concatenate([stretches(((d, tokens(t)) for d, t in texts(b)), w, k)[0] for b in got.to_batches()] or [np.empty(0, np.uint64)]))
    size = len(keys) / max(1, got.num_rows) * rows * sum(np.dtype(x).itemsize for x in KINDS)
    buckets = max(buckets, int(np.ceil(size / RANGE_BYTES)))
    return np.unique(keys[np.linspace(0, len(keys) - 1, buckets + 1).astype(int)[1:-1]]) if len(keys) else keys


def tasks(docs: DataFrame, splitters: np.ndarray) -> int:
    """Tasks among which the ranges are dealt, three to each; the session's own number at least."""
    return max(partitions(docs.sparkSession), -(-(len(splitters) + 1) // 3))


def _rows(kind: int, p: int, doc, start, count, gram=None, offset=None) -> pa.RecordBatch:
    n = len(doc)
    none = pa.nulls(n, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(np.asarray(doc, np.int64)), pa.array(np.asarray(start, np.int64)), pa.array(np.asarray(count, np.int64)), none if gram is None else pa.array(gram.view(np.int64)), pa.nulls(n, pa.int32()) if offset is None else pa.array(np.asarray(offset, np.int32)), pa.array(np.full(n, p, np.int32)), pa.nulls(n, pa.binary())], schema=_FOUND)


def settled(moved: DataFrame, same_doc: bool, n: int, keep_run: bool = False) -> DataFrame:
    """Intervals, contested stretches and, if asked for, a sorted run of what is new in each range; written to the shared
    folder. Each RUN row of `moved` is a range of one historical run, in order; the batch is sorted by itself and
    merge-joined with every run, which stays as it is."""

    def run(batches):
        for p, rows in by_bucket(batches).items():
            blobs = {k: [b for kind, b in rows if kind == k] for k in (STRETCHES, INTERVALS, RUN)}
            for b in blobs[INTERVALS]:
                yield _rows(INTERVALS, p, *unpack(b, np.int64, np.int64, np.int64))
            fresh, out = settle(unpacked(blobs[STRETCHES]), same_doc)
            yield _rows(INTERVALS, p, *out)
            history = [unpacked([b]) for b in blobs[RUN]]
            known, near = np.zeros(len(fresh[0]), bool), np.zeros(len(fresh[0]), bool)
            for old in history:
                same, beside = merge_join(old, fresh)
                known, near = known | same, near | beside
            yield _rows(INTERVALS, p, *runs(fresh[2][known], fresh[3][known], fresh[4][known].astype(np.int64)))
            fresh, near = tuple(c[~known] for c in fresh), near[~known]
            rival = near | several(fresh[0], fresh[1])
            # a gram that only history holds was compared before
            for gram, _, doc, start, count, offset in (tuple(c[rival] for c in fresh), *(tuple(c[np.isin(old[0], fresh[0][near])] for c in old) for old in history)):
                yield _rows(CONTESTED, p, doc, start, count, gram, offset)
            if keep_run and len(fresh[0]):
                yield batches_of(_FOUND, kind=[RUN], doc=[None], start=[None], count=[None], gram=[None], offset=[None], p=[p], blob=[packed(fresh)])
        tidy()

    return stored(moved.repartition(n, "p").mapInArrow(run, FOUND))


def merged_runs(tables: list[DataFrame], n: int) -> DataFrame:
    """One run of several, written to the shared folder: ranges of one p are merged and keep their order."""

    def run(batches):
        for p, rows in by_bucket(batches).items():
            yield batches_of(_MOVE, p=[p], kind=[RUN], blob=[packed(compacted([unpacked([b]) for _, b in rows]))])
        tidy()

    moved = tables[0]
    for t in tables[1:]:
        moved = moved.unionByName(t)
    return stored(moved.repartition(n, "p").mapInArrow(run, MOVE))


def contested(docs: DataFrame, found: DataFrame, tokens: Tokens, w: int, same_doc: bool, n: int, newer_than: int | None = None) -> DataFrame:
    """Intervals (doc, start, count) of contested windows that an equal window precedes."""
    part = F.struct("p", "start", "count", "gram", "offset")
    wanted = found.where(F.col("kind") == CONTESTED).groupBy("doc").agg(F.collect_list(part).alias("parts"))
    text = docs.select(F.col("doc_id").alias("doc"), "text")

    def cut(batches):
        for b in batches:
            parts = b.column("parts")
            edge = parts.offsets.to_numpy()
            p, start, count, gram, offset = (c.to_numpy(zero_copy_only=False) for c in parts.flatten().flatten())
            edge = edge - edge[0]
            out: dict[int, list[list]] = {}
            for i, (doc, raw) in enumerate(texts(b, "doc")):
                tok = tokens(raw)
                for j in range(edge[i], edge[i + 1]):
                    piece = tok[start[j] : start[j] + count[j] + w - 1]
                    if len(piece) == count[j] + w - 1:
                        out.setdefault(int(p[j]), []).append([doc, start[j], count[j], gram[j], offset[j], piece])
            ps, blobs = [], []
            for key, rows in out.items():
                ps.append(key)
                ids = [np.asarray([r[c] for r in rows], np.int64) for c in range(5)]
                body = np.concatenate([r[5] for r in rows])
                head = pack(*ids)
                blobs.append(len(head).to_bytes(8, "little") + head + pack(body))
            yield batches_of(_MOVE, p=ps, kind=[CONTESTED] * len(ps), blob=blobs)
        tidy()

    kind = tokens(b"a b").dtype.type

    def compare(batches):
        for p, rows in by_bucket(batches).items():
            cols, body = [], []
            for _, b in rows:
                k = int.from_bytes(b[:8], "little")
                cols.append(unpack(b[8 : 8 + k], *[np.int64] * 5))
                body.append(unpack(b[8 + k :], kind)[0])
            doc, start, count, gram, offset = (np.concatenate(x) for x in zip(*cols, strict=True))
            whole = np.concatenate(body)
            at = np.concatenate([[0], np.cumsum(count + w - 1)])
            text = [whole[a:z] for a, z in zip(at[:-1], at[1:], strict=True)]
            new = np.ones(len(doc), bool) if newer_than is None else doc > newer_than
            yield _rows(INTERVALS, p, *contest(gram.view(np.uint64), doc, start, count.astype(np.int32), offset.astype(np.int32), text, w, same_doc, new))
        tidy()

    return text.join(wanted, "doc").mapInArrow(cut, MOVE).repartition(n, "p").mapInArrow(compare, FOUND)


def covers(docs: DataFrame, intervals: DataFrame) -> DataFrame:
    """docs (doc_id, text, carried columns) with `cut`: the intervals of its windows that are to go."""
    spans = intervals.groupBy(F.col("doc").alias("_doc")).agg(F.collect_list(F.struct("start", "count")).alias("cut"))
    return docs.join(spans, F.col("doc_id") == F.col("_doc"), "left").drop("_doc")


def merged(cut: pa.Array, i: int, edge: np.ndarray, start: np.ndarray, count: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal covered token runs of row i."""
    a, z = edge[i], edge[i + 1]
    if a == z:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    s, e = start[a:z], start[a:z] + count[a:z] + w - 1
    o = np.argsort(s, kind="stable")
    s, e = s[o], np.maximum.accumulate(e[o])
    head = np.flatnonzero(np.concatenate([[True], s[1:] > e[:-1]]))
    return s[head], e[np.concatenate([head[1:] - 1, [len(s) - 1]])]


def cut_columns(batch: pa.RecordBatch):
    """Offsets, starts and counts of the `cut` column."""
    c = batch.column("cut")
    edge = np.concatenate([[0], np.cumsum([0 if v is None else v for v in pa.compute.list_value_length(c).to_pylist()])]).astype(np.int64)
    flat = c.flatten()
    start, count = (x.to_numpy(zero_copy_only=False) for x in flat.flatten()) if len(flat) else (np.empty(0, np.int64),) * 2
    return edge, start, count

