"""Incremental removal of repeated word windows with a log-structured fingerprint index.

Documents arrive in batches of ascending doc_id. The fingerprints of a batch (stretches of window hashes, see
`windows`) are range-partitioned like the index, sorted, and merge-joined with each of its immutable sorted runs; every
hash match whose surroundings differ is verified word by word. What no run holds becomes a run of its own, written for
the next batch. Once FAN runs of a level have gathered they are merged into one of the next level, so that a batch meets
few runs and a stretch is rewritten once a level. The index keeps the first occurrence of each stretch, so it grows with
distinct text only. `save` and `open` carry it from one session to the next.

Defined cases: a null or empty text has no words; a text under `width` words keeps them all; rows without doc_id take
no part and come back whole; rows that share a doc_id count as one document; windows of one document never remove each
other; extra columns ride along in `carry`; an empty table gives an empty result; an empty batch adds no run's rows. A
batch with an id that is not above all earlier ones is refused.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.llm import repeats
from attesta.llm.common import partitions, tidy, word_hashes, word_spans

GRAM = 4
#: Runs of one level that are merged into one of the next.
FAN = 4


def tokens(raw: bytes) -> np.ndarray:
    return word_hashes(np.frombuffer(raw, np.uint8))[0]


class FingerprintLog:
    """The index. `add` takes a batch and returns its intervals of windows that an earlier document holds."""

    def __init__(self, width: int, gram: int, points: np.ndarray, fan: int = FAN):
        self.width, self.gram, self.points, self.fan = width, gram, points, fan
        self.runs: list[tuple[int, DataFrame, str | None]] = []  # level, table, and name once saved
        self.seen: DataFrame | None = None
        self.newest: int | None = None
        self.version = 0

    def add(self, batch: DataFrame, newest: int | None, more: bool = True) -> DataFrame:
        """batch: doc_id, text; all ids greater than those before. newest: its greatest id. more: another batch may
        follow, so what is new in this one becomes a run."""
        if self.newest is not None and batch.where(F.col("doc_id") <= self.newest).limit(1).count():
            raise ValueError(f"a batch must only hold ids above {self.newest}")
        moved = repeats.scan(batch, tokens, self.width, self.gram, False, self.points)
        for _, run, _ in self.runs:
            moved = moved.unionByName(run)
        n = repeats.tasks(batch, self.points)
        found = repeats.settled(moved, False, n, keep_run=more)
        self.seen = batch if self.seen is None else self.seen.unionByName(batch)
        verified = repeats.contested(self.seen, found, tokens, self.width, False, n, self.newest)
        if more:
            self.runs.append((0, found.where(F.col("kind") == repeats.RUN).select("p", "kind", "blob"), None))
            self._compact()
        self.newest = newest
        return found.where(F.col("kind") == repeats.INTERVALS).select("doc", "start", "count").unionByName(verified.select("doc", "start", "count"))

    def _compact(self):
        level = 0
        while sum(at == level for at, *_ in self.runs) >= self.fan:
            merged = repeats.merged_runs(runs := [run for at, run, _ in self.runs if at == level], repeats.tasks(runs[0], self.points))
            self.runs = [(level + 1, merged, None), *(r for r in self.runs if r[0] != level)]
            level += 1

    def save(self, spark: SparkSession, folder: str):
        """Adds the runs that the folder lacks and, last, a new manifest; runs that it holds are never written again."""
        names = [name or f"run-{uuid.uuid4().hex}" for *_, name in self.runs]
        for (_, run, have), name in zip(self.runs, names, strict=True):
            if have is None:
                run.write.parquet(f"{folder}/{name}")
        self.runs = [(at, run, name) for (at, run, _), name in zip(self.runs, names, strict=True)]
        self.version += 1
        manifest = {"width": self.width, "gram": self.gram, "points": [int(x) for x in self.points], "fan": self.fan, "runs": [[at, name] for at, _, name in self.runs], "newest": self.newest}
        spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{folder}/manifest/version={self.version}")

    @classmethod
    def open(cls, spark: SparkSession, folder: str, seen: DataFrame) -> FingerprintLog:
        """The index as last saved. seen: the documents (doc_id, text) it was made of, for matches are verified there."""
        last = spark.read.text(f"{folder}/manifest").orderBy(F.desc("version")).first()
        have = json.loads(last.value)
        log = cls(have["width"], have["gram"], np.asarray(have["points"], np.uint64), have["fan"])
        log.runs = [(at, spark.read.schema(repeats.MOVE).parquet(f"{folder}/{name}"), name) for at, name in have["runs"]]
        log.seen, log.newest, log.version = seen.select("doc_id", "text"), have["newest"], last.version
        return log


def remove_repeats(docs: DataFrame, carry: list[str] | None = None, width: int = 13, gram: int = GRAM, batches: int = 2, fan: int = FAN) -> DataFrame:
    """doc_id, carry, n_words, spans (array of first and end word of each maximal removed run) and kept (string: the
    remaining words joined by one space) of each row of docs (doc_id, text)."""
    base = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in carry or ["doc_id"]]).alias("carry"))
    pairs = base.select("doc_id", "text")
    points = repeats.split_points(pairs, tokens, width, gram, 3 * partitions(docs.sparkSession))
    cuts = sorted(set(pairs.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01))) if batches > 1 else []
    edges = [None, *map(int, cuts), None]
    log, intervals = FingerprintLog(width, gram, points, fan), None
    for i, (low, high) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        part = pairs
        if low is not None:
            part = part.where(F.col("doc_id") > low)
        if high is not None:
            part = part.where(F.col("doc_id") <= high)
        got = log.add(part, high, more=i + 2 < len(edges))
        intervals = got if intervals is None else intervals.unionByName(got)
    joined = repeats.covers(base, intervals)

    def finish(rows):
        for b in rows:
            edge, start, count = repeats.cut_columns(b)
            n, spans, kept = [], [], []
            for i, raw in enumerate(b.column("text").cast(pa.large_binary())):
                raw = raw.as_buffer().to_pybytes() if raw.is_valid else b""
                s, e = repeats.merged(None, i, edge, start, count, width)
                if len(s):
                    first, end = word_spans(np.frombuffer(raw, np.uint8))
                    total = len(first)
                    e = np.minimum(e, total)
                    s, e = s[s < e], e[s < e]
                    words = [raw[x:y] for x, y in zip(first.tolist(), end.tolist(), strict=True)]
                else:
                    words = raw.split()  # for bytes, exactly the six ASCII spaces
                    total = len(words)
                n.append(total)
                spans.append([{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist(), strict=True)])
                kept.append(b" ".join(w for x, y in zip([0, *e.tolist()], [*s.tolist(), total], strict=True) for w in words[x:y]))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("carry"), pa.array(n, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "carry", "n_words", "spans", "kept"])
        tidy()

    out = T.StructType([base.schema["doc_id"], base.schema["carry"], T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))), T.StructField("kept", T.StringType())])
    return joined.mapInArrow(finish, out)


def op10_lsm_dedup(spark, sf_dir: str) -> DataFrame:
    got = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return got.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
