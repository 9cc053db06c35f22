"""Suffix-array removal of repeated byte strings.

A sparse suffix array: only suffixes that begin at anchors (see `windows`) are kept, which is enough because every
string of 100 bytes holds one. Sampled splitters range-partition the suffixes by their leading bytes; in a bucket,
suffixes are sorted, equal stretches meet as neighbours, and stretches that share an anchor but differ around it are
sorted by multikey quicksort of their 100-byte windows, where each equal neighbour but the first goes. Splitters are
cut between whole anchor grams, so suffixes that could match never lie on two sides of a boundary, and comparing
across boundaries needs no second pass.

Defined cases: a null or empty text, and any text under `width` bytes, keeps all its bytes; rows without doc_id take no
part and come back whole; rows that share a doc_id count as one document; ties by start; extra columns ride along in
`carry`. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.llm import repeats
from attesta.llm.common import partitions, tidy

GRAM = 32


def tokens(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8)


def remove_repeats(docs: DataFrame, carry: list[str] | None = None, width: int = 100, gram: int = GRAM) -> DataFrame:
    """doc_id, carry (struct of the named columns, if any), n_bytes, spans (array of start and end of each maximal
    removed run), kept (binary: the remaining bytes) and kept_text (string: the same without the bytes of characters that
    a cut has broken; signs of the text itself stay) of each row of docs (doc_id, text)."""
    base = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in carry or ["doc_id"]]).alias("carry"))
    pairs = base.select("doc_id", "text")
    points = repeats.split_points(pairs, tokens, width, gram, 3 * partitions(docs.sparkSession))
    n = repeats.tasks(docs, points)
    found = repeats.settled(repeats.scan(pairs, tokens, width, gram, True, points), True, n)
    more = repeats.contested(pairs, found, tokens, width, True, n)
    intervals = found.where(F.col("kind") == repeats.INTERVALS).select("doc", "start", "count").unionByName(more.select("doc", "start", "count"))
    joined = repeats.covers(base, intervals)

    def finish(batches):
        for b in batches:
            edge, start, count = repeats.cut_columns(b)
            n, spans, kept, clean = [], [], [], []
            data = b.column("text").cast(pa.large_binary())
            for i, raw in enumerate(data):
                raw = raw.as_buffer().to_pybytes() if raw.is_valid else b""
                s, e = repeats.merged(None, i, edge, start, count, width)
                e = np.minimum(e, len(raw))
                s, e = s[s < e], e[s < e]
                n.append(len(raw))
                spans.append([{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist(), strict=True)])
                pieces = [raw[x:y] for x, y in zip([0, *e.tolist()], [*s.tolist(), len(raw)], strict=True)]
                kept.append(b"".join(pieces))
                clean.append("".join(x.decode("utf-8", "ignore") for x in pieces))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("carry"), pa.array(n, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary()), pa.array(clean, pa.string())], names=["doc_id", "carry", "n_bytes", "spans", "kept", "kept_text"])
        tidy()

    out = T.StructType([base.schema["doc_id"], base.schema["carry"], T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))), T.StructField("kept", T.BinaryType()), T.StructField("kept_text", T.StringType())])
    return joined.mapInArrow(finish, out)


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    got = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return got.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
