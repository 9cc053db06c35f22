"""Language identification by bit-sliced Bloom filters of character n-grams.

Fitting: in a bounded sample of labelled documents (at most `per_language` of each language, chosen by hash of
doc_id), count the n-grams of whole texts and keep each language's `keep` most frequent ones of each length. Every kept
n-gram sets its language's bit in `probes` slots of one array, so that slot i holds bit i of every language's filter.
A slot has as many 64-bit words as the languages need.

Predicting: the bitwise AND of an n-gram's slots is the set of languages that hold it. The bits are counted for each
language over the whole text and corrected for false positives: of n n-grams, c = true + (n - true) * f, where f is the
share of set slots to the power of `probes`. The language with the largest corrected share wins.

Defined cases: null texts and texts without a letter are `und` with score 0; ties go to the language with more
labelled documents in the sample, then by code point; if nothing is labelled every text is `und`; texts of any length
are counted in pieces; rows are judged one by one, so repeated rows agree; rows that share a doc_id count once in the
sample, by their smallest text; extra columns are not read, and one named like an output gives way to it.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.common import U64, lean, mix, stored, tidy

LENGTHS = (2, 3, 4)
PIECE = 1 << 18  # characters handled at once


@cache
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def grams(codes: np.ndarray) -> list[np.ndarray]:
    """Hashes of the n-grams that begin at each code point, by length; 0 where one has a gap inside. All that is not a
    letter is one space, and n-grams may begin or end with a space, not span one."""
    space = codes == 32
    x = codes.astype(U64) + U64(1)
    have, out = x, []
    inner = np.zeros(len(codes), bool)
    with np.errstate(over="ignore"):
        for n in range(2, max(LENGTHS) + 1):
            m = len(codes) - n + 1
            if m <= 0:
                out.append(np.empty(0, U64))
                continue
            have = have[:m] * U64(0x1F123BB5159A55E5) + x[n - 1 :]
            if n > 2:
                inner = inner[:m] | space[n - 2 : n - 2 + m]
            else:
                inner = space[:m] & space[1:]
            if n in LENGTHS:
                h = mix(have + U64(n))
                h[inner[:m] if n > 2 else inner] = 0
                out.append(h)
    return out


def pieces(texts):
    """(rows, code points) of whole texts in lower case with runs of other characters made one space; several short
    texts together, long ones in pieces that overlap by the longest n-gram."""
    is_letter, over = letters(), max(LENGTHS) - 1
    owner, held, size = [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        for at in range(0, len(text), PIECE):
            codes = np.frombuffer(text[at : at + PIECE + over].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            ok = is_letter[codes]
            codes = np.where(ok, codes, 32)
            ok[1:] |= codes[:-1] != 32  # a space stays where a letter precedes it
            codes = codes[ok]
            if len(codes) and (codes != 32).any():
                owner.append(i)
                held.append(np.concatenate([[32], codes, [32, 32, 32]]).astype(np.uint32))
                size += len(held[-1])
            if size >= PIECE:
                yield owner, held
                owner, held, size = [], [], 0
    if held:
        yield owner, held


@dataclass
class Filters:
    """slots: the bits of all languages' filters; languages in the order of their bits; fill: share of set slots."""

    languages: list[str]
    slots: np.ndarray
    fill: np.ndarray
    probes: int

    def masks(self, h: np.ndarray, word: int = 0) -> np.ndarray:
        """For each n-gram, the languages 64 * word and on whose filters hold it, a bit each."""
        slots = self.slots[word]
        size = U64(len(slots) - 1)
        out = slots[(h & size).astype(np.int64)]
        for j in range(1, self.probes):
            out = out & slots[((h >> U64(20 * j)) & size).astype(np.int64)]
        return out

    def predict(self, texts: list) -> tuple[list[str], list[float]]:
        n, k = len(texts), len(self.languages)
        count, total = np.zeros((n, k)), np.zeros(n)
        for owner, held in pieces(texts):
            edge = np.concatenate([[0], np.cumsum([len(x) for x in held])])
            for h in grams(np.concatenate(held)):
                real = h != 0
                first = edge[:-1]
                first = np.minimum(first, max(0, len(h) - 1))
                np.add.at(total, owner, np.add.reduceat(real, first, dtype=np.int64))
                for word in range(len(self.slots)):
                    mask = self.masks(h, word)
                    mask[~real] = 0
                    for j in range(64 * word, min(k, 64 * word + 64)):
                        np.add.at(count[:, j], owner, np.add.reduceat((mask >> U64(j % 64)) & U64(1), first, dtype=np.int64))
        false = self.fill**self.probes
        share = np.clip((count - total[:, None] * false) / (np.maximum(total, 1)[:, None] * (1 - false)), 0, 1)
        best = share.argmax(axis=1) if k else np.zeros(n, int)
        names = [self.languages[b] if t and k else "und" for b, t in zip(best, total, strict=True)]
        return names, [float(share[i, b]) if total[i] and k else 0.0 for i, b in enumerate(best)]


def fit(labelled: DataFrame, per_language: int = 600, keep: int = 2500, slot_bits: int = 18, probes: int = 3) -> Filters:
    """labelled: doc_id, text, lang without nulls in lang. The sample and the filters are bounded by the parameters for
    each language, whatever the table's size."""
    # a hash threshold for each language leaves little more than its sample, so no task gathers a language
    counts = stored(labelled.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids")))
    ids = labelled.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 40)).alias("h")).join(counts, "lang")
    few = ids.where(F.col("h") < F.lit(float(1 << 40)) * 2 * (per_language + 100) / F.col("ids")).select("lang", "h", "doc_id").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    chosen = stored(few.withColumn("r", rank).where(F.col("r") <= per_language).select("doc_id", "lang"))  # small, so texts stay
    sample = stored(labelled.join(chosen, ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text"))

    def counted(batches):
        for b in batches:
            langs, texts = b.column("lang").to_pylist(), b.column("text").to_pylist()
            for lang in sorted(set(langs)):
                own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
                tally: dict[int, tuple] = {}
                for _, held in pieces(own):
                    for n, h in zip(LENGTHS, grams(np.concatenate(held)), strict=True):
                        v, c = np.unique(h[h != 0], return_counts=True)
                        old = tally.get(n)
                        if old is not None:
                            v, back = np.unique(np.concatenate([old[0], v]), return_inverse=True)
                            c = np.bincount(back, np.concatenate([old[1], c]), len(v)).astype(np.int64)
                        tally[n] = (v, c)
                for n, (v, c) in tally.items():
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(v)), pa.array(np.full(len(v), n, np.int32)), pa.array(v.view(np.int64)), pa.array(c.astype(np.int64))], names=["lang", "n", "gram", "c"])

    grams_of = sample.mapInArrow(counted, "lang string, n int, gram long, c long").groupBy("lang", "n", "gram").agg(F.sum("c").alias("c"))
    best = F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("c"), "gram"))
    table = grams_of.withColumn("r", best).where(F.col("r") <= keep).select("lang", "gram").toArrow()
    weight = {r[0]: r[1] for r in sample.groupBy("lang").count().collect()}
    languages = sorted(weight, key=lambda x: (-weight[x], x))
    slots, fill = np.zeros((-(-len(languages) // 64), 1 << slot_bits), U64), []
    names, hashes = np.array(table.column("lang").to_pylist(), object), table.column("gram").to_numpy().view(U64)
    for bit, lang in enumerate(languages):
        h, word = hashes[names == lang], slots[bit // 64]
        for j in range(probes):
            word[((h >> U64(20 * j)) & U64((1 << slot_bits) - 1)).astype(np.int64)] |= U64(1 << bit % 64)
        fill.append(float(((word >> U64(bit % 64)) & U64(1)).mean()))
    return Filters(languages, slots, np.array(fill), probes)


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """docs with any columns -> the same and lang_pred, score; columns of these names give way."""
    docs = docs.drop("lang_pred", "score")
    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    for f in schema:
        f.nullable = True

    def run(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, 1000):
                b = whole.slice(low, 1000)
                names, scores = filters.predict(b.column(b.schema.names.index("text")).to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*b.schema.names, "lang_pred", "score"])
        tidy()

    lean(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1


def trained(docs: DataFrame) -> Filters:
    """Filters learnt from text and lang of documents that are not held out."""
    return fit(docs.where(~F.coalesce(held_out(), F.lit(True)) & F.col("lang").isNotNull()).select("doc_id", "text", "lang"))


def op1_langid(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = identify(docs.select("doc_id", "text"), trained(docs))
    return got.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
