"""Byte-level BPE: encoding by a fold of ranked merges over the bytes of distinct words, decoding by joining pieces.

The merges run in Spark's higher-order functions. A task reads its texts once, cuts them by the tokenizer's pattern and
emits each distinct word the first time it meets it, then its documents as word numbers; both stay in order in one
stage, so nothing is shuffled and a lost executor costs one task. Each word is folded: `zip_with` looks the rank of
every adjacent pair up in a literal map, `array_min` finds the first merge, `slice` and `concat` apply it. The map is
a sparse table by row displacement: one row for each left token, all rows laid over one another in one array, so a
lookup is two array reads. The last step joins word ids to documents and joins the vocabulary's pieces back to bytes.

Words longer than `LONG` bytes would make the fold quadratic; they take a heap-based merge with the same result.

Defined cases: a null or empty text has no ids; no special tokens; texts of any length; the dictionary of a task starts
anew after `WORDS` words, which bounds memory; repeated rows are encoded alike; other columns ride along unread, and one
named like an output gives way to it.
"""

from __future__ import annotations

import base64
import heapq
import json
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.llm.common import batches_of, lean, tidy

LONG, WORDS = 256, 1_000_000
VOCABULARY = "byte_bpe_50k.tiktoken"
_TABLE = 1 << 19
_MASK = (1 << 62) - 1


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in f if line.strip())}


@cache
def pair_table(path: str) -> tuple[str, str]:
    """Row displacements and the shared table as JSON. Entry: left token * 65536 + rank of the merged pair."""
    have = ranks(path)
    left, right, made = [], [], []
    for word, rank in have.items():
        for cut in range(1, len(word)):
            a, b = have.get(word[:cut]), have.get(word[cut:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                made.append(rank)
    order = np.argsort(np.array(left), kind="stable")
    left, right, made = (np.array(x, np.int64)[order] for x in (left, right, made))
    rows, first, size = np.unique(left, return_index=True, return_counts=True)
    table, taken, shift = np.full(_TABLE, -1, np.int64), np.zeros(_TABLE, bool), np.zeros(int(rows.max()) + 1, np.int64)
    draw = np.random.default_rng(0)
    for j in np.argsort(-size, kind="stable"):
        cells = right[first[j] : first[j] + size[j]]
        while True:
            tries = draw.integers(0, _TABLE - (1 << 16), 64)
            free = ~taken[tries[:, None] + cells].any(axis=1)
            if free.any():
                break
        at = int(tries[free.argmax()])
        taken[at + cells], shift[rows[j]] = True, at
        table[at + cells] = (rows[j] << 16) | made[first[j] : first[j] + size[j]]
    # a free cell is -1 and no spaces are written: the plan and its printed forms hold this text, in the driver
    return tuple(json.dumps(x.tolist(), separators=(",", ":")) for x in (shift, table))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(word: Column, path: str) -> Column:
    """array<int> of the ranks of a word's bytes -> array<int> of its token ids."""
    shift, table = (F.from_json(F.lit(x), kind) for x, kind in zip(pair_table(path), ("array<int>", "array<bigint>"), strict=True))

    def rank(a: Column, b: Column) -> Column:
        # what lies in the cell, less this row's mark: the rank if the cell is this row's, 65536 or more if not
        return (F.get(table, F.get(shift, a) + b) - F.shiftleft(a.cast("bigint"), 16)).bitwiseAND(F.lit(_MASK))

    def step(state: Column, _: Column) -> Column:
        ids = state["ids"]

        def merge(best: Column) -> Column:
            i = best["at"]
            joined = F.concat(F.slice(ids, F.lit(1), i - 1), F.array(best["rank"].cast("int")), F.slice(ids, i + 2, F.lit(LONG)))
            return F.when(best["rank"] < 65536, F.struct(joined.alias("ids"), F.lit(False).alias("done"))).otherwise(F.struct(ids.alias("ids"), F.lit(True).alias("done")))

        def first(found: Column) -> Column:
            least = F.array_min(found)
            return _let(F.struct(least.alias("rank"), F.array_position(found, least).cast("int").alias("at")), merge)

        return F.when(state["done"], state).otherwise(_let(F.zip_with(ids, F.slice(ids, F.lit(2), F.lit(LONG)), rank), first))

    return F.aggregate(word, F.struct(word.alias("ids"), F.lit(False).alias("done")), step, lambda s: s["ids"])


def merge_long(word: bytes, have: dict[bytes, int]) -> list[int]:
    """The same merges with a heap of pairs and links between neighbours."""
    n = len(word)
    part = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(have[p], i) for i in range(n - 1) if (p := part[i] + part[i + 1]) in have]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if not part[i] or j >= n or have.get(part[i] + part[j]) != rank:
            continue
        part[i], part[j] = part[i] + part[j], b""
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (r := have.get(part[a] + part[b])) is not None:
                heapq.heappush(heap, (r, a))
    return [have[p] for p in part if p]


class _Numbers(dict):
    """Numbers words as they come; `new` gathers those not seen before."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        self.new.append(word)
        return at


_MIDDLE = pa.schema([("carry", pa.binary()), ("word", pa.list_(pa.int32())), ("long", pa.binary()), ("numbers", pa.binary())])


def encode(docs: DataFrame, path: str, pattern: str, known_words: int = WORDS) -> DataFrame:
    """docs (any columns, text among them) -> the same columns with ids (binary: little-endian unsigned 32-bit),
    n_tokens and decoded (binary); columns of these names give way. known_words: the size at which a task's dictionary
    starts anew."""
    docs = docs.drop("ids", "n_tokens", "decoded")
    schema = docs.schema
    text_at = schema.names.index("text")

    def words(batches):
        import regex

        find, have = regex.compile(pattern).findall, ranks(path)
        byte_rank = np.array([have[bytes([i])] for i in range(256)], np.int32)
        known = _Numbers()
        for b in batches:
            for low in range(0, b.num_rows, 500):
                part = b.slice(low, 500)
                fresh = len(known) > known_words
                if fresh:
                    known = _Numbers()
                known.new = []
                numbers = [np.fromiter(map(known.__getitem__, find(t)), np.int32).tobytes() if t else b"" for t in part.column(text_at).to_pylist()]
                # a null number of a null word tells the other side to start anew
                new = [w.encode() for w in known.new]
                # a word of the vocabulary is one token from the start, even if no merges lead to it
                short = [b"" if len(w) > LONG else b"." if w in have else w for w in new]
                edge = np.concatenate([[0], np.cumsum([len(w) for w in short])]).astype(np.int32)
                flat = byte_rank[np.frombuffer(b"".join(short), np.uint8)]
                one = [i for i, w in enumerate(new) if w in have and len(w) <= LONG]
                flat[edge[one]] = [have[new[i]] for i in one]
                body = pa.ListArray.from_arrays(pa.array(edge), pa.array(flat))
                if fresh:
                    yield batches_of(_MIDDLE, carry=[None], word=[None], long=[None], numbers=[None])
                for a in range(0, len(new), 10_000):
                    own = body.slice(a, 10_000)
                    long = pa.array([w if len(w) > LONG else None for w in new[a : a + 10_000]], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(own), pa.binary()), own, long, pa.nulls(len(own), pa.binary())], schema=_MIDDLE)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as w:
                    w.write_batch(part)
                rows = len(numbers)
                whole = [sink.getvalue().to_pybytes()] + [None] * (rows - 1)
                yield pa.RecordBatch.from_arrays([pa.array(whole, pa.binary()), pa.nulls(rows, _MIDDLE.field("word").type), pa.nulls(rows, pa.binary()), pa.array(numbers, pa.binary())], schema=_MIDDLE)

    def assemble(batches):
        have = ranks(path)
        piece = [b""] * (max(have.values()) + 1)
        for w, r in have.items():
            piece[r] = w
        flat, size, chunks = np.empty(0, np.int32), np.empty(0, np.int64), []
        rows, due = None, []
        offset = np.zeros(1, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            word, long, numbers, carry = (b.column(b.schema.names.index(n)) for n in ("word", "long", "numbers", "carry"))
            # runs of words and of documents in turn
            is_doc = numbers.is_valid().to_numpy(zero_copy_only=False)
            is_word = word.is_valid().to_numpy(zero_copy_only=False)
            kind = is_doc.astype(np.int8) - is_word.astype(np.int8)
            cut = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
            for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(kind)], strict=True):
                if kind[a] == 0:
                    flat, size, chunks, offset = flat[:0], size[:0], [], np.zeros(1, np.int64)
                elif kind[a] < 0:
                    own = word.slice(a, z - a)
                    count = own.value_lengths().to_numpy().astype(np.int64)
                    ids = own.flatten().to_numpy()
                    extra = long.slice(a, z - a)
                    if extra.null_count < len(extra):
                        parts = np.split(ids, np.cumsum(count)[:-1])
                        for i, w in enumerate(extra.to_pylist()):
                            if w is not None:
                                parts[i] = np.array([have[w]] if w in have else merge_long(w, have), np.int32)
                                count[i] = len(parts[i])
                        ids = np.concatenate(parts)
                    chunks.append((ids, count))
                else:
                    if chunks:
                        flat = np.concatenate([flat, *(c[0] for c in chunks)])
                        size = np.concatenate([size, *(c[1] for c in chunks)])
                        chunks = []
                        offset = np.concatenate([[0], np.cumsum(size)])
                    for raw, head in zip(numbers.slice(a, z - a).to_pylist(), carry.slice(a, z - a).to_pylist(), strict=True):
                        if head is not None:
                            rows, due = pa.ipc.open_stream(head).read_all().combine_chunks().to_batches()[0], []
                        at = np.frombuffer(raw, np.int32)
                        n = size[at]
                        end = np.cumsum(n)
                        total = int(end[-1]) if len(end) else 0
                        due.append(flat[np.repeat(offset[at] - end + n, n) + np.arange(total)] if total else flat[:0])
                        if len(due) == rows.num_rows:
                            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([x.astype("<u4").tobytes() for x in due], pa.binary()), pa.array([len(x) for x in due], pa.int64()), pa.array([b"".join(map(piece.__getitem__, x.tolist())) for x in due], pa.binary())], names=[*rows.schema.names, "ids", "n_tokens", "decoded"])
        tidy()

    lean(docs.sparkSession)
    pair_table(path)
    tidy()
    middle = docs.mapInArrow(words, "carry binary, word array<int>, long binary, numbers binary")
    middle = middle.select("carry", fold(F.col("word"), path).alias("word"), "long", "numbers")
    out = T.StructType([*(T.StructField(f.name, f.dataType) for f in schema), T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.BinaryType())])
    return middle.mapInArrow(assemble, out)


def fewer_tasks(docs: DataFrame, mb: int = 80) -> DataFrame:
    """docs in partitions of about mb of input, for longer tasks meet fewer words for the first time; never fewer
    partitions than cores, and no shuffle."""
    spark = docs.sparkSession
    part = spark.conf.get("spark.sql.files.maxPartitionBytes").lower()
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}
    split = int("".join(filter(str.isdigit, part))) * next((v for k, v in unit.items() if k in part), 1)
    now = docs.rdd.getNumPartitions()
    return docs.coalesce(min(now, max(spark.sparkContext.defaultParallelism, -(-now * split // (mb << 20)))))


def public(name: str = VOCABULARY) -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op3_bpe(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = encode(fewer_tasks(docs), *public())
    return got.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
