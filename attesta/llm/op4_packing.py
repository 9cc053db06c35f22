"""Best-fit-decreasing packing of token ids into rows of one capacity.

A task pools the pieces of its own documents, up to `POOL` tokens, so no ids are shuffled. Documents over the capacity
are split into full pieces and a rest, losing nothing. Pieces are placed in order of decreasing length, each in the
open row whose room is the least that fits; a segment tree over room sizes finds it in log2(capacity) steps. Rows carry
the ids matrix row, cumulative segment lengths and position ids that start anew with each segment.

Defined cases: null and empty texts have no ids and appear in no row; repeated rows are packed each; a text of any
length; ties in length by doc_id and part; a row's name is its first piece, so names are unique where doc_id is; extra columns are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CAPACITY, POOL, WORDS = 2048, 1 << 22, 500_000
_PIECE = pa.struct([("doc_id", pa.int64()), ("part", pa.int32()), ("length", pa.int32())])
_OUT = pa.schema([("row_id", pa.string()), ("n_tokens", pa.int64()), ("segments", pa.list_(_PIECE)), ("cu_seqlens", pa.list_(pa.int32())), ("ids", pa.binary()), ("positions", pa.binary())])
OUT = "row_id string, n_tokens long, segments array<struct<doc_id: long, part: int, length: int>>, cu_seqlens array<int>, ids binary, positions binary"


class Rooms:
    """Open rows by remaining room, and a segment tree of how many rows have each room."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def add(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        at = room + self.leaves
        while at:
            self.tree[at] += 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """The smallest room of at least `least` and a row that has it, which is removed."""
        at, tree = least + self.leaves, self.tree
        while not tree[at]:
            while at & 1:  # a right child: the next range is to the right of the parent
                at >>= 1
                if at <= 1:
                    return None
            at += 1
        while at < self.leaves:
            at *= 2
            if not tree[at]:
                at += 1
        room = at - self.leaves
        row = self.rows[room].pop()
        while at:
            tree[at] -= 1
            at >>= 1
        return room, row


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Rows of piece numbers. lengths: 1 to capacity, in descending order."""
    rooms, rows = Rooms(capacity), []
    for i, n in enumerate(lengths):
        found = rooms.take(n)
        if found is None:
            rows.append([i])
            found = capacity, len(rows) - 1
        else:
            rows[found[1]].append(i)
        if found[0] > n:
            rooms.add(found[0] - n, found[1])
    return rows


class _Known(dict):
    """Ids of words as bytes, found when first asked for; starts anew after `WORDS` words."""

    def __init__(self, have: dict[bytes, int], merge):
        self.have, self.merge = have, merge

    def __missing__(self, word: str) -> bytes:
        if len(self) > WORDS:
            self.clear()
        raw = word.encode()
        ids = self[word] = np.array([self.have[raw]] if raw in self.have else self.merge(raw), "<u4").tobytes()
        return ids


def packed(docs: DataFrame, path: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """docs (doc_id, text) -> packed rows of the ids of the byte-level vocabulary at path."""

    def run(batches):
        import regex
        import tiktoken

        from attesta.llm.op3_bpe import ranks

        have = ranks(path)
        coder = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=have, special_tokens={})
        find = regex.compile(pattern).findall
        known = _Known(have, coder._encode_single_piece)
        count = np.arange(capacity, dtype="<u4").tobytes()
        pool, size = [], 0

        def flush():
            nonlocal pool, size
            pool.sort(key=lambda x: (-len(x[2]), x[0] is None, x[0] or 0, x[1]))
            rows = pack([len(x[2]) // 4 for x in pool], capacity)
            for low in range(0, len(rows), 256):
                out = []
                for row in rows[low : low + 256]:
                    own = [pool[i] for i in row]
                    n = [len(x[2]) // 4 for x in own]
                    out.append((f"{own[0][0]}.{own[0][1]}", sum(n), [{"doc_id": x[0], "part": x[1], "length": m} for x, m in zip(own, n, strict=True)], list(accumulate(n, initial=0)), b"".join(x[2] for x in own), b"".join(count[: 4 * m] for m in n)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _OUT, strict=True)], schema=_OUT)
            pool, size = [], 0

        for b in batches:
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = b"".join(map(known.__getitem__, find(text or "")))
                for part, at in enumerate(range(0, len(ids), 4 * capacity)):
                    pool.append((doc, part, ids[at : at + 4 * capacity]))
                size += len(ids) // 4
                if size >= POOL:
                    yield from flush()
        yield from flush()

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, OUT)


def matrix(rows: list[bytes], capacity: int = CAPACITY, pad: int = 0) -> np.ndarray:
    """Packed rows as one id matrix, padded at the right."""
    out = np.full((len(rows), capacity), pad, np.uint32)
    for i, raw in enumerate(rows):
        ids = np.frombuffer(raw, "<u4")
        out[i, : len(ids)] = ids
    return out


def op4_packing(spark, sf_dir: str) -> DataFrame:
    from attesta.llm.op3_bpe import public

    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), *public())
