"""Self-join of documents by Jaccard similarity of word n-grams, as components.

1. Documents become sets of 64-bit shingle hashes; documents with equal sets form a class and leave a task as one row.
   A class is listed under the tokens of its prefix: the ceil-bounded first part of its set in one global order, of
   which two sets of the asked similarity must share one. The order goes by a counting sketch of all shingles, rare
   ones first; any order is exact, this one keeps lists short. Sets of `LONG` shingles and more are listed under pairs
   of neighbours in their sorted set instead: unlike sets of that size often share one shingle and hardly ever two that
   have none between them, and at most as many runs of shared shingles as there are differences, and one, leave similar
   sets enough pairs for a prefix of pairs to hold one of both.
2. Under each token, classes are points: shingles are hashed into 16 groups and the group counts are coordinates. An
   R-tree (packed by size and coordinates, `LEAF` points a leaf, `FAN` children an inner node) is joined with itself
   from the root down: summed minima of coordinates, of boxes first and of points then, bound the overlap. Pairs that may reach the similarity are only united, so a list of m classes yields under
   m edges. All pairs that can be similar lie in one cluster of these edges.
3. Clusters fetch their sets and verify pairs exactly, again behind the point bound, and skip pairs already connected.
   Clusters over `BLOCK` classes or `WEIGHT` shingles are verified in pairs of blocks, each a task of its own.
4. Rows of one class point at the smallest id of the class in their own batch; one row for each batch and class, and not
   each member, goes on to the class, so that a class of a third of all rows gathers nowhere.

Defined cases: texts with fewer words than n are one shingle of all words; without words, or null, the set is empty and
linked with nothing; repeated rows and equal texts are one class; rows without doc_id are left out; rows that share a
doc_id share a component if either is linked; texts of any length; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import U64, Union, batches_of, by_bucket, components, mix, pack, partitions, stored, tidy, unpack, word_hashes
from attesta.llm.repeats import texts

GROUPS, LEAF, FAN, BLOCK, SLOTS = 16, 64, 16, 4096, 23
LONG, WEIGHT = 512, 1 << 21
#: Bytes of listed tokens, unpacked, that a task is to get, and of sets that a batch holds before they leave.
TASK_BYTES, SENT_BYTES = 48 << 20, 16 << 20
TOKENS, MEMBERS, ROWS, PAIRS = 0, 1, 2, 3
_MOVE = pa.schema([("p", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])
MOVE = "p int, kind int, blob binary"
_TOKEN = (np.uint32, np.uint64, np.int64, np.int32, *[np.int32] * GROUPS)  # half a token, print, doc, size, group counts
_PAIR = (np.uint32, np.uint64, np.int64, np.int32)  # half a pair, print, doc, size


def shingles(raw: bytes, n: int) -> np.ndarray:
    """The sorted set of hashes of n consecutive words, A-Z lowered."""
    words = word_hashes(np.frombuffer(raw, np.uint8), lower=True)[0]
    if not len(words):
        return words
    m = max(1, len(words) - n + 1)
    with np.errstate(over="ignore"):
        roll = words[:m].copy()
        for j in range(1, min(n, len(words))):
            roll = roll * U64(0xA0761D6478BD642F) + words[j : j + m]
        if len(words) < n:
            roll = roll + U64(len(words))
    return np.unique(mix(roll))


def fingerprint(tokens: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(mix((mix(tokens + U64(1)).sum() + U64(len(tokens))).reshape(1))[0])


def coordinates(tokens: np.ndarray) -> np.ndarray:
    return np.bincount((tokens & U64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)


def prefix(s: np.ndarray, often: np.ndarray, percent: int) -> np.ndarray:
    """Of a sorted set with the counts of its shingles, those that a similar set of under `LONG` may be met under."""
    return s[np.argsort(often, kind="stable")[: len(s) - -(-percent * len(s) // 100) + 1]]


def pair_prefix(s: np.ndarray, often: np.ndarray, percent: int) -> np.ndarray:
    """The same for pairs of neighbours in the sorted set, by the rarer shingle of each. Two similar sets share
    3 * overlap - both sizes - 1 pairs at least, which is least where one is `percent` of the other and inside it."""
    with np.errstate(over="ignore"):
        pairs = mix(s[:-1] * U64(0xA0761D6478BD642F) + s[1:])
    order = np.argsort(np.minimum(often[:-1], often[1:]), kind="stable")
    return pairs[order[: len(s) - -(-(2 * percent - 100) * len(s) // 100) + 1]]


def may_match(va, na, vb, nb, percent: int) -> np.ndarray:
    """Whether summed minima of counts leave room for the similarity. Box corners serve as well as points."""
    low, high = np.minimum(na, nb), np.maximum(na, nb)
    return ((100 + percent) * np.minimum(va, vb).sum(axis=-1) >= percent * (na + nb)) & (100 * low >= percent * high)


def unite(label: np.ndarray, row: int, others: np.ndarray) -> None:
    own = np.unique(np.append(label[others], label[row]))
    if len(own) > 1:
        label[np.isin(label, own)] = own[0]


class Node:
    """A box of the R-tree: the largest coordinates, the least and largest size under it, and rows or children."""

    def __init__(self, top, least: int, most: int, rows=None, children=()):
        self.top, self.least, self.most, self.rows, self.children = top, least, most, rows, children


def packed_tree(vec: np.ndarray, size: np.ndarray) -> Node:
    """Leaves are runs of points in order of size and then of the first coordinates; nodes are runs of nodes."""
    order = np.lexsort((vec[:, 1], vec[:, 0], size // 8))
    runs = (order[s : s + LEAF] for s in range(0, len(order), LEAF))
    level = [Node(vec[x].max(axis=0), size[x].min(), size[x].max(), rows=x) for x in runs]
    while len(level) > 1:
        parts = (level[s : s + FAN] for s in range(0, len(level), FAN))
        level = [Node(np.max([n.top for n in p], axis=0), min(n.least for n in p), max(n.most for n in p), children=p) for p in parts]
    return level[0]


def boxes_meet(a: Node, b: Node, percent: int) -> bool:
    """Whether points under a and b may match: the overlap is at most the summed minima of the largest coordinates, and
    at least what the smallest members would need."""
    overlap = int(np.minimum(a.top, b.top).sum())
    return (100 + percent) * overlap >= percent * (a.least + b.least) and 100 * b.most >= percent * a.least and 100 * a.most >= percent * b.least


def tree_join(vec: np.ndarray, size: np.ndarray, label: np.ndarray, percent: int) -> None:
    """Unites labels of points that may match, by a join of the tree with itself; pairs of nodes wait on a stack."""
    root = packed_tree(vec, size)
    due = [(root, root)]
    while due:
        a, b = due.pop()
        if not boxes_meet(a, b, percent):
            continue
        if a.rows is None:  # all leaves are on one level
            due += [(x, y) for i, x in enumerate(a.children) for y in (b.children[i:] if a is b else b.children)]
            continue
        rows, other = a.rows, b.rows
        if len(np.unique(np.concatenate([label[rows], label[other]]))) == 1:
            continue
        ok = may_match(vec[rows][:, None, :], size[rows][:, None], vec[other][None, :, :], size[other][None, :], percent)
        for i, r in enumerate(rows):
            hit = other[ok[i]]
            if len(hit):
                unite(label, r, hit)


def _sketch(docs: DataFrame, n: int) -> np.ndarray:
    """How often shingles occur over all documents: a count for each of 2**`SLOTS` hash slots, one byte on a scale that
    is exact up to 32 and logarithmic above, up to 10**9. Its size is fixed; a fuller sketch only makes prefixes less
    selective."""
    ranges = 64
    width = (1 << SLOTS) // ranges

    def count(batches):
        for b in batches:
            found = [(shingles(raw, n) >> U64(64 - SLOTS)).astype(np.uint32) for _, raw in texts(b)]
            slot, times = np.unique(np.concatenate([*found, np.empty(0, np.uint32)]), return_counts=True)
            del found
            edge = np.searchsorted(slot, np.arange(ranges + 1) * width)
            rows = [(x, pack(np.diff(slot[edge[x] : edge[x + 1]], prepend=np.uint32(0)), np.minimum(times[edge[x] : edge[x + 1]], 65535).astype(np.uint16))) for x in range(ranges) if edge[x] < edge[x + 1]]
            yield batches_of(_MOVE, p=[r[0] for r in rows], kind=[TOKENS] * len(rows), blob=[r[1] for r in rows])
        tidy()

    def total(batches):
        ranged: dict[int, np.ndarray] = {}  # added up as rows come, for they grow with the input
        for part in batches:
            for x, b in zip(part.column("p").to_pylist(), part.column("blob"), strict=True):
                step, times = unpack(b.as_buffer(), np.uint32, np.uint16)
                ranged.setdefault(x, np.zeros(width, np.int64))[np.cumsum(step, dtype=np.int64) - x * width] += times
        for x, sums in ranged.items():
            code = np.where(sums < 32, sums, np.minimum(255, 32 + 9 * np.log2(np.maximum(sums, 32) / 32))).astype(np.uint8)
            yield batches_of(_MOVE, p=[x], kind=[TOKENS], blob=[code.tobytes()])

    out = np.zeros(1 << SLOTS, np.uint8)
    for r in docs.mapInArrow(count, MOVE).repartition(partitions(docs.sparkSession), "p").mapInArrow(total, MOVE).collect():  # 64 rows
        out[r["p"] * width : (r["p"] + 1) * width] = np.frombuffer(r["blob"], np.uint8)
    return out


def _tasks(sketch: np.ndarray, percent: int, least: int) -> int:
    """Tasks among which the sets behind a sketch are dealt: a task's share stays the same however large the input and
    whatever number the session has for its shuffles, which is only the least."""
    code = np.arange(256)
    shingled = np.bincount(sketch, minlength=256) @ np.where(code < 32, code, 32 * 2.0 ** ((code - 32) / 9))
    listed = shingled * (100 - percent) / 100 * sum(np.dtype(x).itemsize for x in _TOKEN)
    return max(least, int(np.ceil(listed / TASK_BYTES)))


def _dealt(lists: list[np.ndarray], buckets: int, columns: tuple):
    """Bucket and packed rows (half a token, columns of its set) of the tokens of each set."""
    rep = np.repeat(np.arange(len(lists)), [len(t) for t in lists])
    flat = np.concatenate(lists)
    bucket = ((flat & U64((1 << 32) - 1)) // U64(GROUPS) % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for x in range(buckets):
        o = order[edge[x] : edge[x + 1]]
        if len(o):
            yield x, pack((flat[o] >> U64(32)).astype(np.uint32), *(c[rep[o]] for c in columns))


def _scan(docs: DataFrame, n: int, percent: int, buckets: int, sketch) -> DataFrame:
    # from sets that may match a long one on; at low similarities few pairs are shared, so all sets go by shingles
    long = LONG if percent >= 60 else np.iinfo(np.int64).max
    meets_long = -(-percent * long // 100)

    def run(batches):
        often = sketch.value
        for b in batches:
            members: list[tuple[int, int, int]] = []  # doc, print, size
            least: dict[tuple[int, int], int] = {}
            few: dict[tuple[int, int], tuple] = {}
            many: dict[tuple[int, int], np.ndarray] = {}
            for doc, raw in texts(b):
                s = shingles(raw, n)
                if not len(s):
                    members.append((doc, 0, 0))
                    continue
                key = (fingerprint(s), len(s))
                members.append((doc, *key))
                if key not in least:
                    seen = often[(s >> U64(64 - SLOTS)).astype(np.int64)]
                    if len(s) < long:
                        few[key] = prefix(s, seen, percent), coordinates(s)
                    if len(s) >= meets_long:
                        many[key] = pair_prefix(s, seen, percent)
                least[key] = min(doc, least.get(key, doc))
            p, kind, blob = [], [], []
            for what, sets in ((TOKENS, few), (PAIRS, many)):
                if sets:
                    columns = np.array([k[0] for k in sets], U64), np.array([least[k] for k in sets], np.int64), np.array([k[1] for k in sets], np.int32)
                    lists = list(sets.values())
                    if what == TOKENS:
                        columns += tuple(np.array([v for _, v in lists], np.int32).T)
                        lists = [t for t, _ in lists]
                    for x, packed in _dealt(lists, buckets, columns):
                        p.append(x)
                        kind.append(what)
                        blob.append(packed)
            if members:
                own = np.array([(d, least.get((fp, n), d), n) for d, fp, n in members], np.int64)
                p.append(int(mix(own[:1, 0].view(U64))[0] % U64(buckets)))
                kind.append(ROWS)
                blob.append(pack(*own.T))
            classes = np.array([(fp, n) for fp, n in least], U64).reshape(-1, 2)
            ids = np.array(list(least.values()), np.int64)
            bucket = (classes[:, 0] % U64(buckets)).astype(np.int64)
            for x in np.unique(bucket):
                own = bucket == x
                p.append(int(x))
                kind.append(MEMBERS)
                blob.append(pack(ids[own], classes[own, 0], classes[own, 1].astype(np.int64)))
            yield batches_of(_MOVE, p=p, kind=kind, blob=blob)
        tidy()

    return docs.mapInArrow(run, MOVE)


def _listed(rows: list[bytes], percent: int):
    """Edges (doc, doc) that connect what may be similar among the classes listed under this bucket's tokens."""
    tok, name, doc, first, cols = _named(rows, _TOKEN)
    if not len(tok):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    size, vec = cols[3][first].astype(np.int64), np.stack([c[first] for c in cols[4:]], axis=1).astype(np.int64)
    del cols
    cut = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1], [True]]))
    forest = Union(len(first))
    length = np.diff(cut)
    two = cut[:-1][length == 2]
    a, b = name[two], name[two + 1]
    ok = may_match(vec[a], size[a], vec[b], size[b], percent)
    for x, y in zip(a[ok].tolist(), b[ok].tolist(), strict=True):
        forest.join(x, y)
    for s, m in zip(cut[:-1][length > 2], length[length > 2], strict=True):
        own = name[s : s + m]
        part = np.array([forest.find(x) for x in own.tolist()])
        if (part != part[0]).any():
            mine = np.unique(part, return_inverse=True)[1]
            tree_join(vec[own], size[own], mine, percent)
            order = np.argsort(mine, kind="stable")
            for x, y in zip(order[:-1].tolist(), order[1:].tolist(), strict=True):
                if mine[x] == mine[y]:
                    forest.join(int(part[x]), int(part[y]))
    return _edges(forest, doc)


def _named(rows: list[bytes], kinds: tuple):
    """Of packed rows (token, print, doc, size, ...): token and class of each entry of a list of several classes, in order of
    both, the smallest doc and a row of each class, and the columns."""
    cols = [np.concatenate(x) for x in zip(*(unpack(b, *kinds) for b in rows), strict=True)]
    order = np.lexsort((cols[3], cols[1]))
    fp, size = cols[1][order], cols[3][order]
    fresh = np.concatenate([[True], (fp[1:] != fp[:-1]) | (size[1:] != size[:-1])])
    first, name = order[fresh], np.empty(len(order), np.int64)
    name[order] = np.cumsum(fresh) - 1
    doc = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(doc, name, cols[2])
    order = np.lexsort((name, cols[0]))
    tok, name = cols[0][order], name[order]
    fresh = np.concatenate([[True], (tok[1:] != tok[:-1]) | (name[1:] != name[:-1])])
    tok, name = tok[fresh], name[fresh]
    shared = np.concatenate([[False], tok[1:] == tok[:-1]])
    shared[:-1] |= shared[1:]
    used, name = np.unique(name[shared], return_inverse=True)
    return tok[shared], name, doc[used], first[used], cols


def _edges(forest: Union, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each class to the smallest doc of its tree."""
    label = np.array([forest.find(x) for x in range(len(doc))], np.int64)
    head = np.full(len(doc), np.iinfo(np.int64).max)
    np.minimum.at(head, label, doc)
    root = head[label]
    moved = root != doc
    return doc[moved], root[moved]


def _listed_pairs(rows: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for lists of pairs. In order of size, sets that may match are joined by neighbours that may."""
    tok, name, doc, first, cols = _named(rows, _PAIR)
    size = cols[3][first].astype(np.int64)
    order = np.lexsort((size[name], tok))
    tok, name = tok[order], name[order]
    forest = Union(len(doc))
    ok = np.flatnonzero((tok[1:] == tok[:-1]) & (100 * size[name[:-1]] >= percent * size[name[1:]]))
    for x, y in zip(name[ok].tolist(), name[ok + 1].tolist(), strict=True):
        forest.join(x, y)
    return _edges(forest, doc)


def _verify(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """The smallest id that each class reaches by verified links."""
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    ids, sets, size = ids[order], [sets[i] for i in order], size[order]
    words, flat = np.unique(np.concatenate(sets), return_inverse=True)
    edge = np.concatenate([[0], np.cumsum(size)])
    vec = np.array([coordinates(s) for s in sets])
    label, mark = np.arange(len(ids)), np.zeros(len(words), np.int32)
    for i in range(len(ids) - 1):
        stop = int(np.searchsorted(size, 100 * size[i] // percent, "right"))
        near = np.arange(i + 1, stop)
        near = near[label[near] != label[i]]
        near = near[may_match(vec[i], size[i], vec[near], size[near], percent)]
        if not len(near):
            continue
        own = flat[edge[i] : edge[i + 1]]
        mark[own] = 1
        at = np.concatenate([[0], np.cumsum(size[near])])
        where = np.repeat(edge[near] - at[:-1], size[near]) + np.arange(at[-1])
        both = np.add.reduceat(mark[flat[where]], at[:-1])
        mark[own] = 0
        hit = near[100 * both >= percent * (size[i] + size[near] - both)]
        if len(hit):
            unite(label, i, hit)
    head = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(head, label, ids)
    out = np.empty(len(ids), np.int64)
    out[order] = head[label]
    return out


def near_duplicates(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_shingles, component_id: a row for each row with a doc_id."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = _sketch(docs, n)
    buckets = parts = _tasks(counted, percent, partitions(spark))

    def told(kind: int, a, b, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(np.ascontiguousarray(a)), pa.array(np.ascontiguousarray(b)), pa.array(n)], names=["kind", "a", "b", "n"])

    def settle(batches):
        for rows in by_bucket(batches).values():
            for a, b, n in (unpack(b, np.int64, np.int64, np.int64) for kind, b in rows if kind == ROWS):
                yield told(ROWS, a, b, n)
            members = [unpack(b, np.int64, np.uint64, np.int64) for kind, b in rows if kind == MEMBERS]
            if members:
                doc, fp, size = (np.concatenate(x) for x in zip(*members, strict=True))
                o = np.lexsort((doc, size, fp))
                doc, fp, size = doc[o], fp[o], size[o]
                head = np.concatenate([[True], (fp[1:] != fp[:-1]) | (size[1:] != size[:-1])])
                rep = doc[np.maximum.accumulate(np.where(head, np.arange(len(doc)), 0))]
                moved = np.unique(np.stack([doc, rep], axis=1)[rep != doc], axis=0)
                yield told(MEMBERS, moved[:, 0], moved[:, 1], np.zeros(len(moved), np.int64))
            for kind, joined in ((TOKENS, _listed), (PAIRS, _listed_pairs)):
                listed = [b for k, b in rows if k == kind]
                if listed:
                    a, b = joined(listed, percent)
                    yield told(TOKENS, a, b, np.zeros(len(a), np.int64))
        tidy()

    sketch = spark.sparkContext.broadcast(counted)
    del counted
    found = stored(_scan(docs, n, percent, buckets, sketch).repartition(parts, "p").mapInArrow(settle, "kind int, a long, b long, n long"))
    sketch.destroy()  # what it served for is written
    tidy()
    clusters = stored(components(found.where(F.col("kind") == TOKENS).select("a", "b")))
    sizes = found.where((F.col("kind") == ROWS) & (F.col("a") == F.col("b"))).groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    parted = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / WEIGHT)).cast("int")
    counts = stored(clusters.join(sizes, "id").groupBy("root").agg(parted.alias("blocks")))
    most = counts.agg(F.max("blocks")).first()[0] or 0
    blocks = F.col("blocks")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    # a class of a large cluster goes to each pair of blocks that holds its own
    pair = F.struct(F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"))
    member = clusters.join(counts, "root").select("id", "root", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("o")).select("id", "root", pair.alias("pair")).groupBy("id", "root").agg(F.collect_set("pair").alias("pairs"))

    def fetch(batches):
        def sent(at: dict[int, list]) -> pa.RecordBatch:
            p, blob = [], []
            for k, rows in at.items():
                head = pack(*(np.array([r[c] for r in rows], np.int64) for c in range(4)), np.array([len(r[4]) for r in rows], np.int64))
                p.append(k)
                blob.append(len(head).to_bytes(8, "little") + head + pack(np.concatenate([r[4] for r in rows])))
            return batches_of(_MOVE, p=p, kind=[TOKENS] * len(p), blob=blob)

        for b in batches:
            roots, pairs = b.column("root").to_pylist(), b.column("pairs").to_pylist()
            at: dict[int, list] = {}
            held = 0
            for (doc, raw), root, many in zip(texts(b), roots, pairs, strict=True):
                s = shingles(raw, n)
                for x in many:
                    key = np.array([root, x["i"], x["j"]], np.int64).view(U64)
                    at.setdefault(int(mix(key + U64(7) * np.arange(3, dtype=U64)).sum() % U64(buckets)), []).append((root, x["i"], x["j"], doc, s))
                    held += s.nbytes
                    if held > SENT_BYTES:  # a set of a large cluster leaves once for each pair of blocks
                        yield sent(at)
                        at, held = {}, 0
            yield sent(at)
        tidy()

    def verify(batches):
        for rows in by_bucket(batches).values():
            heads, bodies = [], []
            for _, b in rows:
                k = int.from_bytes(b[:8], "little")
                heads.append(unpack(b[8 : 8 + k], *[np.int64] * 5))
                bodies.append(unpack(b[8 + k :], np.uint64)[0])
            root, i, j, doc, size = (np.concatenate(x) for x in zip(*heads, strict=True))
            flat, edge = np.concatenate(bodies), np.concatenate([[0], np.cumsum(size)])
            order = np.lexsort((doc, j, i, root))
            cut = np.flatnonzero(np.concatenate([[True], (np.diff(root[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0), [True]]))
            for a, z in zip(cut[:-1], cut[1:], strict=True):
                own = order[a:z]
                reach = _verify(doc[own], [flat[edge[x] : edge[x + 1]] for x in own], percent)
                yield pa.RecordBatch.from_arrays([pa.array(doc[own]), pa.array(reach)], names=["id", "root"])
        tidy()

    text = docs.join(member.withColumnRenamed("id", "doc_id").hint("merge"), "doc_id")
    linked = text.mapInArrow(fetch, MOVE).repartition(parts, "p").mapInArrow(verify, "id long, root long")
    if most > 1:
        linked = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    else:
        linked = linked.groupBy("id").agg(F.min("root").alias("root"))
    # ids that are not their own component: classes' ids in a batch by way of the class, and linked classes
    moved = found.where(F.col("kind") == MEMBERS).select("a", "b").distinct().join(linked.withColumnRenamed("id", "b"), "b", "left").select(F.col("a").alias("id"), F.coalesce("root", "b").alias("root"))
    at = moved.unionByName(linked.where("root <> id"))
    rows = found.where(F.col("kind") == ROWS).select(F.col("a").alias("doc_id"), F.col("b").alias("id"), F.col("n").alias("n_shingles"))
    return rows.join(at, "id", "left").select("doc_id", "n_shingles", F.coalesce("root", "id").alias("component_id"))


def op8_ngram_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
