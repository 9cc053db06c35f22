"""The training-data operators against brute force, on small tables with every awkward case."""

import collections
import gzip
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from attesta.llm import op1_langid, op2_warc, op3_bpe, op4_packing, op5_topk, op6_suffix_dedup, op7_mixing, op8_ngram_join, op9_quality, op10_lsm_dedup, repeats, windows

DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans int, p int, kind string"


def prose(seed, n=120):
    r = np.random.default_rng(seed)
    syllables = ["an", "er", "the", "is", "ou", "ré", "st", "won", "tä", "li"]
    return " ".join("".join(r.choice(syllables, r.integers(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    passage, base = prose(1, 60), prose(2, 150)
    near = base.split()
    near[70] = "changed"
    texts = [None, "", "  \n\t ", "one", "Two words", base, base, " ".join(near), prose(3) + " " + passage, passage + " " + prose(4), prose(5) + "\n" + passage + "\n" + passage, "ab " * 500, "x" * 3000, "日本語テキスト" * 30, base.upper(), "a b c d", "A B c d", prose(6, 30000), "12345 !!! ###", "line one here\n" * 20]
    return [(i, t, ["en", "fr", None][i % 3], ["s1", "s2", None, "s1"][i % 4], 0, 1, 2, "k") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def cover_bytes(texts, width=100):
    seen, out = set(), {}
    for i, t in texts:
        cut = bytearray(len(t))
        for s in range(len(t) - width + 1):
            if t[s : s + width] in seen:
                cut[s : s + width] = b"\1" * width
            seen.add(t[s : s + width])
        out[i] = cut
    return out


def test_suffix_dedup(docs, rows, empty):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    cut = cover_bytes(texts)
    got = {r.doc_id: r for r in op6_suffix_dedup.remove_repeats(docs, carry=["lang", "spans"]).collect()}
    for i, t in texts:
        assert got[i].kept == bytes(x for x, c in zip(t, cut[i], strict=True) if not c), i
        assert len(got[i].spans) == len(re.findall(b"\x01+", bytes(cut[i])))
        assert got[i].carry.spans == 1
    assert op6_suffix_dedup.remove_repeats(empty).count() == 0


def test_lsm_dedup(docs, rows, empty):
    first, words = {}, {r[0]: (r[1] or "").encode().split() for r in rows}
    for i, w in words.items():
        for s in range(len(w) - 12):
            first.setdefault(tuple(w[s : s + 13]), i)
    for batches, fan in ((1, 4), (2, 4), (4, 4), (7, 2)):
        got = {r.doc_id: r for r in op10_lsm_dedup.remove_repeats(docs, batches=batches, fan=fan).collect()}
        for i, w in words.items():
            cut = bytearray(len(w))
            for s in range(len(w) - 12):
                if first[tuple(w[s : s + 13])] < i:
                    cut[s : s + 13] = b"\1" * 13
            assert got[i].n_words == len(w)
            assert got[i].kept.encode() == b" ".join(x for x, c in zip(w, cut, strict=True) if not c), i
    assert op10_lsm_dedup.remove_repeats(empty).count() == 0


def test_merge_join_against_sets():
    r = np.random.default_rng(3)
    for size in (0, 1, 400):
        pairs = sorted({(int(a), int(b)) for a, b in r.integers(0, 25, (size, 2))})
        fresh = sorted((int(a), int(b)) for a, b in r.integers(0, 30, (200, 2)))
        columns = lambda rows: tuple(np.asarray(x, np.uint64) for x in (zip(*rows, strict=True) if rows else ((), ())))
        same, near = windows.merge_join(columns(pairs), columns(fresh))
        assert same.tolist() == [f in set(pairs) for f in fresh]
        assert near.tolist() == [f[0] in {g for g, _ in pairs} for f in fresh]


def test_log_is_continued_from_its_folder(spark, docs, tmp_path):
    pairs, folder = docs.select("doc_id", "text"), f"file://{tmp_path}/log"
    points = repeats.split_points(pairs, op10_lsm_dedup.tokens, 13, op10_lsm_dedup.GRAM, 5)

    def words(intervals):
        return {(r.doc, r.start + i) for r in intervals.collect() for i in range(r["count"])}

    whole = words(op10_lsm_dedup.FingerprintLog(13, op10_lsm_dedup.GRAM, points).add(pairs, None))
    log, got = op10_lsm_dedup.FingerprintLog(13, op10_lsm_dedup.GRAM, points, fan=2), set()
    for low in range(-1, 20, 4):
        got |= words(log.add(pairs.where((F.col("doc_id") > low) & (F.col("doc_id") <= low + 4)), low + 4))
        log.save(spark, folder)
        log = op10_lsm_dedup.FingerprintLog.open(spark, folder, pairs.where(F.col("doc_id") <= low + 4))
        assert len({at for at, *_ in log.runs}) == len(log.runs)  # never two of a level, for two are merged
    assert got == whole
    with pytest.raises(ValueError, match="above"):
        log.add(pairs, None)


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80)])
def test_ngram_join(docs, rows, empty, n, percent):
    sets = {}
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))} if w else set()
    up = {i: i for i in sets}

    def find(x):
        return x if up[x] == x else find(up[x])

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    got = {r[0]: tuple(r)[1:] for r in op8_ngram_join.near_duplicates(docs, n, percent).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in sets}
    assert op8_ngram_join.near_duplicates(empty).count() == 0


def test_bpe(docs, rows, empty):
    import tiktoken

    path, pattern = op3_bpe.public()
    coder = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=op3_bpe.ranks(path), special_tokens={})
    got = {r.doc_id: r for r in op3_bpe.encode(docs, path, pattern).collect()}
    for i, t, *_ in rows:
        assert np.frombuffer(got[i].ids, "<u4").tolist() == coder.encode_ordinary(t or ""), i
        assert got[i].decoded == (t or "").encode()
    assert op3_bpe.encode(empty, path, pattern).count() == 0


def test_packing(docs, rows, empty):
    path, pattern = op3_bpe.public()
    packed = op4_packing.packed(docs, path, pattern, 256).collect()
    back = collections.defaultdict(dict)
    for r in packed:
        ids, at = np.frombuffer(r.ids, "<u4"), r.cu_seqlens
        assert len(ids) == r.n_tokens <= 256
        for s, a, z in zip(r.segments, at[:-1], at[1:], strict=True):
            assert z - a == s.length
            assert np.frombuffer(r.positions, "<u4")[a:z].tolist() == list(range(z - a))
            back[s.doc_id][s.part] = ids[a:z].tolist()
    for r in op3_bpe.encode(docs, path, pattern).collect():
        assert sum((back[r.doc_id][k] for k in sorted(back[r.doc_id])), []) == np.frombuffer(r.ids, "<u4").tolist()
    assert op4_packing.packed(empty, path, pattern).count() == 0


def test_best_fit():
    r = np.random.default_rng(0)
    lengths = sorted(r.integers(1, 65, 300).tolist(), reverse=True)
    room, want = [], []
    for i, n in enumerate(lengths):  # the plain method: least room that fits
        fits = [x for x in range(len(room)) if room[x] >= n]
        if not fits:
            room.append(64)
            want.append([])
            fits = [len(room) - 1]
        least = min(room[x] for x in fits)
        x = next(x for x in fits if room[x] == least)
        room[x] -= n
        want[x].append(i)
    got = op4_packing.pack(lengths, 64)
    assert sorted(map(sum, ([lengths[i] for i in x] for x in got))) == sorted(map(sum, ([lengths[i] for i in x] for x in want)))


def test_quality(docs, rows, empty):
    got = {r.doc_id: r for r in op9_quality.quality(docs).collect()}
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        c = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        rep = {k for j in range(len(w) - 2) if c[tuple(w[j : j + 3])] > 1 for k in (j, j + 1, j + 2)}
        lines = [x for x in (t or "").split("\n") if x.split()]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w))
        assert tuple(got[i])[1:7] == want, i
        assert not (got[i].base_failed and got[i].kept)
    assert op9_quality.quality(empty).count() == 0


def test_mixing(docs, rows, empty):
    got = op7_mixing.mix(docs).collect()
    size = {r[0]: len((r[1] or "").encode().split()) for r in rows}
    total, weight = collections.Counter(), {"s1": 5, "s2": 2, None: 1}
    for r in rows:
        total[r[3]] += size[r[0]]
    open_, left, target = dict(weight), 1.5 * sum(size.values()), {}
    while open_:
        full = [s for s in open_ if left * open_[s] / sum(open_.values()) > 2 * total[s]]
        if not full:
            target |= {s: left * w / sum(open_.values()) for s, w in open_.items()}
            break
        for s in full:
            target[s] = 2.0 * total[s]
        left -= sum(target[s] for s in full)
        open_ = {s: w for s, w in open_.items() if s not in full}
    taken = collections.Counter()
    for r in got:
        assert r.size == size[r.doc_id] and 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(target[r.source])
        taken[r.source] += r.taken
    assert {s: abs(taken[s] - target[s]) < 1 for s in target} == dict.fromkeys(target, True)
    again = op7_mixing.mix(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken, r.position or 0) for r in got) == sorted((r.doc_id, r.taken, r.position or 0) for r in again)
    assert op7_mixing.mix(empty).count() == 0


def test_langid(spark, empty):
    words = {"aa": ["kala", "moku", "tali", "neko"], "bb": ["strum", "vrolt", "gnist", "plyff"]}
    r = np.random.default_rng(3)
    rows = [(i, " ".join(r.choice(words[l], 20)), l) for i in range(120) for l in [["aa", "bb"][i % 2]]]
    rows += [(900, None, "aa"), (901, "123 !!", "bb"), (902, "kala moku tali " * 5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    f = op1_langid.trained(docs)
    got = {x.doc_id: x for x in op1_langid.identify(docs, f).collect()}
    assert all(got[i].lang_pred == l for i, _, l in rows if i < 200)
    assert [(got[i].lang_pred, got[i].score) for i in (900, 901)] == [("und", 0.0)] * 2
    assert got[902].lang_pred == "aa"
    held = {x.doc_id for x in docs.where(op1_langid.held_out()).collect()}
    assert held == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    nothing = op1_langid.trained(empty)
    assert {x.lang_pred for x in op1_langid.identify(docs, nothing).collect()} == {"und"}


def test_topk(spark):
    r = np.random.default_rng(5)
    v = [(i, [float(x) for x in r.normal(0, 1 + i % 3, 8)]) for i in range(300)]
    v += [(i, [1.0] * 8) for i in range(300, 420)] + [(500, None), (501, [1.0, None]), (502, [float("nan")] * 8), (503, [float("inf")] * 8), (520, [0.0] * 8), (540, [])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for x in op5_topk.top_k(df, F.col("vec_id") % 20 == 0, 7).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.score, x.vec_id))
    good = [(i, np.floor(64 * np.array([*x, *[0] * (8 - len(x))])).astype(int)) for i, x in v if x is not None and all(c is not None and np.isfinite(c) for c in x)]
    for i, q in good:
        if i % 20 == 0:
            assert got.pop(i) == [(s, j) for s, j in sorted(((int(q @ c), j) for j, c in good if j != i), key=lambda y: (-y[0], y[1]))[:7]]
    assert not got
    assert op5_topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_warc(spark):
    html = "<html><head><title>A &amp; B</title><script>var t='</p>';</script></head><body><p>One<br>two &lt;3</p><a href='/x'>link</a><!-- no --></body></html>"
    pages = spark.createDataFrame([(1, "http://e.org/", html, 0), (2, None, None, 0), (None, "u", "", 0)], "page_id long, url string, html string, kind int")
    rows = op2_warc.derivatives(pages)
    got = {(r.page_id, r.kind): r.asDict() for r in rows.collect()}
    assert len(got) == 6
    c, m = got[1, "conversion"], got[1, "metadata"]
    assert c["block"] == "One\ntwo <3\nlink" and "title: A & B" in m["block"] and "outlink: /x" in m["block"]
    assert c["refers_to"] == m["refers_to"] and c["concurrent_to"] == m["record_id"]
    assert m["source_digest"] == op2_warc.digest(html.encode())
    for r in op2_warc.members(rows).collect():
        ((head, block),) = op2_warc.parse(r.member)
        assert head["WARC-Block-Digest"] == op2_warc.digest(block) and gzip.decompress(r.member).endswith(b"\r\n\r\n")


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    got = corpus_pipeline.run(spark, sf).collect()
    assert got and all(len(r.ids) == 4 * r.n_tokens for r in got)
    assert hashlib.sha256(b"").hexdigest()
