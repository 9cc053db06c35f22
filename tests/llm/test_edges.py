"""Clashing names, other types, repeated and null ids, and the far side of every size switch."""

import collections
import gzip
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from attesta.llm import common, op1_langid, op2_warc, op3_bpe, op4_packing, op5_topk, op6_suffix_dedup, op7_mixing, op8_ngram_join, op9_quality, op10_lsm_dedup, repeats
from attesta.llm.queries import QUERIES


def prose(seed, n=60):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(list("abcdefghij"), r.integers(3, 9))) for _ in range(n))


def test_more_than_64_languages(spark):
    words = {f"l{i:03d}": [prose(1000 + 7 * i + j, 1) for j in range(7)] for i in range(130)}
    rows = [(100 * i + j, " ".join(w[(j + x) % 7] for x in range(40)), lang) for i, (lang, w) in enumerate(words.items()) for j in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    f = op1_langid.fit(docs, slot_bits=16)
    assert len(f.languages) == 130 and f.slots.shape[0] == 3
    got = {x.doc_id: x.lang_pred for x in op1_langid.identify(docs, f).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) >= 0.99 * len(rows)


def test_masks_against_plain_sets(spark):
    texts = [("aa", "kala moku tali neko"), ("bb", "strum vrolt gnist plyff"), ("cc", "moku strum oeuvre")]
    f = op1_langid.fit(spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string"))

    def plain(text):
        return {g for _, held in op1_langid.pieces([text]) for h in op1_langid.grams(np.concatenate(held)) for g in h[h != 0].tolist()}

    sets = {lang: plain(t) for lang, t in texts}
    probe = sorted(set().union(*sets.values()) | plain("something else altogether"))
    for gram, mask in zip(probe, f.masks(np.array(probe, np.uint64)).tolist(), strict=True):
        held = {lang for i, lang in enumerate(f.languages) if mask >> i & 1}
        assert {lang for lang, s in sets.items() if gram in s} <= held  # a filter may hold more, never less
    names, scores = f.predict([t for _, t in texts])
    assert names == [lang for lang, _ in texts] and min(scores) > 0.99
    # 64 * share of wrong bits is subtracted: text of no language scores near zero
    assert f.predict([prose(5, 400).upper()])[1][0] < 0.2


def test_a_doc_id_repeated_without_end_is_one_of_the_sample(spark):
    rows = [(7, "kala moku", "aa")] * 3000 + [(i, "strum vrolt", "bb") for i in range(100, 130)]
    f = op1_langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=20)
    assert f.languages == ["bb", "aa"]


def test_clashing_names_give_way(spark):
    rows = [(1, "some text", "en", 5.0, "x")]
    a = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, lang_pred string")
    got = op1_langid.identify(a, op1_langid.trained(a)).collect()[0]
    assert got.lang_pred in ("en", "und") and 0 <= got.score <= 1
    b = spark.createDataFrame([(1, "some text", "a", 2, "c")], "doc_id long, text string, ids string, n_tokens int, decoded string")
    assert op3_bpe.encode(b, *op3_bpe.public()).first().decoded == b"some text"
    c = spark.createDataFrame([(1, "some text", 1, 2, 3, 4, 5)], "doc_id int, text string, kept int, spans int, cut int, kind int, p int")
    assert op6_suffix_dedup.remove_repeats(c, carry=["kept", "cut"]).first().carry.kept == 1
    assert op10_lsm_dedup.remove_repeats(c, carry=["spans"], batches=1).first().kept == "some text"
    assert op8_ngram_join.near_duplicates(c).first().n_shingles == 1
    assert op9_quality.quality(c).first().n_words == 2
    d = spark.createDataFrame([(1, "some text", "s", 1, 2, 3, 4)], "doc_id int, text string, source string, size int, taken int, target int, position int")
    assert op7_mixing.mix(d).first()["size"] == 2


def test_int_and_null_ids(spark):
    df = spark.createDataFrame([(1, "one two", "u", "<p>x"), (None, "three", None, None)], "doc_id int, text string, url string, html string")
    assert {r.doc_id for r in op9_quality.quality(df).collect()} == {1, None}
    assert op4_packing.packed(df.coalesce(1), *op3_bpe.public()).count() == 1
    assert op2_warc.derivatives(df.withColumnRenamed("doc_id", "page_id")).count() == 4
    assert {r.doc_id: r.kept for r in op6_suffix_dedup.remove_repeats(df).collect()} == {1: b"one two", None: b"three"}
    assert {r.doc_id: r.kept for r in op10_lsm_dedup.remove_repeats(df).collect()} == {1: "one two", None: "three"}


def test_rows_that_share_a_doc_id(spark):
    t = prose(3, 80)
    df = spark.createDataFrame([(5, t), (5, t), (6, t + " end"), (7, prose(4, 80))], "doc_id long, text string").repartition(2)
    got = sorted(tuple(r)[::2] for r in op8_ngram_join.near_duplicates(df).collect())
    assert got == [(5, 5), (5, 5), (6, 5), (7, 7)]
    assert sorted(len(r.kept) for r in op6_suffix_dedup.remove_repeats(df).collect() if r.doc_id == 5) == [len(t), len(t)]
    packed = op4_packing.packed(df, *op3_bpe.public(), 64).collect()
    assert sum(r.n_tokens for r in packed) == sum(r.n_tokens for r in op3_bpe.encode(df, *op3_bpe.public()).collect())


def edited(base, seed, changes):
    r, w = np.random.default_rng(seed), base.split()
    for i in r.choice(len(w), changes, replace=False):
        w[i] = f"e{seed}x{i}"
    return " ".join(w)


def linked(sets, percent):
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize(("block", "one_task"), [(4096, 1_000_000), (7, 1_000_000), (7, 3)])
def test_large_clusters_and_many_edges(spark, monkeypatch, block, one_task):
    monkeypatch.setattr(op8_ngram_join, "BLOCK", block)
    monkeypatch.setattr(common, "ONE_TASK", one_task)
    base, other = prose(1, 90), prose(2, 90)
    rows = [(i, edited(base, i, i % 5)) for i in range(40)] + [(50 + i, edited(other, i, 2)) for i in range(12)] + [(70 + i, None) for i in range(5)] + [(80, base), (81, base)]
    sets = {}
    for i, t in rows:
        w = (t or "").split()
        sets[i] = {tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))} if w else set()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in op8_ngram_join.near_duplicates(df).collect()}
    assert got == linked(sets, 85)


def test_tasks_of_the_join_grow_with_the_input(spark, monkeypatch):
    dealt, scan = [], op8_ngram_join._scan
    monkeypatch.setattr(op8_ngram_join, "_scan", lambda docs, n, percent, buckets, sketch: dealt.append(buckets) or scan(docs, n, percent, buckets, sketch))
    monkeypatch.setattr(op8_ngram_join, "TASK_BYTES", 2000)
    monkeypatch.setattr(op8_ngram_join, "SENT_BYTES", 2000)  # about three sets, so a batch leaves in several rows
    rows = [(100 * s + i, edited(prose(s, 90), i, i % 5)) for s in range(1, 5) for i in range(8)]
    sets = {i: {tuple(w[j : j + 4]) for j in range(len(w) - 3)} for i, w in ((i, t.split()) for i, t in rows)}
    for some in (rows[:8], rows):
        got = {r.doc_id: r.component_id for r in op8_ngram_join.near_duplicates(spark.createDataFrame(some, "doc_id long, text string").coalesce(1)).collect()}
        assert got == linked({i: sets[i] for i, _ in some}, 85)
    assert dealt[1] > 3 * dealt[0] > 12  # 4 are the session's


@pytest.mark.parametrize("percent", [55, 80, 85])
def test_long_sets_against_all_pairs(spark, monkeypatch, percent):
    r = np.random.default_rng(9)
    rows = []
    for base in (prose(s, 640).split() for s in (11, 12, 13)):
        for i in range(14):  # from 400 to 640 words, some changed
            w = base[int(r.integers(0, 60)) : int(r.integers(460, 641))]
            for j in r.integers(0, len(w), int(r.integers(0, 12))):
                w[j] = f"x{j}"
            rows.append((len(rows), " ".join(w)))
    sets = {i: {tuple(w[j : j + 4]) for j in range(len(w) - 3)} for i, w in ((i, t.split()) for i, t in rows)}
    monkeypatch.setattr(op8_ngram_join, "WEIGHT", 1500)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x.doc_id: x.component_id for x in op8_ngram_join.near_duplicates(df, percent=percent).collect()}
    assert got == linked(sets, percent)


def test_unlike_long_texts_are_no_cluster(spark, monkeypatch):
    found = []
    monkeypatch.setattr(op8_ngram_join, "_sketch", lambda docs, n: np.zeros(1 << op8_ngram_join.SLOTS, np.uint8))  # as full as can be
    monkeypatch.setattr(op8_ngram_join, "components", lambda edges: found.append(edges.count()) or common.components(edges))
    rows = [(i, " ".join((prose(100 + i, 700), "one line that all of these texts share", prose(200 + i, 300)))) for i in range(24)]
    got = op8_ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(x.doc_id == x.component_id for x in got)
    assert found[0] < 4  # 23 edges make one cluster of all


def test_tree_join_against_all_pairs():
    r = np.random.default_rng(3)
    centres = r.integers(0, 9, (12, 16))
    vec = np.maximum(0, centres[r.integers(0, 12, 3000)] + r.integers(-1, 2, (3000, 16))).astype(np.int64)
    size = vec.sum(axis=1)
    got, want = np.arange(3000), np.arange(3000)
    op8_ngram_join.tree_join(vec, size, got, 97)
    for i in range(3000):
        hit = np.flatnonzero(op8_ngram_join.may_match(vec[i], size[i], vec, size, 97))
        op8_ngram_join.unite(want, i, hit)
    pairs = lambda label: len(set(zip(got.tolist(), label.tolist(), strict=True)))
    assert pairs(want) == len(set(got.tolist())) == len(set(want.tolist()))


def brute_top(rows, ids, k):
    out = {}
    for i in ids:
        q = next(v for j, v in rows if j == i)
        score = sorted(((sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in rows if j != i), key=lambda y: (-y[0], y[1]))
        out[i] = [(j, s) for s, j in score[:k]]
    return out


def test_topk_over_many_buckets_of_one_length(spark, monkeypatch):
    monkeypatch.setattr(op5_topk, "ROWS", 16)
    monkeypatch.setattr(op5_topk, "SEEDS", 8)
    r = np.random.default_rng(6)
    rows = [(i, [float(x) for x in r.permutation([3, 1, 0, -2])]) for i in range(150)] + [(200 + i, [float(x) for x in r.normal(0, 2, 4)]) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for x in op5_topk.top_k(df, F.col("vec_id") % 20 == 0, 5).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.vec_id, x.score))
    whole = [(i, [int(np.floor(64 * c)) for c in v]) for i, v in rows]
    assert dict(got) == brute_top(whole, [i for i, _ in rows if i % 20 == 0], 5)


def test_topk_of_large_components(spark):
    rows = [(0, [2.0**30, 1.0, 0.0]), (1, [2.0**20, 3.0, 1e200]), (2, [2.0**20, 3.5, 0.0]), (3, [1.0, 1.0, 0.0])]
    fine = [r for r in rows if r[0] != 1]
    df = spark.createDataFrame(fine, "vec_id long, embedding array<double>")
    want = brute_top([(i, [int(64 * c) for c in v]) for i, v in fine], [0], 3)[0]
    assert [(x.vec_id, x.score) for x in op5_topk.top_k(df, F.col("vec_id") == 0, 3).orderBy("rank").collect()] == want
    with pytest.raises(Exception, match="vec_id 1"):
        op5_topk.top_k(spark.createDataFrame(rows, df.schema), F.col("vec_id") == 0, 3).collect()
    beyond = spark.createDataFrame([(0, [1e20]), (1, [1e20])], df.schema)
    with pytest.raises(Exception, match="beyond a long"):
        op5_topk.top_k(beyond, F.col("vec_id") == 0, 3).collect()


def test_repeated_vec_ids_are_one_query_and_separate_candidates(spark):
    df = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (5, [2.0]), (5, [2.0])], "vec_id long, embedding array<double>")
    assert [(x.query_id, x.vec_id, x.score) for x in op5_topk.top_k(df, F.col("vec_id") == 0, 3).collect()] == [(0, 5, 64 * 128)] * 2


def test_quality_verdict_against_plain(spark):
    texts = [prose(1, 80), (prose(2, 12) + " ") * 3 + prose(3, 60), "\n".join([prose(4, 9)] * 4 + [prose(5, 60)]), prose(6, 30), (prose(7, 6) + " ") * 2 + prose(8, 100)]
    got = {r.doc_id: r for r in op9_quality.quality(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        w = t.split()
        total, over, worst = sum(map(len, w)), False, 0.0
        for n, most in op9_quality.MOST_COVERED.items():
            c = collections.Counter(tuple(w[j : j + n]) for j in range(len(w) - n + 1))
            inside = {j + x for j in range(len(w) - n + 1) if c[tuple(w[j : j + n])] > 1 for x in range(n)}
            share = sum(len(w[j]) for j in inside) / total
            worst, over = max(worst, share), over or share > most
        seen, again = set(), 0
        for line in t.split("\n"):
            again += sum(map(len, line.split())) if line in seen else 0
            seen.add(line)
        assert got[i].most_covered == pytest.approx(worst) and got[i].line_covered == pytest.approx(again / total)
        assert got[i].kept == (not got[i].base_failed and not over and again / total <= op9_quality.MOST_IN_LINES)


def test_warc_from_response_records(spark):
    page = b"<html><title>T</title><body><script>x<p>One</p><a href=/l>l</a></body></html>"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nServer: s\r\n\r\n" + page
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: http://e.org/\r\nContent-Length: {len(block)}\r\n\r\n".encode()
    other = b"WARC/1.1\r\nWARC-Type: request\r\nWARC-Record-ID: <urn:uuid:2>\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    files = spark.createDataFrame([("a", gzip.compress(head + block + b"\r\n\r\n") + gzip.compress(other)), ("b", None)], "path string, content binary")
    got = {r.kind: r for r in op2_warc.from_records(files).collect()}
    assert set(got) == {"metadata", "conversion"} and got["conversion"].refers_to == "<urn:uuid:1>"
    assert got["metadata"].source_digest == op2_warc.digest(page) and "source-header-server: s" in got["metadata"].block
    assert "One" in got["conversion"].block
    assert op2_warc.derivatives(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    row = {"kind": "conversion", "record_id": "r", "refers_to": "s", "concurrent_to": "c", "target_uri": "http://e.org/a\r\nb", "block_digest": "d", "block": "x"}
    ((top, body),) = op2_warc.parse(op2_warc.serialised(row))
    assert top["WARC-Target-URI"] == "http://e.org/a%0D%0Ab" and body == b"x"
    assert op2_warc.visible("a<script>b</script>c<!-- d --><style>e" + "<style>" * 50_000).startswith("a c <style>e")


def uncovered(rows, width, joint):
    """Of (id, parts): the parts outside windows that a smaller id has."""
    seen, out = set(), {}
    for i, parts in rows:
        windows = [joint.join(parts[j : j + width]) for j in range(len(parts) - width + 1)]
        gone = {j + k for j, w in enumerate(windows) if w in seen for k in range(width)}
        out[i] = joint.join(x for j, x in enumerate(parts) if j not in gone)
        seen.update(windows)
    return out


def test_ranges_of_repeats_grow_with_the_input(spark, monkeypatch):
    dealt, settled = [], repeats.settled
    monkeypatch.setattr(repeats, "settled", lambda moved, same_doc, n, **more: dealt.append(n) or settled(moved, same_doc, n, **more))
    monkeypatch.setattr(repeats, "RANGE_BYTES", 200)
    shared = prose(5, 40)
    rows = [(i, f"{prose(10 + i, 60)} {shared} {prose(500 + i, 20)}") for i in range(40)]
    for some in (rows[:10], rows):
        df = spark.createDataFrame(some, "doc_id long, text string")
        bytewise = {r.doc_id: bytes(r.kept).decode() for r in op6_suffix_dedup.remove_repeats(df).collect()}
        assert bytewise == uncovered(some, 100, "")
        wordwise = {r.doc_id: r.kept for r in op10_lsm_dedup.remove_repeats(df).collect()}
        assert wordwise == uncovered([(i, t.split()) for i, t in some], 13, " ")
    assert dealt[3] > 2 * dealt[0] > 8  # 4 are the session's


def test_signs_of_the_text_itself_stay(spark):
    passage = prose(10, 30)
    rows = [(1, passage + " é� end", "en", "s", 1), (2, "own � sign " + passage + " tail é", "en", "s", 1)]
    got = {r.doc_id: r.text for r in corpus_pipeline.repeats(spark, common.stored(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")), "").collect()}
    assert got[1] == rows[0][1] and got[2].startswith("own � sign") and passage not in got[2]


def test_pipeline_stages_against_plain(spark, tmp_path):
    """Each stage on the smallest tables against a plain version of what it must keep."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one = common.stored(corpus_pipeline.language(spark, docs, ""))
    kept = {r.doc_id: r.text for r in one.collect()}
    have = {r.doc_id: r.text for r in docs.collect()}
    assert kept.items() <= have.items()
    two = common.stored(corpus_pipeline.near_duplicates(spark, one, ""))
    sets = {}
    for i, t in kept.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    assert {r.doc_id for r in two.collect()} == set(linked(sets, 80).values())
    three = common.stored(corpus_pipeline.repeats(spark, two, ""))
    seen, want = set(), {}
    for i, t in sorted((r.doc_id, r.text.encode()) for r in two.collect()):
        cut = bytearray(len(t))
        for s in range(len(t) - 99):
            if t[s : s + 100] in seen:
                cut[s : s + 100] = b"\1" * 100
            seen.add(t[s : s + 100])

        spans = []
        for m in re.finditer(rb"\x00+", bytes(cut)):
            spans.append(t[m.start() : m.end()].decode("utf-8", "ignore"))
        want[i] = "".join(spans)

    assert {r.doc_id: r.text for r in three.collect()} == {i: t for i, t in want.items() if t.split()}
    four = common.stored(corpus_pipeline.mixture(spark, three, ""))
    size = {i: len(t.split()) for i, t in want.items() if t.split()}
    taken = collections.Counter()
    for r in four.collect():
        assert want[r.doc_id] == r.text or want[r.doc_id].split()[: len(r.text.split())] == r.text.split()
        taken[r.doc_id] += len(r.text.split())
    assert all(taken[i] <= 2 * size[i] for i in taken) and abs(sum(taken.values()) - 1.5 * sum(size.values())) < 10
    import tiktoken

    path, pattern = op3_bpe.public()
    coder = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=op3_bpe.ranks(path), special_tokens={})
    five = corpus_pipeline.token_ids(spark, four, "").collect()
    plain = collections.Counter((r.doc_id, np.array(coder.encode_ordinary(r.text), "<u4").tobytes()) for r in four.collect())
    assert plain == collections.Counter((r.doc_id, bytes(r.ids)) for r in five)


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, extra int")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.count() == 0, name


def test_digest_columns(spark):
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for r in QUERIES["op3_bpe"](spark, sf).collect():
        assert r.decoded_sha256 == sha((text[r.doc_id] or "").encode())
    for r in QUERIES["op6_suffix_dedup"](spark, sf).collect():
        whole = (text[r.doc_id] or "").encode()
        assert r.n_bytes == len(whole) and (r.n_removed or r.kept_sha256 == sha(whole)) and (r.n_spans > 0) == (r.n_removed > 0)
    for r in QUERIES["op10_lsm_dedup"](spark, sf).collect():
        words = (text[r.doc_id] or "").encode().split()
        assert r.n_words == len(words) and (r.n_removed or r.kept_sha256 == sha(b" ".join(words)))
