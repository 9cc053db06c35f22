"""Resolution operators against brute force, on what the driver's tables do not hold."""

import re

import numpy as np

from attesta.functions import text as X
from attesta.operators import resolve


def norm(text):
    return " ".join(re.sub("[^a-z0-9 ]+", " ", (text or "").lower()).split())


def rescued(docs, items, least, same=()):
    out = {}
    for i, d in docs:
        fit = [j for j, t in items if norm(t) and norm(t) in norm(d) and (len(norm(t)) >= least or (i, j) in same)]
        if fit:
            out[i] = min(fit)
    return out


def test_substring_rescue_of_any_word_count(spark):
    items = [(1, "Electroencephalography"), (2, "Deep Neurolinguistics"), (3, "Neurolinguistics 2"), (4, "photosynthesis of plants"), (5, "Roboethics"), (6, "aaaaaaaaaaaaaaaaaaaa"), (7, "abcdefgh ijklmno"), (8, "abcdefg hijklmno"), (9, ""), (10, None), (11, "Interdisciplinary work")]
    docs = [(1, "On Electroencephalography. 2001"), (2, "xxmagnetoelectroencephalographyzz"), (3, "A. Lu, Deep neurolinguisticsx"), (4, "indeep neurolinguistics"), (5, "deep, neurolinguistics 2b"), (6, "the Photosynthesis of plants"), (7, "roboethics"), (8, "a" * 3000), (9, "xabcdefgh ijklmnop"), (10, "xabcdefg hijklmnop"), (11, None), (12, ""), (13, "roboethics"), (14, "interdisciplinaryw ork, interdisciplinary workx")]
    r = np.random.default_rng(4)
    bits = ["ab", "ba", "a b", "b a", "abab"]
    docs += [(100 + i, "".join(r.choice(bits, 30))) for i in range(40)]
    items += [(100 + i, "".join(r.choice(bits, n))) for i, n in enumerate(r.integers(3, 9, 40))]
    d, t = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    same = [(7, 5), (13, 9), (101, 105)]
    for least in (16, 9, 6):
        assert {x.doc_id: x.item_id for x in resolve.substring_rescue(d, t, least).collect()} == rescued(docs, items, least)
    got = resolve.substring_rescue(d, t, 16, spark.createDataFrame(same, "doc_id long, item_id long"))
    assert {x.doc_id: x.item_id for x in got.collect()} == rescued(docs, items, 16, same)
    assert rescued(docs, items, 16, same)[7] == 5


def best(docs, items):
    out = {}
    for i, d in docs:
        ref = set(norm(d).split())
        for j, t in sorted(items):
            hit = set(norm(t).split())
            if not hit or not ref:
                continue
            shared = len(hit & ref)
            c, ok = max(shared / len(hit), shared / len(ref)), i % 2 == j % 2
            new = [w for w in hit - ref if len(w) >= 3 and w not in X.STOP_WORDS and w not in norm(d).replace(" ", "")]
            if (not new or (len(new) == 1 and ok)) and (hit == ref or (c >= 0.5 and ok)) and c > out.get(i, (0, 0))[1]:
                out[i] = (j, c)
    return out


def test_best_hit_of_short_titles_and_stop_words(spark, tmp_path):
    from attesta.plans.catalogue import QUERIES

    items = [(2, "Graph parsing"), (4, "Parsing trees with forests"), (6, "The semantics of verbs and of nouns in the Basque for us"), (8, "Verification of claims"), (10, "a the of"), (12, ""), (13, "Basque verbs"), (14, "Deep residual connections for image recognition"), (16, None), (18, "On a new data model for parsing in the large")]
    docs = [(2, "Lu. Parsing, 2001"), (4, "trees with forests"), (6, "semantics verbs nouns Basque by Byron 1999 in a journal"), (8, "Verifica- tion of claims"), (10, "parsing"), (12, "Basque verbs"), (14, "Residual connections image recognition"), (15, "Deep residual connections for image recognition"), (16, None), (17, ""), (18, "graph"), (20, "nothing here at all but words of no title " + " ".join(f"w{i}" for i in range(80)) + " graph")]
    words = "graph parsing trees the of a deep verbs nouns".split()
    r = np.random.default_rng(8)
    docs += [(100 + i, " ".join(r.choice(words, r.integers(1, 9)))) for i in range(60)]
    items += [(100 + i, " ".join(r.choice(words, r.integers(1, 9)))) for i in range(30)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {x.doc_id: (x.item_id, x.c) for x in QUERIES["resolver_best_hit"](spark, str(tmp_path)).collect()} == best(docs, items)
    assert {2, 4, 6, 8} <= set(best(docs, items))


def test_pairs_with_words_are_not_broadcast(spark):
    records = spark.createDataFrame([(1, "one plain title of a work and more"), (2, "nothing of the kind")], "doc_id long, text string")
    titles = spark.createDataFrame([(7, "one plain title of a work")], "item_id long, text string")
    got = resolve.contained(records, titles, 0.5)
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [rec" in plan
    assert "BroadcastHashJoin [rec" not in plan
    assert [(r.rec, r.title, r.n, r.shared) for r in got.collect()] == [(1, 7, 6, 6)]
