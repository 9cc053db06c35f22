"""Stages of the pipeline on rows without doc_id, repeated rows and rows that only share a doc_id."""

import collections

import numpy as np
import pytest

import corpus_pipeline
from attesta.llm.common import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n=60):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(list("abcdefghij"), r.integers(3, 9))) for _ in range(n))


def frame(spark, rows):
    return stored(spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], SCHEMA).repartition(3))


def plain(df):
    return collections.Counter((r.doc_id, r.text) for r in df.collect())


def test_near_duplicates_keep_one_row_of_each_component(spark):
    near = prose(1).split()
    near[0] = "changed"
    near = " ".join(near)
    rows = [(5, prose(1), "s1"), (5, prose(1), "s1"), (5, prose(1), "s1"), (7, near, "s1"), (9, prose(2), "s1"), (9, prose(3), "s1"), (None, prose(4), "s1"), (None, prose(5), "s1"), (None, prose(1), "s1"), (11, prose(6), "s1")]
    got = plain(corpus_pipeline.near_duplicates(spark, frame(spark, rows), ""))
    assert got == collections.Counter([(5, prose(1)), (9, prose(2)), (9, prose(3)), (None, prose(4)), (None, prose(5)), (11, prose(6))])


def test_repeats_cut_rows_not_ids(spark):
    passage = prose(10, 30)
    rows = [(1, passage + " " + prose(11), "s1"), (2, prose(12) + " " + prose(13), "s1"), (2, passage + " " + prose(14), "s1"), (None, prose(15) + " " + passage, "s1"), (None, prose(16), "s1")]
    got = plain(corpus_pipeline.repeats(spark, frame(spark, rows), ""))
    assert got == collections.Counter([(1, rows[0][1]), (2, rows[1][1]), (2, prose(14)), (None, prose(15) + " "), (None, prose(16))])


def test_mixture_takes_each_row_once_a_pass(spark):
    rows = [(3, prose(20), "s1")] * 3 + [(4, prose(21), "s1"), (4, prose(22, 20), "s1"), (None, prose(23), "s1"), (None, prose(24, 30), "s2"), (6, prose(25, 90), "s2")]
    got = corpus_pipeline.mixture(spark, frame(spark, rows), "").collect()
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len(t.split())
    weight, due = {"s1": 5, "s2": 2}, 1.5 * sum(size.values())
    want = {s: due * w / 7 for s, w in weight.items()}
    full = [s for s in want if want[s] > 2 * size[s]]
    for s in full:
        want = {x: 2 * size[x] if x == s else due - 2 * size[s] for x in want}
    taken = collections.Counter()
    for r in got:
        taken[r.source] += len(r.text.split())
    assert dict(taken) == {s: pytest.approx(w, abs=1) for s, w in want.items()}
    copies, seen = collections.Counter((i, t) for i, t, _ in rows), collections.Counter((r.doc_id, r.text) for r in got)
    assert all(n <= 2 * copies[k] for k, n in seen.items() if k in copies)
    assert {r.doc_id for r in got} == {3, 4, 6, None}
