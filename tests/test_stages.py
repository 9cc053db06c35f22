"""What queries over tables cannot show: failures, late events, several batches, crashes of judges."""

import os
from types import SimpleNamespace

import pytest

from attesta.operators import judge
from attesta.sources import fetch, files, index
from attesta.streaming.quota import quota_stream


def flaky(row):
    if row["claim"] == "down":
        raise RuntimeError("no answer")
    return {"flag": "confirmed", "support": "made up", "error_class": "overclaim", "confidence": "0.5"}


def test_a_failed_judge_gives_no_row_and_is_asked_again(spark):
    f = spark.createDataFrame([("a", True, "down", "text"), ("b", True, "up", "text"), ("c", False, "up", "text"), ("d", True, "up", None)], "ref_id string, same_paper boolean, claim string, passages string")

    asked = judge.judged(f, flaky, "m", "flag string, confidence double", 2, lambda s: None)
    cache = files.Cache(spark, files.scratch(spark), "ref_id string, flag string, model string", "ref_id", "flag")
    assert {r.ref_id for r in cache.run(f, lambda t: judge.judged(t, flaky, "m", "flag string", 1).select("ref_id", "flag", "model")).collect()} == {"b", "c", "d"}
    well = cache.run(f, lambda t: judge.judged(t, lambda r: {"flag": "refuted"}, "n", "flag string").select("ref_id", "flag", "model"))
    assert {r.ref_id: r.model for r in well.collect()} == {"a": "n", "b": "m", "c": "m", "d": "m"}
    assert {r.ref_id: r.confidence for r in asked.collect()} == {"a": None, "b": 0.5, "c": 0.5, "d": 0.5}


def test_arbiter_rules_and_labels(spark):
    f = spark.createDataFrame([("b", True, "up", "text"), ("c", False, "up", "text"), ("d", True, "up", None), ("e", None, "up", "text")], "ref_id string, same_paper boolean, claim string, passages string")
    got = {r.ref_id: (r.flag, r.support, r.error_class, r.model) for r in judge.arbitrated(f, flaky, "m").collect()}
    wrong = ("refuted", "unverifiable_from_text", "wrong_paper", "rule")
    assert got == {"b": ("confirmed", "other", "overclaim", "m"), "c": wrong, "d": ("refuted", "unverifiable_from_text", "insufficient_evidence", "rule"), "e": wrong}


def test_chat_judge():
    sent = []
    j = judge.ChatJudge(lambda r: sent.append(r) or '```json\n[{"support": "partial"}]\n```', "m-1", "year {year}", "{claim} / {title}", own_heat=("z",))
    assert j({"claim": "c", "title": None, "year": 2026}) == {"support": "partial"}
    assert sent[0]["messages"][1]["content"] == "c / ?" and sent[0]["temperature"] == 0
    assert "temperature" not in judge.ChatJudge(lambda r: "", "z-1", "", "", own_heat=("z",)).request({})
    with pytest.raises(ValueError):
        judge.ChatJudge(lambda r: "no", "m", "", "")({})


def test_pace_and_retries():
    now, waits = [0.0], []

    def wait(s):
        waits.append(s)
        now[0] += s

    p = fetch.Pace(4.0, lambda: now[0], wait)
    for _ in range(3):
        p.turn()
    assert waits == [0.25, 0.25]
    tries, pauses = [], []
    assert fetch.retried(lambda: tries.append(1) or 1 / 0, 3, pauses.append)[1].startswith("ZeroDivisionError")
    assert len(tries) == 3 and pauses == [1.0, 2.0]


def test_late_events_over_several_batches(spark, tmp_path):
    hour = 3600 * 1_000_000
    batches = [[(1, 7, 30 * hour), (2, 7, 31 * hour)], [(3, 7, 29 * hour), (4, 7, 40 * hour), (5, 7, 40 * hour)], [(6, 7, 55 * hour), (7, 8, 40 * hour)]]
    schema, seen = "event_id long, user_id long, us long", set()
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        for f in set((tmp_path / "in").glob("*.parquet")) - seen:  # files come in order of their times
            os.utime(f, (1e9 + i, 1e9 + i))
            seen.add(f)
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = {r.event_id: r.before for r in files.drained(quota_stream(src, "user_id"), "q").collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 4, 5: 4, 6: 2, 7: 0}


def test_snapshot_lock_and_refusal(spark):
    s = index.Snapshot(spark, files.scratch(spark))
    rows = spark.createDataFrame([("k", "10.1/x"), ("l", None)], "norm_title string, doi string")
    assert s.current() is None and s.refresh(rows, "norm_title", 3) == "refused"
    root = s._path(s.root)
    assert [f.getPath().getName() for f in s._fs.listStatus(root) if f.getPath().getName().startswith("v_")] == []
    s._fs.createNewFile(s._path(f"{s.root}/lock"))
    assert s.refresh(rows, "norm_title", 1) == "locked"
    s._fs.delete(s._path(f"{s.root}/lock"), False)
    assert s.refresh(rows, "norm_title", 1, "d") == "rebuilt" and s.meta()["records"] == 2
    assert s.current(by_doi=True).count() == 1


def test_fetch_again_only_when_changed(tmp_path):
    bodies = []
    f = index.Fetched(str(tmp_path / "bib"), lambda: "v1", lambda: bodies.append(1) or b"@article")
    assert f.get()["fetched"] and not f.get()["fetched"] and f.get(force=True)["fetched"] and len(bodies) == 2
    with pytest.raises(ValueError):
        index.downloaded(lambda: iter([b"x"]), str(tmp_path / "dump"), "0" * 32)
    assert not (tmp_path / "dump").exists() and index.published_md5("a" * 32 + "  f.gz") == "a" * 32


def test_bib_files_are_cut_anywhere(spark, tmp_path):
    (tmp_path / "x.bib").write_text("noise\n@article{a,\n  url = \"u\",\n}\nmore noise\n@book{b,\n  url = \"v\",\n}")
    got = files.bib_entries(files.bib_records(spark, str(tmp_path / "x.bib"))).select("entry").collect()
    assert sorted(r.entry.split(",")[0] for r in got) == ["@article{a", "@book{b"]


def test_no_shared_folder_is_an_error():
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None))
    with pytest.raises(ValueError):
        files.scratch(bare)
