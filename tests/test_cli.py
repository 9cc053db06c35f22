"""The verbs, end to end, on files."""

import pytest

from attesta import cli
from attesta.plans import audit_case as case
from attesta.sources import files


def test_check_and_compare(spark, tmp_path):
    (tmp_path / "tei").mkdir()
    entry = case.ENTRY.format(0, case.T1, "2019", "Ada Byron. " + case.T1 + ", 2019.") + case.ENTRY.format(1, "Lost", "2020", "http://x.org no title at all 2020")
    claim = "Trees are parsed with little supervision and many rules, as was shown before"
    (tmp_path / "tei" / "p.tei.xml").write_text(case.HEAD + "<div><head>One</head>" + case.CITE.format(claim) + "</div>" + case.LIST.format(entry))
    (tmp_path / "tei" / "q.tei.xml").write_text("<broken")
    (tmp_path / "dump.xml").write_text(case.DUMP)
    case.PAPERS(spark).write.parquet(f"{tmp_path}/wide")
    base = ["--runs", f"{tmp_path}/runs", "--wide", f"{tmp_path}/wide", "--snapshot", f"{tmp_path}/index"]
    assert cli.main([*base, "--key", "check-2026-p", "refresh", f"{tmp_path}/dump.xml"], spark) == 1  # too few records
    assert cli.main([*base, "--key", "check-2026-p", "refresh", f"{tmp_path}/dump.xml", "--least", "1"], spark) == 0
    assert cli.main([*base, "--key", "check-2026-p", "check", f"{tmp_path}/tei"], spark) == 0
    got = files.read_report(spark, f"{tmp_path}/runs/check-2026-p/check_result", "references_total long, exists long, not_found long, judged long, capped boolean").first()
    assert (got.references_total, got.exists, got.not_found, got.judged, got.capped) == (2, 1, 1, 1, False)
    assert spark.read.parquet(f"{tmp_path}/runs/check-2026-p/failures").count() == 1
    assert cli.main([*base, "compare", "check-2026-p"], spark) == 0
    for verb in (["support", "--n", "1"], ["fulltext", "--n", "1"], ["audit", "--n", "1"]):
        assert cli.main([*base, "--key", "check-2026-p", *verb], spark) == 0


def test_ingest_and_preprints(spark, tmp_path):
    (tmp_path / "a.bib").write_text('noise\n@inproceedings{k,\n  title = "T",\n  year = "2026",\n  url = "https://e.org/2026.conf-long.2/",\n}\n')
    (tmp_path / "feeds").mkdir()
    (tmp_path / "feeds" / "page0.xml").write_text(case.FEEDS[0])
    base = ["--runs", f"{tmp_path}/runs", "--key", "conf-2026"]
    assert cli.main([*base, "ingest", f"{tmp_path}/a.bib", "--prefix", "2026.conf-long"], spark) == 0
    assert [r.paper_id for r in spark.read.parquet(f"{tmp_path}/runs/conf-2026/papers").collect()] == ["2026.conf-long.2"]
    assert cli.main([*base, "preprints", f"{tmp_path}/feeds", "--n", "5"], spark) == 0
    assert [r.paper_id for r in spark.read.parquet(f"{tmp_path}/runs/conf-2026/papers").collect()] == ["2401.00001"]
    with pytest.raises(SystemExit):
        cli.main(["--runs", "x", "verify"], spark)
