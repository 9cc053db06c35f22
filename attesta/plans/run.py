"""A run: a folder of stage tables, and the stages that fill it. Each reads what the ones before have written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.functions import text as X
from attesta.operators import audit, judge, report, resolve, stages
from attesta.sources import fetch, files, index, tei

SUPPORT = "ref_id string, paper_id string, source string, citing_sentence string, section string, marker string, cited_title string, cited_arxiv string, cite_type string, support string, claim_span string, rationale string, confidence double, model string, skipped string"
CATEGORY = "ref_id string, paper_id string, category string, subtype string, rationale string, confidence double, raw_head string, model string"
ARBITER = "ref_id string, paper_id string, first_support string, first_rationale string, citing_sentence string, claim_span string, cited_title string, resolved_title string, flag string, support string, error_class string, rationale string, confidence double, model string"


class Run:
    """key: the run's name, with a year in it. wide, bodies: the wider index and the full texts, as Parquet, if any.
    progress is told of each stage as it begins."""

    def __init__(self, spark: SparkSession, folder: str, key: str, wide: str | None = None, bodies: str | None = None, snapshot: str | None = None, progress: Callable[[str], None] = lambda stage: None):
        self.spark, self.folder, self.key, self.progress = spark, folder.rstrip("/"), key, progress
        self.wide, self.text, self.snapshot = wide, bodies, snapshot

    def path(self, name: str) -> str:
        return f"{self.folder}/{self.key}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def put(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.table(name)

    def tell(self, df: DataFrame, name: str) -> DataFrame:
        files.write_report(df, self.path(name))
        return df

    def year(self) -> int:
        return self.spark.range(1).select(X.run_year(F.lit(self.key))).first()[0]

    def papers(self) -> DataFrame:
        if not self.wide:
            raise ValueError("this stage needs a wider index")
        return self.spark.read.parquet(self.wide)

    def bodies(self) -> DataFrame:
        return self.spark.read.parquet(self.text) if self.text else self.spark.createDataFrame([], "arxiv_id string, body string")

    def ingest(self, bib: str, prefixes: list[str], limit: int | None = None) -> DataFrame:
        self.progress("collecting papers")
        p = files.papers(files.bib_entries(files.bib_records(self.spark, bib)), self.key, prefixes).orderBy("volume", files.paper_number())
        return self.put(p if limit is None else p.limit(limit), "papers")

    def preprints(self, feeds: str, n: int) -> DataFrame:
        """feeds: a folder of Atom pages whose names end in their numbers."""
        self.progress("collecting preprints")
        f = files.listed(self.spark, feeds, "*.xml").select(F.regexp_extract("paper_id", r"(\d+)$", 1).cast("long").alias("page"), F.col("content").cast("string").alias("answer"))
        return self.put(fetch.preprints(fetch.atom_entries(f), self.papers() if self.wide else None, self.key, n), "papers")

    def parse(self, folder: str, limit: int | None = None, layout: DataFrame | None = None) -> DataFrame:
        """folder: TEI files, one a paper."""
        self.progress("extracting references")
        f = files.listed(self.spark, folder, "*.xml", limit).select(F.regexp_replace("paper_id", r"\.tei$", "").alias("paper_id"), F.col("content").cast("string").alias("tei"))
        scan = files.stored(tei.scanned(f))
        refs = self.put(tei.references(scan).orderBy("paper_id", "index"), "refs")
        cited = self.put(tei.contexts(scan, refs), "contexts")
        none = self.spark.createDataFrame([], "paper_id string, layout_count long, ok boolean")
        failed = self.put(report.missing_estimate(tei.failures(scan), none if layout is None else layout), "failures")
        return self.tell(report.parse_report(refs, cited, failed), "parse_report")

    def refresh(self, dump: str, least: int = 1_000_000, digest: str | None = None, force: bool = False) -> str:
        self.progress("building the index")
        records = files.stored(index.dump_records(self.spark, dump))
        self.tell(index.build_stats(records), "index_stats")
        return index.Snapshot(self.spark, self.snapshot).refresh(index.index_rows(records), "norm_title", least, digest, force)

    def verify(self) -> DataFrame:
        """The local index first; a wider one, if any, is asked about the rest only."""
        self.progress("checking existence")
        own = index.Snapshot(self.spark, self.snapshot).current()
        refs = self.table("refs")
        first = files.stored(resolve.classified(refs, own))
        if self.wide:
            rest = refs.join(resolve.escalated(first).select("ref_id"), "ref_id", "left_semi")
            later = files.stored(resolve.classified(rest, own, self.papers()))
            first = audit.todo(first, later, "ref_id").unionByName(later)
        v = self.put(first, "verdicts")
        return audit.distribution(v, "verdict", report.VERDICTS)

    def triage(self) -> DataFrame:
        self.progress("triaging unresolved references")
        t = self.put(resolve.triaged(self.table("verdicts"), self.table("refs"), self.papers()), "triage")
        return report.tally(t, "stage_verdict")

    def categories(self, by: judge.Judge, model: str, limit: int | None = None) -> DataFrame:
        s = self.table("triage").where("stage_verdict = 'suspect'")
        s = s if limit is None else s.orderBy("ref_id").limit(limit)
        cache = files.Cache(self.spark, self.path("l1_judge"), CATEGORY, "ref_id", "category")
        c = cache.run(s, lambda todo: stages.categorised(todo, self.table("refs"), by, model, self.year()))
        return self.tell(report.categories_report(s, c), "l1_judge_report")

    def pool(self) -> DataFrame:
        return stages.pool(self.table("refs"), self.table("verdicts"), self.table("contexts"))

    def _fulltext(self, rows: DataFrame, by: judge.Judge, model: str) -> DataFrame:
        cache = files.Cache(self.spark, self.path("l2_fulltext"), SUPPORT, "ref_id", "support")
        return cache.run(rows, lambda todo: stages.fulltext_support(todo, self.papers(), self.bodies(), by, model))

    def support(self, n: int, by: judge.Judge, model: str, seed: str = "citations") -> DataFrame:
        """A sample of n citations judged by the abstract."""
        self.progress("judging claim support")
        rows = stages.drawn(self.pool(), self.spark.createDataFrame([], "ref_id string"), "ref_id", seed, n, 40)
        got = files.stored(stages.abstract_support(rows, self.papers(), by, model)).where("support is not null")
        own = self.put(stages.first_n(got, "ref_id", seed, n), "l2_sample")
        return self.tell(report.tally(own, "support"), "l2_sample_report")

    def fulltext(self, n: int, by: judge.Judge, model: str, seed: str = "citations") -> DataFrame:
        self.progress("judging claim support")
        cache = files.Cache(self.spark, self.path("l2_fulltext"), SUPPORT, "ref_id", "support")
        got = self._fulltext(stages.drawn(self.pool(), cache.rows(), "ref_id", seed, n, 30), by, model)
        return self.tell(report.support_report(stages.first_n(got, "ref_id", seed, n)), "l2_fulltext_report")

    def arbitrate(self, by: judge.Judge, model: str) -> DataFrame:
        self.progress("arbitrating flags")
        flags = stages.flagged(self.table("l2_fulltext"))
        cache = files.Cache(self.spark, self.path("l2_arbiter"), ARBITER, "ref_id", "flag")
        rows = cache.run(flags, lambda todo: stages.arbiter(todo, self.table("refs"), self.papers(), self.bodies(), by, model))
        return self.tell(report.arbiter_report(flags, rows), "l2_arbiter_report")

    def audit(self, n: int, by: judge.Judge, model: str, floor: int = 10, seed: str = "papers") -> DataFrame:
        """All citations of n papers with at least floor of them."""
        pool = files.stored(self.pool())
        able = pool.groupBy("paper_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= floor)
        own = files.stored(pool.join(audit.sampled(able, "paper_id", seed, n).select("paper_id"), "paper_id", "left_semi"))
        got = self._fulltext(own, by, model).join(own.select("ref_id"), "ref_id", "left_semi")
        self.arbitrate(by, model)
        said = stages.arbitration(got, self.table("l2_arbiter"))
        claim = F.col("cite_type") == "claim"
        flag = claim & F.col("support").isin("not_supported", "partial")
        rolled = audit.by_paper(said.select("paper_id", "ref_id", claim.alias("is_claim"), flag.alias("is_flag"), (flag & F.coalesce(F.col("flag") == "confirmed", F.lit(False))).alias("is_confirmed")), "paper_id", "ref_id")
        self.put(rolled, "paper_audit")
        return self.tell(audit.by_corpus(rolled), "paper_audit_report")

    def check(self, tei_folder: str, by: judge.Judge, strings: judge.Judge, model: str, most: int = 60) -> DataFrame:
        """The whole funnel for a paper, from its TEI to the summary."""
        self.parse(tei_folder)
        if self.table("refs").isEmpty():
            raise ValueError("no references could be extracted")
        self.verify()
        self.triage()
        self.categories(strings, model)
        rows = files.stored(stages.capped(self.pool(), ["index"], most))
        over = bool(rows.agg(F.max("capped")).first()[0])
        got = self._fulltext(rows.drop("capped"), by, model)
        self.arbitrate(by, model)
        out = report.check_summary(self.table("refs"), self.table("verdicts"), self.table("triage"), self.table("l1_judge"), got, self.table("l2_arbiter"), over)
        return self.tell(out, "check_result")


def compare(runs: list[Run]) -> DataFrame:
    """Outcomes of several audited runs side by side."""
    rows = None
    for r in runs:
        s = r.table("l2_fulltext").where("cite_type = 'claim'")
        a = stages.arbitration(s, r.table("l2_arbiter"))
        n = F.count(F.lit(1))
        one = a.agg(n.alias("n"), F.count_if(F.col("support").isin("not_supported", "partial")).alias("flags"), F.count_if(F.col("flag") == "confirmed").alias("confirmed"))
        parts = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("k")) for m in ("flags", "confirmed")])
        one = one.select(F.lit(r.key).alias("venue"), "n", F.explode(parts).alias("p")).select("venue", "p.metric", "p.k", "n")
        rows = one if rows is None else rows.unionByName(one)
    return report.across(rows, [r.key for r in runs])
