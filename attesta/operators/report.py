"""One-row reports of each stage, ready for `sources.files.write_report`, and comparisons across corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.functions import text as X
from attesta.operators import stages

VERDICTS = ["exists", "minor_mismatch", "not_found", "unparseable"]


def tally(rows: DataFrame, key: str) -> DataFrame:
    """One row: a map from each value of key to how often it occurs, in order of value; null is 'none'. The values are
    labels, few by nature."""
    g = rows.groupBy(F.coalesce(key, F.lit("none")).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias(key))


def beside(*rows: DataFrame) -> DataFrame:
    """One-row frames as one row: each stands under the key of the single row that all of them are."""
    out = rows[0].withColumn("_one", F.lit(1))
    for r in rows[1:]:
        out = out.join(r.withColumn("_one", F.lit(1)), "_one")
    return out.drop("_one")


def flags_of(ref_doi: Column, ref_arxiv: Column, ref_year: Column, ref_title: Column, year: int) -> dict[str, Column]:
    """Six booleans of a reference."""
    doi, arxiv = X.norm_doi(ref_doi).isNotNull(), X.norm_arxiv(ref_arxiv).isNotNull()
    return {"has_doi": doi, "has_arxiv": arxiv, "has_id": doi | arxiv, "has_year": ref_year.isNotNull(), "is_current": F.coalesce(ref_year == year, F.lit(False)), "has_title": X.norm_title(ref_title) != ""}


def residual(verdicts: DataFrame, refs: DataFrame, year: int) -> DataFrame:
    """One row over the verdicts not_found: ten counts in one pass. A verdict without a reference has no flag."""
    r = verdicts.where("verdict = 'not_found'").join(refs.select("ref_id", "doi", "arxiv_id", "year", "title"), "ref_id", "left")
    f = flags_of(F.col("doi"), F.col("arxiv_id"), F.col("year"), F.col("title"), year)
    more = {"no_year_no_id": ~f["has_id"] & ~f["has_year"], "id_bearing": f["has_id"], "matchable": f["has_title"] | f["has_id"]}
    return r.agg(F.count(F.lit(1)).alias("not_found"), *[F.count_if(c).alias(n) for n, c in (f | more).items()])


def heads(rows: DataFrame, order: list[str], column: str, n: int = 5, length: int = 160) -> DataFrame:
    """The first n rows, cut for display."""
    return rows.orderBy(*order).limit(n).select(*order, F.substring(column, 1, length).alias(column))


def categories_report(suspects: DataFrame, judged: DataFrame) -> DataFrame:
    """One row: how many suspects came in and were judged, how they fell, and how the judge dropped the rest."""
    base = beside(suspects.agg(F.count(F.lit(1)).alias("suspects_in")), judged.agg(F.count(F.lit(1)).alias("judged"), F.count_if(F.col("category") == "suspicious").alias("suspicious")))
    out = beside(base, tally(judged, "category"), tally(judged.where("category = 'non_paper'"), "subtype"))
    return out.withColumn("dropped", F.col("suspects_in") - F.col("judged"))


def support_report(judged: DataFrame) -> DataFrame:
    """One row over judged citations; the share of support is one of claims, never of mere names."""
    j = judged.where("support is not null")
    claim = F.col("cite_type") == "claim"
    part = lambda label: F.count_if(claim & (F.col("support") == label))
    n = F.count_if(claim)
    share = lambda label: (part(label) / F.greatest(n, F.lit(1))).alias(f"share_{label}")
    return j.agg(F.count(F.lit(1)).alias("sampled"), F.count_if(F.col("source") == "fulltext").alias("from_fulltext"), F.count_if(F.col("source") == "abstract").alias("from_abstract"), n.alias("claim_cites"), F.count_if(F.col("cite_type") == "nominal").alias("nominal_cites"), *[part(x).alias(x) for x in ("supported", "partial", "unverifiable_from_text", "not_supported")], share("supported"), share("not_supported"), (part("partial") + part("not_supported")).alias("flagged"))


def arbiter_report(flagged: DataFrame, rows: DataFrame) -> DataFrame:
    """One row: flags in, arbitrated, confirmed, precision, and classes of either outcome."""
    n, yes = F.count(F.lit(1)), F.count_if(F.col("flag") == "confirmed")
    base = beside(flagged.agg(n.alias("flagged_in")), rows.agg(n.alias("arbitrated"), yes.alias("confirmed"), (yes / F.greatest(n, F.lit(1))).alias("precision")))
    of = lambda flag: tally(rows.where(F.col("flag") == flag), "error_class").withColumnRenamed("error_class", f"{flag}_by_class")
    return beside(base, of("refuted"), of("confirmed"))


def check_summary(refs: DataFrame, verdicts: DataFrame, triage: DataFrame, categories: DataFrame, support: DataFrame, arbiter_rows: DataFrame, was_capped: bool) -> DataFrame:
    """One row: the whole check of a paper. A reference that the judge could not classify is counted as dropped, a flag
    that no arbiter answered as neither confirmed nor refuted."""
    v = verdicts.agg(*[F.count_if(F.col("verdict") == x).alias(x) for x in VERDICTS])
    suspects = triage.where("stage_verdict = 'suspect'").agg(F.count(F.lit(1)).alias("suspects"))
    c = categories.agg(F.count(F.lit(1)).alias("classified"), F.count_if(F.col("category") == "suspicious").alias("suspicious_leads"))
    s = support.where("support is not null")
    f = stages.arbitration(stages.flagged(s), arbiter_rows).agg(F.count(F.lit(1)).alias("first_pass_flags"), F.count_if(F.col("flag") == "confirmed").alias("confirmed_leads"), F.count_if(F.col("flag").isNotNull() & (F.col("flag") != "confirmed")).alias("refuted_by_arbiter"))
    j = s.agg(F.count(F.lit(1)).alias("judged"), F.count_if(F.col("cite_type") == "claim").alias("claim_cites"))
    out = beside(refs.agg(F.count(F.lit(1)).alias("references_total")), v, suspects, c, j, f, tally(triage, "stage_verdict"), tally(categories, "category"))
    return out.withColumn("judge_dropped", F.col("suspects") - F.col("classified")).withColumn("capped", F.lit(was_capped)).drop("suspects", "classified")


def examined(summary: DataFrame) -> DataFrame:
    """How the citations of a check divide: examined as claims, nominal, and unexamined; never negative."""
    zero = F.lit(0).cast("long")
    return summary.select(F.greatest(zero, F.col("claim_cites")).alias("examined"), F.greatest(zero, F.col("judged") - F.col("claim_cites")).alias("nominal"), F.greatest(zero, F.col("exists") - F.col("judged")).alias("unexamined"))


def across(metrics: DataFrame, venues: list[str]) -> DataFrame:
    """metrics (venue, metric, k, n) -> a row a metric with count, trials, share and interval of each venue as text."""
    w = X.wilson(F.col("k"), F.col("n"))
    pct = lambda c: F.format_number(F.bround(100 * c, 2), 2)
    cell = F.concat(F.col("k").cast("string"), F.lit("/"), F.col("n").cast("string"), F.lit(" = "), pct(F.col("k") / F.greatest("n", F.lit(1))), F.lit("% ["), pct(w["low"]), F.lit(", "), pct(w["high"]), F.lit("]"))
    return metrics.withColumn("cell", cell).groupBy("metric").pivot("venue", venues).agg(F.first("cell"))


def missing_estimate(failures: DataFrame, layout: DataFrame) -> DataFrame:
    """failures (paper_id, error) with the layout counter's estimate of their references, null unless it is sound."""
    est = layout.select("paper_id", F.when(F.col("ok"), F.col("layout_count")).alias("estimate"))
    return failures.join(est, "paper_id", "left")


def parse_report(refs: DataFrame, contexts: DataFrame, failed: DataFrame) -> DataFrame:
    """One row of a parse: what came out, what failed, and how many references the failures hide."""
    n = F.count(F.lit(1))
    return beside(refs.agg(n.alias("references"), F.count_distinct("paper_id").alias("papers")), contexts.agg(n.alias("contexts")), failed.agg(n.alias("failures"), F.sum(F.coalesce("estimate", F.lit(0))).alias("refs_missing_estimate")))


def in_order(rows: DataFrame, done: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows of done that answer to rows, in the order of rows."""
    at = rows.select(key, *[F.col(c).alias(f"_{i}") for i, c in enumerate(order)])
    return at.join(done, key).orderBy(*[f"_{i}" for i in range(len(order))]).select(*done.columns)
