"""The judging stages of an audit: which rows are judged, with what text, and what becomes of the answers.

Every stage takes frames and a judge and gives rows with the judge's model; where the judge fails there is no row, so a
`sources.files.Cache` asks again. Rows that no judge can help carry the reason in `skipped`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions import text as X
from attesta.operators import audit, resolve, retrieve
from attesta.operators.judge import ABSTRACT_SUPPORT, CATEGORIES, CITE_TYPES, SUBTYPES, SUPPORT, Judge, arbitrated, judged, valid
from attesta.sources import files

#: A body of no more characters is no full text.
BODY_LEAST = 300


def _text(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c)), F.lit(""))


def categorised(suspects: DataFrame, refs: DataFrame, judge: Judge, model: str, year: int) -> DataFrame:
    """ref_id, paper_id, category, subtype, rationale, confidence, raw_head, model of suspects (ref_id, paper_id,
    raw_head), by what their string is. A suspect without a reference is judged by its head; one without a string has
    no row. year: that of the citing papers, so that a recent entry is no reason for suspicion."""
    r = suspects.select("ref_id", "paper_id", "raw_head").join(refs.select("ref_id", "raw", "title", "year"), "ref_id", "left")
    r = r.withColumn("whole", F.coalesce(F.nullif(_text("raw"), F.lit("")), _text("raw_head"))).where("whole <> ''")
    ask = r.select("ref_id", "paper_id", F.substring("whole", 1, 160).alias("head"), F.substring("whole", 1, 400).alias("raw"), F.substring("title", 1, 120).alias("title"), "year", F.lit(year).alias("venue_year"))
    got = judged(ask, judge, model, "category string, subtype string, rationale string, confidence double").where("category is not null")
    subtype = F.when(F.col("category") == "non_paper", valid(F.col("subtype"), SUBTYPES))
    return got.select("ref_id", "paper_id", valid(F.col("category"), CATEGORIES).alias("category"), subtype.alias("subtype"), "rationale", "confidence", F.col("head").alias("raw_head"), "model")


def pool(refs: DataFrame, verdicts: DataFrame, contexts: DataFrame) -> DataFrame:
    """References that exist and that a sentence cites, with its most specific one: what can be judged at all."""
    sure = verdicts.where("verdict = 'exists'").select("ref_id")
    own = audit.pick_context(contexts, "ref_id", "ord", "sentence").select("ref_id", "marker", "sentence", "section")
    return refs.join(sure, "ref_id", "left_semi").join(own, "ref_id")


def drawn(rows: DataFrame, done: DataFrame, key: str, seed: str, n: int, margin: int) -> DataFrame:
    """The rows to judge next for n judged ones, of which `done` holds some: in seeded order, three times what is due,
    or due + margin, for some of them will fail."""
    due = n - done.count()
    return audit.sampled(audit.todo(rows, done, key), key, seed, max(due * 3, due + margin) if due > 0 else 0)


def first_n(judged_rows: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """The first n judged rows in seeded order: an over-drawn sample cut to its size."""
    return audit.sampled(judged_rows, key, seed, n)


def capped(rows: DataFrame, key: list[str], most: int = 60) -> DataFrame:
    """rows of a paper up to `most` in order of key, with whether the paper had more."""
    paper = Window.partitionBy("paper_id")
    r = rows.withColumn("r", F.row_number().over(paper.orderBy(*key))).withColumn("capped", F.count(F.lit(1)).over(paper) > most)
    return r.where(F.col("r") <= most).drop("r")


def abstract_support(rows: DataFrame, papers: DataFrame, judge: Judge, model: str) -> DataFrame:
    """Support of the claims of rows (see `pool`) by the abstract of the cited work; skipped 'no_abstract' where it does
    not resolve to one."""
    r = _resolved(rows, papers).withColumn("claim", _text("sentence"))
    skipped = r.where("hit is null").select("ref_id", "paper_id", F.lit("no_abstract").alias("skipped"))
    ask = r.where("hit is not null").select("ref_id", "paper_id", F.col("claim").alias("citing_sentence"), F.substring("claim", 1, 700).alias("claim"), "section", "marker", F.col("hit.title").alias("cited_title"), F.col("hit.year").alias("cited_year"), F.substring("hit.abstract", 1, 1600).alias("passages"))
    got = judged(ask, judge, model, "support string, claim_span string, rationale string, confidence double").where("support is not null")
    label = F.when(F.col("support") == "unverifiable_from_text", "unverifiable_from_abstract").otherwise(valid(F.col("support"), ABSTRACT_SUPPORT))
    return got.select("ref_id", "paper_id", "citing_sentence", "section", "cited_title", "cited_year", label.alias("support"), "claim_span", "rationale", "confidence", "model").unionByName(skipped, allowMissingColumns=True)


def _resolved(rows: DataFrame, papers: DataFrame) -> DataFrame:
    return rows.join(resolve.resolved(rows, papers).withColumnRenamed("via", "resolved_via"), "ref_id", "left")


def evidence(rows: DataFrame, bodies: DataFrame, k: int, most: int, abstract_only: Column) -> DataFrame:
    """rows (ref_id, hit, claim, cited_arxiv) with source and passages: the abstract and the k best passages of the
    work's body, in reading order, where bodies (arxiv_id, body) hold one long enough; else abstract_only."""
    full = bodies.where(F.length("body") > BODY_LEAST).select(F.col("arxiv_id").alias("cited_arxiv"), "body")
    r = files.stored(rows.join(full.select("cited_arxiv", F.lit(True).alias("has_body")), "cited_arxiv", "left"))
    asked = r.where("has_body").select("ref_id", "cited_arxiv", F.concat_ws(" ", "hit.title", "claim").alias("query"))
    best = retrieve.top_passages(full.join(asked.select("cited_arxiv").distinct(), "cited_arxiv", "left_semi"), asked, "cited_arxiv", "ref_id", "body", "query", k)
    r = r.join(best, "ref_id", "left")
    text = F.when(F.col("has_body"), X.evidence(_text("hit.abstract"), F.col("blocks"), most)).otherwise(abstract_only)
    return r.withColumn("source", F.when(F.col("has_body"), "fulltext").otherwise("abstract")).withColumn("passages", text).drop("has_body", "blocks")


def _with_arxiv(r: DataFrame) -> DataFrame:
    return r.withColumn("cited_arxiv", X.norm_arxiv(F.coalesce("hit.arxiv_id", "arxiv_id")))


def fulltext_support(rows: DataFrame, papers: DataFrame, bodies: DataFrame, judge: Judge, model: str) -> DataFrame:
    """Support and kind of the citations of rows (see `pool`) by the full text, or the abstract, of the cited work;
    skipped 'unresolved' or 'no_text'. The marker stays, for the arbiter."""
    r = _with_arxiv(_resolved(rows, papers)).withColumn("claim", _text("sentence"))
    lost = r.where("hit is null").select("ref_id", "paper_id", F.lit("unresolved").alias("skipped"))
    r = evidence(r.where("hit is not null"), bodies, 6, 5000, F.substring(_text("hit.abstract"), 1, 1600))
    mute = r.where("passages = ''").select("ref_id", "paper_id", F.lit("no_text").alias("skipped"))
    ask = r.where("passages <> ''").select("ref_id", "paper_id", "source", F.col("claim").alias("citing_sentence"), F.substring("claim", 1, 700).alias("claim"), "section", "marker", F.col("hit.title").alias("cited_title"), "cited_arxiv", "passages")
    got = judged(ask, judge, model, "cite_type string, support string, claim_span string, rationale string, confidence double").where("support is not null")
    kept = got.select("ref_id", "paper_id", "source", "citing_sentence", "section", "marker", "cited_title", "cited_arxiv", valid(F.col("cite_type"), CITE_TYPES).alias("cite_type"), valid(F.col("support"), SUPPORT).alias("support"), "claim_span", "rationale", "confidence", "model")
    return kept.unionByName(lost.unionByName(mute), allowMissingColumns=True)


def flagged(support: DataFrame) -> DataFrame:
    """Claims that the cited work does not, or only in part, support."""
    return support.where((F.col("cite_type") == "claim") & F.col("support").isin("not_supported", "partial"))


def arbiter(flags: DataFrame, refs: DataFrame, papers: DataFrame, bodies: DataFrame, judge: Judge, model: str) -> DataFrame:
    """A second judgement of flags, on twice the text. The cited work is resolved again: if that finds another title or
    none, the flag was judged against the wrong paper. Flags whose reference is gone have no row."""
    f = flags.select("ref_id", "citing_sentence", "cited_title", "section", "marker", F.col("support").alias("first_support"), F.col("rationale").alias("first_rationale"), F.col("claim_span").alias("first_span"))
    own = refs.join(f.select("ref_id"), "ref_id", "left_semi")
    r = _with_arxiv(_resolved(own, papers)).join(f, "ref_id").withColumn("claim", _text("citing_sentence"))
    words = lambda c: F.array_sort(X.content(X.title_tokens(F.col(c))))
    r = r.withColumn("same_paper", F.coalesce((words("hit.title") == words("cited_title")) & F.col("hit").isNotNull(), F.lit(False)))
    abstract = F.when(_text("hit.abstract") != "", F.concat(F.lit("[abstract only, no full text available] "), F.substring(_text("hit.abstract"), 1, 2500))).otherwise("")
    r = evidence(r, bodies, 12, 12_000, abstract)
    ask = r.select("ref_id", "same_paper", F.substring("claim", 1, 700).alias("claim"), "passages", "section", "marker", F.substring("raw", 1, 400).alias("raw"), F.col("hit.title").alias("title"), "first_support", "first_rationale", "first_span")
    said = arbitrated(ask, judge, model)
    return r.select("ref_id", "paper_id", "first_support", "first_rationale", "citing_sentence", "first_span", "cited_title", F.col("hit.title").alias("resolved_title")).withColumnRenamed("first_span", "claim_span").join(said, "ref_id")


def arbitration(flags: DataFrame, arbiter_rows: DataFrame) -> DataFrame:
    """flags with what became of each: confirmed, refuted, or null while no arbiter has answered, which counts as
    neither."""
    return flags.join(arbiter_rows.select("ref_id", "flag", "error_class"), "ref_id", "left")


def leads(categories: DataFrame, refs: DataFrame) -> DataFrame:
    """Suspicious entries as shown to a reader."""
    s = categories.where("category = 'suspicious'").select("ref_id", "rationale", "confidence")
    return s.join(refs.select("ref_id", "index", "raw"), "ref_id", "left").select("ref_id", "index", "raw", "rationale", "confidence")


def published(judgements: DataFrame, arbiter_rows: DataFrame) -> DataFrame:
    """Judgements with the arbiter's outcome, by record_key."""
    return judgements.join(arbiter_rows.select("record_key", F.col("flag"), F.col("error_class")), "record_key")
