"""Fetching from remote services: paced, retried, resumable, with a side output of what failed.

A fetch is any function from a row to an answer. Tasks share a service's rate: each keeps to its part of it, for Spark has
no global limiter. Offline, the function reads files.
"""

from __future__ import annotations

import time
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.functions import text as X
from attesta.sources import files

ATOM, OWN = "{http://www.w3.org/2005/Atom}", "{http://arxiv.org/schemas/atom}"
PDF_LEAST = 10_000


class Pace:
    """Turns of a service: each at least 1/rate seconds after the one before."""

    def __init__(self, rate: float, clock: Callable[[], float] = time.monotonic, wait: Callable[[float], None] = time.sleep):
        self.gap, self.clock, self.wait, self.next = 1 / rate if rate else 0.0, clock, wait, 0.0

    def turn(self) -> None:
        now = self.clock()
        at = max(now, self.next)
        self.next = at + self.gap
        if at > now:
            self.wait(at - now)


class Missing(Exception):
    """The service has no such thing; asking again is of no use."""


def retried(work: Callable, tries: int = 3, wait: Callable[[float], None] = time.sleep):
    """(answer, error): up to tries calls, 2**n seconds apart. Missing is an answer of None at once; whatever else a call
    raises is tried again and then told."""
    error = None
    for n in range(tries):
        try:
            return work(), None
        except Missing:
            return None, None
        except Exception as e:  # a failed call must not end the job
            error = f"{type(e).__name__}: {e}"[:500]
            if n + 1 < tries:
                wait(2.0**n)
    return None, error


def fetched(todo: DataFrame, fetch: Callable[[dict], object], out: str, rate: float = 0.0, tries: int = 3, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """todo with `answer` (type out) and `error`. rate: calls a second over all tasks."""
    parts = todo.rdd.getNumPartitions() if rate else 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pace = Pace(rate / parts if rate else 0.0, wait=wait)
        for b in batches:
            got = []
            for row in b.to_dict("records"):
                pace.turn()
                got.append(retried(lambda: fetch(row), tries, wait))  # noqa: B023
            yield b.assign(answer=[a for a, _ in got], error=[e for _, e in got])

    schema = T.StructType([*todo.schema.fields, T.StructField("answer", T._parse_datatype_string(out)), T.StructField("error", T.StringType())])
    return todo.mapInPandas(run, schema)


def valid_pdf(content: Column, least: int = PDF_LEAST) -> Column:
    return F.coalesce((F.octet_length(content) >= least) & (F.substring(content, 1, 4) == F.lit(b"%PDF")), F.lit(False))


def downloaded(papers: DataFrame, have: DataFrame | None, fetch: Callable[[dict], bytes], rate: float = 4.0, least: int = PDF_LEAST, wait: Callable[[float], None] = time.sleep) -> tuple[DataFrame, DataFrame]:
    """(files, failures) of papers (paper_id, pdf_url): what `have` (paper_id, content) does not hold whole is fetched
    once, written, and split by whether it is a PDF of at least `least` bytes."""
    todo = papers.select("paper_id", "pdf_url")
    if have is not None:
        todo = todo.join(have.where(valid_pdf(F.col("content"), least)).select("paper_id"), "paper_id", "left_anti")
    got = files.stored(fetched(todo, fetch, "binary", rate, wait=wait))
    fine = valid_pdf(F.col("answer"), least)
    new = got.where(fine).select("paper_id", F.col("answer").alias("content"))
    bad = got.where(~fine).select("paper_id", "pdf_url", F.coalesce("error", F.when(F.col("answer").isNull(), "missing").otherwise("not a whole PDF")).alias("error"))
    return new if have is None else have.where(valid_pdf(F.col("content"), least)).select("paper_id", "content").unionByName(new), bad


def extracted(pdfs: DataFrame, extract: Callable[[dict], str], kind: str, cache: files.Cache | None = None, least: int = 500) -> DataFrame:
    """paper_id, kind, tei, error of pdfs (paper_id, content) by an extractor (a function from a row to TEI). cache: a
    `Cache` with the schema of the result and answer 'tei'; TEI of up to `least` characters is no result."""

    def work(todo: DataFrame) -> DataFrame:
        got = fetched(todo.select("paper_id", "content"), extract, "string")
        whole = F.length("answer") > least
        return got.select("paper_id", F.lit(kind).alias("kind"), F.when(whole, F.col("answer")).alias("tei"), F.coalesce("error", F.when(~F.coalesce(whole, F.lit(False)), "empty TEI")).alias("error"))

    return work(pdfs) if cache is None else cache.run(pdfs, work)


def atom_entries(feeds: DataFrame) -> DataFrame:
    """Entries of Atom feeds (page, answer), in order of page and place. A broken feed has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain = lambda e, tag: " ".join((e.findtext(tag) or "").split())
        for b in batches:
            rows = []
            for page, feed in zip(b["page"], b["answer"], strict=True):
                try:
                    found = ET.fromstring(feed).findall(f"{ATOM}entry") if feed and "<!ENTITY" not in feed else []
                except ET.ParseError:
                    found = []
                for i, e in enumerate(found):
                    rows.append((page, i, plain(e, f"{ATOM}id"), plain(e, f"{ATOM}title"), [n for a in e.findall(f"{ATOM}author") if (n := plain(a, f"{ATOM}name"))], plain(e, f"{ATOM}published"), plain(e, f"{OWN}journal_ref"), plain(e, f"{OWN}doi")))
            yield pd.DataFrame(rows, columns=["page", "place", "url", "title", "authors", "published", "journal_ref", "doi"])

    return feeds.select("page", "answer").mapInPandas(run, "page long, place int, url string, title string, authors array<string>, published string, journal_ref string, doi string")


def paper_meta(feeds: DataFrame, year: int) -> DataFrame:
    """paper_id, title, year, authors of single-entry feeds; an entry titled 'error' or not at all is none; a paper
    without a date is of the given year."""
    e = atom_entries(feeds).where((F.col("place") == 0) & (F.col("title") != "") & (F.lower("title") != "error"))
    return e.select(X.arxiv_tail(F.col("url")).alias("paper_id"), "title", F.coalesce(F.nullif(F.regexp_extract("published", r"^([0-9]{4})", 1), F.lit("")).cast("int"), F.lit(year)).alias("year"), "authors")


def preprints(entries: DataFrame, index: DataFrame | None, venue: str, n: int) -> DataFrame:
    """The first n entries, in feed order, that were never published: no journal or DOI of their own, and the index
    (arxiv_id, venue, publication_types), where it knows them, has them in no venue."""
    e = entries.where("coalesce(journal_ref, '') = '' and coalesce(doi, '') = ''").withColumn("paper_id", X.arxiv_tail(F.col("url")))
    if index is not None:
        known = index.groupBy(F.col("arxiv_id").alias("paper_id")).agg(F.min_by(F.struct(F.lit(1).alias("one"), "venue", "publication_types"), "corpus_id").alias("known"))
        e = e.join(known, "paper_id", "left").where(X.unpublished(F.col("known.one"), F.col("known.venue"), F.col("known.publication_types")))
    e = e.orderBy("page", "place").limit(n)
    year = F.coalesce(F.nullif(F.regexp_extract("published", r"^([0-9]{4})", 1), F.lit("")).cast("int"), F.lit(0))
    return e.select("paper_id", "title", "authors", year.alias("year"), F.lit(venue).alias("venue"), F.lit(venue).alias("volume"), F.concat(F.lit("https://arxiv.org/pdf/"), "paper_id").alias("pdf_url"), F.concat(F.lit("https://arxiv.org/abs/"), "paper_id").alias("url"))


def pages(spark: SparkSession, fetch: Callable[[dict], str], first: int, count: int, rate: float = 1 / 3) -> DataFrame:
    """Feed pages first .. first + count - 1, a task each at the service's rate."""
    return fetched(spark.range(first, first + count, 1, max(1, min(count, 8))).withColumnRenamed("id", "page"), fetch, "string", rate)
