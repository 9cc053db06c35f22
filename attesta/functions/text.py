"""Normalisation of titles, names and identifiers as column expressions (Column -> Column)."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words too common to tell titles apart.
STOP_WORDS = (
    "the of and for with from a an to in on via using our we this that is are be as by "
    "towards toward large language model models learning based approach method study "
    "networks network system systems data analysis new"
).split()
# Patterns of identifiers and artefacts.
DOI = r"10\.\d{4,9}/[^\s\"'<>]+"
ARXIV = r"(\d{4}\.\d{4,5})"
ARXIV_IN_TEXT = r"(?i)(?:arxiv[:\s.]*|\babs/)(\d{4}\.\d{4,5})(?:v\d+)?"
YEAR = r"(?:19|20)\d{2}"
YEAR_CITATION = r"\b(19|20)\d{2}[a-z]?\b"
URL = r"https?://\S+"
OCR_DUMP = r"\[\[\[|\], \[\[|`,\s*\d"


def _folding() -> tuple[str, str]:
    """Characters of the basic plane that decompose to one base character, with it, and combining marks, with nothing.
    Hangul and compatibility ideographs stay: they are no letters of a normalised title, folded or not."""
    pairs, marks = [], []
    for code in [*range(0xA0, 0xAC00), *range(0xFB00, 0xFFFE)]:
        if unicodedata.combining(chr(code)):
            marks.append(chr(code))
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code) and base.isascii():
            pairs.append((chr(code), base))
    return "".join(p[0] for p in pairs) + "".join(marks), "".join(p[1] for p in pairs)


_FROM, _TO = _folding()
#: Letters that decompose to several: Latin ligatures and the like.
_LIGATURES = [(chr(c), unicodedata.normalize("NFKD", chr(c))) for c in (0x132, 0x133, 0x2122, *range(0xFB00, 0xFB07))]


def fold(text: Column) -> Column:
    """Without accents, for all that folds to ASCII letters in the basic plane; stays in the JVM. `fold_exact` covers
    the other planes and decompositions to several signs."""
    out = F.translate(text, _FROM, _TO)
    for sign, letters in _LIGATURES:
        out = F.replace(out, F.lit(sign), F.lit(letters))
    return out


def fold_exact(text: Column) -> Column:
    """Without accents, for all of Unicode; an Arrow UDF."""

    @F.pandas_udf("string")
    def run(text: pd.Series) -> pd.Series:
        return text.map(lambda s: None if s is None else "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)))

    return run(text)


def norm_title(title: Column, folded=fold) -> Column:
    """The key of a title: no accents, braces or case, letters and digits only, single spaces; null is empty."""
    plain = F.lower(F.translate(folded(F.coalesce(title, F.lit(""))), "{}\\", ""))
    return F.trim(F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9 ]+", " "), " +", " "))


def tokens(normal: Column) -> Column:
    """Distinct words of a normalised text."""
    return F.array_remove(F.array_distinct(F.split(normal, " ")), "")


def title_tokens(title: Column) -> Column:
    return tokens(norm_title(title))


def content(words: Column) -> Column:
    return F.filter(words, lambda t: (F.length(t) >= 3) & ~t.isin(STOP_WORDS))


def norm_doi(doi: Column) -> Column:
    bare = F.regexp_extract(F.lower(doi), DOI, 0)
    return F.nullif(F.regexp_replace(F.regexp_replace(bare, r"\.+$", ""), r"\)+$", ""), F.lit(""))


def norm_arxiv(arxiv: Column) -> Column:
    return F.nullif(F.regexp_extract(arxiv, ARXIV, 1), F.lit(""))


def arxiv_in(raw: Column) -> Column:
    return F.nullif(F.regexp_extract(raw, ARXIV_IN_TEXT, 1), F.lit(""))


def doi_in(raw: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(raw, DOI, 0)), F.lit(""))


def publication_year(date: Column, raw: Column, arxiv: Column) -> Column:
    """The first year of date; if it is only the arXiv id's prefix, the last year of raw outside ids."""
    found = F.nullif(F.regexp_extract(date, YEAR, 0), F.lit(""))
    masked = F.regexp_replace(F.coalesce(raw, F.lit("")), ARXIV_IN_TEXT, " ")
    again = F.try_element_at(F.regexp_extract_all(masked, F.lit(YEAR), F.lit(0)), F.lit(-1))
    return F.when(F.coalesce(found == F.substring_index(arxiv, ".", 1), F.lit(False)), again).otherwise(found).cast("int")


def last_name(author: Column) -> Column:
    """Surname key of 'First Last' or 'Last, First'."""
    a = F.trim(fold(author))
    bare = F.when(F.contains(a, F.lit(",")), F.substring_index(a, ",", 1)).otherwise(F.element_at(F.split(a, r"\s+"), -1))
    return F.regexp_replace(F.lower(bare), "[^a-z0-9 ]+", "")


def author_keys(authors: Column) -> Column:
    return F.filter(F.array_distinct(F.transform(authors, last_name)), lambda k: k != "")


def year_ok(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= 1


def overlap3(a: Column, b: Column) -> Column:
    """Whether keys meet; unknown if either side has none."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.arrays_overlap(a, b))


def specificity(sentence: Column, pattern: str = YEAR_CITATION) -> Column:
    return F.regexp_count(sentence, F.lit(pattern)).cast("long")


def fingerprint(raw: Column, length: int = 70) -> Column:
    return F.substring(F.regexp_replace(F.lower(raw), "[^a-z0-9]", ""), 1, length)


def bag(text: Column) -> Column:
    """Alphanumeric words, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def non_paper(raw: Column) -> Column:
    """Why a residual is no paper: ocr_dump, software_or_model, url_resource, or null."""
    r = F.trim(raw)
    low = F.lower(r)
    left = F.size(F.filter(F.split(norm_title(F.regexp_replace(r, URL, " ")), " "), lambda t: F.length(t) > 1))
    return F.when(r == "", None).when(r.rlike(OCR_DUMP), "ocr_dump").when(low.contains("github.com") | low.contains("huggingface.co"), "software_or_model").when(r.rlike(URL) & (left < 6), "url_resource")


def debrace(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, "{}", ""), r"\s+", " "))


def split_authors(raw: Column) -> Column:
    """'A and B' in BibTeX as 'First Last' names."""

    def one(p: Column) -> Column:
        p = F.regexp_replace(F.trim(p), ",+$", "")
        return F.when(F.contains(p, F.lit(",")), F.trim(F.concat_ws(" ", F.trim(F.regexp_extract(p, "(?s),(.*)$", 1)), F.trim(F.substring_index(p, ",", 1))))).otherwise(p)

    return F.filter(F.transform(F.split(debrace(raw), r"\s+and\s+"), one), lambda p: p != "")


def volume_of(paper_id: Column) -> Column:
    return F.when(paper_id.rlike(r"^[A-Z]\d{2}-\d\d+$"), F.regexp_extract(paper_id, r"^([A-Z]\d{2}-\d)\d+$", 1)).otherwise(F.regexp_replace(paper_id, r"\.[^.]*$", ""))


def is_front_matter(paper_id: Column) -> Column:
    return paper_id.endswith(".0") | paper_id.rlike(r"^[A-Z]\d{2}-\d0+$")


def clean_tex(tex: Column) -> Column:
    """Readable text of a LaTeX body: no comments, bibliography or commands, their last arguments kept. A documented
    subset of what a LaTeX parser does."""
    t = F.regexp_replace(tex, r"(?<!\\)%[^\n]*", "")
    t = F.regexp_replace(t, r"(?s)\\begin\{thebibliography\}.*?\\end\{thebibliography\}", "")
    t = F.regexp_replace(t, r"\\bibliography\{[^}]*\}", "")
    for _ in range(3):  # commands inside arguments of commands
        t = F.regexp_replace(t, r"\\[a-zA-Z]+\*?(?:\[[^\]]*\])?\{([^{}]*)\}", "$1")
    t = F.regexp_replace(F.regexp_replace(t, r"\\([%&_#$])", "$1"), r"\\[a-zA-Z]+\*?", "")
    return F.trim(F.regexp_replace(F.translate(t, "{}", ""), r"\n{3,}", "\n\n"))


def arxiv_id(raw: Column) -> Column:
    """A bare id of a URL, a PDF link or an id with a version; null if it is none."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(raw), r"^(?i)https?://arxiv\.org/(?:abs|pdf)/", ""), r"(?:v\d+)?(?:\.pdf)?$", "")
    return F.when(bare.rlike(r"^(?:\d{4}\.\d{4,5}|[a-z-]+(?:\.[A-Z]{2})?/\d{7})$"), bare)


def run_key(paper: Column, year: Column) -> Column:
    return F.concat_ws("-", F.lit("check"), year.cast("string"), F.replace(paper, F.lit("/"), F.lit("-")))


def run_year(key: Column) -> Column:
    """The first year of a run's key; a key without one is an error."""
    found = F.nullif(F.regexp_extract(key, YEAR, 0), F.lit(""))
    return F.when(found.isNull(), F.raise_error(F.concat(F.lit("no year in run key "), F.coalesce(key, F.lit("null")))).cast("int")).otherwise(found.cast("int"))


def arxiv_tail(url: Column) -> Column:
    """The last path segment of an entry's URL, without a version after a numeric id."""
    tail = F.regexp_extract(F.regexp_replace(url, "/+$", ""), "([^/]*)$", 1)
    head = F.substring_index(tail, "v", 1)
    return F.when(F.contains(tail, F.lit("v")) & head.rlike(r"^[0-9.]*[0-9][0-9.]*$"), head).otherwise(tail)


def digit_year(year: Column) -> Column:
    """A year written in digits only; anything else is null."""
    return F.when(year.rlike(r"^[0-9]{1,9}$"), year).cast("int")


def first_doi(links: Column) -> Column:
    """The first DOI among links (array<string>); null without one."""
    return F.get(F.filter(F.transform(links, norm_doi), lambda d: d.isNotNull()), F.lit(0))


def hit_year(hit: Column) -> Column:
    """The year of a search hit in JSON: the first of its year fields that begins with four digits."""
    one = lambda name: F.regexp_extract(F.get_json_object(hit, f"$.{name}"), r"^([0-9]{4})", 1)
    return F.coalesce(*[F.nullif(one(n), F.lit("")) for n in ("year", "published_year", "pub_year")]).cast("int")


def hit_authors(hit: Column) -> Column:
    """The authors of a search hit in JSON, given as names or as objects with a name."""
    each = F.from_json(F.get_json_object(hit, "$.authors"), "array<string>")
    names = F.transform(F.coalesce(each, F.array().cast("array<string>")), lambda a: F.when(F.startswith(F.ltrim(a), F.lit("{")), F.get_json_object(a, "$.name")).otherwise(a))
    return F.filter(names, lambda n: n.isNotNull() & (n != ""))


def unpublished(record: Column, venue: Column, types: Column) -> Column:
    """Whether an index record shows a preprint that no venue took; no record (null) counts as one."""
    none = F.lower(F.trim(F.coalesce(venue, F.lit("")))).isin("", "arxiv.org", "arxiv")
    return F.when(record.isNull(), True).otherwise(~F.coalesce(F.array_contains(types, "Conference"), F.lit(False)) & none)


def evidence(abstract: Column, blocks: Column, most: int) -> Column:
    """What a judge reads: the abstract, marked, and the passages, between rules, cut to most characters."""
    lead = F.when(F.coalesce(abstract, F.lit("")) != "", F.concat(F.lit("[abstract] "), abstract))
    return F.substring(F.concat_ws("\n---\n", lead, blocks), 1, most)


def client_ip(forwarded: Column) -> Column:
    return F.trim(F.substring_index(forwarded, ",", 1))


def judged_json(answer: Column, schema: str) -> Column:
    """A judge's JSON answer, fenced or wrapped in a list or not."""
    bare = F.regexp_replace(F.trim(answer), r"^```(?:json)?\s*|\s*```$", "")
    return F.from_json(F.regexp_replace(bare, r"(?s)^\[(.*)\]$", "$1"), schema)


def wilson(k: Column, n: Column, z: float = 1.96) -> Column:
    """struct(low, high) of the score interval; zeros without trials."""
    p, m = k / F.nullif(n, F.lit(0)), F.nullif(n, F.lit(0))
    centre, spread = (p + z * z / (2 * m)) / (1 + z * z / m), z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m)) / (1 + z * z / m)
    low, high = F.greatest(F.lit(0.0), centre - spread), F.least(F.lit(1.0), centre + spread)
    return F.struct(F.when(n > 0, low).otherwise(0.0).alias("low"), F.when(n > 0, high).otherwise(0.0).alias("high"))
