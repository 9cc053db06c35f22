"""References, citation contexts and failures of parsed papers (TEI), read in one pass.

The XML is read in Python, which keeps mixed content in order; ids, years and fallbacks are column expressions. A document
that cannot be read gives a row with its error and never stops the job. Documents with a type declaration are refused, so
that no entity is expanded.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.functions import text as X

REFERENCE = "ref_id string, paper_id string, index int, raw string, title string, authors array<string>, year int, venue string, doi string, arxiv_id string, extractor string"
CONTEXT = "paper_id string, ref_id string, marker string, sentence string, section string, ord long"
TEI = "{http://www.tei-c.org/ns/1.0}"
XML_ID = "{http://www.w3.org/XML/1998/namespace}id"
_SCAN = "paper_id string, kind string, ord long, raw string, a string, m string, j string, authors array<string>, doi string, arxiv string, date string, marker string, sentence string, section string, error string"
_NAMES = [f.split()[0] for f in _SCAN.split(", ")]
REF, CTX, ERR = "reference", "context", "error"


def _text(el) -> str:
    return "" if el is None else " ".join("".join(el.itertext()).split())


def _root(tei: str | None) -> ET.Element:
    if not tei:
        raise ValueError("no TEI")
    if "<!DOCTYPE" in tei or "<!ENTITY" in tei:
        raise ValueError("a type declaration is refused")
    return ET.fromstring(tei)


def _listed(root: ET.Element) -> list[ET.Element]:
    """Entries of bibliography lists; the paper's own entry in the header is in none."""
    return root.findall(f".//{TEI}listBibl/{TEI}biblStruct")


def _entry(e: ET.Element) -> dict:
    title = lambda level, up="": _text(e.find(f".//{up}{TEI}title[@level='{level}']"))
    ids = {(x.get("type") or "").lower(): _text(x) for x in e.iter(f"{TEI}idno")}
    date = e.find(f".//{TEI}imprint/{TEI}date")
    names = [" ".join(filter(None, map(_text, p))) for p in e.findall(f".//{TEI}author/{TEI}persName")]
    return {"raw": _text(e.find(f"{TEI}note[@type='raw_reference']")), "a": title("a"), "m": title("m", f"{TEI}monogr/"), "j": title("j", f"{TEI}monogr/"), "authors": [n for n in names if n], "doi": ids.get("doi", ""), "arxiv": ids.get("arxiv", ""), "date": "" if date is None else date.get("when") or _text(date)}


def _cited(el: ET.Element, section: str | None) -> Iterator[tuple[ET.Element, str | None]]:
    """Sentences inside divisions, in document order, each once and with the head of its innermost division."""
    for child in el:
        if child.tag == f"{TEI}div":
            yield from _cited(child, _text(child.find(f"{TEI}head")))
        else:
            if child.tag == f"{TEI}s" and section is not None:
                yield child, section
            yield from _cited(child, section)


def _contexts(root: ET.Element) -> Iterator[dict]:
    raws = {f"#{e.get(XML_ID)}": _text(e.find(f"{TEI}note[@type='raw_reference']")) for e in _listed(root) if e.get(XML_ID)}
    body = root.find(f".//{TEI}text/{TEI}body")
    for s, section in _cited(body, None) if body is not None else ():
        for mark in s.findall(f"{TEI}ref[@type='bibr']"):
            if raw := raws.get(mark.get("target") or ""):
                yield {"raw": raw, "marker": _text(mark), "sentence": _text(s), "section": section}


def scanned(files: DataFrame) -> DataFrame:
    """files (paper_id, tei, and optionally tei_full, the run that has the body) -> a row for each bibliography entry,
    citation marker and error. If only the full run fails, the references stay and the error is told."""
    full = "tei_full" if "tei_full" in files.columns else "tei"

    def rows(paper, tei, whole) -> Iterator[dict]:
        try:
            root = _root(tei)
            for i, e in enumerate(_listed(root)):
                yield {"kind": REF, "ord": i} | _entry(e)
            for i, c in enumerate(_contexts(root if whole is tei else _root(whole))):
                yield {"kind": CTX, "ord": i} | c
        except (ET.ParseError, ValueError) as e:
            yield {"kind": ERR, "ord": 0, "error": f"TEI parse: {e}"[:500]}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [{"paper_id": p} | r for p, t, w in zip(b["paper_id"], b["tei"], b[full], strict=True) for r in rows(p, t, t if full == "tei" else w)]
            yield pd.DataFrame([[r.get(n) for n in _NAMES] for r in got], columns=_NAMES, dtype=object)

    return files.select("paper_id", "tei", *([full] if full != "tei" else [])).mapInPandas(run, _SCAN)


def references(scan: DataFrame) -> DataFrame:
    """References of a scan. A title falls back to the book's, a venue that only repeats the title is blank."""
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    r = scan.where(F.col("kind") == REF).withColumn("index", F.col("ord").cast("int"))
    r = r.withColumn("arxiv_id", F.coalesce(X.arxiv_in(F.col("arxiv")), X.norm_arxiv(F.col("arxiv")), blank("arxiv"), X.arxiv_in(F.col("raw"))))
    r = r.withColumn("title", F.coalesce(blank("a"), blank("m"))).withColumn("venue", F.coalesce(blank("j"), blank("m")))
    return r.select(F.concat_ws("#", "paper_id", "index").alias("ref_id"), "paper_id", "index", "raw", "title", "authors", X.publication_year(F.col("date"), F.col("raw"), F.col("arxiv_id")).alias("year"), F.nullif("venue", "title").alias("venue"), F.coalesce(F.lower(blank("doi")), X.doi_in(F.col("raw"))).alias("doi"), "arxiv_id", F.lit("grobid").alias("extractor"))


def contexts(scan: DataFrame, refs: DataFrame) -> DataFrame:
    """Citing sentences of a scan, bridged to refs by bibliography fingerprint, the last reference of a fingerprint
    winning; what no audited reference answers to is dropped."""
    c = scan.where(F.col("kind") == CTX).select("paper_id", "ord", "marker", "sentence", "section", X.fingerprint(F.col("raw")).alias("fp"))
    bridge = refs.where("raw <> ''").withColumn("fp", X.fingerprint(F.col("raw"))).groupBy("paper_id", "fp").agg(F.max_by("ref_id", "index").alias("ref_id"))
    return c.join(bridge, ["paper_id", "fp"]).select("paper_id", "ref_id", "marker", "sentence", F.nullif("section", F.lit("")).alias("section"), "ord")


def failures(scan: DataFrame) -> DataFrame:
    return scan.where(F.col("kind") == ERR).select("paper_id", "error")


def tei_references(files: DataFrame) -> DataFrame:
    """files (paper_id, tei) -> references, a row for each entry of its bibliography."""
    return references(scanned(files))


def tei_contexts(files: DataFrame, refs: DataFrame) -> DataFrame:
    return contexts(scanned(files), refs)
