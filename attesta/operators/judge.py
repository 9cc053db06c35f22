"""Judges: pluggable functions from claims to labels, run where the rows are, with the model recorded on each row."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.sources.fetch import retried

# The labels of each judge.
CATEGORIES = ("known_paper", "plausible_paper", "non_paper", "garbled", "suspicious")
SUBTYPES = ("software", "model", "dataset", "webpage", "docs", "blog", "standard", "thesis", "report", "other")
SUPPORT = ("supported", "partial", "unverifiable_from_text", "not_supported")
ABSTRACT_SUPPORT = ("supported", "partial", "unverifiable_from_abstract", "not_supported")
CITE_TYPES = ("claim", "nominal")
FLAGS = ("confirmed", "refuted")
REFUTED = ("wrong_paper", "contrastive_misread", "negative_claim", "multicite_overreach", "span_ownership", "naming", "insufficient_evidence", "judge_error")
CONFIRMED = ("wrong_reference", "stance_inversion", "overclaim", "misattribution", "loose_cite")

Judge = Callable[[dict], dict | None]


def answered(text: str | None) -> dict | None:
    """A model's JSON object, fenced or in a list or not; None if it is none."""
    bare = re.sub(r"^```(?:json)?\s*|\s*```$", "", (text or "").strip())
    try:
        got = json.loads(bare)
    except ValueError:
        return None
    got = got[0] if isinstance(got, list) and got else got
    return got if isinstance(got, dict) else None


class ChatJudge:
    """A judge behind a chat service. send: a function from a request (model, messages, max_tokens, temperature) to the
    answer's text. template: the question, with fields of the row in braces. Models whose names start as in own_heat get
    no temperature; the others 0. An answer that is no JSON object counts as a failed call."""

    def __init__(self, send: Callable[[dict], str], model: str, system: str, template: str, max_tokens: int = 400, own_heat: tuple[str, ...] = ()):
        self.send, self.model, self.system, self.template, self.max_tokens, self.own_heat = send, model, system, template, max_tokens, own_heat

    def request(self, row: dict) -> dict:
        blank = {k: "?" if v is None or v == "" or v != v else v for k, v in row.items()}
        ask = {"model": self.model, "max_tokens": self.max_tokens, "messages": [{"role": "system", "content": self.system.format(**blank)}, {"role": "user", "content": self.template.format(**blank)}]}
        return ask if self.own_heat and self.model.startswith(self.own_heat) else ask | {"temperature": 0}

    def __call__(self, row: dict) -> dict:
        got = answered(self.send(self.request(row)))
        if got is None:
            raise ValueError("no JSON object")
        return got


def judged(rows: DataFrame, judge: Judge, model: str, out: str, retries: int = 4, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """rows with the judge's fields (DDL out) and model. A judge that raises is asked again, 2**n seconds apart; one that
    fails or answers None leaves nulls: keep such rows out of a `sources.files.Cache` by its answer column."""
    fields = T._parse_datatype_string(out)
    kinds = {f.name: str if isinstance(f.dataType, T.StringType) else float for f in fields}

    def value(answer: dict, name: str):
        v = answer.get(name)
        try:
            return None if v is None else kinds[name](v)
        except (TypeError, ValueError):
            return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            answers = [retried(lambda: judge(row), retries, wait)[0] or {} for row in b.to_dict("records")]  # noqa: B023
            yield b.assign(**{n: pd.Series([value(a, n) for a in answers], b.index, object) for n in kinds}, model=model)

    schema = T.StructType([*rows.schema.fields, *fields.fields, T.StructField("model", T.StringType())])
    return rows.mapInPandas(run, schema)


def valid(label: Column, allowed: tuple[str, ...], other: str = "other") -> Column:
    """A judge's label, or other where it made one up."""
    return F.when(label.isin(*allowed), label).when(label.isNotNull(), other)


def overlap_judge(row: dict) -> dict:
    """A deterministic offline judge of support: by the share of the claim's words that the passages hold. Claims of
    under eight words only name the work."""
    claim, text = set(str(row["claim"]).lower().split()), set(str(row["passages"] or "").lower().split())
    share = len(claim & text) / len(claim) if claim else 0.0
    label = "unverifiable_from_text" if not text else "supported" if share >= 0.6 else "partial" if share >= 0.3 else "not_supported"
    flag, fault = ("confirmed", "misattribution") if label == "not_supported" else ("refuted", "judge_error")
    return {"support": label, "confidence": share, "cite_type": "nominal" if len(claim) < 8 else "claim", "claim_span": str(row["claim"])[:80], "rationale": f"{len(claim & text)} of {len(claim)} words", "flag": flag, "error_class": fault}


def string_judge(row: dict) -> dict:
    """A deterministic offline judge of bibliography entries: by length, digits and links."""
    raw = str(row["raw"])
    if "http" in raw:
        return {"category": "non_paper", "subtype": "webpage", "rationale": "a link", "confidence": 0.9}
    if len(raw) < 20:
        return {"category": "garbled", "subtype": None, "rationale": "short", "confidence": 0.8}
    if not any(c.isdigit() for c in raw):
        return {"category": "suspicious", "subtype": None, "rationale": "no year", "confidence": 0.5}
    return {"category": "plausible_paper", "subtype": None, "rationale": "reads well", "confidence": 0.7}


def arbitrated(flagged: DataFrame, judge: Judge, model: str) -> DataFrame:
    """flagged (ref_id, same_paper, claim, passages, any other columns for the judge) -> flag, support, error_class,
    rationale, confidence, model. What the rules settle never reaches the judge: another paper's record, or no text to
    judge by. Where the judge fails there is no row, so that a later run asks again."""
    rule = F.when(~F.coalesce("same_paper", F.lit(False)), "wrong_paper").when(F.coalesce(F.length("passages"), F.lit(0)) == 0, "insufficient_evidence")
    ruled = flagged.withColumn("rule", rule)
    why = F.when(F.col("rule") == "wrong_paper", "the flag was judged against another paper").otherwise("no text to judge by")
    short = ruled.where("rule is not null").select("ref_id", F.lit("refuted").alias("flag"), F.lit("unverifiable_from_text").alias("support"), F.col("rule").alias("error_class"), why.alias("rationale"), F.lit(1.0).alias("confidence"), F.lit("rule").alias("model"))
    asked = judged(ruled.where("rule is null").drop("rule"), judge, model, "flag string, support string, error_class string, rationale string, confidence double")
    asked = asked.where(F.col("flag").isin(*FLAGS)).withColumns({"support": valid(F.col("support"), SUPPORT), "error_class": F.when(F.col("flag") == "confirmed", valid(F.col("error_class"), CONFIRMED)).otherwise(valid(F.col("error_class"), REFUTED))})
    return short.unionByName(asked.select("ref_id", "flag", "support", "error_class", "rationale", "confidence", "model"))
