"""Entry points: `python -m attesta.cli VERB ...`, or `spark-submit` with the same words."""

from __future__ import annotations

import argparse
import importlib
import sys

from pyspark.sql import SparkSession

from attesta.operators import judge
from attesta.plans.run import Run, compare


def _judge(name: str) -> judge.Judge:
    """'module:function', or one of the offline judges."""
    if ":" in name:
        module, attribute = name.split(":", 1)
        return getattr(importlib.import_module(module), attribute)
    return {"overlap": judge.overlap_judge, "string": judge.string_judge}[name]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="attesta")
    p.add_argument("--runs", required=True, help="folder of runs, shared by all executors")
    p.add_argument("--key", help="the run's name, with a year in it")
    p.add_argument("--wide", help="Parquet of the wider index")
    p.add_argument("--bodies", help="Parquet of full texts (arxiv_id, body)")
    p.add_argument("--snapshot", help="folder of the local index")
    p.add_argument("--judge", default="overlap")
    p.add_argument("--string-judge", default="string")
    p.add_argument("--model", default="offline-1", help="recorded on each judged row")
    verbs = p.add_subparsers(dest="verb", required=True)
    add = lambda name, *given: [verbs.add_parser(name)] and [verbs.choices[name].add_argument(*a, **k) for a, k in given]
    some = (("--limit",), {"type": int})
    n = (("--n",), {"type": int, "default": 100})
    add("ingest", (("bib",), {}), (("--prefix",), {"action": "append", "default": []}), some)
    add("preprints", (("feeds",), {}), n)
    add("parse", (("tei",), {}), some)
    add("refresh", (("dump",), {}), (("--least",), {"type": int, "default": 1_000_000}), (("--digest",), {}), (("--force",), {"action": "store_true"}))
    add("verify")
    add("triage")
    add("judge", some)
    for name in ("support", "fulltext", "audit"):
        add(name, n)
    add("arbitrate")
    add("compare", (("keys",), {"nargs": "+"}))
    add("check", (("tei",), {}))
    return p


def main(args: list[str], spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.getOrCreate()
    if a.verb != "compare" and not a.key:
        raise SystemExit("--key is needed")
    r = Run(spark, a.runs, a.key or "", a.wide, a.bodies, a.snapshot, lambda stage: print(stage, flush=True))
    by = _judge(a.judge)
    done = {
        "ingest": lambda: r.ingest(a.bib, a.prefix, a.limit), "preprints": lambda: r.preprints(a.feeds, a.n), "parse": lambda: r.parse(a.tei, a.limit),
        "refresh": lambda: r.refresh(a.dump, a.least, a.digest, a.force), "verify": r.verify, "triage": r.triage, "judge": lambda: r.categories(_judge(a.string_judge), a.model, a.limit),
        "support": lambda: r.support(a.n, by, a.model), "fulltext": lambda: r.fulltext(a.n, by, a.model), "arbitrate": lambda: r.arbitrate(by, a.model), "audit": lambda: r.audit(a.n, by, a.model),
        "compare": lambda: compare([Run(spark, a.runs, k) for k in a.keys]), "check": lambda: r.check(a.tei, by, _judge(a.string_judge), a.model),
    }[a.verb]()
    if isinstance(done, str):
        print(done)
        return 0 if done in ("rebuilt", "unchanged") else 1
    done.show(50, False)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
