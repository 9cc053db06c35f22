"""Quality rules with repetition coverage.

Words of a text become 64-bit hashes; rolling hashes of several n-gram lengths are sorted in numpy, and a coverage
mask marks every word inside an n-gram that occurs twice or more. The verdict measures the characters under the mask
for each length, and those in repeated lines, against the limits below.

Defined cases: a null or empty text has no words and fails the base rule; windows never cross documents; repeated rows
are judged alike; one row's work is linear in its text (sorting aside), so very long texts need no special case; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from attesta.llm.common import U64, mix, word_hashes

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
#: Largest share of word characters inside repeated n-grams of each length.
MOST_COVERED = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of word characters in lines that equal an earlier one.
MOST_IN_LINES = 0.20
OUT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, most_covered double, line_covered double"


def repeated(hashes: np.ndarray, n: int) -> np.ndarray:
    """Mask of the words inside n-word windows found twice or more."""
    m = len(hashes) - n + 1
    cover = np.zeros(len(hashes), bool)
    if m < 2:
        return cover
    with np.errstate(over="ignore"):
        roll = hashes[:m].copy()
        for j in range(1, n):
            roll = roll * U64(0x9FB21C651E98DF25) + hashes[j : j + m]
    roll = mix(roll)
    o = np.argsort(roll, kind="stable")
    same = roll[o][1:] == roll[o][:-1]
    if not same.any():
        return cover
    hit = np.zeros(m, bool)
    hit[o[1:][same]] = True
    hit[o[:-1][same]] = True
    edge = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(hit)
    edge[at] += 1
    edge[at + n] -= 1
    return np.cumsum(edge[:-1]) > 0


def measure(text: str | None) -> tuple:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    hashes, starts, ends = word_hashes(raw)
    if not len(hashes):
        return 0, 0, 0, 0, 0, True, False, 0.0, 0.0
    points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    chars = points[ends] - points[starts]
    total = int(chars.sum())
    seen, doubles, in_lines = set(), 0, 0
    for line in text.split("\n"):
        if line in seen:
            doubles += 1
            in_lines += len(line) - sum(map(line.count, " \t\v\f\r"))
        elif line.strip(" \t\v\f\r"):
            seen.add(line)
    n = len(hashes)
    repeat = int(repeated(hashes, 3).sum())
    base = n < 50 or 100 * repeat > 50 * n
    worst, over = 0.0, False
    for length, most in MOST_COVERED.items():
        share = float(chars[repeated(hashes, length)].sum()) / total
        worst, over = max(worst, share), over or share > most
        if not share:
            break  # longer repeats hold shorter ones
    share = in_lines / total
    return n, total, int(SYMBOLS[raw].sum()), doubles, repeat, base, not (base or over or share > MOST_IN_LINES), worst, share


def quality(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> a row of measures and verdicts each."""

    def run(batches):
        for b in batches:
            rows = [measure(t.as_py()) for t in b.column("text")]
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            cols = list(zip(*rows, strict=True)) or [()] * 9
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=[x.split()[0] for x in OUT.split(", ")])

    # doc_id keeps its own type
    docs = docs.select("doc_id", "text")
    return docs.mapInArrow(run, OUT.replace("doc_id long", f"doc_id {docs.schema['doc_id'].dataType.simpleString()}"))


def op9_quality(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
