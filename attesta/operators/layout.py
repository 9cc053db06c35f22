"""Counting bibliography entries from positioned words: lines, headings, margins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lines(words: DataFrame) -> DataFrame:
    """words (paper_id, page, col, x0, top, size, text) -> a row for each line. Words in order of (half of top, rounded
    half-even; x0); a line ends where top leaves the line's first word by more than 2. Columns of a page are small, so
    each is folded as one array."""
    key = ["paper_id", "page", "col"]
    w = F.array_sort(F.collect_list(F.struct(F.bround(F.col("top") / 2).alias("band"), "x0", "top", "size", "text")))
    start = F.struct(F.lit(None).cast("double").alias("anchor"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("out"))

    def step(acc, x):
        new = acc["anchor"].isNull() | (F.abs(x["top"] - acc["anchor"]) > 2)
        n = acc["n"] + F.when(new, 1).otherwise(0)
        return F.struct(F.when(new, x["top"]).otherwise(acc["anchor"]).alias("anchor"), n.alias("n"), F.concat(acc["out"], F.array(n)).alias("out"))

    grouped = words.groupBy(*key).agg(w.alias("w")).withColumn("line", F.aggregate("w", start, step, lambda a: a["out"]))
    one = grouped.select(*key, F.posexplode(F.arrays_zip("line", "w")).alias("seq", "e")).select(*key, "seq", F.col("e.line").alias("line"), "e.w.*")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda s: s["text"]), " ")
    return one.groupBy(*key, "line").agg(F.min("x0").alias("x0"), F.percentile("size", F.lit(0.5)).alias("size"), text.alias("text"))


def split_columns(words: DataFrame) -> DataFrame:
    """words (paper_id, page, width, x0, top, size, text) with `col`: 0 left of the page's middle, else 1."""
    return words.withColumn("col", F.when(F.col("x0") < F.col("width") / 2, 0).otherwise(1))


def reading_order(found: DataFrame) -> DataFrame:
    """lines with `line_no` in a paper: by page, the left column before the right, from the top."""
    order = Window.partitionBy("paper_id").orderBy("page", "col", "line")
    return found.withColumn("line_no", F.row_number().over(order) - 1)


def counted(words: DataFrame, papers: DataFrame | None = None) -> DataFrame:
    """The whole counter: words -> (paper_id, layout_count, ok, note). papers: all that were read, so that one without
    words has a row too."""
    return entries(reading_order(lines(split_columns(words))), papers)


def sound(counts: DataFrame) -> DataFrame:
    """Counts that may be compared."""
    return counts.where(F.col("ok") & (F.col("layout_count") != 0))


def column_margin(df: DataFrame, keys: list[str], x0: str) -> DataFrame:
    """The left margin of each column: the smallest position, to half a point, that occurs twice; else the smallest."""
    spots = df.groupBy(*keys, (F.bround(F.col(x0) * 2) / 2).alias("spot")).agg(F.count(F.lit(1)).alias("n"), F.min(x0).alias("least"))
    return spots.groupBy(*keys).agg(F.coalesce(F.min(F.when(F.col("n") >= 2, F.col("spot"))), F.min("least")).alias("margin"))


def entries(df: DataFrame, papers: DataFrame | None = None) -> DataFrame:
    """lines (paper_id, line_no, col, x0, size, text) -> (paper_id, layout_count, ok, note): flush-left capitalised lines
    between the last references heading and the first heading after it that is set larger than the body."""
    paper = Window.partitionBy("paper_id")
    heading = F.lower(F.trim("text")).isin("references", "bibliography")
    d = df.withColumn("head", F.max(F.when(heading, F.col("line_no"))).over(paper)).where(F.col("line_no") > F.col("head"))
    d = d.withColumn("idx", F.row_number().over(paper.orderBy("line_no")) - 1)
    body = d.where("idx < 15").groupBy("paper_id").agg(F.percentile("size", F.lit(0.5)).alias("body"))
    d = d.join(body, "paper_id")
    larger = (F.col("idx") > 5) & (F.col("size") > F.col("body") + 0.4) & (F.length("text") <= 80) & F.col("text").rlike(r"^\s*\p{L}")
    d = d.withColumn("cut", F.min(F.when(larger, F.col("idx"))).over(paper)).where(F.col("cut").isNull() | (F.col("idx") < F.col("cut")))
    d = d.join(column_margin(d, ["paper_id", "col"], "x0"), ["paper_id", "col"])
    good = (F.abs(F.col("x0") - F.col("margin")) <= 2.5) & (F.length("text") >= 3) & F.col("text").rlike(r"^\s*\p{Lu}")
    n = d.groupBy("paper_id").agg(F.count_if(good).alias("layout_count"))
    # a block of under three lines, before any cut, is no bibliography
    block = df.withColumn("head", F.max(F.when(heading, F.col("line_no"))).over(paper)).groupBy("paper_id").agg(F.max("head").alias("head"), F.count_if(F.col("line_no") > F.col("head")).alias("block"))
    every = (df if papers is None else papers).select("paper_id").distinct().join(block, "paper_id", "left").join(n, "paper_id", "left")
    ok = F.coalesce(F.col("block") >= 3, F.lit(False))
    note = F.when(F.col("head").isNull(), "no References heading found").when(~ok, "references block is empty").otherwise("")
    return every.select("paper_id", F.when(ok, F.coalesce("layout_count", F.lit(0))).otherwise(0).cast("long").alias("layout_count"), ok.alias("ok"), note.alias("note"))
