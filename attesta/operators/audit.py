"""Pools, selections, distributions and roll-ups of audited records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions import text as X


def pick_context(contexts: DataFrame, key: str, ord_col: str, text: str, least: int = 40, pattern: str = X.YEAR_CITATION) -> DataFrame:
    """The context of each key with the fewest matches of pattern, the first on ties; short ones do not count."""
    c = contexts.where(F.length(F.coalesce(F.col(text), F.lit(""))) >= least).withColumn("specificity", X.specificity(F.col(text), pattern))
    rank = F.row_number().over(Window.partitionBy(key).orderBy("specificity", ord_col))
    return c.withColumn("r", rank).where("r = 1").drop("r")


def todo(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What a resumed stage still has to do."""
    return inputs.join(done.select(key), key, "left_anti")


def override(first: DataFrame, later: DataFrame, key: str, value: str, new: str) -> DataFrame:
    """first, with later's value where it has one."""
    return first.join(later.select(key, new), key, "left").withColumn(value, F.coalesce(new, value)).drop(new)


def last_wins(rows: DataFrame, key: str, ord_col: str) -> DataFrame:
    fields = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*fields), ord_col).alias("s")).select(key, "s.*")


def distribution(rows: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Count and share of each of values, zeros included, in one aggregate."""
    counts = [F.count_if(F.col(key) == v).alias(f"c{i}") for i, v in enumerate(values)]
    one = rows.agg(*counts, F.count(F.lit(1)).alias("total"))
    items = F.array(*[F.struct(F.lit(v).alias(key), F.col(f"c{i}").alias("n")) for i, v in enumerate(values)])
    return one.select(F.explode(items).alias("e"), "total").select(f"e.{key}", "e.n", (F.col("e.n") / F.nullif(F.col("total"), F.lit(0))).alias("share"))


def sampled(rows: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """A uniform sample that depends on seed and keys only, not on partitions."""
    return rows.withColumn("draw", F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))).orderBy("draw", key).limit(n).drop("draw")


def compared(layout: DataFrame, parsed: DataFrame, key: str) -> DataFrame:
    """layout (key, layout) against parsed (key, grobid) counts: difference and ratio of each."""
    both = layout.join(parsed, key, "left").withColumn("grobid", F.coalesce("grobid", F.lit(0)))
    return both.withColumn("diff", F.col("grobid") - F.col("layout")).withColumn("ratio", F.col("grobid") / F.col("layout"))


def comparison(rows: DataFrame) -> DataFrame:
    near = F.count_if(F.abs("diff") <= 2)
    return rows.agg(F.count(F.lit(1)).alias("papers"), F.sum("grobid").alias("grobid_total"), F.sum("layout").alias("layout_total"), F.percentile("ratio", F.lit(0.5)).alias("median_ratio"), near.alias("within_2"), (near / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("within_2_share"))


def qa_sample(rows: DataFrame, key: str, seed: str, control: int = 15, probe: int = 15, most: int = 160) -> DataFrame:
    """A random control sample, and the worst of the others in a band of missing entries, with the reason of each."""
    c = sampled(rows, key, seed, control).withColumn("reason", F.lit("control"))
    band = rows.where((-F.col("diff")).between(3, 40) & (F.col("layout") <= most))
    p = todo(band, c, key).orderBy("diff", key).limit(probe).withColumn("reason", F.lit("probe"))
    return c.unionByName(p)


def by_paper(judged: DataFrame, paper: str, ref: str) -> DataFrame:
    """judged (paper, ref, is_claim, is_flag, is_confirmed) -> a roll-up of each paper with its confirmed refs."""
    detail = F.array_sort(F.collect_list(F.when(F.col("is_confirmed"), F.col(ref))))
    return judged.groupBy(paper).agg(F.count(F.lit(1)).alias("judged"), F.count_if("is_claim").alias("claim_cites"), F.count_if("is_flag").alias("flags"), F.count_if("is_confirmed").alias("confirmed"), detail.alias("confirmed_refs"))


def by_corpus(papers: DataFrame) -> DataFrame:
    some = lambda c: F.count_if(F.col(c) > 0)
    n = F.count(F.lit(1))
    return papers.agg(n.alias("papers"), some("flags").alias("papers_flagged"), some("confirmed").alias("papers_confirmed"), F.sum("claim_cites").alias("claim_cites"), F.sum("confirmed").alias("confirmed"), (F.sum("confirmed") / F.greatest(F.sum("claim_cites"), F.lit(1))).alias("confirmed_per_cite"))


def residue(total: Column, exists: Column, minor: Column, rescued: Column, non_paper: Column, garbled: Column, gap: Column, suspicious: Column) -> list[Column]:
    """The parts of a check's references; what is in none of them is `rest`, so parts always sum to the total."""
    matched = exists + minor + rescued
    rest = F.greatest(F.lit(0), total - matched - non_paper - garbled - gap - suspicious)
    coverage = F.when(total > 0, F.floor(100 * matched / F.nullif(total, F.lit(0)) + 0.5)).otherwise(0)
    return [matched.alias("matched"), non_paper.alias("non_paper"), garbled.alias("garbled"), gap.alias("index_gap"), suspicious.alias("suspicious"), rest.alias("rest"), coverage.cast("long").alias("coverage")]
