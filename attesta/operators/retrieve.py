"""Passages and BM25 over them, as joins on query terms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions import text as X
from attesta.sources import files


def chunks(df: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = 130, overlap: int = 40) -> DataFrame:
    """(id, idx, passage): windows of size words, each overlapping the one before."""
    words = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    w = df.select(id_col, words.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.size("w") - 1, F.lit(size - overlap))
    return w.select(id_col, F.posexplode(F.transform(starts, lambda i: F.array_join(F.slice("w", i + 1, size), " ")))).toDF(id_col, "idx", "passage")


def bm25(passages: DataFrame, queries: DataFrame, keys: list[str], query: str, text: str, query_text: str, k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25, whole: str | None = None) -> DataFrame:
    """keys + query + score of each passage that shares a term with a query. Term weights are floored at epsilon of
    their mean where negative; query terms count as often as they occur. whole: the column, if any, within which
    passages form a corpus of their own; queries must then carry it too."""
    over = [whole] if whole else []
    p = passages.select(*dict.fromkeys([*keys, *over]), X.bag(F.col(text)).alias("bag"))
    sums = [F.count(F.lit(1)).alias("docs"), F.avg(F.size("bag")).alias("mean_length")]
    terms = p.select(*dict.fromkeys([*keys, *over]), F.size("bag").alias("length"), F.explode("bag").alias("term"))
    tf = terms.groupBy(*dict.fromkeys([*keys, *over]), "length", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy(*over, "term").agg(F.count(F.lit(1)).alias("df"))
    rarity = lambda n: F.log(n - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    if over:
        weight = df.join(p.groupBy(*over).agg(*sums), over).withColumn("idf", rarity(F.col("docs")))
        weight = weight.join(weight.groupBy(*over).agg(F.avg("idf").alias("mean_idf")), over)
    else:  # one row of totals each
        total = p.agg(*sums).first()
        weight = df.withColumn("idf", rarity(F.lit(total["docs"]))).withColumn("mean_length", F.lit(total["mean_length"]))
        weight = weight.withColumn("mean_idf", F.lit(weight.agg(F.avg("idf")).first()[0]))
    weight = weight.withColumn("idf", F.when(F.col("idf") < 0, epsilon * F.col("mean_idf")).otherwise(F.col("idf")))
    q = queries.select(query, *over, F.explode(X.bag(F.col(query_text))).alias("term")).groupBy(query, *over, "term").agg(F.count(F.lit(1)).alias("times"))
    hit = tf.join(q, [*over, "term"]).join(weight, [*over, "term"])
    part = F.col("times") * F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean_length")))
    return hit.groupBy(query, *dict.fromkeys([*keys, *over])).agg(F.round(F.sum(part), 6).alias("score"))


def top(scored: DataFrame, query: str, order: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(query).orderBy(F.desc("score"), *order))
    return scored.withColumn("hit_rank", rank).where(F.col("hit_rank") <= k)


def best(passages: DataFrame, queries: DataFrame, keys: list[str], query: str, text: str, query_text: str, k: int, k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25) -> DataFrame:
    """query, keys, score, hit_rank of the k best passages of each query over one corpus: the same rows as `top` of
    `bm25`. Term counts are written once. Scoring is dealt by passage, not by term, so that a common word is no hot key:
    query terms, if small by file size, are broadcast, all sums of a passage are made where it lies, and only the k best
    of each task and query move again."""
    count = F.count(F.lit(1))
    # the empty term stands once in each passage and counts them, empty ones too
    terms = passages.select(*keys, X.bag(F.col(text)).alias("bag")).select(*keys, F.size("bag").alias("length"), F.explode(F.array_append("bag", "")).alias("term"))
    every = files.stored(terms.groupBy(*keys, "length", "term").agg(count.alias("tf")))
    df = files.stored(every.groupBy("term").agg(count.alias("df"), F.sum("tf").alias("occurs")))
    docs, sums, kinds = df.agg(F.max(F.when(F.col("term") == "", F.col("df"))), F.sum(F.when(F.col("term") != "", F.col("occurs"))), F.count_if(F.col("term") != "")).first()
    mean = F.lit((sums or 0) / max(docs or 0, 1) or 1.0)
    df = df.where("term <> ''").withColumn("idf", F.log(F.lit(docs or 0) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    mean_idf = df.agg(F.sum("idf")).first()[0] / kinds if kinds else 0.0
    weight = F.when(F.col("idf") < 0, epsilon * F.lit(mean_idf)).otherwise(F.col("idf"))
    q = queries.select(query, F.explode(X.bag(F.col(query_text))).alias("term")).groupBy(query, "term").agg(count.alias("times"))
    q = files.stored(q.join(df, "term").select(query, "term", (F.col("times") * weight * (k1 + 1)).alias("weight")))
    part = F.col("weight") * F.col("tf") / (F.col("tf") + k1 * (1 - b + b * F.col("length") / mean))
    scored = every.repartition(*keys).join(q, "term").groupBy(query, *keys).agg(F.round(F.sum(part), 6).alias("score"))
    return top(scored, query, keys, k)


def top_passages(bodies: DataFrame, claims: DataFrame, doc: str, query: str, text: str, query_text: str, k: int) -> DataFrame:
    """query and blocks (array<string>): the k best passages of the claim's own document, in reading order. Each document
    is a corpus of its own; passages that share no word with the claim score 0, ties go to the earlier one, and a claim
    without words gets the first k."""
    c = chunks(bodies, doc, text)
    s = bm25(c, claims, [doc, "idx"], query, "passage", query_text, whole=doc)
    every = c.join(claims.select(doc, query), doc).join(s.select(query, doc, "idx", "score"), [query, doc, "idx"], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    best_k = every.withColumn("r", F.row_number().over(Window.partitionBy(query).orderBy(F.desc("score"), "idx"))).where(F.col("r") <= k)
    return best_k.groupBy(query).agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "passage"))), lambda x: x["passage"]).alias("blocks"))
