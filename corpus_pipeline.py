"""A corpus pipeline of five stages: language, near duplicates, repeated passages, mixture, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one works on all that it kept. Columns of
documents are doc_id, text, lang, source and n_chars; other columns are not read.

Defined cases, in every stage: an empty table gives an empty one; each row is a document of its own, whether its doc_id
is null, shared or its own; repeated rows are treated alike, but for near duplicates and repeated strings, where the
first stays; null or empty text is in no language and goes in the first stage; given to a later stage alone it has no
near duplicate and nothing to cut, takes no place in a mixture, and has no ids; a null lang or source is kept as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm import op1_langid, op3_bpe, op6_suffix_dedup, op7_mixing, op8_ngram_join
from attesta.llm.common import WORD_SQL, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents with a smaller share of known n-grams are in no language that was learnt.
LEAST_SCORE = 0.5
#: Words that a task of the last stage remembers; fewer than alone, for earlier stages' Python workers live on.
KNOWN_WORDS = 250_000


def numbered(docs: DataFrame) -> DataFrame:
    """docs with `row`, a number for each row: doc_id where every row has one of its own. Otherwise rows are numbered in
    order of doc_id (null last) and then content, and written, for a number must stay the same in every later read."""
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    if not ids.where("doc_id is null or rows > 1").limit(1).count():
        return docs.withColumn("row", F.col("doc_id").cast("long"))
    ordered = docs.select(*COLUMNS).orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text", "lang", "source", "n_chars"))
    return stored(ordered.withColumn("row", F.monotonically_increasing_id()))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a letter and those that fit no learnt language; lang becomes the identified one."""
    got = op1_langid.identify(docs, op1_langid.trained(docs))
    return got.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each component of five-word shingle sets with similarity 0.8 or more, that of smallest doc_id;
    rows without doc_id come last. Rows that only share a doc_id stay."""
    docs = numbered(docs)
    got = op8_ngram_join.near_duplicates(docs.select(F.col("row").alias("doc_id"), "text"), n=5, percent=80)
    gone = got.where("doc_id <> component_id").select(F.col("doc_id").alias("row")).distinct()
    return docs.join(gone, "row", "left_anti").select(*COLUMNS)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every 100-byte string that also starts earlier, and what is left of a character that a cut has broken; a
    document of which nothing but space stays goes."""
    rows = numbered(docs).select(F.col("row").alias("doc_id"), F.col("doc_id").alias("id"), "text", "lang", "source", "n_chars")
    got = op6_suffix_dedup.remove_repeats(rows, carry=["id", "lang", "source", "n_chars", "text"])
    kept = F.when(F.size("spans") == 0, F.col("carry.text")).otherwise(F.col("kept_text"))
    got = got.select(F.col("carry.id").alias("doc_id"), kept.alias("text"), "carry.lang", "carry.source", F.size("spans").alias("cut"))
    got = got.where((F.col("cut") == 0) | F.col("text").rlike(WORD_SQL))
    return got.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each pass over a document, range-sorted by training position; the last document of a pass is cut to the
    words still due. Columns of documents have no place for the position, so a reader that deals files anew loses the
    order: `op7_mixing.mix` returns the position itself."""
    docs = numbered(docs)
    mixed = op7_mixing.mix(docs.select(F.col("row").alias("doc_id"), "source", "text")).withColumnRenamed("doc_id", "row")
    takes = F.array(F.struct(F.col("first_take").alias("take"), F.col("position").alias("at")), F.struct(F.col("second_take").alias("take"), F.col("second_position").alias("at")))
    passes = mixed.select("row", "size", F.explode(takes).alias("pass")).where("pass.take > 0").select("row", "size", "pass.take", "pass.at")
    words = F.regexp_extract_all("text", F.lit(WORD_SQL), F.lit(0))
    text = F.when(F.col("take") < F.col("size"), F.concat_ws(" ", F.slice(words, F.lit(1), F.col("take").cast("int")))).otherwise(F.col("text"))
    rows = docs.join(passes, "row").withColumn("text", text).withColumn("n_chars", F.when(F.col("take") < F.col("size"), F.length("text")).otherwise(F.col("n_chars")))
    return rows.orderBy("at", "row").select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of whole texts as little-endian unsigned 32-bit integers."""
    return op3_bpe.encode(op3_bpe.fewer_tasks(docs.select("doc_id", "lang", "source", "text")), *op3_bpe.public(), known_words=KNOWN_WORDS).select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeats", repeats), ("mixture", mixture), ("token_ids", token_ids)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
