"""Sources and sinks: JSON lines and reports, BibTeX, TeX archives, listings, resumable caches."""

from __future__ import annotations

import io
import tarfile
import uuid
import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.functions import text as X


def read_jsonl(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines of a known schema; blank lines do not count, a malformed one fails."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_sheet(df: DataFrame, path: str, blanks: list[str]) -> None:
    """A worksheet with a header and empty columns to fill in."""
    df.withColumns({c: F.lit("") for c in blanks}).write.mode("overwrite").option("header", True).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A one-row frame as one JSON document."""
    df.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame | None:
    """A JSON report, over several lines or not; None if there is none."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def listed(spark: SparkSession, folder: str, pattern: str = "*.pdf", limit: int | None = None) -> DataFrame:
    """Files of a folder in order of their paths, the first `limit` if one is given: path, name without suffix, length,
    content."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    f = f.select("path", F.regexp_extract("path", r"([^/]+?)(?:\.[^./]+)?$", 1).alias("paper_id"), "length", "content").orderBy("path")
    return f if limit is None else f.limit(limit)


def bib_records(spark: SparkSession, path: str) -> DataFrame:
    """BibTeX files (gzipped or not) cut at each @ in column 0, so that large files are read by many tasks."""
    return spark.read.option("lineSep", "\n@").text(path).where(F.col("value").rlike(r"^@?\w+\s*\{")).select(F.regexp_replace("value", "^@?", "\n@").alias("value"))


def bib_entries(texts: DataFrame, value: str = "value") -> DataFrame:
    """A row for each BibTeX entry of texts (whole files, or `bib_records`): from an @ in column 0 to the first line
    that begins with }."""
    parts = F.split(F.concat(F.lit("\n"), F.col(value)), "\n@")
    body = texts.select(F.explode(F.slice(parts, 2, F.size(parts))).alias("e"))
    return body.select(F.regexp_replace(F.concat(F.lit("@"), "e"), r"(?s)\n\}.*$", "\n}").alias("entry"))


def papers(entries: DataFrame, venue: str, prefixes: list[str], base: str = r"https://[^/]+/") -> DataFrame:
    """Papers of entries: fields by lower-cased name, the last of a name wins; entries without an id URL, of other
    volumes, front matter and such without a year leave."""
    pattern = F.lit(r'(?s)(\w+)\s*=\s*"((?:[^"\\]|\\.)*)"')
    names = F.transform(F.regexp_extract_all("entry", pattern, F.lit(1)), F.lower)
    pairs = F.arrays_zip(names.alias("k"), F.regexp_extract_all("entry", pattern, F.lit(2)).alias("v"))
    field = lambda n: F.element_at(F.filter("pairs", lambda p: p["k"] == n), -1)["v"]
    p = entries.select("entry", pairs.alias("pairs")).where(F.size(F.filter("pairs", lambda x: x["k"] == "url")) > 0)
    has = lambda n: F.when(F.size(F.filter("pairs", lambda x: x["k"] == n)) > 0, field(n))
    p = p.select(F.regexp_extract(field("url"), f'^{base}([^/"]+?)/?$', 1).alias("paper_id"), X.debrace(has("title")).alias("title"), X.split_authors(F.coalesce(has("author"), F.lit(""))).alias("authors"), has("year").alias("y"), has("doi").alias("doi"), has("pages").alias("pages"), F.regexp_extract("entry", r"^@\w+\{([^,]*),", 1).alias("bibkey"))
    p = p.withColumn("volume", X.volume_of(F.col("paper_id"))).withColumn("year", F.expr("try_cast(y as int)")).drop("y")
    wanted = F.lit(False)
    for x in prefixes:
        wanted = wanted | F.startswith(F.col("volume"), F.lit(x))
    p = p.where((F.col("paper_id") != "") & wanted & ~X.is_front_matter(F.col("paper_id")) & F.col("year").isNotNull())
    return p.withColumns({"venue": F.lit(venue), "pdf_name": F.concat("paper_id", F.lit(".pdf"))})


def paper_number() -> Column:
    """Sort key inside a volume, for either form of id."""
    return F.regexp_extract("paper_id", r"(\d+)$", 1).cast("int")


def tex_source(content: Column) -> Column:
    """All .tex files of an e-print payload (tar, gzipped or not; or one gzipped file); empty where there is none."""

    def one(raw: bytes | None) -> str:
        if not raw:
            return ""
        try:
            raw = zlib.decompress(raw, 47)
        except zlib.error:
            pass
        try:
            with tarfile.open(fileobj=io.BytesIO(raw)) as tar:
                return "\n".join(tar.extractfile(m).read().decode("utf-8", "replace") for m in tar if m.isfile() and m.name.endswith(".tex"))
        except tarfile.TarError:
            return raw.decode("utf-8", "replace")

    @F.pandas_udf("string")
    def run(payloads: pd.Series) -> pd.Series:
        return payloads.map(one)

    return run(content)


def digests(files: DataFrame) -> DataFrame:
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"))


class Cache:
    """Results of a resumable stage: append-only Parquet by key. A run computes what is missing and appends it. answer:
    a column that is null where the work failed; such rows are not kept, so a later run tries them again."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, answer: str | None = None):
        self.spark, self.path, self.schema, self.key, self.answer = spark, path, schema, key, answer

    def rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], self.schema)

    def run(self, inputs: DataFrame, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        todo = inputs.join(self.rows().select(self.key), self.key, "left_anti")
        done = compute(todo)
        if self.answer:
            done = done.where(F.col(self.answer).isNotNull())
        done.write.mode("append").parquet(self.path)
        return self.rows()


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that all executors share. A session must name one: a machine's own folder would hold
    parts that other executors cannot read."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{root.rstrip('/')}/attesta-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores; a table of more splits is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def drained(stream: DataFrame, name: str) -> DataFrame:
    """All rows of a finite stream, written once as Parquet by a query with its own checkpoint."""
    path = scratch(stream.sparkSession)
    q = stream.writeStream.format("parquet").option("path", f"{path}/{name}").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/{name}")
