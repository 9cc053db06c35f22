"""The bibliographic index: built from an XML dump, kept as versioned snapshots, looked up by DOI and by title."""

from __future__ import annotations

import hashlib
import re
import uuid
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from html.entities import name2codepoint

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.functions import text as X

# The record types of a publication dump.
PUBLICATIONS = ("article", "inproceedings", "proceedings", "book", "incollection", "phdthesis", "mastersthesis")
RECORD = "norm_title string, year int, last_names array<string>, doi string, dblp_key string, row_ord long"
_RAW = "kind string, key string, title string, year string, authors array<string>, ee array<string>, error string"
_XML_OWN = {"amp", "lt", "gt", "quot", "apos"}


def entities(dtd: str) -> dict[str, str]:
    """Named characters that a DTD declares; the standard names if it is too short to be one (1000 characters)."""
    if len(dtd) <= 1000:
        return {n: chr(c) for n, c in name2codepoint.items()}
    return {n: chr(int(v)) for n, v in re.findall(r'<!ENTITY\s+(\w+)\s+"&#(\d+);"', dtd)}


def dump_records(spark: SparkSession, path: str, names: dict[str, str] | None = None) -> DataFrame:
    """Records of an XML dump of publications, a row each, whatever their type. The dump is cut at the key attribute that
    each record's first tag has, in one scan by many tasks (a .gz is one task: write it as text once before). Named
    characters are replaced before a record is read; a broken record gives a row with its error."""
    names = names or {n: chr(c) for n, c in name2codepoint.items()}
    ends = rf"(?s)^(.*?</({'|'.join(PUBLICATIONS)})>)"
    cut = spark.read.option("lineSep", ' key="').text(path).select(F.regexp_extract("value", ends, 2).alias("kind"), F.regexp_extract("value", ends, 1).alias("body")).where("kind <> ''")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plain = lambda el: " ".join("".join(el.itertext()).split()) if el is not None else None
        for b in batches:
            rows = []
            for kind, body in zip(b["kind"], b["body"], strict=True):
                text = re.sub(r"&(\w+);", lambda m: m.group() if m.group(1) in _XML_OWN else names.get(m.group(1), m.group()), f'<{kind} key="{body}')
                try:
                    e = ET.fromstring(text)
                except ET.ParseError as x:
                    rows.append((kind, None, None, None, [], [], str(x)[:500]))
                    continue
                rows.append((kind, e.get("key"), plain(e.find("title")), plain(e.find("year")), [plain(a) for a in e.findall("author")], [plain(a) for a in e.findall("ee")], None))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in _RAW.split(", ")])

    return cut.mapInPandas(run, _RAW)


def index_rows(records: DataFrame) -> DataFrame:
    """Index rows of dump records: those with a title. row_ord follows the keys, so that first and last are defined."""
    r = records.where("error is null").select(X.norm_title(F.col("title")).alias("norm_title"), X.digit_year(F.col("year")).alias("year"), F.filter(F.transform("authors", X.last_name), lambda n: n != "").alias("last_names"), X.first_doi(F.col("ee")).alias("doi"), F.col("key").alias("dblp_key"))
    return r.where("norm_title <> ''").withColumn("row_ord", F.xxhash64("dblp_key").bitwiseAND(F.lit((1 << 62) - 1)))


def build_stats(records: DataFrame) -> DataFrame:
    """One row: records with a title, those with a DOI, those left out for want of a title, those that broke."""
    titled = X.norm_title(F.col("title")) != ""
    fine = F.col("error").isNull()
    return records.agg(F.count_if(fine & titled).alias("records"), F.count_if(fine & titled & X.first_doi(F.col("ee")).isNotNull()).alias("with_doi"), F.count_if(fine & ~titled).alias("skipped_no_title"), F.count_if(~fine).alias("broken"))


def published_md5(payload: str) -> str:
    """The digest that a publisher lists beside a dump."""
    md5 = (payload.split() or [""])[0]
    if len(md5) != 32:
        raise ValueError(f"no md5 in {payload[:80]!r}")
    return md5


def downloaded(chunks: Callable[[], Iterator[bytes]], target: str, expect_md5: str) -> int:
    """Streams chunks into target on the driver's machine and checks their digest; a part that fails leaves no file."""
    import os

    seen, size = hashlib.md5(usedforsecurity=False), 0
    with open(f"{target}.part", "wb") as f:
        for c in chunks():
            f.write(c)
            seen.update(c)
            size += len(c)
    if seen.hexdigest() != expect_md5:
        os.unlink(f"{target}.part")
        raise ValueError(f"md5 {seen.hexdigest()}, expected {expect_md5}")
    os.replace(f"{target}.part", target)
    return size


class Fetched:
    """A download that is repeated only if its source changed: `head` gives the source's version (Last-Modified),
    `body` its bytes. The meta file beside it holds version and digest."""

    def __init__(self, target: str, head: Callable[[], str], body: Callable[[], bytes]):
        self.target, self.head, self.body = target, head, body

    def get(self, force: bool = False) -> dict:
        import gzip
        import json
        import os

        meta_path, version = f"{self.target}.meta.json", self.head()
        if not force and os.path.exists(self.target) and os.path.exists(meta_path):
            with open(meta_path) as f:
                meta = json.load(f)
            if meta["version"] == version:
                return meta | {"fetched": False}
        data = self.body()
        data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
        with open(f"{self.target}.part", "wb") as f:
            f.write(data)
        os.replace(f"{self.target}.part", self.target)
        meta = {"version": version, "sha256": hashlib.sha256(data).hexdigest(), "bytes": len(data)}
        with open(meta_path, "w") as f:
            json.dump(meta, f)
        return meta | {"fetched": True}


class Snapshot:
    """A keyed index as versioned Parquet directories behind a pointer. A build becomes current only if it is large
    enough; readers of the old one are not disturbed. One writer at a time, by a lock file that only one can create."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 0):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _version(self):
        try:
            return self.spark.read.parquet(f"{self.root}/pointer").orderBy(F.desc("seq")).first()
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None

    def meta(self) -> dict | None:
        v = self._version()
        return v.asDict() if v else None

    def current(self, by_doi: bool = False) -> DataFrame | None:
        """The index, sorted by its key; or the copy by DOI, which holds rows with one only."""
        v = self._version()
        if not v:
            return None
        name = v["name"] + ("_doi" if by_doi else "")
        if self.spark.catalog.tableExists(name):  # where this session's catalog knows the buckets
            return self.spark.table(name)
        return self.spark.read.parquet(f"{self.root}/{name}")

    def _put(self, rows: DataFrame, key: str, name: str) -> None:
        if self.buckets:
            rows.write.bucketBy(self.buckets, key).sortBy(key).option("path", f"{self.root}/{name}").saveAsTable(name)
        else:
            rows.repartition(F.col(key)).sortWithinPartitions(key).write.parquet(f"{self.root}/{name}")

    def _drop(self, name: str) -> None:
        for n in (name, f"{name}_doi"):
            self.spark.sql(f"drop table if exists {n}")
            self._fs.delete(self._path(f"{self.root}/{n}"), True)

    def refresh(self, build: DataFrame, key: str, least: int = 1_000_000, digest: str | None = None, force: bool = False) -> str:
        """'rebuilt'; 'unchanged' if the current version was built from the same digest; 'refused' if build has under
        least rows, which leaves nothing behind; 'locked' if another writer is at it. Rows with a doi column get a
        second copy by DOI."""
        lock = self._path(f"{self.root}/lock")
        self._fs.mkdirs(self._path(self.root))
        if not self._fs.createNewFile(lock):
            return "locked"
        try:
            now = self._version()
            if digest and not force and now and now["digest"] == digest:
                return "unchanged"
            name = f"v_{uuid.uuid4().hex}"
            self._put(build, key, name)
            made = self.spark.read.parquet(f"{self.root}/{name}")
            n = made.count()
            if n < least:
                self._drop(name)
                return "refused"
            if "doi" in build.columns:
                self._put(made.where("doi is not null"), "doi", f"{name}_doi")
            row = self.spark.sql("select unix_micros(current_timestamp()) as seq")
            row.select("seq", F.lit(name).alias("name"), F.lit(digest).cast("string").alias("digest"), F.lit(n).cast("long").alias("records")).write.mode("append").parquet(f"{self.root}/pointer")
            return "rebuilt"
        finally:
            self._fs.delete(lock, False)


def by_doi(refs: DataFrame, index: DataFrame, doi: str = "doi") -> DataFrame:
    """refs with index rows of the same DOI; the argument is normalised first, an empty key has no rows."""
    r = refs.withColumn("_doi", X.norm_doi(F.col(doi))).where(F.col("_doi").isNotNull())
    return r.join(index.where("doi is not null").withColumnRenamed("doi", "_doi"), "_doi").withColumnRenamed("_doi", "index_doi")


def by_title(refs: DataFrame, index: DataFrame, title: str = "title") -> DataFrame:
    """refs with index rows of the same normalised title; an empty key has no rows."""
    return refs.withColumn("norm_title", X.norm_title(F.col(title))).where("norm_title <> ''").join(index, "norm_title")
