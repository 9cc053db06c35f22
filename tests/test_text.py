import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from attesta.functions import text as X


def model(s):
    s = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))
    s = re.sub(r"[{}\\]", "", s).lower()
    return " ".join(re.sub(r"[^a-z0-9 ]+", " ", s).split())


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=20), min_size=20, max_size=60))
def test_exact_fold(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.n for r in df.select("i", X.norm_title(F.col("t"), X.fold_exact).alias("n")).collect()}
    assert got == {i: model(t) for i, t in enumerate(texts)}


def test_fast_fold(spark):
    text = "Émile Ångström, Ḃárö {Ö}ž ́e straße"
    assert spark.createDataFrame([(text,)], "t string").select(X.norm_title(F.col("t"))).first()[0] == model(text)


def test_names_and_ids(spark):
    df = spark.createDataFrame([("Lu, Pan", "hep-th/9901001v2"), ("Ada de Byron", "https://arxiv.org/pdf/2304.05376v2.pdf"), ("", "x")], "a string, i string")
    assert [tuple(r) for r in df.select(X.last_name(F.col("a")), X.arxiv_id(F.col("i"))).collect()] == [("lu", "hep-th/9901001"), ("byron", "2304.05376"), ("", None)]


def test_wilson(spark):
    low, high = spark.range(1).select(X.wilson(F.lit(20), F.lit(2110)).alias("w")).first().w
    assert abs(low - 0.00614) < 1e-4 and abs(high - 0.0146) < 1e-4
    assert tuple(spark.range(1).select(X.wilson(F.lit(0), F.lit(0)).alias("w")).first().w) == (0.0, 0.0)
