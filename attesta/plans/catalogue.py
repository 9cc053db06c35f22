"""All registered queries of the engine on the driver's tables, each with the SQL it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.functions import text as X
from attesta.operators import audit, jobs, judge, layout, resolve, retrieve
from attesta.sources import files, index, tei
from attesta.streaming.quota import quota_stream

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def NT(c: str) -> str:  # noqa: N802
    return f"trim(regexp_replace(regexp_replace(lower(translate(strip_accents(coalesce({c}, '')), '{{}}\\', '')), '[^a-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))"


def TOK(c: str) -> str:  # noqa: N802
    return f"list_distinct(list_filter(string_split({NT(c)}, ' '), lambda t: t <> ''))"


STOPS = "[" + ", ".join(f"'{w}'" for w in X.STOP_WORDS) + "]"


def CONTENT(tokens: str) -> str:  # noqa: N802
    return f"list_filter({tokens}, lambda t: length(t) >= 3 AND NOT list_contains({STOPS}, t))"


# --- text


@query(f"SELECT doc_id, {NT('text')} AS norm FROM documents")
def norm_title_docs(spark, d):
    return table(spark, d, "documents").select("doc_id", X.norm_title(F.col("text")).alias("norm"))


@query(f"SELECT doc_id, {NT('text')} AS norm FROM documents")
def norm_title_exact(spark, d):
    """The same by whole Unicode tables; equal where text has no compatibility characters."""
    return table(spark, d, "documents").select("doc_id", X.norm_title(F.col("text"), X.fold_exact).alias("norm"))


@query(f"SELECT doc_id, len({TOK('text')})::BIGINT AS n_tokens, len({CONTENT(TOK('text'))})::BIGINT AS n_content FROM documents")
def title_token_stats(spark, d):
    t = table(spark, d, "documents").select("doc_id", X.title_tokens(F.col("text")).alias("t"))
    return t.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.size(X.content(F.col("t"))).cast("long").alias("n_content"))


FP = "substr(regexp_replace(lower(text), '[^a-z0-9]', '', 'g'), 1, 70)"


@query(f"WITH f AS (SELECT doc_id, source, {FP} AS fp FROM documents), b AS (SELECT fp, max(doc_id) AS bridged FROM f GROUP BY fp) SELECT doc_id, fp, bridged FROM f LEFT JOIN b USING (fp)")
def fingerprint_bridge(spark, d):
    f = table(spark, d, "documents").select("doc_id", X.fingerprint(F.col("text")).alias("fp"))
    return f.join(f.groupBy("fp").agg(F.max_by("doc_id", "doc_id").alias("bridged")), "fp", "left").select("doc_id", "fp", "bridged")


LITERAL_IDS = [
    (1, "https://doi.org/10.1000/XYZ-12.", "CoRR, abs/1907.10597, 2019", "1907"),
    (2, "10.18653/v1/N19-1423).", "Proc. arXiv:2005.14165v3, 2020", "2005"),
    (3, "none", "Journal 1234.5678, 2015", "2015"),
    (4, "doi:10.5555/abc.(def).", "arXiv 1703.03400 preprint", "2017-05"),
]
VALUES_IDS = ", ".join(f"({a}, '{b}', '{c}', '{e}')" for a, b, c, e in LITERAL_IDS)
AX = r"'(?i)(?:arxiv[:\s.]*|\babs/)(\d{4}\.\d{4,5})(?:v\d+)?'"


@query(
    rf"""WITH v(id, doi, raw, date) AS (VALUES {VALUES_IDS}),
a AS (SELECT *, nullif(regexp_extract(raw, {AX}, 1), '') AS arxiv_id, nullif(regexp_extract(date, '(?:19|20)\d{{2}}', 0), '') AS y FROM v)
SELECT id, nullif(regexp_replace(regexp_replace(regexp_extract(lower(doi), '10\.\d{{4,9}}/[^\s"''<>]+', 0), '\.+$', ''), '\)+$', ''), '') AS doi,
nullif(regexp_extract(raw, '(\d{{4}}\.\d{{4,5}})', 1), '') AS bare_arxiv, arxiv_id,
CASE WHEN y = split_part(arxiv_id, '.', 1) THEN list_extract(regexp_extract_all(regexp_replace(raw, {AX}, ' ', 'g'), '(?:19|20)\d{{2}}'), -1) ELSE y END::INTEGER AS year FROM a"""
)
def doi_arxiv_normalise(spark, d):
    v = spark.createDataFrame(LITERAL_IDS, "id int, doi string, raw string, date string").withColumn("ax", X.arxiv_in(F.col("raw")))
    return v.select("id", X.norm_doi(F.col("doi")).alias("doi"), X.norm_arxiv(F.col("raw")).alias("bare_arxiv"), F.col("ax").alias("arxiv_id"), X.publication_year(F.col("date"), F.col("raw"), F.col("ax")).alias("year"))


@query("SELECT c_custkey, regexp_replace(lower(list_extract(regexp_split_to_array(trim(strip_accents(c_name)), '\\s+'), -1)), '[^a-z0-9 ]+', '', 'g') AS surname FROM customer")
def surname_keys(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.element_at(X.author_keys(F.array("c_name")), 1).alias("surname"))


@query(rf"""SELECT page_id, CASE WHEN trim(url) = '' THEN NULL WHEN regexp_matches(url, '\[\[\[|\], \[\[|`,\s*\d') THEN 'ocr_dump'
WHEN contains(lower(url), 'github.com') OR contains(lower(url), 'huggingface.co') THEN 'software_or_model'
WHEN regexp_matches(url, 'https?://\S+') AND len(list_filter(string_split({NT("regexp_replace(url, 'https?://\\S+', ' ', 'g')")}, ' '), lambda t: length(t) > 1)) < 6 THEN 'url_resource' END AS reason FROM pages""")
def non_paper_rules(spark, d):
    return table(spark, d, "pages").select("page_id", X.non_paper(F.col("url")).alias("reason"))


# --- resolution

PAIRS = f"""d AS (SELECT doc_id, {TOK('text')} AS w FROM documents), b AS (SELECT item_id, {TOK('text')} AS w FROM benchmark),
p AS (SELECT doc_id, item_id, len(b.w) AS n, len(list_intersect(b.w, d.w)) AS shared, len(d.w) AS m FROM d, b)"""
BEST = f"WITH {PAIRS}, a AS (SELECT doc_id, item_id, shared / n AS c, row_number() OVER (PARTITION BY doc_id ORDER BY shared / n DESC, item_id) AS r FROM p WHERE n > 0 AND ((n >= 5 AND shared / n >= 0.85) OR (shared / n >= 0.999 AND n >= 3)))"


@query(BEST + " SELECT doc_id, item_id, round_even(c, 3) AS containment FROM a WHERE r = 1")
def token_containment_rescue(spark, d):
    return resolve.containment_rescue(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query(f"WITH d AS (SELECT doc_id, {NT('text')} AS t FROM documents), b AS (SELECT item_id, {NT('text')} AS t FROM benchmark) SELECT doc_id, min(item_id) AS item_id FROM d JOIN b ON contains(d.t, b.t) WHERE length(b.t) >= 16 GROUP BY doc_id")
def substring_rescue(spark, d):
    return resolve.substring_rescue(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("SELECT o_orderkey, arg_min(l_partkey, (l_linenumber, l_partkey)) AS l_partkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def exact_key_first_match(spark, d):
    refs = table(spark, d, "orders").select("o_orderkey")
    index = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_linenumber")
    return resolve.first_match(refs, index, "o_orderkey", "l_linenumber", "l_partkey").select("o_orderkey", "l_partkey")


@query("""WITH p AS (SELECT o_orderkey, l_linenumber AS ln, CASE WHEN l_returnflag <> 'N' THEN l_linestatus = 'O' END AS au, abs(year(o_orderdate) - year(l_shipdate) - l_linenumber % 3) <= 1 AS y
FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
g AS (SELECT o_orderkey, min(ln) FILTER (coalesce(au, false) OR coalesce(y, false)) AS e, max(ln) FILTER (NOT coalesce(y, true) AND au IS NULL) AS m FROM p GROUP BY o_orderkey)
SELECT o_orderkey, CASE WHEN e IS NOT NULL THEN 'exists' WHEN m IS NOT NULL THEN 'minor_mismatch' END AS verdict, coalesce(e, m) AS matched FROM g""")
def corroborated_verdict(spark, d):
    """Stand-in: years up to a year apart agree; every third line is two years off."""
    p = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    p = p.select("o_orderkey", "l_linenumber", F.when(F.col("l_returnflag") != "N", F.col("l_linestatus") == "O").alias("author_overlap"), F.year("o_orderdate").alias("ref_year"), (F.year("l_shipdate") + F.col("l_linenumber") % 3).alias("rec_year"))
    return resolve.corroborated(p, "o_orderkey", "l_linenumber")


@query("""SELECT doc_id, CASE WHEN q = 1 THEN 'exists' WHEN n > 0 AND t = 1 THEN 'minor_mismatch' WHEN b IS NOT NULL THEN 'exists' WHEN n > 0 THEN 'not_found' ELSE 'unparseable' END AS verdict
FROM (SELECT d.doc_id, l.quality AS q, l.toxic AS t, b.item_id AS b, length(""" + NT("d.text") + """) AS n FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN benchmark b ON b.item_id = d.doc_id)""")
def verdict_cascade(spark, d):
    r = table(spark, d, "documents").select("doc_id", F.col("text").alias("title"), F.lit(None).cast("string").alias("doi"), F.lit(None).cast("string").alias("arxiv_id"))
    r = r.join(table(spark, d, "labels"), "doc_id", "left").join(table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"), F.col("item_id").alias("b")), "doc_id", "left")
    return resolve.cascade(r, F.when(F.col("quality") == 1, F.lit(1)), F.when(F.col("toxic") == 1, "minor_mismatch"), F.col("b")).select("doc_id", "verdict")


@query("SELECT o_orderkey, coalesce(c_name, s_name) AS name, CASE WHEN c_name IS NOT NULL THEN 'customer' WHEN s_name IS NOT NULL THEN 'supplier' END AS via FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey LEFT JOIN supplier ON s_suppkey = o_custkey")
def id_priority_coalesce(spark, d):
    c = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("o_custkey"), "s_name")
    j = table(spark, d, "orders").select("o_orderkey", "o_custkey").join(c, "o_custkey", "left").join(s, "o_custkey", "left")
    return j.select("o_orderkey", F.coalesce("c_name", "s_name").alias("name"), F.when(F.col("c_name").isNotNull(), "customer").when(F.col("s_name").isNotNull(), "supplier").alias("via"))


GUARD = [
    (1, "Deep residual connections for image recognition", "K. He. Deep residual connections for image recognition. 2016.", ""),
    (2, "Photonic deep residual connections", "K. He. Deep residual connections for image recognition. 2016.", ""),
    (3, "A survey of biomedical claim verification", "Survey of bio- medical claim verifica- tion. 2021.", "biomed- ical claim"),
    (4, "Traffic forecasting on graphs", "The herd of open foundation models. 2024.", "The herd of open foundation models"),
    (5, "of the and", "anything at all", ""),
]
VALUES_GUARD = ", ".join(f"({a}, '{b}', '{c}', '{e}')" for a, b, c, e in GUARD)


@query(f"""WITH v(id, resolved, raw, parsed) AS (VALUES {VALUES_GUARD}),
t AS (SELECT id, {CONTENT(TOK('resolved'))} AS p, {CONTENT(TOK('raw'))} AS r, {CONTENT(TOK('parsed'))} AS o, replace({NT('raw')}, ' ', '') AS packed FROM v),
c AS (SELECT id, len(p) AS n, len(list_intersect(p, CASE WHEN len(o) < 3 THEN r ELSE o END)) AS s, len(list_filter(p, lambda x: NOT list_contains(r, x) AND NOT list_contains(o, x) AND NOT contains(packed, x))) AS new FROM t)
SELECT id, CASE WHEN n = 0 THEN false ELSE (2 * s >= n OR s >= 4) AND (new = 0 OR (new = 1 AND n > 8)) END AS consistent FROM c""")
def title_consistency_guard(spark, d):
    v = spark.createDataFrame(GUARD, "id int, resolved string, raw string, parsed string")
    return v.select("id", resolve.title_consistent(F.col("resolved"), F.col("raw"), F.col("parsed")).alias("consistent"))


@query(f"""WITH {PAIRS}, s AS (SELECT *, greatest(shared / n, shared / greatest(m, 1)) AS c, doc_id % 2 = item_id % 2 AS au FROM p WHERE n > 0),
f AS (SELECT s.*, len(list_filter({CONTENT(TOK('i.text'))}, lambda x: NOT list_contains({TOK('t.text')}, x) AND NOT contains(replace({NT('t.text')}, ' ', ''), x))) AS new FROM s JOIN documents t USING (doc_id) JOIN benchmark i USING (item_id) WHERE s.c >= 0.5),
g AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY c DESC, item_id) AS r FROM f WHERE (new = 0 OR (new = 1 AND au)) AND ((shared = n AND shared = m) OR (c >= 0.5 AND au)))
SELECT doc_id, item_id, c FROM g WHERE r = 1""")
def resolver_best_hit(spark, d):
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    same = F.col("doc_id") % 2 == F.col("item_id") % 2
    p = resolve.hits(docs, items).withColumn("author_ok", same).withColumn("year_ok", same)
    return resolve.best_hit(p, "doc_id", "item_id")


@query(BEST + f" SELECT doc_id, item_id, list_sort({CONTENT(TOK('d.text'))}) <> list_sort({CONTENT(TOK('b.text'))}) AS wrong FROM a JOIN documents d USING (doc_id) JOIN benchmark b USING (item_id) WHERE r = 1")
def wrong_record_check(spark, d):
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    m = resolve.containment_rescue(docs, items).join(docs.select("doc_id", "text"), "doc_id").join(items.select("item_id", F.col("text").alias("title")), "item_id")
    words = lambda c: F.array_sort(X.content(X.title_tokens(F.col(c))))
    return m.select("doc_id", "item_id", (words("text") != words("title")).alias("wrong"))


# --- retrieval

CHUNKS = """w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda t: t <> '') AS w FROM documents),
c AS (SELECT doc_id, (s // 90)::INTEGER AS idx, array_to_string(list_slice(w, s + 1, s + 130), ' ') AS passage FROM (SELECT doc_id, w, unnest(range(0, len(w), 90)) AS s FROM w))"""


@query(f"WITH {CHUNKS} SELECT * FROM c")
def chunk_windows(spark, d):
    return retrieve.chunks(table(spark, d, "documents"))


def BM25(corpus: str, keys: str) -> str:  # noqa: N802
    return f"""t AS (SELECT {keys}, regexp_extract_all(lower(body), '[a-z0-9]+') AS bag FROM {corpus}),
tf AS (SELECT {keys}, length, term, count(*) AS tf FROM (SELECT {keys}, len(bag) AS length, unnest(bag) AS term FROM t) GROUP BY ALL),
n AS (SELECT count(*) AS docs, avg(len(bag)) AS mean FROM t),
i AS (SELECT term, ln(docs - count(*) + 0.5) - ln(count(*) + 0.5) AS idf FROM tf, n GROUP BY term, docs),
f AS (SELECT term, CASE WHEN idf < 0 THEN 0.25 * (SELECT avg(idf) FROM i) ELSE idf END AS idf FROM i),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, {keys}, round(sum(times * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * length / mean))), 6) AS score FROM tf JOIN q USING (term) JOIN f USING (term), n GROUP BY ALL)"""


@query(f"WITH b AS (SELECT doc_id, text AS body FROM documents), {BM25('b', 'doc_id')} SELECT item_id, doc_id, score, hit_rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS hit_rank FROM s) WHERE hit_rank <= 8")
def candidate_top8(spark, d):
    s = retrieve.best(files.spread(table(spark, d, "documents").select("doc_id", "text")), table(spark, d, "benchmark"), ["doc_id"], "item_id", "text", "text", 8)
    return s.select("item_id", "doc_id", "score", "hit_rank")


@query(f"WITH {CHUNKS}, b AS (SELECT doc_id, idx, passage AS body FROM c), {BM25('b', 'doc_id, idx')} SELECT item_id, doc_id, idx, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, idx) AS r FROM s) WHERE r <= 4")
def bm25_top_passages(spark, d):
    c = retrieve.chunks(files.spread(table(spark, d, "documents").select("doc_id", "text")))
    s = retrieve.best(c, table(spark, d, "benchmark"), ["doc_id", "idx"], "item_id", "passage", "text", 4)
    return s.select("item_id", "doc_id", "idx", "score")


# --- audit


@query("SELECT conv_id, turn, specificity FROM (SELECT conv_id, turn, len(regexp_extract_all(text, '[.,]'))::BIGINT AS specificity, row_number() OVER (PARTITION BY conv_id ORDER BY len(regexp_extract_all(text, '[.,]')), turn) AS r FROM conversations WHERE length(coalesce(text, '')) >= 40) WHERE r = 1")
def pick_context(spark, d):
    return audit.pick_context(table(spark, d, "conversations"), "conv_id", "turn", "text", pattern="[.,]").select("conv_id", "turn", "specificity")


@query("WITH p AS (SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AND doc_id IN (SELECT conv_id FROM conversations)) SELECT source, count(*) AS pool FROM p GROUP BY source HAVING count(*) >= 2")
def judgeable_pool(spark, d):
    p = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi")
    p = p.join(table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id")), "doc_id", "left_semi")
    return p.groupBy("source").agg(F.count(F.lit(1)).alias("pool")).where("pool >= 2")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_todo(spark, d):
    return audit.todo(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("SELECT doc_id, coalesce(CASE WHEN quality = 1 THEN 'exists' END, 'not_found') AS verdict FROM documents LEFT JOIN labels USING (doc_id)")
def override_merge(spark, d):
    first = table(spark, d, "documents").select("doc_id", F.lit("not_found").alias("verdict"))
    later = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "exists").alias("new"))
    return audit.override(first, later, "doc_id", "verdict", "new")


COUNTS = """l AS (SELECT l_orderkey AS k, count(*) AS layout FROM lineitem GROUP BY 1), g AS (SELECT l_orderkey AS k, count(*) AS grobid FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1),
r AS (SELECT k, layout, coalesce(grobid, 0) AS grobid, coalesce(grobid, 0) - layout AS diff, coalesce(grobid, 0) / layout AS ratio FROM l LEFT JOIN g USING (k))"""


def _counts(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), "l_returnflag")
    n = F.count(F.lit(1))
    return audit.compared(li.groupBy("k").agg(n.alias("layout")), li.where("l_returnflag = 'N'").groupBy("k").agg(n.alias("grobid")), "k")


@query(f"WITH {COUNTS} SELECT count(*) AS papers, sum(grobid)::BIGINT AS grobid_total, sum(layout)::BIGINT AS layout_total, median(ratio) AS median_ratio, count_if(abs(diff) <= 2)::BIGINT AS within_2, count_if(abs(diff) <= 2) / count(*) AS within_2_share FROM r")
def compare_counts(spark, d):
    return audit.comparison(_counts(spark, d))


@query(f"""WITH {COUNTS}, c AS (SELECT *, 'control' AS reason FROM r ORDER BY md5('7:' || k), k LIMIT 15),
p AS (SELECT *, 'probe' AS reason FROM r WHERE k NOT IN (SELECT k FROM c) AND -diff BETWEEN 3 AND 40 AND layout <= 160 ORDER BY diff, k LIMIT 15)
SELECT k, diff, reason FROM c UNION ALL SELECT k, diff, reason FROM p""")
def qa_sample(spark, d):
    return audit.qa_sample(_counts(spark, d), "k", "7").select("k", "diff", "reason")


LABELLED = "v AS (SELECT doc_id, source, lang, quality, toxic, CASE WHEN quality = 1 THEN 'exists' WHEN toxic = 1 THEN 'suspect' WHEN quality = 0 THEN 'not_found' ELSE 'unparseable' END AS verdict FROM documents LEFT JOIN labels USING (doc_id))"
VERDICTS = ["exists", "minor_mismatch", "not_found", "suspect", "unparseable"]


def _labelled(spark, d):
    v = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars").join(table(spark, d, "labels"), "doc_id", "left")
    return v.withColumn("verdict", F.when(F.col("quality") == 1, "exists").when(F.col("toxic") == 1, "suspect").when(F.col("quality") == 0, "not_found").otherwise("unparseable"))


@query(f"WITH {LABELLED}, e AS (SELECT unnest({VERDICTS}) AS verdict) SELECT e.verdict, count(v.doc_id) AS n, count(v.doc_id) / (SELECT count(*) FROM v) AS share FROM e LEFT JOIN v USING (verdict) GROUP BY e.verdict")
def verdict_distribution(spark, d):
    return audit.distribution(_labelled(spark, d), "verdict", VERDICTS)


@query("SELECT count(*) AS residual, count_if(quality IS NOT NULL)::BIGINT AS has_id, count_if(lang = 'en')::BIGINT AS has_year, count_if(lang <> 'en' AND quality IS NULL)::BIGINT AS no_year_no_id, count_if(n_chars > 1000)::BIGINT AS matchable FROM documents LEFT JOIN labels USING (doc_id)")
def residual_profile(spark, d):
    c = F.count_if
    return _labelled(spark, d).agg(F.count(F.lit(1)).alias("residual"), c(F.col("quality").isNotNull()).alias("has_id"), c(F.col("lang") == "en").alias("has_year"), c((F.col("lang") != "en") & F.col("quality").isNull()).alias("no_year_no_id"), c(F.col("n_chars") > 1000).alias("matchable"))


ROLL = f"{LABELLED}, p AS (SELECT source, count(*) AS judged, count_if(lang = 'en')::BIGINT AS claim_cites, count_if(quality = 0)::BIGINT AS flags, count_if(quality = 0 AND toxic = 1)::BIGINT AS confirmed, list(doc_id ORDER BY doc_id) FILTER (quality = 0 AND toxic = 1) AS refs FROM v WHERE quality IS NOT NULL GROUP BY source)"


def _rolled(spark, d):
    j = _labelled(spark, d).where("quality is not null")
    return audit.by_paper(j.select("source", "doc_id", (F.col("lang") == "en").alias("is_claim"), (F.col("quality") == 0).alias("is_flag"), ((F.col("quality") == 0) & (F.col("toxic") == 1)).alias("is_confirmed")), "source", "doc_id")


@query(f"WITH {ROLL} SELECT source, judged, claim_cites, flags, confirmed, coalesce(array_to_string(refs, ','), '') AS refs FROM p")
def paper_audit_rollup(spark, d):
    return _rolled(spark, d).withColumn("refs", F.concat_ws(",", F.col("confirmed_refs").cast("array<string>"))).drop("confirmed_refs")


@query(f"WITH {ROLL} SELECT count(*) AS papers, count_if(flags > 0)::BIGINT AS papers_flagged, count_if(confirmed > 0)::BIGINT AS papers_confirmed, sum(claim_cites)::BIGINT AS claim_cites, sum(confirmed)::BIGINT AS confirmed, sum(confirmed) / greatest(sum(claim_cites), 1) AS confirmed_per_cite FROM p")
def corpus_audit_rollup(spark, d):
    return audit.by_corpus(_rolled(spark, d))


@query("""WITH g AS (SELECT source, count_if(quality = 1)::DOUBLE AS k, count(quality)::DOUBLE AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source),
h AS (SELECT source, k, n, k / nullif(n, 0) AS p, nullif(n, 0) AS m, 1.96::DOUBLE AS z FROM g),
i AS (SELECT *, (p + z * z / (2 * m)) / (1 + z * z / m) AS c, z * sqrt(p * (1 - p) / m + z * z / (4 * m * m)) / (1 + z * z / m) AS s FROM h)
SELECT source, k::BIGINT AS k, n::BIGINT AS n, round(coalesce(greatest(0, c - s), 0), 9) AS low, round(coalesce(least(1, c + s), 0), 9) AS high FROM i""")
def wilson_by_group(spark, d):
    g = _labelled(spark, d).groupBy("source").agg(F.count_if(F.col("quality") == 1).alias("k"), F.count("quality").alias("n")).withColumn("w", X.wilson(F.col("k"), F.col("n")))
    return g.select("source", "k", "n", F.round("w.low", 9).alias("low"), F.round("w.high", 9).alias("high"))


@query(f"WITH {LABELLED} SELECT verdict, count_if(lang = 'de')::BIGINT AS de, count_if(lang = 'en')::BIGINT AS en, count_if(lang = 'es')::BIGINT AS es, count_if(lang = 'fr')::BIGINT AS fr FROM v GROUP BY verdict")
def venue_pivot(spark, d):
    p = _labelled(spark, d).groupBy("verdict").pivot("lang", ["de", "en", "es", "fr"]).agg(F.count(F.lit(1)))
    return p.select("verdict", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("de", "en", "es", "fr")])


@query("""WITH c AS (SELECT source, count(*) AS total, count_if(quality = 1) AS e, count_if(quality = 0 AND toxic = 1) AS s, count_if(quality IS NULL AND lang = 'en') AS np, count_if(quality IS NULL AND lang = 'de') AS g FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source)
SELECT source, e::BIGINT AS matched, np::BIGINT AS non_paper, g::BIGINT AS garbled, 0::BIGINT AS index_gap, s::BIGINT AS suspicious, greatest(0, total - e - np - g - s)::BIGINT AS rest, floor(100 * e / total + 0.5)::BIGINT AS coverage FROM c""")
def funnel_partition(spark, d):
    c = F.count_if
    q = F.col("quality")
    g = _labelled(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("total"), c(q == 1).alias("e"), c((q == 0) & (F.col("toxic") == 1)).alias("s"), c(q.isNull() & (F.col("lang") == "en")).alias("np"), c(q.isNull() & (F.col("lang") == "de")).alias("g"))
    zero = F.lit(0).cast("long")
    return g.select("source", *audit.residue(F.col("total"), F.col("e"), zero, zero, F.col("np"), F.col("g"), zero, F.col("s")))


@query("SELECT count(*) AS arbitrated, count_if(toxic = 1)::BIGINT AS confirmed, count_if(toxic = 0)::BIGINT AS refuted, count_if(toxic = 1) / greatest(count(*), 1) AS precision FROM labels WHERE quality = 0")
def two_stage_precision(spark, d):
    f = table(spark, d, "labels").where("quality = 0")
    n = F.count(F.lit(1))
    return f.agg(n.alias("arbitrated"), F.count_if(F.col("toxic") == 1).alias("confirmed"), F.count_if(F.col("toxic") == 0).alias("refuted"), (F.count_if(F.col("toxic") == 1) / F.greatest(n, F.lit(1))).alias("precision"))


WORDS_OF = "list_distinct(list_filter(regexp_split_to_array(lower({}), '\\s+'), lambda t: t <> ''))"


@query(f"""WITH {PAIRS}, a AS (SELECT doc_id, item_id, row_number() OVER (PARTITION BY doc_id ORDER BY shared DESC, item_id DESC) AS r FROM p WHERE n > 0 AND shared >= n * 0.5),
j AS (SELECT doc_id::VARCHAR AS ref_id, lang = 'en' AS same, len(list_intersect({WORDS_OF.format('i.text')}, {WORDS_OF.format('t.text')})) / len({WORDS_OF.format('i.text')}) AS share FROM a JOIN documents t USING (doc_id) JOIN benchmark i USING (item_id) WHERE r = 1)
SELECT ref_id, CASE WHEN same AND share < 0.3 THEN 'confirmed' ELSE 'refuted' END AS flag, CASE WHEN coalesce(NOT same, true) THEN 'wrong_paper' WHEN share < 0.3 THEN 'misattribution' ELSE 'judge_error' END AS error_class FROM j""")
def judged_support(spark, d):
    """Arbitration of documents by the offline judge against the best benchmark item's text."""
    docs, items = table(spark, d, "documents"), table(spark, d, "benchmark")
    m = resolve.contained(docs, items, 0.5).groupBy("rec").agg(F.max_by("title", F.struct("shared", "title")).alias("title"))
    f = docs.join(m.withColumnRenamed("rec", "doc_id"), "doc_id").join(items.select(F.col("item_id").alias("title"), F.col("text").alias("claim")), "title")
    return judge.arbitrated(f.select(F.col("doc_id").cast("string").alias("ref_id"), (F.col("lang") == "en").alias("same_paper"), "claim", F.col("text").alias("passages")), judge.overlap_judge, "offline-overlap-1").select("ref_id", "flag", "error_class")


# --- layout


@query("SELECT l_returnflag, coalesce(min(spot) FILTER (n >= 2), min(least)) AS margin FROM (SELECT l_returnflag, round_even(l_discount * 100 * 2, 0) / 2 AS spot, count(*) AS n, min(l_discount * 100) AS least FROM lineitem GROUP BY 1, 2) GROUP BY l_returnflag")
def column_margin(spark, d):
    li = table(spark, d, "lineitem").select("l_returnflag", (F.col("l_discount") * 100).alias("x0"))
    return layout.column_margin(li, ["l_returnflag"], "x0")


WORDS = [("p", 1, 0, x, t, 10.0, w) for x, t, w in ((10.0, 0.0, "The"), (30.0, 1.5, "first"), (12.0, 3.0, "next"), (40.0, 4.9, "row"), (10.0, 5.1, "then"), (10.0, 20.0, "Last"), (25.0, 20.4, "one"))]


@query("SELECT * FROM (VALUES ('p', 1, 0, 1, 10.0, 10.0, 'The first'), ('p', 1, 0, 2, 12.0, 10.0, 'next row'), ('p', 1, 0, 3, 10.0, 10.0, 'then'), ('p', 1, 0, 4, 10.0, 10.0, 'Last one')) AS t(paper_id, page, col, line, x0, size, text)")
def line_grouping(spark, d):
    return layout.lines(spark.createDataFrame(WORDS, "paper_id string, page int, col int, x0 double, top double, size double, text string"))


BLOCK = [("a", i, 0, x, s, t) for i, (x, s, t) in enumerate([(10.0, 12.0, "References"), (10.0, 9.0, "Adams. One title."), (20.0, 9.0, "continued here"), (10.2, 9.0, "Baker. Second."), (10.0, 9.0, "Clark. Third."), (20.0, 9.0, "more"), (10.0, 9.0, "Davis. Fourth."), (10.0, 9.0, "Evans. Fifth."), (10.0, 12.0, "Appendix"), (10.0, 9.0, "Not a reference")])] + [("b", 0, 0, 1.0, 9.0, "No heading")]
VALUES_BLOCK = ", ".join(f"('{a}', {b}, {c}, {x}, {s}, '{t}')" for a, b, c, x, s, t in BLOCK)


@query(f"""WITH v(paper_id, line_no, col, x0, size, text) AS (VALUES {VALUES_BLOCK}),
h AS (SELECT *, max(line_no) FILTER (lower(trim(text)) IN ('references', 'bibliography')) OVER (PARTITION BY paper_id) AS head FROM v),
i AS (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY line_no) - 1 AS idx FROM h WHERE line_no > head),
b AS (SELECT paper_id, median(size) AS body FROM i WHERE idx < 15 GROUP BY 1),
c AS (SELECT i.*, min(idx) FILTER (idx > 5 AND size > body + 0.4 AND length(text) <= 80 AND regexp_matches(text, '^\\s*\\p{{L}}')) OVER (PARTITION BY i.paper_id) AS cut FROM i JOIN b USING (paper_id)),
k AS (SELECT * FROM c WHERE cut IS NULL OR idx < cut),
m AS (SELECT paper_id, col, coalesce(min(spot) FILTER (n >= 2), min(least)) AS margin FROM (SELECT paper_id, col, round_even(x0 * 2, 0) / 2 AS spot, count(*) AS n, min(x0) AS least FROM k GROUP BY ALL) GROUP BY 1, 2),
r AS (SELECT paper_id, count_if(abs(x0 - margin) <= 2.5 AND length(text) >= 3 AND regexp_matches(text, '^\\s*\\p{{Lu}}')) AS n, count(*) AS block FROM k JOIN m USING (paper_id, col) GROUP BY 1)
SELECT paper_id, CASE WHEN coalesce(block >= 3, false) THEN n ELSE 0 END::BIGINT AS layout_count, coalesce(block >= 3, false) AS ok, CASE WHEN paper_id = 'b' THEN 'no References heading found' ELSE '' END AS note FROM (SELECT DISTINCT paper_id FROM v) LEFT JOIN r USING (paper_id)""")
def reference_block_count(spark, d):
    return layout.entries(spark.createDataFrame(BLOCK, "paper_id string, line_no int, col int, x0 double, size double, text string"))


# --- jobs

QUOTA = "SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW) - 1 AS before FROM events"


@query(QUOTA)
def quota_24h(spark, d):
    return jobs.quota(table(spark, d, "events"), "user_id", "ts").select("event_id", "user_id", "before")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS job_id, max(ts) AS created_at FROM events WHERE event_type = 'purchase' AND ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY user_id")
def latest_done_within_ttl(spark, d):
    e = table(spark, d, "events")
    now = e.agg(F.max("ts")).first()[0]
    since = F.lit(now) - F.expr("interval 7 days")
    return jobs.latest_done(e, "user_id", "ts", "event_id", F.col("event_type") == "purchase", since)


@query("SELECT event_id, rank() OVER (ORDER BY ts) - 1 AS position FROM events WHERE event_type = 'click'")
def queue_position(spark, d):
    return jobs.queue(table(spark, d, "events"), "ts", F.col("event_type") == "click").select("event_id", "position")


@query("SELECT event_id, user_id, ts FROM events WHERE event_type = 'click' ORDER BY ts, event_id LIMIT 1")
def fifo_next(spark, d):
    return table(spark, d, "events").where("event_type = 'click'").orderBy("ts", "event_id").limit(1).select("event_id", "user_id", "ts")


@query(f"WITH q AS ({QUOTA}) SELECT event_id, CASE WHEN value < 1 THEN 'invalid' WHEN event_type = 'purchase' THEN 'reuse' WHEN event_type = 'click' THEN 'attach' WHEN before >= 5 THEN 'over_quota' ELSE 'enqueue' END AS decision FROM events JOIN q USING (event_id)")
def job_dedupe_decision(spark, d):
    q = jobs.quota(table(spark, d, "events"), "user_id", "ts")
    kind = F.col("event_type")
    return q.select("event_id", jobs.admission(F.col("value") >= 1, kind == "purchase", kind == "click", F.col("before")).alias("decision"))


@query(QUOTA)
def stream_vs_batch_quota(spark, d):
    e = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parquet*")
    s = quota_stream(e.select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us")), "user_id")
    return files.drained(s, "quota")


# --- sources

BIB = '@inproceedings{a-2026,\n  title = "{D}eep {P}arsing",\n  author = "Lu, Pan and Ada Byron",\n  year = "2026",\n  url = "https://example.org/2026.conf-long.2/",\n  title = "Deep {P}arsing Again",\n}\nnoise\n@proceedings{f,\n  title = "Front",\n  year = "2026",\n  url = "https://example.org/2026.conf-long.0",\n}\n@article{o,\n  title = "Old",\n  year = "2018",\n  url = "https://example.org/P18-1001",\n}'


@query("SELECT * FROM (VALUES ('2026.conf-long.2', 'Deep Parsing Again', 'Pan Lu|Ada Byron', 2026, 'a-2026', '2026.conf-long'), ('P18-1001', 'Old', '', 2018, 'o', 'P18-1')) AS t(paper_id, title, authors, year, bibkey, volume)")
def bib_entries(spark, d):
    p = files.papers(files.bib_entries(spark.createDataFrame([(BIB,)], "value string")), "conf", ["2026.conf-long", "P18-1"])
    p = p.orderBy("volume", files.paper_number())
    return p.select("paper_id", "title", F.concat_ws("|", "authors").alias("authors"), "year", "bibkey", "volume")


TEI_DOC = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><text><body><div><head>Intro</head><p><s>As shown before <ref type="bibr" target="#b0">[1]</ref>.</s></p></div></body><back><listBibl><biblStruct xml:id="b0"><analytic><title level="a">Green <hi>AI</hi></title><author><persName><forename>Roy</forename><surname>Lee</surname></persName></author></analytic><monogr><title level="j">CoRR</title><imprint><date when="1907"/></imprint></monogr><note type="raw_reference">Roy Lee. Green AI. CoRR, abs/1907.10597, 2019.</note></biblStruct></listBibl></back></text></TEI>'


@query("SELECT 'p#0' AS ref_id, 'Green AI' AS title, 'Roy Lee' AS authors, 2019 AS year, 'CoRR' AS venue, '1907.10597' AS arxiv_id")
def tei_references(spark, d):
    r = tei.tei_references(spark.createDataFrame([("p", TEI_DOC)], "paper_id string, tei string"))
    return r.select("ref_id", "title", F.concat_ws("|", "authors").alias("authors"), "year", "venue", "arxiv_id")


@query("SELECT 'p' AS paper_id, 'p#0' AS ref_id, '[1]' AS marker, 'As shown before [1].' AS sentence, 'Intro' AS section, 0::BIGINT AS ord")
def tei_contexts(spark, d):
    f = spark.createDataFrame([("p", TEI_DOC)], "paper_id string, tei string")
    return tei.tei_contexts(f, tei.tei_references(f))


@query("SELECT 1 AS id, 'A bold move at 5% cost ' || chr(10) || chr(10) || 'End x' AS text")
def tex_clean(spark, d):
    t = spark.createDataFrame([(1, "A \\textbf{bold \\emph{move}} at 5\\% cost % note\n\n\n\nEnd \\cite{x}\\bibliography{refs}")], "id int, tex string")
    return t.select("id", X.clean_tex(F.col("tex")).alias("text"))


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def jsonl_roundtrip(spark, d):
    path = files.scratch(spark)
    files.write_jsonl(table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars"), path)
    return files.read_jsonl(spark, path, "doc_id long, lang string, source string, n_chars long")


@query("SELECT doc_id, source, NULL::VARCHAR AS true_count FROM documents")
def csv_sheet(spark, d):
    path = files.scratch(spark)
    files.write_sheet(table(spark, d, "documents").select("doc_id", "source"), path, ["true_count"])
    return spark.read.option("header", True).schema("doc_id long, source string, true_count string").csv(path)


@query("SELECT doc_id, length(text)::BIGINT AS n FROM documents")
def resume_cache_idempotent(spark, d):
    cache = files.Cache(spark, files.scratch(spark), "doc_id long, n long", "doc_id")
    docs = table(spark, d, "documents").select("doc_id", "text")
    work = lambda x: x.select("doc_id", F.length("text").cast("long").alias("n"))
    cache.run(docs.where("doc_id < 100"), work)  # an interrupted first run
    return cache.run(docs, work)


@query("SELECT item_id, text FROM benchmark")
def snapshot_swap(spark, d):
    s = index.Snapshot(spark, files.scratch(spark))
    s.refresh(table(spark, d, "benchmark"), "item_id", least=1)
    s.refresh(table(spark, d, "benchmark").limit(0), "item_id", least=1)  # too small, refused
    return s.current()
