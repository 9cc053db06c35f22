"""A small audit, whole: every stage table as literals, the queries over them, and the SQL they are held against.

The driver's tables have no bibliographies, so the rules that need them run here, each on rows that exercise it.
"""

from __future__ import annotations

import gzip
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.functions import text as X
from attesta.operators import audit, jobs, judge, layout, report, resolve, retrieve, stages
from attesta.plans.catalogue import CONTENT, NT, TOK, query
from attesta.sources import fetch, files, index, tei


def sql(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, list):
        return "[" + ", ".join(map(sql, v)) + "]" + ("::VARCHAR[]" if not v else "")
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)


class Table:
    """Literal rows, as a frame and as a common table expression."""

    def __init__(self, name: str, ddl: str, rows: list[tuple]):
        self.name, self.ddl, self.rows = name, ddl, rows
        self.names = [f.split()[0] for f in ddl.split(", ")]

    def __call__(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, self.ddl)

    @property
    def cte(self) -> str:
        quoted = ", ".join(f'"{n}"' for n in self.names)
        return f"{self.name}({quoted}) AS (VALUES " + ", ".join("(" + ", ".join(map(sql, r)) + ")" for r in self.rows) + ")"


T1, T2, T3 = "Parsing trees with little supervision", "Verification of biomedical claims by retrieval", "Agreement errors in morphologically rich languages"
REFS = Table("refs", "ref_id string, paper_id string, index int, raw string, title string, authors array<string>, year int, doi string, arxiv_id string", [
    ("p#0", "p", 0, "Ada Byron. Parsing trees. doi 10.1000/tree.1", T1, ["Ada Byron"], 2019, "https://doi.org/10.1000/TREE.1.", None),
    ("p#1", "p", 1, "Roy Lee. Verification of biomedical claims by retrieval. 2012.", T2, ["Roy Lee"], 2012, None, None),
    ("p#2", "p", 2, "Agreement errors in morphologically rich languages, 2016", T3, [], 2016, None, None),
    ("p#3", "p", 3, "Agreement errors in morphologically rich languages, 2001", T3, [], 2001, None, None),
    ("p#4", "p", 4, "Z. Other. Verification of biomedical claims by retrieval. 1990.", T2, ["Zoe Other"], 1990, None, None),
    ("p#5", "p", 5, "arXiv:1907.10597, 2019", None, [], 2019, None, "1907.10597v2"),
    ("p#6", "p", 6, "Lu. In: Graph rewriting for dialogue state tracking, pages 1-9", None, [], None, None, None),
    ("p#7", "p", 7, "Table 3: scores", None, [], None, None, None),
    ("p#8", "p", 8, "See https://github.com/some/tool", "Some tool", [], 2024, None, None),
    ("p#9", "p", 9, "Roethe. Sampling long documents under a fixed budget of words. 2020", "Sampling", ["Kim Roethe"], 2020, None, None),
    ("q#0", "q", 0, "Nobody. A work that no index has ever held, 2021", "A work that no index has ever held", ["No Body"], 2021, None, "2101.00001"),
    ("q#1", "q", 1, "Photonic deep residual connections by K. He", "Photonic deep residual connections", ["K. He"], 2015, "10.1000/res.1", None),
    ("q#2", "q", 2, "Ada Byron. Deep residual connections for image recognition. 2016.", "Deep residual connections", ["Ada Byron"], 2016, None, None),
    ("q#3", "q", 3, "no year and no sense", "An unheard of thing", [], None, None, None),
])
INDEX = Table("idx", "norm_title string, year int, last_names array<string>, doi string, dblp_key string, row_ord long", [
    ("parsing trees with little supervision", 2019, ["byron"], "10.1000/tree.1", "k/1", 1),
    ("verification of biomedical claims by retrieval", 2010, ["lee", "kim"], None, "k/2", 2),
    ("verification of biomedical claims by retrieval", 2011, ["poe"], None, "k/3", 3),
    ("agreement errors in morphologically rich languages", 2017, [], None, "k/4", 4),
    ("agreement errors in morphologically rich languages", 2016, ["doe"], None, "k/5", 5),
])
ABSTRACT = "We sample long documents under a fixed budget of words and find that accuracy grows with the budget in all four languages that we tried"
PAPERS = Table("papers", "corpus_id string, title string, authors array<string>, year int, abstract string, doi string, arxiv_id string, venue string, publication_types array<string>", [
    ("c1", "Green computing", ["Roy Lee"], 2019, "Computing should count its energy.", None, "1907.10597", "arXiv", []),
    ("c2", "Graph rewriting for dialogue state tracking", ["Pan Lu"], 2018, "", None, None, "", []),
    ("c3", "Sampling long documents under a strict budget of words", ["Kim Roethe"], 2020, ABSTRACT, None, None, "J", ["JournalArticle"]),
    ("c4", "Deep residual connections for image recognition", ["K. He"], 2016, "Residual connections ease training of deep networks for image recognition.", "10.1000/res.1", "1512.03385", "", ["Conference"]),
    ("c5", T1, ["Ada Byron"], 2019, "Trees are parsed with little supervision and many rules.", "10.1000/tree.1", None, "ACL", ["Conference"]),
    ("c7", "Fixed budget", [], 2021, "A budget.", None, None, None, None),
    ("c6", T2, ["Roy Lee"], 2012, None, None, None, "J", []),
])
CONTEXTS = Table("contexts", "paper_id string, ref_id string, marker string, sentence string, section string, ord long", [
    ("p", "p#0", "[1]", "Trees are parsed with little supervision and many rules in all languages (Byron, 2019; Lee, 2012).", "Intro", 0),
    ("p", "p#0", "[1]", "Trees are parsed with little supervision and many rules, as was shown.", "Related", 1),
    ("p", "p#1", "[2]", "Retrieval verifies biomedical claims well enough for daily use in clinics.", None, 2),
    ("p", "p#5", "[5]", "too short", "Intro", 3),
    ("p", "p#5", "[5]", "Green computing is expensive, wrong and never counts energy at all whatever happens.", "Intro", 4),
    ("p", "p#7", "[7]", "Nothing here can be judged, for the entry was never parsed at all.", "Intro", 5),
    ("q", "q#1", "(He)", "Residual connections are used in (He et al., 2015) and nowhere else.", "Data", 0),
])
BODY = " ".join(f"filler{i} word{i % 7} goes on" for i in range(60)) + " computing should count its energy and green machines wait " + " ".join(f"later{i} text" for i in range(40))
BODIES = Table("bodies", "arxiv_id string, body string", [("1907.10597", BODY), ("1512.03385", "too short a body")])
RAW = "coalesce(trim(raw), '')"
AUTH = "list_distinct(list_filter(list_transform(authors, lambda a: regexp_replace(lower(CASE WHEN contains(a, ',') THEN split_part(a, ',', 1) ELSE list_extract(string_split(trim(a), ' '), -1) END), '[^a-z0-9 ]+', '', 'g')), lambda k: k <> ''))"
DOI = r"nullif(regexp_replace(regexp_replace(regexp_extract(lower({}), '10\.\d{{4,9}}/[^\s\"''<>]+', 0), '\.+$', ''), '\)+$', ''), '')"
AX = r"nullif(regexp_extract({}, '(\d{{4}}\.\d{{4,5}})', 1), '')"

# --- the local and the wide index

CLASSIFIED = f"""{REFS.cte}, {INDEX.cte}, {PAPERS.cte},
r AS (SELECT *, {NT('title')} AS nt, {DOI.format('doi')} AS d, {AX.format('arxiv_id')} AS ax, {AUTH} AS ak, {NT('raw')} AS nraw FROM refs),
i1 AS (SELECT ref_id, arg_min(dblp_key, row_ord) AS doi_key FROM r JOIN idx ON idx.doi = r.d GROUP BY 1),
pr AS (SELECT ref_id, row_ord, CASE WHEN len(ak) > 0 AND len(last_names) > 0 THEN list_has_any(ak, last_names) END AS au, abs(r.year - idx.year) <= 1 AS y FROM r JOIN idx ON norm_title = nt WHERE nt <> ''),
i2 AS (SELECT ref_id, min(row_ord) FILTER (coalesce(au, false) OR coalesce(y, false)) AS e, max(row_ord) FILTER (NOT coalesce(y, true) AND au IS NULL) AS m FROM pr GROUP BY 1),
w1 AS (SELECT ref_id, min(corpus_id) AS c FROM r JOIN papers ON {DOI.format('papers.doi')} = r.d GROUP BY 1),
w2 AS (SELECT ref_id, min(corpus_id) AS c FROM r JOIN papers ON {AX.format('papers.arxiv_id')} = r.ax GROUP BY 1),
w3 AS (SELECT ref_id, min(corpus_id) AS c FROM r JOIN papers ON contains(nraw, {NT('papers.title')}) WHERE length({NT('papers.title')}) >= 16 GROUP BY 1),
v AS (SELECT r.ref_id, r.paper_id, nt, d, ax, doi_key, CASE WHEN nt <> '' THEN CASE WHEN e IS NOT NULL THEN 'exists' WHEN m IS NOT NULL THEN 'minor_mismatch' END END AS tv, coalesce(e, m) AS row, w1.c AS c1, w2.c AS c2, w3.c AS c3
 FROM r LEFT JOIN i1 USING (ref_id) LEFT JOIN i2 USING (ref_id) LEFT JOIN w1 USING (ref_id) LEFT JOIN w2 USING (ref_id) LEFT JOIN w3 USING (ref_id)),
verdicts AS (SELECT ref_id, paper_id, CASE WHEN doi_key IS NOT NULL THEN 'exists' WHEN tv IS NOT NULL THEN tv WHEN coalesce(c1, c2, c3) IS NOT NULL THEN 'exists' WHEN nt <> '' OR d IS NOT NULL OR ax IS NOT NULL THEN 'not_found' ELSE 'unparseable' END AS verdict,
 CASE WHEN doi_key IS NOT NULL THEN 'index:doi' WHEN tv IS NOT NULL THEN 'index:title' WHEN c1 IS NOT NULL THEN 'wide:doi' WHEN c2 IS NOT NULL THEN 'wide:arxiv' WHEN c3 IS NOT NULL THEN 'wide:text' END AS matched_via,
 CASE WHEN doi_key IS NOT NULL THEN doi_key WHEN tv IS NOT NULL THEN row::VARCHAR WHEN coalesce(c1, c2, c3) IS NOT NULL THEN coalesce(c1, c2, c3) WHEN nt = '' THEN 'no usable title' ELSE nt END AS evidence FROM v)"""


@cache
def verdicts(spark) -> DataFrame:
    return files.stored(resolve.classified(REFS(spark), INDEX(spark), PAPERS(spark)))


@query(f"WITH {CLASSIFIED} SELECT * FROM verdicts")
def case_verdicts(spark, d):
    """The whole verdict cascade."""
    return verdicts(spark)


@query(f"WITH {CLASSIFIED}, l AS (SELECT ref_id, CASE WHEN doi_key IS NOT NULL THEN 'exists' WHEN tv IS NOT NULL THEN tv WHEN nt <> '' OR d IS NOT NULL OR ax IS NOT NULL THEN 'not_found' ELSE 'unparseable' END AS verdict FROM v) SELECT ref_id, verdict FROM l WHERE verdict IN ('not_found', 'unparseable')")
def case_escalated(spark, d):
    """What the local index alone leaves for the wide one."""
    return resolve.escalated(resolve.classified(REFS(spark), INDEX(spark))).select("ref_id", "verdict")


@query(f"WITH {CLASSIFIED} SELECT ref_id, coalesce(c1, c2) AS corpus_id, CASE WHEN c1 IS NOT NULL THEN 'doi' ELSE 'arxiv' END AS via FROM v WHERE coalesce(c1, c2) IS NOT NULL")
def case_paper_by_id(spark, d):
    return resolve.paper_by_id(REFS(spark), PAPERS(spark)).select("ref_id", F.col("hit.corpus_id").alias("corpus_id"), "via")


@query(f"WITH {REFS.cte}, {INDEX.cte} SELECT ref_id, dblp_key, 'doi' AS by FROM refs JOIN idx ON idx.doi = {DOI.format('refs.doi')} UNION ALL SELECT ref_id, dblp_key, 'title' FROM refs JOIN idx ON norm_title = {NT('title')} WHERE norm_title <> ''")
def case_index_lookups(spark, d):
    a = index.by_doi(REFS(spark).select("ref_id", "doi"), INDEX(spark)).select("ref_id", "dblp_key", F.lit("doi").alias("by"))
    return a.unionByName(index.by_title(REFS(spark).select("ref_id", "title"), INDEX(spark)).select("ref_id", "dblp_key", F.lit("title").alias("by")))


TRIAGED = f"""{CLASSIFIED}, nf AS (SELECT r.*, {TOK('raw')} AS rt FROM verdicts JOIN r USING (ref_id) WHERE verdict = 'not_found'),
tk AS (SELECT corpus_id, {TOK('title')} AS w, {AUTH} AS pk, year AS py FROM papers),
ct AS (SELECT ref_id, corpus_id, len(w) AS n, len(list_intersect(w, rt)) / len(w) AS c, coalesce(list_has_any(ak, pk), false) OR coalesce(abs(year - py) <= 1, false) AS ok FROM nf, tk WHERE len(w) > 0),
bt AS (SELECT ref_id, corpus_id, round_even(c, 3) AS containment, row_number() OVER (PARTITION BY ref_id ORDER BY c DESC, corpus_id) AS k FROM ct WHERE (n >= 5 AND c >= 0.85) OR (c >= 0.9 AND ok) OR (c >= 0.999 AND n >= 3)),
tr AS (SELECT nf.ref_id, nf.paper_id, raw, corpus_id, CASE WHEN contains(lower(raw), 'github.com') THEN 'software_or_model' END AS reason FROM nf LEFT JOIN (FROM bt WHERE k = 1) USING (ref_id)),
triage AS (SELECT ref_id, paper_id, CASE WHEN corpus_id IS NOT NULL THEN 'exists' WHEN reason IS NOT NULL THEN 'non_paper' ELSE 'suspect' END AS stage_verdict, CASE WHEN corpus_id IS NOT NULL THEN 'wide:tokens' ELSE reason END AS matched_via,
 CASE WHEN corpus_id IS NOT NULL THEN NULL WHEN reason IS NOT NULL THEN raw[1:120] ELSE raw[1:200] END AS raw_head FROM tr)"""


@cache
def triage(spark) -> DataFrame:
    return files.stored(resolve.triaged(verdicts(spark), REFS(spark), PAPERS(spark)))


@query(f"WITH {TRIAGED} SELECT * FROM triage")
def case_triage(spark, d):
    """Rescue, rules, suspects, rewritten in the order of the verdicts."""
    return report.in_order(verdicts(spark), triage(spark), "ref_id", ["ref_id"])


@query(f"WITH {TRIAGED} SELECT ref_id, corpus_id AS hit, containment FROM bt WHERE k = 1")
def case_corroborated_containment(spark, d):
    v = verdicts(spark).where("verdict = 'not_found'")
    return resolve.best_contained(REFS(spark).join(v.select("ref_id"), "ref_id", "left_semi"), PAPERS(spark))


CONSISTENT = f"""ck AS (SELECT ref_id, corpus_id, k, len(p) AS n, len(list_intersect(p, CASE WHEN len(o) < 3 THEN rr ELSE o END)) AS s, len(list_filter(p, lambda x: NOT list_contains(rr, x) AND NOT list_contains(o, x) AND NOT contains(packed, x))) AS fresh FROM
 (SELECT ref_id, corpus_id, k, {CONTENT(TOK('pt'))} AS p, {CONTENT(TOK('raw'))} AS rr, {CONTENT(TOK('title'))} AS o, replace({NT('raw')}, ' ', '') AS packed FROM
  (SELECT r.ref_id, r.raw, r.title, papers.corpus_id, papers.title AS pt, 1 AS k FROM r JOIN papers ON {DOI.format('papers.doi')} = r.d WHERE coalesce(abstract, '') <> '' UNION ALL
   SELECT r.ref_id, r.raw, r.title, papers.corpus_id, papers.title, 2 FROM r JOIN papers ON {AX.format('papers.arxiv_id')} = r.ax WHERE coalesce(abstract, '') <> ''))),
dr AS (SELECT ref_id, arg_min(corpus_id, k) AS corpus_id, CASE min(k) WHEN 1 THEN 'doi' ELSE 'arxiv' END AS via FROM ck WHERE n > 0 AND (2 * s >= n OR s >= 4) AND (fresh = 0 OR (fresh = 1 AND n > 8)) GROUP BY ref_id),
sh AS (SELECT r.ref_id, papers.corpus_id, {TOK('papers.title')} AS h, CASE WHEN r.nt <> '' THEN {TOK('r.title')} ELSE {TOK('r.raw')} END AS t, {CONTENT(TOK('papers.title'))} AS hc, {TOK("concat_ws(' ', r.raw, r.title)")} AS wrote, replace({NT("concat_ws(' ', r.raw, r.title)")}, ' ', '') AS packed,
 coalesce(CASE WHEN len(ak) > 0 AND len(papers.authors) > 0 THEN list_has_any(ak, {AUTH.replace('(authors,', '(papers.authors,')}) END, false) AS au, coalesce(abs(r.year - papers.year) <= 1, false) AS y FROM r, papers WHERE coalesce(abstract, '') <> '' AND {RAW.replace('raw', 'r.raw')} <> '' AND ref_id NOT IN (SELECT ref_id FROM dr)),
sc AS (SELECT *, greatest(len(list_intersect(h, t)) / len(h), len(list_intersect(h, t)) / greatest(len(t), 1)) AS c, len(list_filter(hc, lambda x: NOT list_contains(wrote, x) AND NOT contains(packed, x))) AS new FROM sh WHERE len(h) > 0),
sr AS (SELECT ref_id, corpus_id, row_number() OVER (PARTITION BY ref_id ORDER BY c DESC, corpus_id) AS k FROM sc WHERE c > 0 AND (new = 0 OR (new = 1 AND au AND y)) AND (list_sort(h) = list_sort(t) OR (c >= 0.7 AND (au OR y)) OR (c >= 0.5 AND au))),
resolved AS (FROM dr UNION ALL SELECT ref_id, corpus_id, 'search' FROM sr WHERE k = 1)"""


@query(f"WITH {CLASSIFIED}, {CONSISTENT} SELECT * FROM resolved")
def case_resolved(spark, d):
    """The cited work with an abstract: by DOI, by arXiv id, by search, each behind its guard."""
    return resolve.resolved(REFS(spark), PAPERS(spark)).select("ref_id", F.col("hit.corpus_id").alias("corpus_id"), "via")


# --- judges

STRING = """CASE WHEN contains(w, 'http') THEN 'non_paper' WHEN length(w) < 20 THEN 'garbled' WHEN NOT regexp_matches(w, '[0-9]') THEN 'suspicious' ELSE 'plausible_paper' END"""
JUDGED = f"{TRIAGED}, cats AS (SELECT t.ref_id, t.paper_id, {STRING.replace('w,', 'raw,').replace('(w)', '(raw)')} AS category, raw[1:160] AS raw_head FROM triage t JOIN refs USING (ref_id) WHERE stage_verdict = 'suspect' AND {RAW} <> '')"


@cache
def categories(spark) -> DataFrame:
    return files.stored(stages.categorised(triage(spark).where("stage_verdict = 'suspect'"), REFS(spark), judge.string_judge, "offline-string-1", 2026))


@query(f"WITH {JUDGED} SELECT *, 'offline-string-1' AS model FROM cats")
def case_categories(spark, d):
    return categories(spark).select("ref_id", "paper_id", "category", "raw_head", "model")


@query(f"WITH {JUDGED} SELECT ref_id, index, raw FROM cats JOIN refs USING (ref_id) WHERE category = 'suspicious'")
def case_leads(spark, d):
    return stages.leads(categories(spark), REFS(spark)).select("ref_id", "index", "raw")


POOL = f"""{CLASSIFIED}, px AS (SELECT c.*, row_number() OVER (PARTITION BY ref_id ORDER BY len(regexp_extract_all(sentence, '\\b(19|20)\\d{{2}}[a-z]?\\b')), ord) AS k FROM contexts c WHERE length(sentence) >= 40),
pool AS (SELECT r.*, marker, sentence, section FROM r JOIN (FROM px WHERE k = 1) USING (ref_id) WHERE ref_id IN (SELECT ref_id FROM verdicts WHERE verdict = 'exists'))"""
POOL = POOL.replace(f"{PAPERS.cte},", f"{PAPERS.cte}, {CONTEXTS.cte},", 1)


@cache
def pool(spark) -> DataFrame:
    return files.stored(stages.pool(REFS(spark), verdicts(spark), CONTEXTS(spark)))


@query(f"WITH {POOL} SELECT ref_id, marker, sentence, section FROM pool")
def case_pool(spark, d):
    return pool(spark).select("ref_id", "marker", "sentence", "section")


@query(f"WITH {POOL}, done AS (SELECT 'p#0' AS ref_id) SELECT ref_id FROM pool WHERE ref_id NOT IN (FROM done) ORDER BY md5('s:' || ref_id), ref_id LIMIT greatest((2 - 1) * 3, (2 - 1) + 1)")
def case_overdrawn_sample(spark, d):
    done = spark.createDataFrame([("p#0",)], "ref_id string")
    return stages.drawn(pool(spark), done, "ref_id", "s", 2, 1).select("ref_id")


@query(f"WITH {REFS.cte}, n AS (SELECT ref_id, paper_id, row_number() OVER (PARTITION BY paper_id ORDER BY index) AS k, count(*) OVER (PARTITION BY paper_id) > 6 AS capped FROM refs) SELECT ref_id, paper_id, capped FROM n WHERE k <= 6")
def case_capped(spark, d):
    return stages.capped(REFS(spark), ["index"], 6).select("ref_id", "paper_id", "capped")


def words(c: str) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array(lower({c}), '\\s+'), lambda t: t <> ''))"


SHARE = f"len(list_intersect({words('claim')}, {words('passages')})) / len({words('claim')})"
LABEL = "CASE WHEN share >= 0.6 THEN 'supported' WHEN share >= 0.3 THEN 'partial' ELSE 'not_supported' END"
SUPPORT = f"""{POOL}, {CONSISTENT}, ev AS (SELECT pool.ref_id, pool.paper_id, trim(sentence) AS claim, marker, papers.title AS cited_title, papers.corpus_id, papers.abstract, {AX.format("coalesce(papers.arxiv_id, pool.arxiv_id)")} AS cited_arxiv FROM pool LEFT JOIN resolved USING (ref_id) LEFT JOIN papers ON papers.corpus_id = resolved.corpus_id),
ab AS (SELECT *, trim(abstract)[1:1600] AS passages FROM ev WHERE corpus_id IS NOT NULL)"""


@query(f"WITH {SUPPORT}, s AS (SELECT ref_id, claim, passages, {SHARE} AS share FROM ab) SELECT ref_id, {LABEL} AS support, NULL AS skipped FROM s UNION ALL SELECT ref_id, NULL, 'no_abstract' FROM ev WHERE corpus_id IS NULL")
def case_abstract_support(spark, d):
    return stages.abstract_support(pool(spark), PAPERS(spark), judge.overlap_judge, "offline-overlap-1").select("ref_id", "support", "skipped")


# the one body is three passages of 130 words or fewer, under the six that are read, so the judge sees them all in order
CHUNKED = """bw AS (SELECT arxiv_id, list_filter(regexp_split_to_array(body, '\\s+'), lambda t: t <> '') AS w FROM bodies WHERE length(body) > 300),
bc AS (SELECT arxiv_id, string_agg(p, chr(10) || '---' || chr(10) ORDER BY s) AS text FROM (SELECT arxiv_id, s, array_to_string(list_slice(w, s + 1, s + 130), ' ') AS p FROM (SELECT arxiv_id, w, unnest(range(0, len(w), 90)) AS s FROM bw)) GROUP BY 1)"""
FULL = f"""{SUPPORT.replace(f'{PAPERS.cte},', f'{PAPERS.cte}, {BODIES.cte},', 1)}, {CHUNKED},
fe AS (SELECT ev.*, CASE WHEN text IS NULL THEN 'abstract' ELSE 'fulltext' END AS source, CASE WHEN text IS NULL THEN trim(abstract)[1:1600] ELSE ('[abstract] ' || trim(abstract) || chr(10) || '---' || chr(10) || text)[1:5000] END AS passages FROM ev LEFT JOIN bc ON bc.arxiv_id = cited_arxiv WHERE corpus_id IS NOT NULL),
fs AS (SELECT *, {SHARE} AS share, CASE WHEN len({words('claim')}) < 8 THEN 'nominal' ELSE 'claim' END AS cite_type FROM fe),
full_support AS (SELECT ref_id, paper_id, source, marker, claim, cited_title, cited_arxiv, cite_type, {LABEL} AS support, NULL AS skipped FROM fs UNION ALL SELECT ref_id, paper_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'unresolved' FROM ev WHERE corpus_id IS NULL)"""


@cache
def fulltext(spark) -> DataFrame:
    return files.stored(stages.fulltext_support(pool(spark), PAPERS(spark), BODIES(spark), judge.overlap_judge, "offline-overlap-1"))


@query(f"WITH {FULL} SELECT ref_id, source, marker, cited_arxiv, cite_type, support, skipped FROM full_support")
def case_fulltext_support(spark, d):
    return fulltext(spark).select("ref_id", "source", "marker", "cited_arxiv", "cite_type", "support", "skipped")


FLAGGED = Table("flags", "ref_id string, paper_id string, citing_sentence string, cited_title string, section string, marker string, support string, rationale string, claim_span string, cite_type string", [
    ("p#5", "p", "Green computing is expensive, wrong and never counts energy at all whatever happens.", "Green computing", "Intro", "[5]", "not_supported", "why", "span", "claim"),
    ("p#0", "p", "Trees are parsed with little supervision and many rules, as was shown.", "Another title altogether", None, "[1]", "partial", "why", "span", "claim"),
    ("p#7", "p", "Nothing here can be judged.", "Nothing", None, "[7]", "partial", "why", "span", "claim"),
    ("x#9", "x", "A flag whose reference is gone.", "Gone", None, "[9]", "partial", "why", "span", "claim"),
])
ARBITER = f"""{FULL.replace(f'{PAPERS.cte},', f'{PAPERS.cte}, {FLAGGED.cte},', 1)},
af AS (SELECT flags.ref_id, trim(citing_sentence) AS claim, list_sort({CONTENT(TOK('papers.title'))}) = list_sort({CONTENT(TOK('cited_title'))}) AS same, abstract, {AX.format("coalesce(papers.arxiv_id, r.arxiv_id)")} AS ca FROM flags JOIN r USING (ref_id) LEFT JOIN resolved USING (ref_id) LEFT JOIN papers ON papers.corpus_id = resolved.corpus_id),
ag AS (SELECT ref_id, coalesce(same, false) AS same, claim, CASE WHEN text IS NOT NULL THEN ('[abstract] ' || trim(abstract) || chr(10) || '---' || chr(10) || text)[1:12000] WHEN trim(coalesce(abstract, '')) <> '' THEN '[abstract only, no full text available] ' || trim(abstract)[1:2500] ELSE '' END AS passages FROM af LEFT JOIN bc ON bc.arxiv_id = ca),
ah AS (SELECT *, {SHARE} AS share FROM ag),
arbiter AS (SELECT ref_id, CASE WHEN same AND passages <> '' AND share < 0.3 THEN 'confirmed' ELSE 'refuted' END AS flag, CASE WHEN NOT same THEN 'wrong_paper' WHEN passages = '' THEN 'insufficient_evidence' WHEN share < 0.3 THEN 'misattribution' ELSE 'judge_error' END AS error_class, CASE WHEN NOT same OR passages = '' THEN 'rule' ELSE 'offline-overlap-1' END AS model FROM ah)"""


@cache
def arbitrated(spark) -> DataFrame:
    return files.stored(stages.arbiter(FLAGGED(spark), REFS(spark), PAPERS(spark), BODIES(spark), judge.overlap_judge, "offline-overlap-1"))


@query(f"WITH {ARBITER} SELECT * FROM arbiter")
def case_arbiter(spark, d):
    return arbitrated(spark).select("ref_id", "flag", "error_class", "model")


@query(f"WITH {ARBITER} SELECT ref_id, flag, error_class FROM flags LEFT JOIN arbiter USING (ref_id)")
def case_flags_settled(spark, d):
    return stages.arbitration(FLAGGED(spark), arbitrated(spark)).select("ref_id", "flag", "error_class")


@query(f"WITH {ARBITER} SELECT (SELECT count(*) FROM flags) AS flagged_in, count(*) AS arbitrated, count_if(flag = 'confirmed')::BIGINT AS confirmed, count_if(flag = 'confirmed') / greatest(count(*), 1) AS precision, count_if(error_class = 'wrong_paper')::BIGINT AS wrong_paper FROM arbiter")
def case_arbiter_report(spark, d):
    r = report.arbiter_report(FLAGGED(spark), arbitrated(spark))
    return r.select("flagged_in", "arbitrated", "confirmed", "precision", F.coalesce(F.col("refuted_by_class")["wrong_paper"], F.lit(0)).alias("wrong_paper"))


@query(f"""WITH {FULL}, j AS (FROM full_support WHERE support IS NOT NULL) SELECT count(*) AS sampled, count_if(source = 'fulltext')::BIGINT AS from_fulltext, count_if(source = 'abstract')::BIGINT AS from_abstract, count_if(cite_type = 'claim')::BIGINT AS claim_cites, count_if(cite_type = 'nominal')::BIGINT AS nominal_cites,
count_if(cite_type = 'claim' AND support = 'supported')::BIGINT AS supported, count_if(cite_type = 'claim' AND support IN ('partial', 'not_supported'))::BIGINT AS flagged, count_if(cite_type = 'claim' AND support = 'supported') / greatest(count_if(cite_type = 'claim'), 1) AS share_supported FROM j""")
def case_support_report(spark, d):
    return report.support_report(fulltext(spark)).select("sampled", "from_fulltext", "from_abstract", "claim_cites", "nominal_cites", "supported", "flagged", "share_supported")


@query(f"WITH {JUDGED}, s AS (SELECT count(*) AS n FROM triage WHERE stage_verdict = 'suspect') SELECT any_value(n) AS suspects_in, count(*) AS judged, count_if(category = 'suspicious')::BIGINT AS suspicious, any_value(n) - count(*) AS dropped FROM cats, s")
def case_categories_report(spark, d):
    """Written as a JSON document and read again."""
    path = files.scratch(spark)
    r = report.categories_report(triage(spark).where("stage_verdict = 'suspect'"), categories(spark))
    files.write_report(r, path)
    return files.read_report(spark, path, "suspects_in long, judged long, suspicious long, dropped long")


CHECKED = f"""WITH {JUDGED}, sup AS (SELECT count(*) AS judged, count_if(cite_type = 'claim')::BIGINT AS claim_cites FROM flags WHERE support IS NOT NULL),
sm AS (SELECT (SELECT count(*) FROM refs) AS references_total, count_if(verdict = 'exists')::BIGINT AS exists, count_if(verdict = 'minor_mismatch')::BIGINT AS minor_mismatch, count_if(verdict = 'not_found')::BIGINT AS not_found, count_if(verdict = 'unparseable')::BIGINT AS unparseable,
(SELECT count(*) FROM triage WHERE stage_verdict = 'suspect') - (SELECT count(*) FROM cats) AS judge_dropped, (SELECT count(*) FROM cats WHERE category = 'suspicious') AS suspicious_leads FROM verdicts)""".replace(f"{PAPERS.cte},", f"{PAPERS.cte}, {FLAGGED.cte},", 1)
ARBITRATED = Table("arb", "ref_id string, flag string, error_class string", [("p#5", "confirmed", "misattribution"), ("p#0", "refuted", "wrong_paper")])


@cache
def summary(spark) -> DataFrame:
    return files.stored(report.check_summary(REFS(spark), verdicts(spark), triage(spark), categories(spark), FLAGGED(spark), ARBITRATED(spark), False))


@query(f"{CHECKED} SELECT sm.*, judged, claim_cites, judged AS first_pass_flags, 1::BIGINT AS confirmed_leads, 1::BIGINT AS refuted_by_arbiter, false AS capped FROM sm, sup")
def case_check_summary(spark, d):
    return summary(spark).drop("stage_verdict", "category")


@query(f"{CHECKED} SELECT greatest(0, claim_cites)::BIGINT AS examined, greatest(0, judged - claim_cites)::BIGINT AS nominal, greatest(0, exists - judged)::BIGINT AS unexamined FROM sm, sup")
def case_examined(spark, d):
    return report.examined(summary(spark))


HAS = f"{DOI.format('doi')} IS NOT NULL", f"{AX.format('arxiv_id')} IS NOT NULL", f"{NT('title')} <> ''"


@query(f"""WITH {CLASSIFIED}, n AS (SELECT {HAS[0]} AS d1, {HAS[1]} AS a1, {HAS[2]} AS t1, year FROM verdicts LEFT JOIN refs USING (ref_id) WHERE verdict = 'not_found') SELECT count(*) AS not_found, count_if(d1)::BIGINT AS has_doi, count_if(a1)::BIGINT AS has_arxiv, count_if(d1 OR a1)::BIGINT AS has_id, count_if(year IS NOT NULL)::BIGINT AS has_year, count_if(coalesce(year = 2024, false))::BIGINT AS is_current, count_if(t1)::BIGINT AS has_title,
count_if(NOT (d1 OR a1) AND year IS NULL)::BIGINT AS no_year_no_id, count_if(d1 OR a1)::BIGINT AS id_bearing, count_if(t1 OR d1 OR a1)::BIGINT AS matchable FROM n""")
def case_residual_flags(spark, d):
    return report.residual(verdicts(spark), REFS(spark), 2024)


@query(f"WITH {REFS.cte} SELECT ref_id, raw[1:30] AS raw FROM refs ORDER BY ref_id LIMIT 5")
def case_heads(spark, d):
    return report.heads(REFS(spark), ["ref_id"], "raw", 5, 30)


KEYED = Table("kj", "record_key string, support string", [("a", "partial"), ("b", "supported")])
KEYED_ARB = Table("ka", "record_key string, flag string, error_class string", [("a", "refuted", "naming"), ("c", "confirmed", "overclaim")])


@query(f"WITH {KEYED.cte}, {KEYED_ARB.cte} SELECT record_key, support, flag, error_class FROM kj JOIN ka USING (record_key)")
def case_published_join(spark, d):
    return stages.published(KEYED(spark), KEYED_ARB(spark))


METRICS = Table("mt", "venue string, metric string, k long, n long", [("v1", "flags", 20, 2110), ("v2", "flags", 0, 0), ("v1", "confirmed", 1, 3)])


@query(f"""WITH {METRICS.cte}, w AS (SELECT *, k / nullif(n, 0) AS p, nullif(n, 0) AS m FROM mt), b AS (SELECT *, (p + 1.96 * 1.96 / (2 * m)) / (1 + 1.96 * 1.96 / m) AS c, 1.96 * sqrt(p * (1 - p) / m + 1.96 * 1.96 / (4 * m * m)) / (1 + 1.96 * 1.96 / m) AS s FROM w),
t AS (SELECT venue, metric, k || '/' || n || ' = ' || printf('%.2f', round_even(100.0::DOUBLE * k / greatest(n, 1), 2)) || '% [' || printf('%.2f', round_even(coalesce(100::DOUBLE * greatest(0, c - s), 0), 2)) || ', ' || printf('%.2f', round_even(CASE WHEN n = 0 THEN 0 ELSE 100::DOUBLE * least(1, c + s) END, 2)) || ']' AS cell FROM b)
SELECT metric, max(cell) FILTER (venue = 'v1') AS v1, max(cell) FILTER (venue = 'v2') AS v2 FROM t GROUP BY metric""")
def case_across_venues(spark, d):
    return report.across(METRICS(spark), ["v1", "v2"])


# --- parsing

HEAD = '<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><biblStruct><analytic><title level="a">Own title</title></analytic></biblStruct></teiHeader><text><body>'
CITE = '<s>{} <ref type="bibr" target="#b0">[1]</ref>.</s>'
LIST = '</body><back><div><s>Outside the body <ref type="bibr" target="#b0">[1]</ref></s></div><listBibl>{}</listBibl></back></text></TEI>'
ENTRY = '<biblStruct xml:id="b{}"><analytic><title level="a">{}</title></analytic><monogr><title level="j">CoRR</title><imprint><date when="{}"/></imprint></monogr><note type="raw_reference">{}</note></biblStruct>'
TEI = Table("teis", "paper_id string, tei string", [
    ("a", HEAD + "<div><head>One</head><p>" + CITE.format("First") + "</p><div><head>Inner</head>" + CITE.format("Second") + "</div>" + CITE.format("Third") + "</div><div><head>Two</head>" + CITE.format("Fourth") + "</div>" + LIST.format(ENTRY.format(0, "Green <hi>AI</hi>", "1907", "Lee. Green AI. CoRR, abs/1907.10597, 2019.") + ENTRY.format(1, "", "2020", "A raw entry 2020"))),
    ("b", "<TEI><broken"),
    ("c", None),
    ("d", '<!DOCTYPE x [<!ENTITY e "boom">]><TEI>&e;</TEI>'),
])


@query("SELECT * FROM (VALUES ('a#0', 'a', 0, 'Green AI', 2019, '1907.10597', 'CoRR'), ('a#1', 'a', 1, NULL, 2020, NULL, 'CoRR')) AS t(ref_id, paper_id, \"index\", title, year, arxiv_id, venue)")
def case_parsed_references(spark, d):
    scan = files.stored(tei.scanned(TEI(spark)))
    return tei.references(scan).orderBy("paper_id", "index").select("ref_id", "paper_id", "index", "title", "year", "arxiv_id", "venue")


@query("SELECT * FROM (VALUES (0, 'First [1].', 'One'), (1, 'Second [1].', 'Inner'), (2, 'Third [1].', 'One'), (3, 'Fourth [1].', 'Two')) AS t(ord, sentence, section)")
def case_parsed_contexts(spark, d):
    scan = files.stored(tei.scanned(TEI(spark)))
    return tei.contexts(scan, tei.references(scan)).select("ord", "sentence", "section")


LAYOUT = Table("lc", "paper_id string, layout_count long, ok boolean", [("b", 31, True), ("c", 9, False), ("e", 0, True), ("f", 4, True)])


@query(f"WITH {LAYOUT.cte}, f(paper_id) AS (VALUES ('b'), ('c'), ('d')) SELECT paper_id, CASE WHEN ok THEN layout_count END AS estimate FROM f LEFT JOIN lc USING (paper_id)")
def case_failures(spark, d):
    bad = tei.failures(tei.scanned(TEI(spark)))
    return report.missing_estimate(bad, LAYOUT(spark)).select("paper_id", "estimate")


@query("SELECT 2::BIGINT AS \"references\", 1::BIGINT AS papers, 4::BIGINT AS contexts, 3::BIGINT AS failures, 31::BIGINT AS refs_missing_estimate")
def case_parse_report(spark, d):
    scan = files.stored(tei.scanned(TEI(spark)))
    refs = tei.references(scan)
    return report.parse_report(refs, tei.contexts(scan, refs), report.missing_estimate(tei.failures(scan), LAYOUT(spark)))


@query(f"WITH {LAYOUT.cte} SELECT paper_id, layout_count FROM lc WHERE ok AND layout_count <> 0")
def case_sound_counts(spark, d):
    return layout.sound(LAYOUT(spark)).select("paper_id", "layout_count")


PAGE = [("a", 1, 200.0, x, t, s, w) for x, t, s, w in [(10.0, 0.0, 12.0, "Text"), (110.0, 50.0, 12.0, "References"), (110.0, 60.0, 9.0, "Adams."), (130.0, 60.4, 9.0, "One."), (120.0, 70.0, 9.0, "more"), (110.0, 80.0, 9.0, "Baker.")]]
PAGE += [("a", 2, 200.0, 10.0, 10.0 * i, 9.0, w) for i, w in enumerate(["Clark.", "Davis.", "lower", "Evans."])] + [("b", 1, 200.0, 10.0, 0.0, 9.0, "References"), ("b", 1, 200.0, 10.0, 9.0, 9.0, "Alone.")]


@query("SELECT * FROM (VALUES ('a', 5::BIGINT, true, ''), ('b', 0::BIGINT, false, 'references block is empty'), ('z', 0::BIGINT, false, 'no References heading found')) AS t(paper_id, layout_count, ok, note)")
def case_counted_entries(spark, d):
    """From words to the count, over two columns and two pages."""
    w = spark.createDataFrame(PAGE, "paper_id string, page int, width double, x0 double, top double, size double, text string")
    return layout.counted(w, spark.createDataFrame([("a",), ("b",), ("z",)], "paper_id string"))


@query("SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS t(page, col)")
def case_reading_order(spark, d):
    w = spark.createDataFrame([("p", p, 100.0, x, 0.0, 9.0, "w") for x in (60.0, 10.0) for p in (1, 0)], "paper_id string, page int, width double, x0 double, top double, size double, text string")
    return layout.reading_order(layout.lines(layout.split_columns(w))).orderBy("line_no").select("page", "col")


# --- sources

DUMP = '<dblp>\n<article mdate="x" key="j/1"><author>Jos&eacute; Lu</author><author>Byron, Ada</author><title>Parsing <i>trees</i>.</title><year>2019</year><ee>http://x.org</ee><ee>https://doi.org/10.1000/A.1</ee><ee>https://doi.org/10.1000/b</ee></article><inproceedings key="c/2"><title></title></inproceedings>\n<www key="homepages/1"><title>Home Page</title></www>\n<phdthesis key="t/3"><author>R. Poe</author><title>Long &amp; short</title><year>19x9</year></phdthesis><book key="b/4"><title>Broken &nosuch; thing</title></book>\n</dblp>'


def dump(spark) -> DataFrame:
    path = files.scratch(spark)
    spark.createDataFrame([(DUMP,)], "value string").coalesce(1).write.text(path)
    return files.stored(index.dump_records(spark, path))


@query("SELECT * FROM (VALUES ('j/1', 'parsing trees', 2019, 'lu|byron', '10.1000/a.1'), ('t/3', 'long short', NULL, 'poe', NULL)) AS t(dblp_key, norm_title, year, names, doi)")
def case_index_build(spark, d):
    rows = index.index_rows(dump(spark))
    return rows.select("dblp_key", "norm_title", "year", F.concat_ws("|", "last_names").alias("names"), "doi")


@query("SELECT 2::BIGINT AS records, 1::BIGINT AS with_doi, 1::BIGINT AS skipped_no_title, 1::BIGINT AS broken")
def case_build_stats(spark, d):
    return index.build_stats(dump(spark))


@query(f"WITH {INDEX.cte} SELECT dblp_key, 'title' AS copy FROM idx UNION ALL SELECT dblp_key, 'doi' FROM idx WHERE doi IS NOT NULL UNION ALL VALUES ('rebuilt', 'status'), ('unchanged', 'status'), ('refused', 'status')")
def case_snapshot_copies(spark, d):
    """Bucketed by title, a second copy by DOI; an unchanged and a refused refresh."""
    s = index.Snapshot(spark, files.scratch(spark), buckets=2)
    said = [s.refresh(INDEX(spark), "norm_title", 1, "d1"), s.refresh(INDEX(spark), "norm_title", 1, "d1"), s.refresh(INDEX(spark), "norm_title", 99, "d2")]
    out = s.current().select("dblp_key", F.lit("title").alias("copy")).unionByName(s.current(by_doi=True).select("dblp_key", F.lit("doi").alias("copy")))
    return out.unionByName(spark.createDataFrame([(x, "status") for x in said], "dblp_key string, copy string"))


FEED = '<feed xmlns="http://www.w3.org/2005/Atom" xmlns:x="http://arxiv.org/schemas/atom">{}</feed>'
POST = '<entry><id>http://arxiv.org/abs/{}</id><title>{}</title><published>{}</published><author><name>Ada Byron</name></author>{}</entry>'
FEEDS = [FEED.format(POST.format("2401.00001v2", "One\n  title", "2024-01-01T00:00:00Z", "") + POST.format("2401.00002v1", "Printed", "2024-01-02", "<x:journal_ref>J 1</x:journal_ref>")), FEED.format(POST.format("1512.03385v1", "In a venue", "2015", "") + POST.format("1907.10597", "Known preprint", "", "") + POST.format("2401.00009", "Beyond n", "2024", "")), "no xml"]


@query("SELECT * FROM (VALUES ('2401.00001', 'One title', 2024), ('1907.10597', 'Known preprint', 0)) AS t(paper_id, title, year)")
def case_preprints(spark, d):
    got = fetch.fetched(spark.range(3).withColumnRenamed("id", "page"), lambda r: FEEDS[r["page"]], "string")
    return fetch.preprints(fetch.atom_entries(got), PAPERS(spark), "pre-2024", 2).select("paper_id", "title", "year")


@query("SELECT '2401.00001' AS paper_id, 'One title' AS title, 2024 AS year")
def case_paper_meta(spark, d):
    feeds = [(0, FEEDS[0]), (1, FEED.format(POST.format("x", "Error", "2020", ""))), (2, FEED.format(""))]
    return fetch.paper_meta(spark.createDataFrame(feeds, "page long, answer string"), 2026).select("paper_id", "title", "year")


def _pdf(row: dict) -> bytes:
    if row["paper_id"] == "gone":
        raise fetch.Missing
    if row["paper_id"] == "down":
        raise OSError("no route")
    return b"%PDF" + b"x" * 20 if row["paper_id"] == "new" else b"<html>"


@query("SELECT * FROM (VALUES ('new', 'file'), ('held', 'file'), ('page', 'not a whole PDF'), ('gone', 'missing'), ('down', 'OSError: no route')) AS t(paper_id, what)")
def case_downloads(spark, d):
    """Resumed, paced, retried; what is no PDF goes to the failures."""
    todo = spark.createDataFrame([(p, f"https://example.org/{p}") for p in ("new", "held", "page", "gone", "down")], "paper_id string, pdf_url string")
    have = spark.createDataFrame([("held", b"%PDF" + b"y" * 20), ("page", b"%P")], "paper_id string, content binary")
    got, bad = fetch.downloaded(todo, have, _pdf, rate=1000.0, least=20, wait=lambda s: None)
    return got.select("paper_id", F.lit("file").alias("what")).unionByName(bad.select("paper_id", F.col("error").alias("what")))


@query("SELECT * FROM (VALUES ('a', 600::BIGINT), ('b', 600::BIGINT)) AS t(paper_id, n)")
def case_extract_cache(spark, d):
    """An extractor behind its cache: what it could not read is asked again."""
    cache = files.Cache(spark, files.scratch(spark), "paper_id string, kind string, tei string, error string", "paper_id", "tei")
    pdfs = spark.createDataFrame([("a", b"1"), ("b", b"2"), ("c", b"3")], "paper_id string, content binary")
    fetch.extracted(pdfs, lambda r: "t" * 600 if r["paper_id"] == "a" else "short", "refs", cache)
    return fetch.extracted(pdfs, lambda r: "t" * 600 if r["paper_id"] == "b" else "short", "refs", cache).select("paper_id", F.length("tei").cast("long").alias("n"))


@query("SELECT * FROM (VALUES ('a', 'A body with bold words.'), ('b', ''), ('c', 'One file')) AS t(paper_id, text)")
def case_tex_source(spark, d):
    import io
    import tarfile

    box = io.BytesIO()
    with tarfile.open(fileobj=box, mode="w:gz") as t:
        for name, data in (("main.tex", b"A body with \\textbf{bold} words. % note"), ("fig.png", b"no")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    rows = [("a", box.getvalue()), ("b", None), ("c", gzip.compress(b"One file"))]
    return spark.createDataFrame(rows, "paper_id string, content binary").select("paper_id", X.clean_tex(files.tex_source(F.col("content"))).alias("text"))


@query("SELECT * FROM (VALUES ('a', '900150983cd24fb0d6963f7d28e17f72'), ('b', '92eb5ffee6ae2fec3ad71c777531578f')) AS t(name, md5)")
def case_listing(spark, d):
    """Files of a folder in order of name, with their digests."""
    path = files.scratch(spark)
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for name, data in (("b.pdf", b"b"), ("a.pdf", b"abc"), ("c.txt", b"no"), ("d.pdf", b"beyond")):
        out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"))
        out.write(bytearray(data))
        out.close()
    f = files.listed(spark, path, "*.pdf", 2)
    return files.digests(f).select(F.regexp_extract("path", r"([^/]+)\.pdf$", 1).alias("name"), "md5")


# --- scalars

ODD = Table("odd", "id int, url string, hit string, key string, ees array<string>, year string, forwarded string, paper string, answer string", [
    (1, "http://arxiv.org/abs/2401.12345v2", '{"year": 2019, "authors": ["A B", {"name": "C D"}, {"id": 1}]}', "check-2026-x", ["x", "10.1000/A.", "10.1000/b"], "2019", "1.2.3.4, 5.6.7.8", "cs/0101001", '```json\n{"support": "partial"}\n```'),
    (2, "http://arxiv.org/abs/cs/0101001/", '{"published_year": "2020-05"}', "acl-1998", [], "19x9", "9.9.9.9", "2401.1", '[{"support": "supported"}]'),
    (3, "https://x.org/live", '{"pub_year": "n.d.", "authors": null}', "v2019b", None, None, None, None, None),
])


@query("SELECT * FROM (VALUES (1, '2401.12345', 2019, 'A B|C D', 2026, '10.1000/a', 2019, '1.2.3.4', 'check-2026-cs-0101001', 'partial'), (2, '0101001', 2020, '', 1998, NULL, NULL, '9.9.9.9', 'check-2026-2401.1', 'supported'), (3, 'live', NULL, '', 2019, NULL, NULL, NULL, 'check-2026', NULL)) AS t(id, tail, hit_year, hit_authors, run_year, doi, year, ip, key, support)")
def case_odd_fields(spark, d):
    c = F.col
    return ODD(spark).select("id", X.arxiv_tail(c("url")).alias("tail"), X.hit_year(c("hit")).alias("hit_year"), F.concat_ws("|", X.hit_authors(c("hit"))).alias("hit_authors"), X.run_year(c("key")).alias("run_year"), X.first_doi(c("ees")).alias("doi"), X.digit_year(c("year")).alias("year"), X.client_ip(c("forwarded")).alias("ip"), X.run_key(c("paper"), F.lit(2026)).alias("key"), X.judged_json(c("answer"), "support string")["support"].alias("support"))


@query(f"WITH {REFS.cte} SELECT ref_id, paper_id, title FROM refs")
def case_last_wins(spark, d):
    r = REFS(spark).select("ref_id", "paper_id", "title")
    old = r.withColumn("title", F.lit("stale")).withColumn("ord", F.lit(0))
    return audit.last_wins(old.unionByName(r.withColumn("ord", F.lit(1))), "ref_id", "ord").select("ref_id", "paper_id", "title")


# --- the service

H = jobs.HOUR
STATE = Table("st", "job_id string, arxiv_id string, ip string, status string, stage string, created_at long, at long, seq long, result string, error string", [
    ("j1", "2401.00001", "a", "queued", None, 1 * H, 1 * H, 1, None, None),
    ("j1", "2401.00001", "a", "running", "starting", 1 * H, 2 * H, 2, None, None),
    ("j1", "2401.00001", "a", "running", "judging", 1 * H, 2 * H, 3, None, None),
    ("j2", "2401.00002", "a", "done", "end", 2 * H, 3 * H, 3, "{}", None),
    ("j3", "2401.00003", "b", "queued", None, 4 * H, 4 * H, 1, None, None),
    ("j4", "2401.00004", "b", "queued", None, 5 * H, 5 * H, 1, None, None),
    ("j5", "2401.00005", "a", "error", "x", 6 * H, 7 * H, 3, None, "boom"),
    ("j6", "2401.00006", "a", "done", "end", 6 * H, 7 * H, 3, "{}", None),
    ("j7", "2401.00007", "a", "done", "end", 7 * H, 7 * H, 3, "{}", None),
])
LATEST = f"""{STATE.cte}, la AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY "at" DESC, seq DESC) AS k FROM st) WHERE k = 1)"""


@query(f"WITH {LATEST}, i(job_id) AS (VALUES ('j1'), ('j2'), ('j4'), ('j5'), ('j9')), w AS (SELECT job_id, rank() OVER (ORDER BY created_at) - 1 AS ahead FROM la WHERE status = 'queued') SELECT job_id, status, stage, CASE WHEN status IS NOT NULL THEN coalesce(ahead, 0) END AS queue_ahead, CASE WHEN status = 'done' THEN result END AS result, error FROM i LEFT JOIN la USING (job_id) LEFT JOIN w USING (job_id)")
def case_job_status(spark, d):
    asked = spark.createDataFrame([("j1",), ("j2",), ("j4",), ("j5",), ("j9",)], "job_id string")
    return jobs.status(jobs.latest(STATE(spark)), asked).drop("arxiv_id")


@query(f"WITH {LATEST} SELECT job_id, 'queued' AS status, seq + 1 AS seq FROM la WHERE status = 'running'")
def case_recovered(spark, d):
    return jobs.recovered(jobs.latest(STATE(spark)), 9 * H).select("job_id", "status", "seq")


ASKED = Table("rq", "request_id string, raw string, forwarded string, at long", [
    ("r1", "https://arxiv.org/abs/2401.00002v3", "c", 9 * H), ("r2", "2401.00001", "c, d", 9 * H), ("r3", "2401.99999", "a", 9 * H),
    ("r4", "2401.99999", "b", 9 * H), ("r5", "nonsense", "c", 9 * H), ("r6", "2401.00002", "c", (2 + 7 * 24) * H), ("r7", "2401.00005", "c", 9 * H),
])


@query("SELECT * FROM (VALUES ('r1', 'reuse', 'j2'), ('r2', 'attach', 'j1'), ('r3', 'over_quota', NULL), ('r4', 'enqueue', 'job-r4'), ('r5', 'invalid', NULL), ('r6', 'enqueue', 'job-r6'), ('r7', 'enqueue', 'job-r7')) AS t(request_id, decision, job_id)")
def case_submitted(spark, d):
    return jobs.submitted(jobs.latest(STATE(spark)), ASKED(spark)).select("request_id", "decision", "job_id")


@query("SELECT * FROM (VALUES ('2401.00001', 'done', 'judging', NULL), ('2401.00002', 'error', 'starting', 'no paper'), ('2401.00003', 'queued', NULL, NULL)) AS t(arxiv_id, status, stage, error)")
def case_worker(spark, d):
    """Two jobs served in turn, the second in vain, a third still waiting."""
    now = iter(range(1, 1000))
    s = jobs.Service(spark, files.scratch(spark), lambda: next(now))
    for i in (1, 2, 3):
        s.submit(f"2401.0000{i}", "a")

    def check(paper: str, progress) -> dict:
        if paper.endswith("2"):
            raise ValueError("no paper")
        progress("judging")
        return {"paper": paper}

    s.work(check), s.work(check)
    return jobs.latest(s.log()).select("arxiv_id", "status", "stage", "error")


# --- passages

SPOTS = Table("sp", "doc string, text string", [("d", " ".join(f"w{i // 90}x w{i}" for i in range(400))), ("e", "one short text")])


@query("SELECT * FROM (VALUES ('near', '4|5'), ('none', '0|1'), ('short', '0')) AS t(q, idx)")
def case_top_passages(spark, d):
    """The best passages of the claim's own document, in reading order; a claim without words gets the first."""
    claims = spark.createDataFrame([("near", "d", "w225 w224"), ("none", "d", "?!"), ("short", "e", "nothing in common")], "q string, doc string, query string")
    got = retrieve.top_passages(SPOTS(spark), claims, "doc", "q", "text", "query", 2)
    every = retrieve.chunks(SPOTS(spark), "doc", "text")
    at = got.select("q", F.posexplode("blocks")).join(every.select("idx", F.col("passage").alias("col")), "col").groupBy("q").agg(F.array_sort(F.collect_list(F.struct("pos", "idx"))).alias("x"))
    return at.select("q", F.concat_ws("|", F.transform("x", lambda s: s["idx"].cast("string"))).alias("idx"))

