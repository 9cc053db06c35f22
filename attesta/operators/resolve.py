"""Resolution of raw records against an index of titled records: keys, containment, substrings, guards.

Every join here is an equi-join on keys or tokens. The token joins prune by prefix first: a title contained to a share
of at least theta has one of its (1 - theta) * n + 1 rarest tokens in the record, so only those are joined, and the
candidates are verified on whole token sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions import text as X
from attesta.sources import files, index as ix


def first_match(refs: DataFrame, index: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """refs with the value of the first index row of the same key, by order and then
    value; null without one."""
    best = index.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(value, F.struct(order, value)).alias(value))
    return refs.join(best, key, "left")


def corroborated(pairs: DataFrame, ref: str, order: str) -> DataFrame:
    """pairs (ref, order, author_overlap, ref_year, rec_year; a row for each candidate of the same title) -> verdict:
    exists with the first corroborated candidate, else minor_mismatch with the last whose year conflicts and whose
    authors are unknown, else null."""
    ok = X.year_ok(F.col("ref_year"), F.col("rec_year"))
    exists = F.coalesce(F.col("author_overlap"), F.lit(False)) | F.coalesce(ok, F.lit(False))
    minor = F.coalesce(~ok, F.lit(False)) & F.col("author_overlap").isNull()
    g = pairs.groupBy(ref).agg(F.min(F.when(exists, F.col(order))).alias("first_exists"), F.max(F.when(minor, F.col(order))).alias("last_minor"))
    verdict = F.when(F.col("first_exists").isNotNull(), "exists").when(F.col("last_minor").isNotNull(), "minor_mismatch")
    return g.select(ref, verdict.alias("verdict"), F.coalesce("first_exists", "last_minor").alias("matched"))


def cascade(refs: DataFrame, by_doi: Column, by_title: Column, by_id: Column) -> DataFrame:
    """The verdict of refs (title, doi, arxiv_id) given the outcome of each stage, cheapest first: an index row by DOI,
    a title verdict (exists or minor_mismatch, which is final), a record of the wider index."""
    titled, has_id = X.norm_title(F.col("title")) != "", F.col("doi").isNotNull() | F.col("arxiv_id").isNotNull()
    verdict = (
        F.when(by_doi.isNotNull(), "exists").when(titled & by_title.isNotNull(), by_title).when(by_id.isNotNull(), "exists").when(titled | has_id, "not_found").otherwise("unparseable")
    )
    return refs.withColumn("verdict", verdict)


def token_rows(df: DataFrame, id_col: str, text: str, name: str) -> DataFrame:
    words = df.select(F.col(id_col).alias(name), X.title_tokens(F.col(text)).alias("words"))
    return words.select(name, F.size("words").cast("long").alias(f"{name}_n"), F.explode("words").alias("token"), "words")


def contained(records: DataFrame, titles: DataFrame, least: float, rec_id: str = "doc_id", title_id: str = "item_id", rec_text: str = "text", title_text: str = "text") -> DataFrame:
    """(rec, title, n, shared): pairs in which at least that share of a title's n tokens occurs in the record. Token sets
    are written once; what is small by then is broadcast by its file size, and no side moves that need not."""
    t = files.stored(token_rows(titles, title_id, title_text, "title"))
    r = files.stored(files.spread(records.select(F.col(rec_id).alias(rec_id), F.col(rec_text).alias(rec_text))).select(F.col(rec_id).alias("rec"), X.title_tokens(F.col(rec_text)).alias("rec_words")))
    wanted = files.stored(t.select("token").distinct())
    # tokens of records that no title has leave first; how often the others occur ranks a title's tokens
    rows = r.select("rec", F.explode("rec_words").alias("token")).join(wanted, "token", "left_semi")
    often = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    rank = F.row_number().over(Window.partitionBy("title").orderBy("df", "token"))
    prefix = t.join(often, "token", "left").withColumn("df", F.coalesce("df", F.lit(0))).withColumn("r", rank)
    prefix = files.stored(prefix.where(F.col("r") <= F.col("title_n") - F.ceil(F.col("title_n") * F.lit(least)) + 1).select("title", "token"))
    rare = prefix.select("token").distinct()
    pairs = files.stored(prefix.join(r.select("rec", F.explode("rec_words").alias("token")).join(rare, "token", "left_semi"), "token").select("rec", "title").distinct())
    whole = t.groupBy("title").agg(F.first("words").alias("words"))
    # pairs are small as a file only: with a title's words in every row they would not fit a driver that broadcasts them
    both = r.join(pairs.join(whole, "title").hint("merge"), "rec")
    both = both.select("rec", "title", F.size("words").cast("long").alias("n"), F.size(F.array_intersect("words", "rec_words")).cast("long").alias("shared"))
    return both.where(F.col("shared") >= F.col("n") * F.lit(least))


def accepted(n: Column, c: Column, corroboration: Column) -> Column:
    """Whether a title of n tokens, contained to share c, stands: long and well covered, covered and corroborated, or
    covered whole."""
    return ((n >= 5) & (c >= 0.85)) | ((c >= 0.90) & corroboration) | ((c >= 0.999) & (n >= 3))


def containment_rescue(records: DataFrame, titles: DataFrame, corroboration: Column | None = None) -> DataFrame:
    """(doc_id, item_id, containment) of the best accepted title of each record, first title on ties."""
    found = contained(records, titles, 0.85).withColumn("c", F.col("shared") / F.col("n"))
    found = found.where(accepted(F.col("n"), F.col("c"), F.lit(False) if corroboration is None else corroboration))
    best = F.row_number().over(Window.partitionBy("rec").orderBy(F.desc("c"), "title"))
    return found.withColumn("r", best).where("r = 1").select(F.col("rec").alias("doc_id"), F.col("title").alias("item_id"), F.bround("c", 3).alias("containment"))


def substring_rescue(records: DataFrame, titles: DataFrame, least: int = 16, same_author: DataFrame | None = None) -> DataFrame:
    """(doc_id, item_id): the first title whose normalised form of at least that length is a substring of the record; a
    shorter one counts for the pairs (doc_id, item_id) in same_author.
    A contained title has all but its end words whole in the record, so its rarest inner word blocks the join. Of two
    words, the longer has at least half the length: its end next to the gap, with one letter beyond, blocks. One word
    lies in one word of the record and is blocked by its first letters."""
    least, half = max(least, 1), max(least // 2, 1)
    every = files.stored(titles.select(F.col("item_id").alias("title"), X.norm_title(F.col("text")).alias("nt")).where("nt <> ''"))
    t = every.where(F.length("nt") >= least).withColumn("w", F.split("nt", " ")).withColumn("kind", F.least(F.size("w"), F.lit(3)))
    r = files.stored(files.spread(records.select("doc_id", "text")).select(F.col("doc_id").alias("rec"), X.norm_title(F.col("text")).alias("nr")))
    # how often the inner words of titles occur; the rarest of a title is its key
    inner = t.where("kind = 3").select("title", F.explode(F.array_distinct(F.slice("w", 2, F.size("w") - 2))).alias("token"))
    inner = files.stored(inner)
    words = r.select(F.explode(F.array_distinct(F.split("nr", " "))).alias("token")).join(inner.select("token").distinct(), "token", "left_semi")
    often = words.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    # a word that no record has rules its title out
    rarest = inner.join(often, "token", "left").groupBy("title").agg(F.min_by("token", F.struct(F.coalesce("df", F.lit(0)), "token")).alias("token"), F.min(F.coalesce("df", F.lit(0))).alias("df")).where("df > 0")
    a, b = F.get("w", F.lit(0)), F.get("w", F.lit(1))
    gap = F.when(F.length(a) >= F.length(b), F.concat_ws(" ", F.right(a, F.lit(half)), F.left(b, F.lit(1)))).otherwise(F.concat_ws(" ", F.right(a, F.lit(1)), F.left(b, F.lit(half))))
    keyed = t.where("kind < 3").select("title", "kind", F.when(F.col("kind") == 1, F.left("nt", F.lit(least))).otherwise(gap).alias("token"))
    keyed = files.stored(keyed.unionByName(rarest.select("title", F.lit(3).alias("kind"), "token")))
    windows = lambda *parts: F.array_distinct(F.concat(*[F.regexp_extract_all("nr", F.lit(f"(?=({p}))"), F.lit(1)) for p in parts]))
    one, two = windows(f"[a-z0-9]{{{least}}}"), windows(f"[a-z0-9]{{{half}}} [a-z0-9]", f"[a-z0-9] [a-z0-9]{{{half}}}")
    # three rows at most are broadcast; keys of kinds that no title has are not made
    asked = r.withColumn("kind", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).join(F.broadcast(keyed.select("kind").distinct()), "kind", "left_semi")
    keys = asked.select("rec", "kind", F.explode(F.when(F.col("kind") == 1, one).when(F.col("kind") == 2, two).otherwise(F.array_distinct(F.split("nr", " ")))).alias("token"))
    pairs = keyed.join(keys, ["kind", "token"]).select("rec", "title")
    if same_author is not None:
        short = every.where(F.length("nt") < least).select("title")
        pairs = pairs.unionByName(same_author.select(F.col("doc_id").alias("rec"), F.col("item_id").alias("title")).join(short, "title", "left_semi"))
    hit = files.stored(pairs.distinct().join(every, "title")).join(r, "rec").where(F.contains("nr", F.col("nt")))
    return hit.groupBy("rec").agg(F.min("title").alias("item_id")).select(F.col("rec").alias("doc_id"), "item_id")


def novel(title_words: Column, raw: Column, parsed: Column) -> Column:
    """Content words of a resolved title that the citation never wrote, line-break hyphens aside."""
    known = F.array_union(X.content(X.tokens(X.norm_title(raw))), X.content(X.title_tokens(parsed)))
    packed = F.replace(X.norm_title(raw), F.lit(" "), F.lit(""))
    return F.filter(F.array_except(title_words, known), lambda t: ~F.contains(packed, t))


def title_consistent(resolved: Column, raw: Column, parsed: Column) -> Column:
    """Whether a resolved title may be the cited one."""
    p = X.content(X.title_tokens(resolved))
    own = X.content(X.title_tokens(parsed))
    r = F.when(F.size(own) < 3, X.content(X.tokens(X.norm_title(raw)))).otherwise(own)
    shared, n, new = F.size(F.array_intersect(p, r)), F.size(p), F.size(novel(p, raw, parsed))
    return F.when(n == 0, F.lit(False)).otherwise(((shared * 2 >= n) | (shared >= 4)) & ((new == 0) | ((new == 1) & (n > 8))))


def shortlist(rows: DataFrame, titles: DataFrame, least: float, hits: int = 4) -> DataFrame:
    """(rec, title) of pairs that may share k = ceil(least * n) of a title's n tokens: they share `hits` of the
    n - k + hits rarest ones. rows (rec, token), titles (title, title_n, token)."""
    rows = rows.join(titles.select("token").distinct(), "token", "left_semi")
    often = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    rank = F.row_number().over(Window.partitionBy("title").orderBy("df", "token"))
    prefix = titles.join(often, "token", "left").withColumn("df", F.coalesce("df", F.lit(0))).withColumn("r", rank)
    k = F.ceil(F.col("title_n") * F.lit(least))
    prefix = prefix.withColumn("hits", F.least(k, F.lit(hits))).where(F.col("r") <= F.col("title_n") - k + F.col("hits"))
    met = prefix.select("title", "hits", "token").join(rows, "token").groupBy("rec", "title").agg(F.count(F.lit(1)).alias("met"), F.max("hits").alias("hits"))
    return met.where(F.col("met") >= F.col("hits")).select("rec", "title")


def hits(records: DataFrame, titles: DataFrame, wrote: str = "text") -> DataFrame:
    """(doc_id, item_id, shared, n_hit, n_ref, novel) of all pairs that `best_hit` may let stand: half of the title's
    tokens are in the record or half of the record's in the title. Only records of fewer tokens than the longest title
    can hold less than half of a title and yet lie half in it. novel counts as `novel` does, against the column wrote.
    Normalised records are written once, to be read often."""
    spark, path = records.sparkSession, files.scratch(records.sparkSession)
    # inline keeps Spark from writing an expression again into every later one that reads it
    once = lambda *c: F.inline(F.array(F.struct(*c)))
    normal = files.spread(records).select("doc_id", once(X.norm_title(F.col("text")).alias("normal"), X.norm_title(F.col(wrote)).alias("whole")))
    normal.select("doc_id", X.tokens(F.col("normal")).alias("w"), X.tokens(F.col("whole")).alias("known"), F.replace("whole", F.lit(" "), F.lit("")).alias("packed")).write.parquet(path)
    cited = spark.read.parquet(path)
    items = titles.select("item_id", X.title_tokens(F.col("text")).alias("words")).withColumn("n_hit", F.size("words").cast("long"))
    # one row is broadcast
    brief = cited.withColumn("n", F.size("w").cast("long")).join(F.broadcast(items.agg(F.max("n_hit").alias("longest"))), F.col("n") < F.col("longest"))
    item_rows = items.select(F.col("item_id").alias("title"), F.col("n_hit").alias("title_n"), F.explode("words").alias("token"))
    covered = shortlist(cited.select(F.col("doc_id").alias("rec"), F.explode("w").alias("token")), item_rows, 0.5)
    covering = shortlist(item_rows.select(F.col("title").alias("rec"), "token"), brief.select(F.col("doc_id").alias("title"), F.col("n").alias("title_n"), F.explode("w").alias("token")), 0.5)
    pairs = covered.toDF("doc_id", "item_id").unionByName(covering.select(F.col("title").alias("doc_id"), F.col("rec").alias("item_id"))).distinct()
    both = pairs.join(items, "item_id").join(cited, "doc_id")
    both = both.select("*", once(F.size(F.array_intersect("words", "w")).cast("long").alias("shared"), F.size("w").cast("long").alias("n_ref")))
    both = both.where(F.col("shared") * 2 >= F.least("n_hit", "n_ref"))
    new = F.filter(F.array_except(X.content(F.col("words")), F.col("known")), lambda t: ~F.contains(F.col("packed"), t))
    return both.select("doc_id", "item_id", "shared", "n_hit", "n_ref", once(F.size(new).cast("long").alias("novel")))


def best_hit(pairs: DataFrame, rec: str, hit: str) -> DataFrame:
    """pairs (rec, hit, shared, n_hit, n_ref, novel, author_ok, year_ok) -> the hit of largest overlap that stands."""
    c = F.greatest(F.col("shared") / F.col("n_hit"), F.col("shared") / F.greatest(F.col("n_ref"), F.lit(1)))
    fresh = (F.col("novel") == 0) | ((F.col("novel") == 1) & F.col("author_ok") & F.col("year_ok"))
    exact = (F.col("shared") == F.col("n_hit")) & (F.col("shared") == F.col("n_ref"))
    good = pairs.withColumn("c", c).where(fresh & (exact | ((F.col("c") >= 0.7) & (F.col("author_ok") | F.col("year_ok"))) | ((F.col("c") >= 0.5) & F.col("author_ok"))))
    top = F.row_number().over(Window.partitionBy(rec).orderBy(F.desc("c"), hit))
    return good.withColumn("r", top).where((F.col("r") == 1) & (F.col("c") > 0)).select(rec, hit, "c")


def paper_by_id(refs: DataFrame, papers: DataFrame) -> DataFrame:
    """ref_id, hit (the whole row of papers) and via ('doi' or 'arxiv') of refs (ref_id, doi, arxiv_id) that an index of
    papers (corpus_id, doi, arxiv_id, ...) knows: by DOI first, then by arXiv id; the first corpus_id of an id."""
    whole = F.struct(*papers.columns)
    first = lambda key: papers.select(key(F), whole.alias("hit")).where("k is not null").groupBy("k").agg(F.min_by("hit", "hit.corpus_id").alias("hit"))
    doi = first(lambda f: X.norm_doi(f.col("doi")).alias("k"))
    arxiv = first(lambda f: X.norm_arxiv(f.col("arxiv_id")).alias("k"))
    r = refs.select("ref_id", X.norm_doi(F.col("doi")).alias("d"), X.norm_arxiv(F.col("arxiv_id")).alias("a"))
    r = r.join(doi.toDF("d", "by_doi"), "d", "left").join(arxiv.toDF("a", "by_arxiv"), "a", "left")
    via = F.when(F.col("by_doi").isNotNull(), "doi").when(F.col("by_arxiv").isNotNull(), "arxiv")
    return r.select("ref_id", F.coalesce("by_doi", "by_arxiv").alias("hit"), "by_doi", "by_arxiv", via.alias("via")).where("via is not null")


def shared_authors(refs: DataFrame, papers: DataFrame, shorter: int = 16) -> DataFrame:
    """(doc_id, item_id) of refs and papers with a common author key, for papers whose title has under `shorter`
    characters: only those need it."""
    few = papers.where(F.length(X.norm_title(F.col("title"))).between(1, shorter - 1)).select(F.col("corpus_id").alias("item_id"), F.explode(X.author_keys(F.col("authors"))).alias("k"))
    return refs.select(F.col("ref_id").alias("doc_id"), F.explode(X.author_keys(F.col("authors"))).alias("k")).join(few, "k").select("doc_id", "item_id").distinct()


def classified(refs: DataFrame, index: DataFrame, papers: DataFrame | None = None) -> DataFrame:
    """ref_id, paper_id, verdict, matched_via, evidence of refs, by the cascade of `cascade`: the index by DOI; by title,
    corroborated; then, if papers (a wider index) are given, by DOI, by arXiv id and by a title inside the raw string."""
    direct = ix.by_doi(refs.select("ref_id", "doi"), index).groupBy("ref_id").agg(F.min_by("dblp_key", "row_ord").alias("doi_key"))
    pairs = ix.by_title(refs.select("ref_id", "title", "authors", F.col("year").alias("ref_year")), index.withColumnRenamed("year", "rec_year"))
    pairs = pairs.select("ref_id", "row_ord", X.overlap3(X.author_keys(F.col("authors")), F.array_distinct("last_names")).alias("author_overlap"), "ref_year", "rec_year")
    titled = corroborated(pairs, "ref_id", "row_ord").withColumnsRenamed({"verdict": "title_verdict", "matched": "title_row"}).where("title_verdict is not null")
    r = refs.join(direct, "ref_id", "left").join(titled, "ref_id", "left")
    if papers is not None:
        ids = paper_by_id(refs, papers).select("ref_id", F.col("via").alias("wide"), F.col("hit.corpus_id").alias("wide_id"))
        named = substring_rescue(refs.select(F.col("ref_id").alias("doc_id"), F.col("raw").alias("text")), papers.select(F.col("corpus_id").alias("item_id"), F.col("title").alias("text")), same_author=shared_authors(refs, papers))
        r = r.join(ids, "ref_id", "left").join(named.select(F.col("doc_id").alias("ref_id"), F.col("item_id").alias("text_id")), "ref_id", "left")
    else:
        r = r.withColumns({"wide": F.lit(None).cast("string"), "wide_id": F.lit(None).cast("string"), "text_id": F.lit(None).cast("string")})
    r = cascade(r.withColumns({"doi": X.norm_doi(F.col("doi")), "arxiv_id": X.norm_arxiv(F.col("arxiv_id"))}), F.col("doi_key"), F.col("title_verdict"), F.coalesce("wide_id", "text_id"))
    by_title = (X.norm_title(F.col("title")) != "") & F.col("title_verdict").isNotNull()
    via = F.when(F.col("doi_key").isNotNull(), "index:doi").when(by_title, "index:title").when(F.col("wide").isNotNull(), F.concat(F.lit("wide:"), "wide")).when(F.col("text_id").isNotNull(), "wide:text")
    normal = X.norm_title(F.col("title"))
    proof = F.when(F.col("doi_key").isNotNull(), F.col("doi_key")).when(by_title, F.col("title_row").cast("string")).when(via.isNotNull(), F.coalesce("wide_id", "text_id")).when(normal == "", "no usable title").otherwise(normal)
    return r.select("ref_id", "paper_id", "verdict", via.alias("matched_via"), proof.alias("evidence"))


def escalated(verdicts: DataFrame) -> DataFrame:
    """What the local index could not settle and a wider one is asked about."""
    return verdicts.where(F.col("verdict").isin("not_found", "unparseable"))


def triaged(verdicts: DataFrame, refs: DataFrame, papers: DataFrame) -> DataFrame:
    """ref_id, paper_id, stage_verdict, matched_via, raw_head of the verdicts not_found: rescued by a title whose tokens
    the raw string holds, else no paper by rule, else suspect."""
    r = verdicts.where("verdict = 'not_found'").select("ref_id", "paper_id").join(refs.select("ref_id", "raw", "authors", "year"), "ref_id", "left")
    hit = best_contained(r, papers)
    r = r.join(hit, "ref_id", "left")
    reason = X.non_paper(F.coalesce("raw", F.lit("")))
    stage = F.when(F.col("hit").isNotNull(), "exists").when(reason.isNotNull(), "non_paper").otherwise("suspect")
    head = F.when(stage == "non_paper", F.substring("raw", 1, 120)).when(stage == "suspect", F.substring("raw", 1, 200))
    return r.select("ref_id", "paper_id", stage.alias("stage_verdict"), F.when(F.col("hit").isNotNull(), "wide:tokens").otherwise(reason).alias("matched_via"), head.alias("raw_head"))


def best_contained(refs: DataFrame, papers: DataFrame) -> DataFrame:
    """ref_id, hit (corpus_id), containment of the best accepted paper of each reference; authors and years
    corroborate, an empty author list does not."""
    found = contained(refs, papers, 0.85, "ref_id", "corpus_id", "raw", "title").withColumn("c", F.col("shared") / F.col("n"))
    found = found.join(refs.select(F.col("ref_id").alias("rec"), F.col("authors").alias("ra"), F.col("year").alias("ry")), "rec").join(papers.select(F.col("corpus_id").alias("title"), F.col("authors").alias("pa"), F.col("year").alias("py")), "title")
    same = F.coalesce(X.overlap3(X.author_keys(F.col("ra")), X.author_keys(F.col("pa"))), F.lit(False)) | F.coalesce(X.year_ok(F.col("ry"), F.col("py")), F.lit(False))
    found = found.where(accepted(F.col("n"), F.col("c"), same))
    best = F.row_number().over(Window.partitionBy("rec").orderBy(F.desc("c"), "title"))
    return found.withColumn("r", best).where("r = 1").select(F.col("rec").alias("ref_id"), F.col("title").alias("hit"), F.bround("c", 3).alias("containment"))


def resolved(refs: DataFrame, papers: DataFrame) -> DataFrame:
    """ref_id, hit (row of papers), via of refs whose cited work papers hold with an abstract: by DOI, by arXiv id, each
    behind the title guard, else the best search hit that stands."""
    known = papers.where(F.coalesce("abstract", F.lit("")) != "")
    ids = paper_by_id(refs, papers).join(refs.select("ref_id", "raw", "title"), "ref_id")
    fine = lambda c: (F.coalesce(F.col(f"{c}.abstract"), F.lit("")) != "") & title_consistent(F.col(f"{c}.title"), F.col("raw"), F.col("title"))
    direct = ids.select("ref_id", F.when(fine("by_doi"), F.struct(F.col("by_doi").alias("hit"), F.lit("doi").alias("via"))).when(fine("by_arxiv"), F.struct(F.col("by_arxiv").alias("hit"), F.lit("arxiv").alias("via"))).alias("s")).where("s is not null").select("ref_id", "s.hit", "s.via")
    rest = refs.where("coalesce(raw, '') <> ''").join(direct.select("ref_id"), "ref_id", "left_anti")
    title = F.when(X.norm_title(F.col("title")) != "", F.col("title")).otherwise(F.col("raw"))
    # overlap counts against the cited title, novelty against the raw string and the title
    p = hits(rest.select(F.col("ref_id").alias("doc_id"), title.alias("text"), F.concat_ws(" ", "raw", "title").alias("wrote")), known.select(F.col("corpus_id").alias("item_id"), F.col("title").alias("text")), "wrote")
    p = p.join(rest.select(F.col("ref_id").alias("doc_id"), F.col("authors").alias("ra"), F.col("year").alias("ry")), "doc_id").join(known.select(F.col("corpus_id").alias("item_id"), F.col("authors").alias("pa"), F.col("year").alias("py")), "item_id")
    p = p.withColumn("author_ok", F.coalesce(X.overlap3(X.author_keys(F.col("ra")), X.author_keys(F.col("pa"))), F.lit(False))).withColumn("year_ok", F.coalesce(X.year_ok(F.col("ry"), F.col("py")), F.lit(False)))
    best = best_hit(p, "doc_id", "item_id").select(F.col("doc_id").alias("ref_id"), F.col("item_id").alias("corpus_id"))
    found = best.join(known.select("corpus_id", F.struct(*known.columns).alias("hit")), "corpus_id").select("ref_id", "hit", F.lit("search").alias("via"))
    return direct.unionByName(found)
