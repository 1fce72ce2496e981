"""Queries over the tables, each with the same result in DuckDB's SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions import abbreviations, concepts, phrases, tagging, text
from scriptorium.operators import relational
from scriptorium.plans import pipeline
from scriptorium.sources import records
from scriptorium.steps import spread

#: A small vocabulary of words that the documents hold, in two categories: surface, label, category, database, ids.
VOCABULARY = [(s, s.upper(), c, d, [f"{d}:{i}"]) for i, (s, c, d) in enumerate([("tion", "GENE", "HGNC"), ("ther", "GENE", "HGNC"), ("thing", "DISEASE", "OMIM"), ("erin", "DISEASE", "OMIM"), ("thatin", "DISEASE", "OMIM"), ("ther erin", "GENE", "HGNC"), ("the", "GENE", "HGNC")])]
_values = ", ".join(f"('{s}', '{c}', '{d}', '{ids[0]}')" for s, _, c, d, ids in VOCABULARY)
_separators = tagging.SEPARATORS.replace("'", "''")
_stop = ", ".join(f"'{w}'" for w in text.STOPWORDS)

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and texts, on all cores even if the table is one row group."""
    return spread(t(spark, sf_dir, "documents").select("doc_id", "text"))


@query("""
    SELECT o_custkey, max(o_orderdate) AS o_orderdate, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
           arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice
    FROM orders GROUP BY o_custkey""")
def latest_order_per_customer(spark, d):
    return relational.latest_by(t(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice"), "o_custkey", "o_orderdate", "o_orderkey")


@query("SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id")
def latest_turn_per_conversation(spark, d):
    return relational.latest_by(t(spark, d, "conversations").select("conv_id", "turn", "role", "text"), "conv_id", "turn")


@query("""
    WITH u AS (SELECT doc_id AS pub_id, 'a' AS filename, n_chars AS payload FROM documents
               UNION ALL SELECT doc_id, 'b', CAST(quality AS BIGINT) FROM labels)
    SELECT pub_id, max(filename) AS filename, arg_max(payload, filename) AS payload FROM u GROUP BY pub_id""")
def union_dedup_versions(spark, d):
    base = t(spark, d, "documents").select(F.col("doc_id").alias("pub_id"), F.lit("a").alias("filename"), F.col("n_chars").alias("payload"))
    newer = t(spark, d, "labels").select(F.col("doc_id").alias("pub_id"), F.lit("b").alias("filename"), F.col("quality").cast("long").alias("payload"))
    return relational.latest_by(relational.union_all(base, newer), "pub_id", "filename")


@query("""
    SELECT user_id, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) = 'error' AS is_deleted,
           CASE WHEN arg_max(event_type, (ts, event_id)) = 'error' THEN NULL ELSE arg_max(value, (ts, event_id)) END AS value
    FROM events GROUP BY user_id""")
def tombstone_passthrough(spark, d):
    dead = F.col("event_type") == "error"
    rows = t(spark, d, "events").select("user_id", "ts", "event_id", dead.alias("is_deleted"), F.when(~dead, F.col("value")).alias("value"))
    return relational.latest_by(rows, "user_id", "ts", "event_id")


_parts = "split_part(text, chr(10), 1) AS title, CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS abstract"


def _titled(spark, d):
    at = F.instr("text", "\n")
    return t(spark, d, "documents").select("doc_id", F.substring_index("text", "\n", 1).alias("title"), F.when(at > 0, F.substring(F.col("text"), at + 1, F.length("text"))).otherwise("").alias("abstract"))


@query(f"""
    WITH p AS (SELECT doc_id, {_parts} FROM documents)
    SELECT doc_id, CASE WHEN title <> '' AND abstract <> '' THEN title || ' ' || abstract WHEN title <> '' THEN title ELSE '' END AS analyzed FROM p""")
def text_to_analyze(spark, d):
    return _titled(spark, d).select("doc_id", text.text_to_analyze(F.col("title"), F.col("abstract")).alias("analyzed"))


@query(r"SELECT doc_id, regexp_replace(text, '[ \t\n\x0B\f\r]{2,}', ' ', 'g') AS normalized FROM documents")
def normalize_whitespace(spark, d):
    return t(spark, d, "documents").select("doc_id", text.collapse_blanks(F.col("text")).alias("normalized"))


def _greek_sql(c):
    for letter, name in text.greek_names().items():
        c = f"replace({c}, '{letter}', '{name}')"
    return c


@query(f"SELECT doc_id, {_greek_sql(chr(39) + 'αβΓ-λ ς Ω ' + chr(39) + ' || text')} AS named FROM documents")
def greek_letters(spark, d):
    return t(spark, d, "documents").select("doc_id", text.name_greek(F.concat(F.lit("αβΓ-λ ς Ω "), F.col("text"))).alias("named"))


@query(r"""SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS strict_k
    FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL""")
def json_pub_id_extract(spark, d):
    rows = t(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.regexp_extract("props", '"k": ([0-9]+)', 1).cast("long").alias("strict_k"))
    return rows.where("k is not null")


@query("""SELECT doc_id, CASE WHEN strpos(text, '. ') > 0 THEN substr(text, 1, strpos(text, '. ') - 1) ELSE text END AS title,
    CASE WHEN strpos(text, '. ') > 0 THEN substr(text, strpos(text, '. ') + 2) ELSE '' END AS abstract FROM documents""")
def tagged_text_split(spark, d):
    title, abstract = text.split_tagged(F.col("text"))
    return t(spark, d, "documents").select("doc_id", title.alias("title"), abstract.alias("abstract"))


_words = r"SELECT DISTINCT w AS surface FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z-]+')) AS w FROM documents)"


def _surfaces(spark, d):
    return t(spark, d, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z-]+)"), 1)).alias("surface")).distinct()


@query(f"""
    SELECT surface FROM ({_words}) WHERE length(surface) > 2
      AND CASE WHEN octet_length(encode(surface)) < 5 THEN surface NOT IN ({_stop}) ELSE lower(surface) NOT IN ({_stop}) END""")
def dictionary_admission(spark, d):
    return _surfaces(spark, d).where(tagging.admit(F.col("surface")))


@query(f"""
    WITH a AS (SELECT surface FROM ({_words}) WHERE length(surface) > 2
                 AND CASE WHEN octet_length(encode(surface)) < 5 THEN surface NOT IN ({_stop}) ELSE lower(surface) NOT IN ({_stop}) END),
    f AS (SELECT lower(surface) AS surface, surface AS element FROM a UNION SELECT replace(lower(surface), '-', ''), surface FROM a)
    SELECT surface, min(element) AS element FROM f WHERE length(surface) > 2 GROUP BY surface""")
def dictionary_build(spark, d):
    entries = _surfaces(spark, d).select("surface", F.col("surface").alias("label"), F.lit("WORD").alias("category"), F.lit("DB").alias("reference_db"), F.array("surface").alias("ids"), F.lit(0).alias("idx"))
    return tagging.build_dictionary(entries).select("surface", "element")


_tags = f"""
    v(surface, category, reference_db, reference) AS (VALUES {_values}),
    pieces AS (SELECT doc_id, text, surface, category, reference_db, reference, unnest(string_split(lower(text), surface)) AS piece,
                      generate_subscripts(string_split(lower(text), surface), 1) AS i FROM documents, v),
    starts AS (SELECT *, CAST(sum(length(piece)) OVER (PARTITION BY doc_id, surface ORDER BY i) + (i - 1) * length(surface) AS BIGINT) AS pos,
                      count(*) OVER (PARTITION BY doc_id, surface) AS n FROM pieces),
    hits AS (SELECT doc_id, text, category, reference_db, reference, pos AS start_at, pos + length(surface) AS end_at FROM starts WHERE i < n
               AND (pos = 0 OR strpos('{_separators}', substr(text, pos, 1)) > 0)
               AND (pos + length(surface) = length(text) OR strpos('{_separators}', substr(text, pos + length(surface) + 1, 1)) > 0)),
    tags AS (SELECT doc_id, category, reference_db, reference, start_at, end_at, substr(text, start_at + 1, end_at - start_at) AS match FROM hits h
             WHERE NOT EXISTS (SELECT 1 FROM hits o WHERE o.doc_id = h.doc_id AND o.category = h.category AND o.reference_db = h.reference_db
                               AND (o.start_at, o.end_at) <> (h.start_at, h.end_at) AND o.start_at <= h.start_at AND o.end_at >= h.end_at))"""


def _tagged(spark, d):
    return tagging.tag_texts(_texts(spark, d), VOCABULARY)


@query(f"WITH {_tags} SELECT doc_id, category, reference_db, reference, start_at, end_at, match FROM tags")
def entity_tags(spark, d):
    tag = F.explode("tags").alias("x")
    return _tagged(spark, d).select("doc_id", tag).select("doc_id", "x.category", "x.reference_db", "x.reference", F.col("x.start").cast("long").alias("start_at"), F.col("x.end").cast("long").alias("end_at"), "x.match")


@query(f"WITH {_tags} SELECT doc_id, category || '|' || reference_db AS tag_group, count(*) AS n FROM tags GROUP BY 1, 2")
def tag_group_counts(spark, d):
    groups = _tagged(spark, d).select("doc_id", F.explode(tagging.group_tags(F.col("tags"))).alias("tag_group", "found"))
    return groups.select("doc_id", "tag_group", F.size("found").cast("long").alias("n"))


@query(f"""WITH {_tags}
    SELECT doc_id, count(*) AS n FROM tags WHERE start_at >= 10 AND end_at <= 200 GROUP BY doc_id""")
def tags_in_range(spark, d):
    return _tagged(spark, d).select("doc_id", F.size(tagging.tags_in_range(F.col("tags"), 10, 200)).cast("long").alias("n")).where("n > 0")


_has = lambda names: " OR ".join(f"list_contains(words, '{n}')" for n in names)


@query(f"""
    WITH s AS (SELECT doc_id, unnest(string_split(text, '. ')) AS sentence FROM documents),
    w AS (SELECT doc_id, string_split(lower(sentence), ' ') AS words FROM s)
    SELECT doc_id, count(*) AS n FROM w WHERE ({_has(["tion", "ther"])}) AND ({_has(["thing", "erin"])}) GROUP BY doc_id""")
def sentence_cooccurrence(spark, d):
    words = F.split(F.lower("sentence"), " ")
    rows = t(spark, d, "documents").select("doc_id", F.explode(F.split("text", r"\. ")).alias("sentence")).select("doc_id", words.alias("words"))

    def tagged(names, category):
        return F.transform(F.filter("words", lambda w: w.isin(*names)), lambda w: F.struct(w.alias("match"), F.lit(category).alias("category")))

    tags = F.concat(tagged(("tion", "ther"), "GENE"), tagged(("thing", "erin"), "DISEASE"))
    return rows.where(tagging.cooccurring(tags)).groupBy("doc_id").agg(F.count("*").alias("n"))


@query("""
    WITH r AS (SELECT l_orderkey, l_linenumber, CAST(l_linenumber AS BIGINT) AS start_at, CAST(l_linenumber + l_quantity % 7 AS BIGINT) AS end_at FROM lineitem)
    SELECT l_orderkey, start_at, end_at FROM r WHERE
      (SELECT count(*) FROM r o WHERE o.l_orderkey = r.l_orderkey AND o.start_at <= r.start_at AND o.end_at >= r.end_at) = 1""")
def nested_removal(spark, d):
    span = F.struct(F.col("l_linenumber").cast("long").alias("start"), (F.col("l_linenumber") + F.col("l_quantity") % 7).cast("long").alias("end"))
    groups = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(span).alias("spans"))
    return groups.select("l_orderkey", F.explode(tagging.remove_nested(F.col("spans"))).alias("s")).select("l_orderkey", F.col("s.start").alias("start_at"), F.col("s.end").alias("end_at"))


_phrases = "p AS (SELECT doc_id, phrase, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS phrase FROM documents) GROUP BY 1, 2)"
_merged = f"""{_phrases}, plural AS (SELECT a.doc_id, a.phrase, b.n FROM p a JOIN p b ON a.doc_id = b.doc_id AND b.phrase = a.phrase || 's'),
    merged AS (SELECT p.doc_id, p.phrase, p.n + coalesce(plural.n, 0) AS n FROM p LEFT JOIN plural ON p.doc_id = plural.doc_id AND p.phrase = plural.phrase
               WHERE NOT EXISTS (SELECT 1 FROM plural x WHERE x.doc_id = p.doc_id AND x.phrase || 's' = p.phrase))"""


def _counts(spark, d, change=None):
    words = F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), 1)
    return phrases.counted(t(spark, d, "documents").select("doc_id", "text"), words, change)


@query(f"WITH {_phrases} SELECT doc_id, phrase, n FROM p")
def phrase_counts(spark, d):
    return _counts(spark, d)


@query(f"WITH {_merged} SELECT doc_id, phrase, n FROM merged")
def plural_merge(spark, d):
    return _counts(spark, d, phrases.with_plurals)


@query(f"WITH {_merged} SELECT doc_id, phrase, n FROM merged WHERE n > 1 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, phrase) <= 5")
def top5_phrases(spark, d):
    return _counts(spark, d, lambda counts: phrases.recurring(phrases.with_plurals(counts), 5))


@query(f"WITH {_merged} SELECT doc_id, count(*) AS recurring FROM merged WHERE n > 1 GROUP BY doc_id")
def recurring_phrases(spark, d):
    return plural_merge(spark, d).where("n > 1").groupBy("doc_id").agg(F.count("*").alias("recurring"))


@query("SELECT doc_id, CAST(floor((length(lower(text)) - length(replace(lower(text), 'the', ''))) / 3) AS BIGINT) AS n FROM documents")
def phrase_occurrences(spark, d):
    return t(spark, d, "documents").select("doc_id", text.count_of(F.lower("text"), F.lit("the")).alias("n"))


@query("""
    WITH n AS (SELECT p_brand, list_distinct(list(p_name)) AS names FROM part GROUP BY p_brand), e AS (SELECT p_brand, names, unnest(names) AS phrase FROM n)
    SELECT p_brand, phrase, CAST(len(list_filter(names, lambda s: s <> phrase AND contains(s, phrase))) AS BIGINT) AS boost FROM e""")
def substring_boost(spark, d):
    names = t(spark, d, "part").groupBy("p_brand").agg(F.collect_set("p_name").alias("names")).select("p_brand", "names", F.explode("names").alias("phrase"))
    return names.select("p_brand", "phrase", F.size(F.filter("names", lambda s: (s != F.col("phrase")) & s.contains(F.col("phrase")))).cast("long").alias("boost"))


@query("""
    WITH b AS (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT a.p_brand AS reference_a, b.p_brand AS reference_b, count(*) AS n FROM b a JOIN b USING (l_orderkey) WHERE a.p_brand < b.p_brand GROUP BY 1, 2""")
def adjacency_matrix(spark, d):
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(t(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    return relational.pair_counts(rows, "l_orderkey", "p_brand")


@query("""
    SELECT p_partkey, [replace(p_name, ' ', '_') || '|' || replace(p_brand, ' ', '_')] AS directed,
      [replace(p_name, ' ', '_') || '|' || replace(p_brand, ' ', '_'), replace(p_brand, ' ', '_') || '|' || replace(p_name, ' ', '_')] AS undirected FROM part""")
def relations_of_concepts(spark, d):
    ref = lambda c: F.array(F.replace(F.col(c), F.lit(" "), F.lit("_")))
    return t(spark, d, "part").select("p_partkey", relational.relations(ref("p_name"), ref("p_brand")).alias("r")).select("p_partkey", "r.directed", "r.undirected")


@query("SELECT p_partkey, 'CONCEPT' AS category, p_name AS label, p_name AS match, replace(p_name, ' ', '_') AS reference, '' AS reference_db FROM part")
def concept_self_tags(spark, d):
    return t(spark, d, "part").select("p_partkey", relational.self_tag(F.col("p_name")).alias("s")).select("p_partkey", "s.category", "s.label", "s.match", "s.reference", "s.reference_db")


@query("SELECT doc_id AS pub_id, lang AS chunk, source AS abbreviation, 3 AS kept_fields FROM documents")
def small_publication(spark, d):
    nlp = F.struct(F.col("lang").alias("chunks"), F.col("source").alias("abbreviations"), F.col("text").alias("tagged_text"), F.lit(1).alias("tagged_entities"), F.lit(2).alias("concepts"), F.lit(3).alias("embedding_text"), F.lit(4).alias("tagged_entities_grouped"))
    small = relational.small_rows(t(spark, d, "documents").select(F.col("doc_id").alias("pub_id"), F.struct(nlp.alias("nlp")).alias("text_mined_entities")))
    fields = len(small.schema["text_mined_entities"].dataType["nlp"].dataType.fields)
    return small.select("pub_id", F.col("text_mined_entities.nlp.chunks").alias("chunk"), F.col("text_mined_entities.nlp.abbreviations").alias("abbreviation"), F.lit(fields).alias("kept_fields"))


_stem = r"""CASE WHEN regexp_matches(w, '[^ae]ies$') THEN regexp_replace(w, 'ies$', 'y') WHEN regexp_matches(w, '[us]s$|[aeio]es$') THEN w
    WHEN regexp_matches(w, '..s$') THEN regexp_replace(w, 's$', '') ELSE w END"""


@query(rf"""
    WITH r AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}'']+')) AS w0 FROM documents),
    w AS (SELECT doc_id, regexp_replace(w0, '''s$|''$', '') AS w FROM r)
    SELECT doc_id, {_stem} AS token, count(*) AS n FROM w WHERE w <> '' AND w NOT IN ({_stop}) GROUP BY 1, 2""")
def analyzer_tokens(spark, d):
    return phrases.counted(t(spark, d, "documents").select("doc_id", "text"), text.analyze(F.col("text")), phrase="token")


@query(f"SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents) WHERE w NOT IN ({_stop}) GROUP BY doc_id")
def stopword_anti_join(spark, d):
    words = t(spark, d, "documents").select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), 1)).alias("w"))
    stop = spark.createDataFrame([(w,) for w in text.STOPWORDS], "w string")
    return words.join(F.broadcast(stop), "w", "left_anti").groupBy("doc_id").agg(F.count("*").alias("n"))


_vocab = lambda table: f"SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM {table}"


@query(f"""
    WITH a AS ({_vocab("documents")}), b AS ({_vocab("conversations")})
    SELECT 'union' AS operation, count(*) AS n FROM (SELECT w FROM a UNION SELECT w FROM b) UNION ALL
    SELECT 'intersect', count(*) FROM (SELECT w FROM a INTERSECT SELECT w FROM b) UNION ALL SELECT 'except', count(*) FROM (SELECT w FROM a EXCEPT SELECT w FROM b)""")
def vocabulary_sets(spark, d):
    a, b = (t(spark, d, x).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), 1)).alias("w")).distinct() for x in ("documents", "conversations"))
    each = (("union", a.union(b).distinct()), ("intersect", a.intersect(b)), ("except", a.subtract(b)))
    return relational.union_all(*[x.agg(F.count("*").alias("n")).select(F.lit(o).alias("operation"), "n") for o, x in each])


@query(f"SELECT conv_id, turn, array_to_string(list_filter(string_split(text, ' '), lambda w: regexp_matches(w, '[A-Za-z0-9]') AND lower(w) NOT IN ({_stop})), ' ') AS plain FROM conversations")
def emit_plain_text(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", concepts.plain_text(F.split("text", " ")).alias("plain"))


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events WHERE user_id IS NOT NULL GROUP BY user_id")
def index_upsert(spark, d):
    """What clicks and purchases update, over the index of all other events."""
    rows = t(spark, d, "events").select("user_id", "event_id", "event_type", "value")
    new = F.coalesce(F.col("event_type").isin("click", "purchase"), F.lit(False))
    return relational.upsert(rows.where(~new), rows.where(new), "user_id", "event_id")


@query("SELECT page_id, CASE WHEN length(url) <= 256 THEN url END AS url_key, CASE WHEN length(html) <= 256 THEN html END AS html_key FROM pages")
def keyword_fields(spark, d):
    return t(spark, d, "pages").select("page_id", relational.keyword(F.col("url")).alias("url_key"), relational.keyword(F.col("html")).alias("html_key"))


@query(f"WITH p AS (SELECT doc_id, {_parts} FROM documents) SELECT CAST(doc_id AS VARCHAR) AS pub_id, title, abstract, '2015-02-01' AS pub_date, FALSE AS is_deleted FROM p")
def xml_records(spark, d):
    """Documents written as XML records and parsed again."""
    esc = lambda c: F.replace(F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("\r"), F.lit("&#13;"))
    xml = F.concat(F.lit('<MedlineCitation Status="x"><PMID Version="1">'), F.col("doc_id").cast("string"), F.lit("</PMID><Article><ArticleTitle>"), esc("title"), F.lit("</ArticleTitle><Abstract><AbstractText>"), esc("abstract"), F.lit("</AbstractText></Abstract><Journal><JournalIssue><PubDate><Year>2015</Year><Month>Feb</Month></PubDate></JournalIssue></Journal></Article></MedlineCitation>"))
    back = records.parse_records(_titled(spark, d).select(xml.alias("xml"), F.lit("f").alias("filename")))
    return back.select("pub_id", F.coalesce("title", F.lit("")).alias("title"), "abstract", "pub_date", "is_deleted")


@query()
def abbreviations_of_documents(spark, d):
    return _texts(spark, d).select("doc_id", abbreviations.find_abbreviations()("text").alias("found"))


@query()
def noun_phrase_chunks(spark, d):
    return _texts(spark, d).select("doc_id", phrases.chunk_texts()(text.normalise(F.col("text"))).alias("c")).select("doc_id", "c.*")


@query()
def svo_concepts(spark, d):
    return concepts.concept_table(_texts(spark, d))


@query()
def enriched_concepts(spark, d):
    """The whole analysis of the documents, and its concept rows."""
    pubs = _titled(spark, d).select(F.col("doc_id").cast("string").alias("pub_id"), "title", "abstract", F.lit("2015-02-01").alias("pub_date"))
    return relational.concept_rows(pipeline.enrich(pubs, VOCABULARY)).select("pub_id", "date", F.col("concept.subject").alias("subject"), F.col("concept.verb").alias("verb"), F.col("concept.object").alias("object"), F.col("concept.relations.directed").alias("directed"))
