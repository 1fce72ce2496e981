"""Relational operators: newest versions, the four splits of enriched records, relations, keyed upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.tagging import TAG
from scriptorium.functions.text import split_tagged


def latest_by(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The newest row of each key; a deletion that is newest stays. Partial aggregation, no list of a key's rows."""
    rest = [c for c in df.columns if c not in (key, *order)]
    newest = df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("newest"))
    return newest.select(key, *[F.col(f"newest.{c}").alias(c) for c in (*order, *rest)])


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def self_tag(text):
    """The CONCEPT tag of a subject or object."""
    none = F.lit(None).cast("int")
    own = {"match": text, "start": none, "end": none, "category": F.lit("CONCEPT"), "reference_db": F.lit(""), "reference": F.replace(text, F.lit(" "), F.lit("_")), "original_value": text, "label": text, "sentence": none}
    return F.struct(*[c.alias(name) for name, c in own.items()])


def with_self_tag(tags, text):
    """A map of tags by category, and the self tag under CONCEPT."""
    own = F.create_map(F.lit("CONCEPT"), F.array(self_tag(text).cast(TAG)))
    rest = F.map_filter(F.coalesce(tags, F.create_map().cast(f"map<string,array<{TAG}>>")), lambda k, _: k != "CONCEPT")
    return F.map_concat(rest, own)


def relations(subjects, objects):
    """Directed and undirected pairs of all references of two lists of references; repeats stay."""
    pair = lambda a, b: F.concat_ws("|", a, b)
    directed = F.flatten(F.transform(subjects, lambda s: F.transform(objects, lambda o: pair(s, o))))
    undirected = F.flatten(F.flatten(F.transform(subjects, lambda s: F.transform(objects, lambda o: F.array(pair(s, o), pair(o, s))))))
    return F.struct(directed.alias("directed"), undirected.alias("undirected"))


def concept_rows(enriched: DataFrame) -> DataFrame:
    """A row per concept with its tags, self tags included, and the relations of their references: concept, pub_id,
    date (the publication's), abbreviations.
    """
    nlp = F.col("text_mined_entities.nlp")
    rows = enriched.select("pub_id", F.col("pub_date").alias("date"), nlp["abbreviations"].alias("abbreviations"), F.explode(nlp["concepts"]).alias("c"))
    tagged = F.col("c").withField("subject_tags", with_self_tag(F.col("c.subject_tags"), F.col("c.subject"))).withField("object_tags", with_self_tag(F.col("c.object_tags"), F.col("c.object")))
    rows = rows.withColumn("c", tagged)
    references = lambda tags: F.transform(F.flatten(F.map_values(tags)), lambda t: t["reference"])
    concept = F.col("c").withField("relations", relations(references(F.col("c.subject_tags")), references(F.col("c.object_tags"))))
    return rows.select(concept.alias("concept"), "pub_id", "date", "abbreviations")


def bioentity_rows(enriched: DataFrame) -> DataFrame:
    return enriched.select(F.col("text_mined_entities.nlp.tagged_entities").alias("entities"), "pub_id").where("entities is not null")


def tagged_text_rows(enriched: DataFrame) -> DataFrame:
    title, abstract = split_tagged(F.col("text_mined_entities.nlp.tagged_text"))
    return enriched.where("text_mined_entities.nlp.tagged_text is not null").select(title.alias("title"), abstract.alias("abstract"), "pub_id")


def small_rows(enriched: DataFrame) -> DataFrame:
    nlp = F.col("text_mined_entities.nlp").dropFields("tagged_text", "tagged_entities", "concepts", "embedding_text")
    return enriched.withColumn("text_mined_entities", F.col("text_mined_entities").withField("nlp", nlp))


def pair_counts(df: DataFrame, key: str, reference: str, most: int = 1000) -> DataFrame:
    """The adjacency matrix of references that share a key: reference_a, reference_b (a < b), in how many keys.

    Of a key with more than ``most`` references, those on one side are dealt to several parts and the other side comes to each,
    so that no task has all the pairs of a key.
    """
    one = df.select(key, reference).distinct()
    sized = one.groupBy(key).agg(F.ceil(F.count("*") / most).cast("int").alias("parts")).where("parts > 1")
    dealt = one.join(sized, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    a = dealt.select(key, F.col(reference).alias("reference_a"), F.pmod(F.xxhash64(reference), F.col("parts")).cast("int").alias("part"))
    b = dealt.select(key, F.col(reference).alias("reference_b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return a.join(b, [key, "part"]).where("reference_a < reference_b").groupBy("reference_a", "reference_b").agg(F.count("*").alias("n"))


def upsert(target: DataFrame, updates: DataFrame, key: str, order: str) -> DataFrame:
    """Keyed overwrite: rows without a key are left out, the last of a key wins."""
    return latest_by(union_all(target, updates).where(F.col(key).isNotNull()), key, order)


def keyword(c):
    """Exact-match keys: values of more than 256 characters aren't searchable."""
    return F.when(F.length(c) <= 256, c)


def any_date(c):
    """The date formats that the index takes: date and time, date, epoch millis."""
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")), F.timestamp_millis(F.when(c.rlike("^-?[0-9]+$"), c).cast("long")))
