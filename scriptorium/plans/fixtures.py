"""A handful of parsed sentences, as a parser with a trained model would give them: what queries over trees run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Word, part of speech, dependency and place of the head of each token; a word that ends in ~ is not followed by a space.
SENTENCES = {
    1: "Strong:ADJ:amod:1 tea:NOUN:nsubj:2 prevents:VERB:ROOT:2 dull:ADJ:amod:4 headaches:NOUN:dobj:2 and:CCONJ:cc:4 morning:NOUN:compound:7 fatigue~:NOUN:conj:4 .:PUNCT:punct:2",
    2: "Long:ADJ:amod:2 night:NOUN:compound:2 shifts:NOUN:nsubj:5 do:AUX:aux:5 not:PART:neg:5 improve:VERB:ROOT:5 sleep:NOUN:compound:7 quality~:NOUN:dobj:5 .:PUNCT:punct:5",
    3: "Growers:NOUN:nsubj:1 say:VERB:ROOT:1 that:SCONJ:mark:4 salt:NOUN:nsubj:4 reduces:VERB:ccomp:1 the:DET:det:6 yield:NOUN:dobj:4 of:ADP:prep:6 winter:NOUN:compound:9 wheat~:NOUN:pobj:7 .:PUNCT:punct:1",
    4: "No:DET:det:1 filter:NOUN:nsubj:2 removes:VERB:ROOT:2 fine:ADJ:amod:4 dust:NOUN:dobj:2 from:ADP:prep:2 city:NOUN:compound:7 air~:NOUN:pobj:5 .:PUNCT:punct:2",
    5: "The:DET:det:1 valve:NOUN:nsubjpass:5 (~:PUNCT:punct:1 V2):PROPN:appos:1 was:AUX:auxpass:5 replaced:VERB:ROOT:5 by:ADP:agent:5 a:DET:det:9 steel:NOUN:compound:9 part~:NOUN:pobj:6 .:PUNCT:punct:5",
    6: "Rain:NOUN:nsubj:1 falls~:VERB:ROOT:1 .:PUNCT:punct:1",
    7: "Bees:NOUN:nsubj:1 visit:VERB:ROOT:1 flowers:NOUN:dobj:1 and:CCONJ:cc:1 never:ADV:neg:5 harm:VERB:conj:1 fruit:NOUN:compound:7 trees~:NOUN:dobj:5 .:PUNCT:punct:1",
}


def rows() -> list[tuple]:
    """sentence, i, text, idx, lemma, pos, dep, head, space."""
    out = []
    for number, said in SENTENCES.items():
        at = 0
        for i, one in enumerate(said.split(" ")):
            word, pos, dep, head = one.rsplit(":", 3)
            space = not word.endswith("~")
            word = word.removesuffix("~")
            lemma = word.lower().removesuffix("s") if pos == "VERB" and word.endswith("s") else word.lower()
            out.append((number, i, word, at, lemma, "VERB" if pos == "AUX" else pos, dep, int(head), space))
            at += len(word) + space
    return out


def tokens(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), "sentence int, i int, text string, idx int, lemma string, pos string, dep string, head int, space boolean")


def tokens_sql() -> str:
    """The same as a common table expression ``tok``, with ``sent`` (sentence, said)."""
    quote = lambda x: "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)
    values = ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in rows())
    return f"""tok(sentence, i, text, idx, lemma, pos, dep, head, space) AS (VALUES {values}),
        sent AS (SELECT sentence, string_agg(text || CASE WHEN space THEN ' ' ELSE '' END, '' ORDER BY i) AS said FROM tok GROUP BY sentence),
        up(sentence, i, above, far) AS (SELECT sentence, i, head, 1 FROM tok WHERE head <> i
            UNION ALL SELECT u.sentence, u.i, t.head, far + 1 FROM up u JOIN tok t ON t.sentence = u.sentence AND t.i = u.above WHERE t.head <> t.i)"""
