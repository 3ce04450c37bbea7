"""Part-of-speech tags in context, learned from labelled documents and put on all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sentilode.checks import sql as S
from sentilode.checks.registry import query
from sentilode.checks.tables import corpus_lexicon, document_terms, documents, load
from sentilode.checks.texts import LEXICON, TERMS
from sentilode.functions.arrays import let
from sentilode.operators import lemma, tagging
from sentilode.operators.scale import BROADCAST_BYTES, measured_bytes
from sentilode.session import materialize

# The tagged corpus of the checks: tags by the ending of a word, but nouns after one of these words.
ARTICLES = ["the", "a", "an", "la", "le", "el", "der", "die", "das", "un", "une", "ein"]
TAGS = ["DT", "JJ", "NN", "RB", "VB"]
SENTENCE_END = "[.!?\\n]+"
LETTERS = "\\p{L}+"


def _tag(word: Column, before: Column) -> Column:
    return (
        F.when(word.isin(ARTICLES), "DT").when(before.isin(ARTICLES), "NN").when(word.endswith("ly"), "RB")
        .when(word.endswith("ing") | word.endswith("ed") | word.endswith("en"), "VB")
        .when(word.endswith("er") | word.endswith("est"), "JJ").otherwise("NN")
    )


def _words(sentence: Column) -> Column:
    return F.regexp_extract_all(F.lower(sentence), F.lit(LETTERS), F.lit(0))


def _cut(docs: DataFrame) -> DataFrame:
    """(doc_id, at, tokens)"""
    cut = docs.select("doc_id", F.posexplode(F.split("text", SENTENCE_END)).alias("at", "sentence"))
    return cut.select("doc_id", "at", _words(F.col("sentence")).alias("tokens")).filter(F.size("tokens") > 0)


def _ruled(sentences: DataFrame) -> DataFrame:
    """(tokens, tags) by the rule of the checks."""
    rule = let(F.col("tokens"), lambda t: F.transform(t, lambda w, i: _tag(w, F.coalesce(F.when(i > 0, F.get(t, i - 1)), F.lit("")))))
    return sentences.select("tokens", rule.alias("tags"))


def _tagged(spark, sf_dir) -> DataFrame:
    """(doc_id, at, tokens, tags) of all documents."""
    sentences = materialize(_cut(documents(spark, sf_dir)), "sentences")
    labelled = load(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    corpus = _ruled(sentences.join(labelled, "doc_id", "left_semi"))
    return tagging.with_tags(sentences, "tokens", tagging.learn(corpus))


_NAMES = "[" + ", ".join(S.quoted(t) for t in TAGS) + "]"
_EACH = f"range(1, {len(TAGS) + 1})"
_ARTICLES = "(" + ", ".join(map(S.quoted, ARTICLES)) + ")"
_THROUGH = f"list_transform({_EACH}, lambda j: v.sums[j] + c.follow[j][k])"


def _logarithm(n: str, total: str, kinds: str) -> str:
    return f"CAST(round(ln((coalesce({n}, 0) + 1)::DOUBLE / (coalesce({total}, 0) + {kinds})) * {tagging.UNIT}) AS BIGINT)"


# Both give `tagged`: (doc_id, sid, i, term, tag) of every token.
TAG_CTES = f"""
cut AS (
  SELECT doc_id, s AS sentence, i AS sid FROM (
    SELECT doc_id, unnest(k) AS s, generate_subscripts(k, 1) - 1 AS i
    FROM (SELECT doc_id, regexp_split_to_array(text, '[.!?' || chr(10) || ']+') AS k FROM documents))),
sentences AS (SELECT doc_id, sid, regexp_extract_all(lower(sentence), {S.quoted(LETTERS)}) AS w FROM cut),
tok AS (SELECT doc_id, sid, unnest(w) AS term, generate_subscripts(w, 1) AS i FROM sentences WHERE len(w) > 0),
ruled AS (
  SELECT doc_id, sid, i, term, CASE WHEN term IN {_ARTICLES} THEN 'DT' WHEN before IN {_ARTICLES} THEN 'NN'
    WHEN term LIKE '%ly' THEN 'RB' WHEN term LIKE '%ing' OR term LIKE '%ed' OR term LIKE '%en' THEN 'VB'
    WHEN term LIKE '%er' OR term LIKE '%est' THEN 'JJ' ELSE 'NN' END AS tag
  FROM (SELECT t.*, lag(term) OVER (PARTITION BY t.doc_id, sid ORDER BY i) AS before FROM tok t
        WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))),
steps AS (
  SELECT before, tag, count(*) AS n FROM (
    SELECT tag, coalesce(lag(tag) OVER (PARTITION BY doc_id, sid ORDER BY i), '') AS before FROM ruled) GROUP BY ALL),
names AS (SELECT unnest({_NAMES}) AS tag),
begins AS (SELECT tag AS before FROM names UNION ALL SELECT ''),
follow AS (
  SELECT b.before, list({_logarithm("s.n", "t.total", len(TAGS))} ORDER BY k.tag) AS logs
  FROM begins b CROSS JOIN names k LEFT JOIN steps s ON s.before = b.before AND s.tag = k.tag
  LEFT JOIN (SELECT before, sum(n) AS total FROM steps GROUP BY before) t ON t.before = b.before GROUP BY b.before),
uses AS (SELECT term, tag, count(*) AS n FROM ruled GROUP BY ALL),
word_class AS (SELECT term, string_agg(DISTINCT tag, '|' ORDER BY tag) AS class FROM uses GROUP BY term),
ending_class AS (
  SELECT right(term, {tagging.ENDING}) AS ending, string_agg(DISTINCT tag, '|' ORDER BY tag) AS class
  FROM uses WHERE length(term) >= {tagging.ENDING} GROUP BY ALL),
classes AS (SELECT class FROM word_class UNION SELECT class FROM ending_class UNION SELECT '*'),
said AS (SELECT class, tag, sum(n) AS n FROM uses JOIN word_class USING (term) GROUP BY ALL),
emit AS (
  SELECT c.class, list({_logarithm("s.n", "t.total", "(SELECT count(*) FROM classes)")} ORDER BY k.tag) AS logs
  FROM classes c CROSS JOIN names k LEFT JOIN said s ON s.class = c.class AND s.tag = k.tag
  LEFT JOIN (SELECT tag, sum(n) AS total FROM uses GROUP BY tag) t ON t.tag = k.tag GROUP BY c.class),
seq AS (
  SELECT t.doc_id, t.sid, t.i, t.term, e.logs AS own FROM tok t LEFT JOIN word_class w ON w.term = t.term
  LEFT JOIN ending_class d ON d.ending = right(t.term, {tagging.ENDING}) JOIN emit e ON e.class = coalesce(w.class, d.class, '*')),
consts AS (
  SELECT (SELECT list(logs ORDER BY before) FROM follow WHERE before <> '') AS follow,
    (SELECT logs FROM follow WHERE before = '') AS start),
v AS (
  SELECT s.doc_id, s.sid, s.i, list_transform({_EACH}, lambda k: c.start[k] + s.own[k]) AS sums,
    list_transform({_EACH}, lambda k: CAST(k AS VARCHAR)) AS paths
  FROM seq s, consts c WHERE s.i = 1
  UNION ALL
  SELECT v.doc_id, v.sid, s.i, list_transform({_EACH}, lambda k: list_max({_THROUGH}) + s.own[k]),
    list_transform({_EACH}, lambda k: v.paths[list_position({_THROUGH}, list_max({_THROUGH}))] || CAST(k AS VARCHAR))
  FROM v JOIN seq s ON s.doc_id = v.doc_id AND s.sid = v.sid AND s.i = v.i + 1, consts c),
last AS (
  SELECT v.doc_id, v.sid, paths[list_position(sums, list_max(sums))] AS path FROM v
  JOIN (SELECT doc_id, sid, max(i) AS n FROM tok GROUP BY ALL) l ON l.doc_id = v.doc_id AND l.sid = v.sid AND l.n = v.i),
tagged AS (
  SELECT t.doc_id, t.sid, t.i, t.term, {_NAMES}[CAST(substr(l.path, CAST(t.i AS BIGINT), 1) AS INTEGER)] AS tag
  FROM tok t JOIN last l ON l.doc_id = t.doc_id AND l.sid = t.sid)"""


def _part(at: Column, words: Column) -> Column:
    return F.struct(at.alias("at"), F.array_join(words, " ").alias("text"))


def _joined(rows: DataFrame, parts: Column, name: str) -> DataFrame:
    """The texts of a document's sentences in order."""
    return rows.select("doc_id", F.array_join(F.transform(F.array_sort(parts), lambda p: p["text"]), " ").alias(name))


def _by_document(rows: DataFrame, words: str, name: str) -> DataFrame:
    """One text per document: its sentences' words in order."""
    parts = rows.select("doc_id", _part(F.col("at"), F.col(words)).alias("part")).groupBy("doc_id").agg(F.collect_list("part").alias("parts"))
    return _joined(parts, F.col("parts"), name)


@query(
    "tags_in_context",
    f"WITH RECURSIVE {TAG_CTES} SELECT doc_id, string_agg(tag, ' ' ORDER BY sid, i) AS tags FROM tagged GROUP BY doc_id",
)
def tags_in_context(spark, sf_dir):
    return _by_document(_tagged(spark, sf_dir), "tags", "tags")


@query(
    "words_of_two_tags",
    f"WITH RECURSIVE {TAG_CTES} SELECT term, string_agg(DISTINCT tag, ' ' ORDER BY tag) AS tags, count(*) AS n FROM tagged "
    "GROUP BY term HAVING count(DISTINCT tag) > 1",
)
def words_of_two_tags(spark, sf_dir):
    """The words that have different tags in different sentences."""
    pairs = F.zip_with("tokens", "tags", lambda w, tag: F.struct(w.alias("term"), tag.alias("tag")))
    words = _tagged(spark, sf_dir).select(F.inline(pairs))
    found = words.groupBy("term").agg(F.array_sort(F.collect_set("tag")).alias("tags"), F.count("*").alias("n"))
    return found.filter(F.size("tags") > 1).select("term", F.array_join("tags", " ").alias("tags"), "n")


POS = "CASE substr(tag, 1, 1) WHEN 'J' THEN 'a' WHEN 'V' THEN 'v' WHEN 'R' THEN 'r' ELSE 'n' END"


@query(
    "lemmatize_in_context",
    f"WITH RECURSIVE {TERMS}, {LEXICON}, {TAG_CTES}, placed AS (SELECT *, {POS} AS pos FROM tagged), "
    f"used AS (SELECT DISTINCT term, pos FROM placed), {S.lemma_ctes('used', 'lexicon')} "
    "SELECT doc_id, string_agg(l.lemma, ' ' ORDER BY sid, i) AS lemmatized FROM placed p "
    "JOIN lemma_of l ON l.term = p.term AND l.pos = p.pos GROUP BY doc_id",
)
def lemmatize_in_context(spark, sf_dir):
    """Texts are cut into words again in each pass, not written; they are shuffled once."""
    lexicon = corpus_lexicon(spark, document_terms(spark, sf_dir))
    docs = documents(spark, sf_dir)
    good = materialize(load(spark, sf_dir, "labels").filter("quality = 1").select("doc_id").distinct(), "good-documents")
    good = F.broadcast(good) if measured_bytes(good) <= BROADCAST_BYTES else good
    tagger = tagging.learn(_ruled(_cut(docs.join(good, "doc_id", "left_semi"))))
    found = tagging.lemmatize_documents(
        docs, "doc_id", "text", lambda text: F.transform(F.split(text, SENTENCE_END), _words), tagger, lexicon, lemma.irregular_table(spark)
    )
    return _joined(found.filter(F.size("at") > 0), F.zip_with("at", "lemmatized", _part), "lemmatized")
