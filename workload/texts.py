"""Language, corpus, token and term-weight queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions import text as X
from faultline.functions.stems import spanish_stem
from faultline.operators import cleaning as C
from faultline.operators import corpus as K
from faultline.operators import features as V
from faultline.operators import language as L
from faultline.operators import translation as T
from faultline.operators.grid_search import DistanceKMeans, Search, grid_search
from faultline.operators.transformers import TfidfFeatures, TokenCleaner
from faultline.plans.sizing import spread
from workload.tables import table, texts

LANGUAGES = ("de", "en", "es", "fr")
STOP_WORDS = (
    "de", "la", "que", "el", "en", "y", "a", "los", "se", "del",
    "the", "of", "and", "to", "in", "is", "le", "les", "et", "des",
    "der", "die", "und", "das", "nicht",
)
CUSTOM_WORDS = ("para", "with", "pour", "sich")


def _strings(words: tuple) -> str:
    return ", ".join(f"'{w}'" for w in sorted(words))


def language_id(spark: SparkSession, d: str) -> DataFrame:
    """Language of every document, from profiles of the labelled documents."""
    documents = texts(spark, d, "doc_id", "text", "lang")
    profile = L.language_profile(documents, "text", "lang", LANGUAGES)
    return L.detect_language(documents, ["doc_id"], "text", profile, LANGUAGES)


def _language_sql(profiled: str = "true", detected: str = "true") -> str:
    """Language of the ``detected`` documents, from profiles of the ``profiled`` ones."""
    return f"""
c AS (SELECT doc_id, lang, length(text) AS len, string_split(lower(text), '') AS ch FROM documents),
g AS (SELECT doc_id, lang, ch[i] || ch[i + 1] || ch[i + 2] AS gram
      FROM (SELECT doc_id, lang, ch, unnest(range(1, len(ch) - 1)) AS i FROM c)),
n AS (SELECT lang, gram, count(*) AS n FROM g WHERE {profiled} AND lang IN ({_strings(LANGUAGES)}) GROUP BY ALL),
k AS (SELECT * FROM n),
v AS (SELECT count(DISTINCT gram) AS v FROM k),
tot AS (SELECT lang, sum(n) AS total FROM k GROUP BY lang),
p AS (SELECT a.gram, tot.lang, ln((coalesce(k.n, 0) + 1) / (tot.total + v.v)) AS w
      FROM (SELECT DISTINCT gram FROM k) a CROSS JOIN tot CROSS JOIN v
      LEFT JOIN k ON k.gram = a.gram AND k.lang = tot.lang),
gn AS (SELECT doc_id, gram, count(*) AS n FROM g WHERE {detected} GROUP BY ALL),
s AS (SELECT doc_id, p.lang, sum(gn.n * w) AS score FROM gn JOIN p USING (gram) GROUP BY ALL),
best AS (SELECT doc_id, lang FROM s
         QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang DESC) = 1),
languages AS (
  SELECT c.doc_id, CASE WHEN coalesce(c.len, 0) < 5 THEN 'Too short'
                        WHEN best.lang IS NULL THEN 'Error' ELSE best.lang END AS language
  FROM c LEFT JOIN best USING (doc_id) WHERE {detected})
"""

LANGUAGE_ID = f"WITH {_language_sql()} SELECT * FROM languages"


def corpus_languages(spark: SparkSession, d: str) -> DataFrame:
    """Documents detected as Spanish or Portuguese."""
    detected = L.keep_languages(language_id(spark, d), "language")
    documents = table(spark, d, "documents").select("doc_id", "source")
    return documents.join(detected, "doc_id")


CORPUS_LANGUAGES = f"""
WITH {_language_sql()}
SELECT doc_id, source, language FROM documents JOIN languages USING (doc_id)
WHERE language IN ('es', 'pt')
"""


def detected_worklist(spark: SparkSession, d: str) -> DataFrame:
    """Work-list end to end: distinct texts of two fields, their detected language, and what there is to translate."""
    documents = texts(spark, d, "doc_id", "text", "source", "lang")
    profile = L.language_profile(documents.where("doc_id % 2 = 0"), "text", "lang", LANGUAGES)
    worklist = L.distinct_texts(documents.where("doc_id % 2 = 1").select("text", "source"), ["text", "source"])
    detected = L.detect_language(worklist, ["field", "text"], "text", profile, LANGUAGES)
    return L.translation_budget(detected)


DETECTED_WORKLIST = f"""
WITH {_language_sql("doc_id % 2 = 0", "doc_id % 2 = 1")},
t AS (SELECT DISTINCT text, language FROM documents JOIN languages USING (doc_id))
SELECT 'text' AS field, count(*) AS texts, CAST(sum(length(text)) AS BIGINT) AS characters
FROM t WHERE language NOT IN ('es', 'Error', 'Too short')
"""


def stemmed_documents(spark: SparkSession, d: str) -> DataFrame:
    """Spanish documents as stems, each distinct word stemmed once."""
    documents = texts(spark, d, "doc_id", "text", "lang").where("lang = 'es'")
    words = documents.select("doc_id", X.tokens("text", stop_words=STOP_WORDS, alpha_only=True).alias("words"))
    return X.stemmed(words, "doc_id", "words", spanish_stem)


def html_to_text(spark: SparkSession, d: str) -> DataFrame:
    pages = spread(table(spark, d, "pages").select("page_id", "html"), "page_id")
    return K.html_texts(pages, "page_id", "html")


# HTML reads these entities with or without their semicolon, as where a title was cut.
_HTML_SQL = r"""
regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  regexp_replace(regexp_replace(html,
    '<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', '', 'gs'),
    '<[^>]*>', '', 'g'),
  '&quot;?', '"', 'g'), '&middot;?', '·', 'g'), '&copy;?', '©', 'g'), '&amp;?', '&', 'g')
"""

HTML_TO_TEXT = f"SELECT page_id AS doc_id, {_HTML_SQL} AS text_to_analyse FROM pages"


def sentences(spark: SparkSession, d: str) -> DataFrame:
    return K.sentence_rows(texts(spark, d, "doc_id", "text"), "doc_id", "text")


_SENTENCE_SQL = r"""
SELECT {key} AS doc_id, unnest(range(len(parts))) AS position, unnest(parts) AS text_to_analyse
FROM (SELECT {key}, [s FOR s IN [trim(p, E' \t\n\r') FOR p IN
        string_split(regexp_replace({text}, '([.!?])\s+', E'\\1\x01', 'g'), E'\x01')]
      IF s <> ''] AS parts FROM {table})
"""

SENTENCES = f"""
SELECT doc_id, CAST(position AS INTEGER) AS position, text_to_analyse
FROM ({_SENTENCE_SQL.format(key="doc_id", text="text", table="documents")})
"""


def corpus_union(spark: SparkSession, d: str) -> DataFrame:
    """Tickets, questions, product documents and catalogue in one corpus."""
    turns = table(spark, d, "conversations")
    product = sentences(spark, d)
    catalogue = K.sentence_rows(table(spark, d, "benchmark"), "item_id", "text")
    return K.build_corpus(
        {
            "tickets": K.ticket_texts(turns, "conv_id", "role", "text"),
            "faq": html_to_text(spark, d),
            "products": product,
            "catalogue": catalogue,
        }
    )


CORPUS_UNION = f"""
SELECT 'tickets' AS source, CAST(conv_id AS VARCHAR) AS doc_id,
       coalesce(role, '') || ' ' || coalesce(text, '') AS text_to_analyse FROM conversations
UNION ALL SELECT 'faq', CAST(page_id AS VARCHAR), {_HTML_SQL} FROM pages
UNION ALL SELECT 'products', CAST(doc_id AS VARCHAR), text_to_analyse
  FROM ({_SENTENCE_SQL.format(key="doc_id", text="text", table="documents")})
UNION ALL SELECT 'catalogue', CAST(doc_id AS VARCHAR), text_to_analyse
  FROM ({_SENTENCE_SQL.format(key="item_id", text="text", table="benchmark")})
"""


def token_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Both token pipelines: without punctuation, and with letters only."""
    documents = texts(spark, d, "doc_id", "text")
    plain = X.tokens("text", stop_words=STOP_WORDS, drop_punctuation=True)
    alpha = X.tokens(
        "text", stop_words=STOP_WORDS, alpha_only=True, custom_stop_words=CUSTOM_WORDS
    )
    result = documents.select(
        "doc_id",
        F.array_join(plain, " ").alias("plain"),
        F.array_join(alpha, " ").alias("alpha"),
    )
    return result.where(F.col("alpha") != "")


_WORDS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"

TOKEN_PIPELINE = rf"""
WITH t AS (
  SELECT doc_id,
    array_to_string([w FOR w IN {_WORDS_SQL} IF w NOT IN ({_strings(STOP_WORDS)})], ' ') AS plain,
    array_to_string([w FOR w IN {_WORDS_SQL} IF w NOT IN ({_strings(STOP_WORDS + CUSTOM_WORDS)})
      AND regexp_full_match(w, '\p{{L}}+')], ' ') AS alpha
  FROM documents)
SELECT * FROM t WHERE alpha <> ''
"""


def domain_stopwords(spark: SparkSession, d: str) -> DataFrame:
    documents = texts(spark, d, "doc_id", "text")
    kept = X.without_words(X.split_words(F.lower("text")), CUSTOM_WORDS)
    return documents.select("doc_id", F.array_join(kept, " ").alias("text"), F.size(kept).alias("words"))


DOMAIN_STOPWORDS = rf"""
WITH t AS (SELECT doc_id, [w FOR w IN regexp_split_to_array(lower(text), '\s+')
                           IF w <> '' AND w NOT IN ({_strings(CUSTOM_WORDS)})] AS words FROM documents)
SELECT doc_id, array_to_string(words, ' ') AS text, CAST(len(words) AS INTEGER) AS words FROM t
"""


def _weights(spark: SparkSession, d: str) -> DataFrame:
    documents = texts(spark, d, "doc_id", "text")
    vocabulary = V.fit_tfidf(documents, V.term_tokens("text"))
    return V.tfidf_weights(documents, "doc_id", "text", vocabulary)


def tfidf_weights(spark: SparkSession, d: str) -> DataFrame:
    return _weights(spark, d).withColumn("weight", F.round("weight", 6))


_TFIDF_SQL = r"""
tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
n AS (SELECT count(*) AS n FROM documents),
df AS (SELECT term, ln((n + 1) / (count(*) + 1)) + 1 AS idf FROM tf, n GROUP BY term, n
       HAVING count(*) >= n * 0.01 AND count(*) <= n * 0.99),
raw AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN df USING (term)),
tfidf AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)
"""

TFIDF_WEIGHTS = f"WITH {_TFIDF_SQL} SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf"


def term_weights(spark: SparkSession, d: str) -> DataFrame:
    return V.term_weights(_weights(spark, d)).withColumn("weight", F.round("weight", 6))


TERM_WEIGHTS = f"WITH {_TFIDF_SQL} SELECT term, round(sum(weight), 6) AS weight FROM tfidf GROUP BY term"


def word2vec_docs(spark: SparkSession, d: str) -> DataFrame:
    """Document vectors of a word-vector model: 100 numbers, words seen twice, two rounds."""
    documents = texts(spark, d, "doc_id", "text").select("doc_id", V.term_tokens("text").alias("tokens"))
    model = V.fit_word2vec(documents, "tokens", size=100, min_count=2, epochs=2, seed=1)
    vectors = V.word2vec_vectors(model, documents, ["doc_id"])
    return vectors.select("doc_id", F.transform("vector", lambda x: F.round(x.cast("double"), 6)).alias("vector"))


def encoded_documents(spark: SparkSession, d: str) -> DataFrame:
    """Hashed sentence vectors of all documents."""
    documents = texts(spark, d, "doc_id", "text").select(
        "doc_id", V.term_tokens("text").alias("tokens")
    )
    vectors = V.hashed_vectors(documents, "tokens", ["doc_id"], width=64)
    return vectors.select("doc_id", F.transform("vector", lambda x: F.round(x.cast("double"), 6)).alias("vector"))


def _counting_encoder():
    """A stand-in sentence encoder: length, letters e, blanks."""
    return lambda texts: [[len(t), t.count("e"), t.count(" ")] for t in texts]


def encoded_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of an injected encoder, one number a column."""
    vectors = V.encode(texts(spark, d, "doc_id", "text"), "doc_id", "text", _counting_encoder)
    return vectors.select("doc_id", *[F.get("vector", F.lit(i)).cast("long").alias(f"v{i}") for i in range(3)])


ENCODED_SENTENCES = """
SELECT doc_id, CAST(length(t) AS BIGINT) AS v0, CAST(length(t) - length(replace(t, 'e', '')) AS BIGINT) AS v1,
       CAST(length(t) - length(replace(t, ' ', '')) AS BIGINT) AS v2
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""


PUNCTUATION, STOPPED, CLUSTERS = (0, "dropPunctuation"), (0, "stopWords"), (2, "k")


def _grid(spark: SparkSession, d: str) -> Search:
    """With and without punctuation and stop words, features fitted inside the folds, 250 clusters."""
    cleaner = TokenCleaner(inputCol="text", outputCol="tokens")
    tfidf = TfidfFeatures(inputCol="tokens", outputCol="vector")
    pipeline = Pipeline(stages=[cleaner, tfidf, DistanceKMeans(seed=0, maxIter=20)])
    values = {STOPPED: [list(STOP_WORDS), []], PUNCTUATION: [True, False], CLUSTERS: [250]}
    names = {STOPPED: "stop_words", PUNCTUATION: "drop_punctuation", CLUSTERS: "k"}
    return grid_search(texts(spark, d, "doc_id", "text"), "doc_id", pipeline, values, names)


def preprocessing_grid(spark: SparkSession, d: str) -> DataFrame:
    """Documents with their cluster by the best of all variants, and that variant's parameters."""
    search = _grid(spark, d)
    best = {n: " ".join(v) if isinstance(v, list) else v for n, v in search.best.items()}
    placed = search.clustered(texts(spark, d, "doc_id", "text")).select("doc_id", "cluster", F.round("distance", 6).alias("distance"))
    return placed.select("*", *[F.lit(v).alias(n) for n, v in best.items()])


def _shouting():
    """A stand-in translator."""
    return lambda texts: [f"es: {t}" for t in texts]


def batch_translate(spark: SparkSession, d: str) -> DataFrame:
    """Texts that need a translation and are not cached, translated in batches."""
    documents = table(spark, d, "documents").select("lang", "text")
    worklist = L.to_translate(documents.withColumnRenamed("lang", "language"))
    cache = documents.where(F.col("lang") == "fr").select(
        "text", F.col("text").alias("text_translated")
    )
    fresh = T.untranslated(worklist, cache, "text")
    return T.translate_texts(fresh, "text", _shouting, batch_size=50)


BATCH_TRANSLATE = """
SELECT DISTINCT text, 'es: ' || text AS text_translated, CAST(NULL AS VARCHAR) AS error
FROM documents WHERE lang NOT IN ('es', 'Error', 'Too short') AND text IS NOT NULL
  AND text NOT IN (SELECT text FROM documents WHERE lang = 'fr' AND text IS NOT NULL)
"""


def header_rows(spark: SparkSession, d: str) -> DataFrame:
    """Documents left after dropping rows that repeat a header, here the name of a language column."""
    documents = table(spark, d, "documents").select(
        "doc_id", F.when(F.col("source") == "src1", "lang").when(F.col("source") != "src2", F.col("lang")).alias("lang")
    )
    return C.without_header_rows(documents, "lang")


HEADER_ROWS = """
SELECT doc_id, CASE WHEN source <> 'src2' THEN lang END AS lang FROM documents
WHERE source IS NULL OR source <> 'src1'
"""

QUERIES = {
    "language_id": (language_id, LANGUAGE_ID),
    "detected_worklist": (detected_worklist, DETECTED_WORKLIST),
    "stemmed_documents": (stemmed_documents, None),
    "corpus_languages": (corpus_languages, CORPUS_LANGUAGES),
    "html_to_text": (html_to_text, HTML_TO_TEXT),
    "sentences": (sentences, SENTENCES),
    "corpus_union": (corpus_union, CORPUS_UNION),
    "token_pipeline": (token_pipeline, TOKEN_PIPELINE),
    "domain_stopwords": (domain_stopwords, DOMAIN_STOPWORDS),
    "tfidf_weights": (tfidf_weights, TFIDF_WEIGHTS),
    "term_weights": (term_weights, TERM_WEIGHTS),
    "word2vec_docs": (word2vec_docs, None),
    "preprocessing_grid": (preprocessing_grid, None),
    "encoded_sentences": (encoded_sentences, ENCODED_SENTENCES),
    "encoded_documents": (encoded_documents, None),
    "batch_translate": (batch_translate, BATCH_TRANSLATE),
    "header_rows": (header_rows, HEADER_ROWS),
}
