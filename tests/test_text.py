import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from faultline.functions import text as X
from faultline.functions.stems import spanish_stem
from faultline.operators import corpus as K
from faultline.operators import features as V
from faultline.operators import language as L
from faultline.operators import translation as T
from faultline.operators.transformers import TfidfFeatures, TokenCleaner


def one(spark, values, expression):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expression).collect()]


def test_tokens(spark):
    text = "El Motor NO funciona, ¿avería térmica?"
    assert one(spark, [text], X.tokens("v"))[0] == [
        "el", "motor", "no", "funciona", ",", "¿", "avería", "térmica", "?"
    ]
    assert one(spark, [text], X.tokens("v", lower=False, stop_words=["el", "no"], drop_punctuation=True))[0] == [
        "Motor", "funciona", "avería", "térmica"
    ]
    assert one(spark, ["ab1 cd de"], X.tokens("v", alpha_only=True, custom_stop_words=["de"]))[0] == ["cd"]
    assert one(spark, ["el EL", "", None], X.tokens("v", stop_words=["el"])) == [[], [], []]


def test_domain_words(spark):
    words = X.without_words(X.split_words(F.lower("v")))
    assert one(spark, ["Avería del  motor motor", "", "error"], words) == [["del", "motor", "motor"], [], []]


def test_sentences(spark):
    assert one(spark, ["Uno. Dos!  Tres? Cuatro 1.5 v.", " ", None], X.sentences("v")) == [
        ["Uno.", "Dos!", "Tres?", "Cuatro 1.5 v."], [], None
    ]


def test_html(spark):
    html = "<!DOCTYPE html><p>a &lt; b&amp;amp;<br>c</p><!-- x --><script>var t='</p>';</script><style>p{}</style>&eacute;"
    assert one(spark, [html, None, "plain", "<p>open"], X.html_text("v")) == ["a < b&amp;cé", None, "plain", "open"]
    assert X.visible_text("<p>x<![CDATA[ y ]]></p><template>no</template>z") == "x y z"


STEMS = """cheque chequ, chequeo cheque, cheques chequ, chiapas chiap, chicas chic, chicharrones chicharron, chico chic,
    chihuahua chihuahu, chile chil, chilena chilen, chilango chilang, torá tor, tórax torax, torear tor, toreado tor,
    toreándolo tor, toreó tore, torero torer, torneo torne, toros tor, torpe torp, torpes torp, torres torr, tortuga tortug,
    averías aver, defectos defect, rápidamente rapid, comunicaciones comun, funcionando funcion, funciona funcion,
    averiguar averigu, diciéndole dic, sigue sig, paguen pag, construyendo constru, arrepentimiento arrepent,
    posibilidad posibil, biología biolog, existencia existent, creativas creativ, a a, y y"""


def test_spanish_stems():
    for pair in STEMS.split(","):
        word, stem = pair.split()
        assert spanish_stem(word) == stem, word


def test_stems_of_rows(spark):
    rows = [(1, ["motores", "rotos", None, "motores"]), (2, None), (3, []), (4, ["x"] * 500 + ["rotos"])]
    docs = spark.createDataFrame(rows, "id int, words array<string>").repartition(3)
    found = {r["id"]: r["stems"] for r in X.stemmed(docs, "id", "words", spanish_stem).collect()}
    assert found == {1: ["motor", "rot", None, "motor"], 2: None, 3: [], 4: ["x"] * 500 + ["rot"]}
    table = X.stem_table(docs, "words", spanish_stem)
    assert sorted(map(tuple, table.collect())) == [("motores", "motor"), ("rotos", "rot"), ("x", "x")]


def test_language_by_join_and_in_the_task(spark, monkeypatch):
    rows = [(1, "la casa es muy grande", "es"), (2, "the house is very big", "en"), (3, "la mesa", "es"), (4, "the table", "en")]
    labelled = spark.createDataFrame(rows, "id int, t string, lang string")
    asked = spark.createDataFrame([(1, "LA CASA"), (1, "the house"), (2, None), (3, "zzzzzz"), (4, "la"), (5, "")], "id int, t string")
    profile = L.language_profile(labelled, "t", "lang", ["es", "en"])
    local = sorted(map(str, L.detect_language(asked, ["id"], "t", profile, ["es", "en"]).collect()))
    monkeypatch.setattr(L, "MAX_PROFILE_ROWS", 3)
    joined = sorted(map(str, L.detect_language(asked, ["id"], "t", profile, ["es", "en"]).collect()))
    assert joined == local and "'en'" in local[0] + local[1]


def test_language(spark):
    train = [
        ("es", "el motor no arranca y la pantalla está apagada desde ayer por la noche"),
        ("en", "the engine does not start and the screen is off since yesterday night"),
        ("fr", "le moteur ne démarre pas et l'écran est éteint depuis hier soir"),
    ]
    languages = ("en", "es", "fr")
    profile = L.language_profile(spark.createDataFrame(train, "lang string, text string"), "text", "lang", languages, 200)
    texts = ["la pantalla no arranca", "the screen does not start", "l'écran ne démarre pas", "abcd", None, "12345 678", "la la"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = {r["id"]: r["language"] for r in L.detect_language(df, ["id"], "text", profile, languages).collect()}
    assert [found[i] for i in range(6)] == ["es", "en", "fr", "Too short", "Too short", "Error"]
    labelled = spark.createDataFrame([(k, v) for k, v in found.items()], "id int, language string")
    assert L.keep_languages(labelled, "language").count() == sum(v == "es" for v in found.values())


def test_trigrams_of_long_texts(monkeypatch):
    monkeypatch.setattr(L, "CHUNK", 10)
    texts = ["", None, "ab", "abc", "x" * 9 + "añb𝄞c" * 7, "0123456789ab"]
    found = [(i, g) for owners, ids in L._trigrams(texts) for i, g in zip(owners.tolist(), L._printed(ids))]
    assert found == [(i, t[j : j + 3]) for i, t in enumerate(texts) if t for j in range(len(t) - 2)]


def test_worklist(spark):
    df = spark.createDataFrame([("a text", "x"), ("a text", None), ("un texto", "x")], "p string, q string")
    work = L.distinct_texts(df, ["p", "q"])
    assert sorted(map(tuple, work.collect()), key=str) == [("p", "a text"), ("p", "un texto"), ("q", "x"), ("q", None)]
    tagged = work.withColumn("language", F.when(F.col("text") == "a text", "en").when(F.col("text") == "un texto", "es").otherwise("Too short"))
    assert [tuple(r) for r in L.translation_budget(tagged).collect()] == [("p", 1, 6)]


def test_batches_and_errors(spark):
    def make():
        def translate(batch):
            if "bad" in batch:
                raise ValueError("no service")
            return [f"<{t}>" for t in batch]

        return translate

    texts = spark.createDataFrame([(t,) for t in ["a", "b", "bad", "c"]], "t string").coalesce(1)
    found = {r["t"]: (r["t_translated"], r["error"]) for r in T.translate_texts(texts, "t", make, 2, partitions=1).collect()}
    lost = [t for t, (done, error) in found.items() if error == "no service" and done is None]
    assert "bad" in lost and len(lost) == 2
    assert all(found[t] == (f"<{t}>", None) for t in found.keys() - set(lost))
    cache = spark.createDataFrame([("a", "<a>"), ("bad", None)], "t string, t_translated string")
    work = texts.unionByName(spark.createDataFrame([("a",), (None,)], "t string"))
    assert sorted(r[0] for r in T.untranslated(work, cache, "t").collect()) == ["b", "bad", "c"]
    assert T.untranslated(work, None, "t").count() == 4


def test_corpus(spark):
    tickets = spark.createDataFrame([(1, "no", None)], "id int, a string, b string")
    pages = spark.createDataFrame([(2, "<b>x</b>")], "id int, html string")
    docs = spark.createDataFrame([(3, "Uno. Dos.")], "id int, t string")
    corpus = K.build_corpus({
        "tickets": K.ticket_texts(tickets, "id", "a", "b"),
        "faq": K.html_texts(pages, "id", "html"),
        "docs": K.sentence_rows(docs, "id", "t"),
    })
    assert sorted(map(tuple, corpus.select("source", "doc_id", "text_to_analyse").collect())) == [
        ("docs", "3", "Dos."), ("docs", "3", "Uno."), ("faq", "2", "x"), ("tickets", "1", "no ")
    ]


def test_tfidf(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(1, "all one aa aa"), (2, "all two aa"), (3, "all x"), (4, ""), (5, "all two")], "id int, t string"
    )
    vocabulary = V.fit_tfidf(docs, V.term_tokens("t"), min_df=0.4, max_df=0.6)
    assert {r["term"]: r["df"] for r in vocabulary.collect()} == {"aa": 2, "two": 2}
    weights = {(r["id"], r["term"]): r["weight"] for r in V.tfidf_weights(docs, "id", "t", vocabulary).collect()}
    assert weights[(1, "aa")] == pytest.approx(1.0) and weights[(2, "aa")] == pytest.approx(2**-0.5)
    assert set(weights) == {(1, "aa"), (2, "aa"), (2, "two"), (5, "two")}
    new = spark.createDataFrame([(9, "two unseen")], "id int, t string")
    assert [tuple(r) for r in V.tfidf_weights(new, "id", "t", vocabulary).collect()] == [(9, "two", pytest.approx(1.0))]
    with monkeypatch.context() as patched:
        patched.setattr(V, "is_small", lambda df: False)
        large = {(r["id"], r["term"]): r["weight"] for r in V.tfidf_weights(docs, "id", "t", vocabulary).collect()}
        assert large == {k: pytest.approx(v) for k, v in weights.items()}
    plan = V.tfidf_weights(docs, "id", "t", vocabulary)._jdf.queryExecution().toString()
    assert "hashpartitioning" not in plan
    totals = {r["term"]: r["weight"] for r in V.term_weights(V.tfidf_weights(docs, "id", "t", vocabulary)).collect()}
    assert totals["aa"] == pytest.approx(1 + 2**-0.5)


def test_encoders(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "a b")], "id int, t string")

    def make():
        return lambda texts: [[len(t), 1.0] for t in texts]

    found = {r["id"]: list(r["vector"]) for r in V.encode(docs, "id", "t", make, 2).collect()}
    assert found == {1: [3.0, 1.0], 2: [0.0, 1.0], 3: [3.0, 1.0]}
    hashed = V.hashed_vectors(docs.where("t IS NOT NULL").select("id", X.split_words("t").alias("w")), "w", ["id"], 16)
    vectors = [r["vector"] for r in hashed.orderBy("id").collect()]
    assert vectors[0] == vectors[1] and sum(x * x for x in vectors[0]) == pytest.approx(1.0)


def test_word2vec(spark):
    docs = spark.createDataFrame([(i, ["motor", "roto", f"w{i}"]) for i in range(6)], "id int, w array<string>")
    model = V.fit_word2vec(docs, "w", size=4, min_count=2, epochs=1, partitions=1)
    assert {r["word"] for r in model.getVectors().collect()} == {"motor", "roto"}
    vectors = V.word2vec_vectors(model, docs, ["id"])
    assert vectors.count() == 6 and len(vectors.first()["vector"]) == 4


def test_stages_agree_with_the_relational_weights(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "all one, aa aa b!"), (2, "ALL two aa"), (3, "all x"), (4, ""), (5, "all two")], "id int, t string"
    )
    cleaner = TokenCleaner(inputCol="t", outputCol="tokens", dropPunctuation=True, stopWords=["one"])
    tfidf = TfidfFeatures(inputCol="tokens", outputCol="v", minDF=0.4, maxDF=0.6)
    model = Pipeline(stages=[cleaner, tfidf]).fit(docs)
    words = model.stages[1].stages[1].vocabulary
    found = {
        (r["id"], words[i]): w
        for r in model.transform(docs).collect()
        for i, w in zip(r["v"].indices.tolist(), r["v"].values)
    }
    vocabulary = V.fit_tfidf(docs, V.term_tokens("t"), 0.4, 0.6)
    wanted = {(r["id"], r["term"]): r["weight"] for r in V.tfidf_weights(docs, "id", "t", vocabulary).collect()}
    assert found == {k: pytest.approx(v) for k, v in wanted.items()}
    cleaner.setParams(lower=False, dropPunctuation=False)
    assert cleaner.transform(docs).first()["tokens"] == ["all", ",", "aa", "aa", "b", "!"]
    cleaner.write().overwrite().save(str(tmp_path / "cleaner"))
    assert TokenCleaner.load(str(tmp_path / "cleaner")).getOrDefault("stopWords") == ["one"]
