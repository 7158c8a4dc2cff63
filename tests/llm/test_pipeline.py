"""Each stage of the pipeline against plain Python, on rows that repeat, tie, or lack values."""

import hashlib
import itertools
import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from faultline.llm import byte_bpe, mixing, pii, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component string, row int"
BASE = " ".join(f"word{i}" for i in range(60))
ROWS = [
    (7, BASE, "en", "a"),
    (7, "another text of the same id", "de", "b"),
    (3, BASE + " end", "en", "a"),
    (None, BASE.upper(), None, "a"),
    (None, "no id here", "en", None),
    (None, "no id here", "en", None),
    (11, "", "en", "a"),
    (12, None, None, None),
    (13, None, None, None),
    (14, "mail joe@host.org or call +49 30 1234567", "de", "b"),
    (14, "mail joe@host.org or call +49 30 1234567", "de", "b"),
    (15, "short", "fr", "c"),
    (16, "long text " * 30_000, "fr", "c"),
]


def table(spark, rows):
    full = [(i, t, lang, s, None if t is None else len(t), "c", 9) for i, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ROWS).repartition(3).cache()


def stage(name):
    return dict(pipeline.STAGES)[name]


def plain(df):
    return sorted([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in df.collect()], key=str)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())


def shingles(text, size):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def test_stages_keep_columns_and_take_empty_tables(spark, docs):
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "near_copies", "personal_data", "mixing", "byte_bpe"]
    for name, run in pipeline.STAGES:
        found = run(spark, docs.where("1 = 0"), "/root/testdata/sf0.01")
        assert found.collect() == []
        assert name == "byte_bpe" or found.columns == docs.columns


def test_toxicity_drops_what_scores_high(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r[0] for r in stage("toxicity")(spark, docs, folder).select("doc_id").collect()}
    scored = toxicity.toxicity(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    assert kept == {r["doc_id"] for r in scored if r["score"] < 0.5} and len(kept) < len(scored)


def test_near_copies_keeps_one_row_of_each_class(spark, docs):
    kept = plain(stage("near_copies")(spark, docs, ""))
    sets = [shingles(t, 5) for _, t, *_ in ROWS]
    root = list(range(len(ROWS)))
    for _ in ROWS:
        for a, b in itertools.combinations(range(len(ROWS)), 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                root[a] = root[b] = min(root[a], root[b])
    classes = {}
    for k, r in enumerate(root):
        classes.setdefault(r, []).append(ROWS[k])
    least = [min(c, key=lambda r: (r[0] is None, r[0] or 0)) for c in classes.values()]
    assert kept == plain(table(spark, least))
    ids = Counter(r[0] for r in kept)
    assert ids[7] == 1 and ids[None] == 1 and ids[14] == 1 and ids[12] == ids[13] == ids[11] == 1


def test_a_repeated_id_loses_no_text(spark):
    rows = [(7, "one text of seven words and more", "en", "a"), (7, "quite another text under that id", "en", "a"), (8, BASE, "en", "a")]
    rows += [(9, BASE, "en", "a"), (9, "a text that only nine has, and no copy", "en", "a")]
    kept = plain(stage("near_copies")(spark, table(spark, rows), ""))
    assert kept == plain(table(spark, [r for r in rows if (r[0], r[1]) != (9, BASE)]))


def test_personal_data_is_masked(spark, docs):
    found = stage("personal_data")(spark, docs, "").collect()
    wanted = [(i, None if t is None else masked(t)) for i, t, *_ in ROWS]
    assert sorted([(r["doc_id"], r["text"]) for r in found], key=str) == sorted(wanted, key=str)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in found)


def masked(text):
    """Every span, as ``find_spans`` gives them, by plain slicing."""
    base, every = pii.find_spans(text)
    out, end = "", 0
    for kind, start, stop in sorted(every, key=lambda s: s[1]):
        if start >= end:
            out, end = out + text[end:start] + f"[{kind.upper()}]", stop
    return out + text[end:]


def test_mixing_repeats_rows_as_drawn(spark, docs):
    found = plain(stage("mixing")(spark, docs, ""))
    drawn = Counter()
    for r in mixing.mix(docs).select("doc.*", "copies").collect():
        drawn[tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars"))] += r["copies"]
    assert found == sorted(drawn.elements(), key=str)


def test_encoding_matches_the_library(spark, docs):
    ranks = byte_bpe.default_ranks()
    from tiktoken.load import load_tiktoken_bpe

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(ranks), special_tokens={})
    found = stage("byte_bpe")(spark, docs, "").collect()
    assert len(found) == len(ROWS)
    wanted = []
    for i, t, *_ in ROWS:
        ids = library.encode_ordinary(t or "")
        wanted.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()))
    assert sorted([(r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in found], key=str) == sorted(wanted, key=str)


def test_run_chains_the_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, run in pipeline.STAGES:
        docs = run(spark, docs, folder)
    wanted = docs.groupBy(*docs.columns).count()
    found = pipeline.run(spark, folder)
    assert found.groupBy(*found.columns).count().exceptAll(wanted).where(F.lit(True)).count() == 0
    assert found.count() == docs.count() > 0
