"""The threshold join against brute force over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.operators import fuzzy_join
from tests.test_matching import brute, lcs, random_texts, token_set_ratio


def run(spark, codes, entries, threshold=85):
    code_rows = spark.createDataFrame([(c,) for c in codes], "cod_articulo string")
    catalogue = spark.createDataFrame(list(enumerate(entries)), "catalogue_pos int, CODART string")
    found = fuzzy_join.matches_from(code_rows.repartition(3), catalogue.repartition(3), threshold).collect()
    assert len(found) == len({r["cod_articulo"] for r in found})
    return {r["cod_articulo"]: (r["CODART_A3"], r["Fuzzy_Score"]) for r in found}


def wanted(codes, entries, threshold):
    pairs = {c: brute(c, entries) for c in codes if c is not None}
    return {c: b for c, b in pairs.items() if b[1] >= threshold}


def test_pairs_of_texts():
    rng = random.Random(1)
    texts = random_texts(rng, 80)
    left, right = ["".join(sorted(t)) for t in texts[:40]], ["".join(sorted(t)) for t in texts[40:]]
    assert fuzzy_join.pair_lcs(left, right).tolist() == [lcs(a, b) for a, b in zip(left, right)]
    assert fuzzy_join.pair_lcs(["", "a"], ["b", ""]).tolist() == [0, 0]


def test_probes_reach_every_text_that_shares_enough(spark):
    rng = random.Random(3)
    tokens = ["a", "bb", "ccc", "dddd", "eeeee", "ffffffffff", "g", "hh"]
    rows = [(rng.sample(tokens, rng.randint(1, 6)),) for _ in range(150)]
    found = fuzzy_join.with_keys(spark.createDataFrame(rows, "tokens array<string>"), 85)
    for r in found.collect():
        own = r["tokens"]
        length = len(" ".join(own))
        for bits in range(1, 1 << len(own)):
            both = [t for i, t in enumerate(own) if bits >> i & 1]
            inner = len(" ".join(both))
            if 200 * inner / (inner + length) >= 84.5:
                pairs = {" ".join(sorted((t, u))) for t in both for u in both if t != u}
                assert set(r["probes"]) & (pairs | set(both)) and (pairs | set(both)) <= set(r["every"])


@pytest.mark.parametrize("threshold", [85, 70])
def test_random_against_brute_force(spark, monkeypatch, threshold):
    monkeypatch.setattr(fuzzy_join, "BLOCK", 37)
    monkeypatch.setattr(fuzzy_join, "CHUNK", 11)
    monkeypatch.setattr(fuzzy_join, "PAIRS", 29)
    rng = random.Random(threshold)
    entries = sorted(set(random_texts(rng, 150)))
    codes = random_texts(rng, 250)
    assert run(spark, codes, entries, threshold) == wanted(codes, entries, threshold)


def test_long_texts_and_shuffled_tokens(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(25)]
    entries = [" ".join(rng.sample(words, rng.randint(3, 9))) for _ in range(120)]

    def typed(text):
        text = list(text)
        for _ in range(rng.randint(0, 9)):
            text[rng.randrange(len(text))] = rng.choice("abcdefgh  ")
        parts = "".join(text).split()
        rng.shuffle(parts)
        return " ".join(parts)

    codes = [typed(rng.choice(entries)) for _ in range(250)]
    found = run(spark, codes, entries)
    assert found == wanted(codes, entries, 85)
    assert {s for _, s in found.values()} >= {85, 90, 100}


def test_edge_rows(spark):
    entries = ["AZ-1 motor", "motor azul", "motor", "panel 20", "panel 21", "!!", None, "motor"]
    codes = ["AZ-1 MOTOR", "az 1 (motor)", "azul", "motor nuevo", "azul motor", "panl 20", "panel 2", "", "--", None, "zzz"]
    plain = [e for e in entries if e and e != "!!"]
    assert run(spark, codes, entries) == wanted([c for c in codes if c], plain, 85)
    assert run(spark, codes, []) == run(spark, [], entries) == {}


def test_a_hot_token_meets_few_texts(spark):
    """Most texts hold the same token; candidates come from the rare ones."""
    codes = [f"motor rotor{i:04d} x{i % 7}" for i in range(2000)]
    entries = [f"motor rotor{i:04d}" for i in range(0, 4000, 2)]
    rows = spark.createDataFrame([(c,) for c in codes], "text string")
    catalogue = spark.createDataFrame([(e, i, e) for i, e in enumerate(entries)], "text string, pos long, entry string")
    frequency = catalogue.select(F.explode(F.split("text", " ")).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    own, other = (fuzzy_join._by_rarity(d, frequency) for d in (rows, catalogue))
    keyed = [fuzzy_join.with_keys(d, 85) for d in (own, other)]
    keys, every = ([d.select(F.explode(c).alias("key")) for d in keyed] for c in ("probes", "every"))
    met = keys[0].join(every[1], "key").count() + every[0].join(keys[1], "key").count()
    assert met < 4 * len(codes)
    assert run(spark, codes[:50], entries[:50]) == wanted(codes[:50], entries[:50], 85)


def test_no_text_reaches_the_driver(spark):
    codes = spark.createDataFrame([("motor",)], "cod_articulo string")
    catalogue = spark.createDataFrame([(0, "motor")], "catalogue_pos int, CODART string")
    plan = fuzzy_join.matches_from(codes, catalogue)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan


def test_rounding_at_the_threshold():
    assert np.isclose(token_set_ratio("abcdefghijklm", "abcdefghijkxyz"), 200 * 11 / 27)
