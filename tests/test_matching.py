"""Fuzzy matching against an independent brute force."""

import random
import re

import pytest

from faultline.operators import matching
from faultline.operators.matching import best_matches, lcs_lengths


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def ratio(a, b):
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 0.0


def token_set_ratio(a, b):
    a, b = (set(re.sub(r"\W+", " ", t.lower()).split()) for t in (a, b))
    if not a or not b:
        return 0.0
    both = " ".join(sorted(a & b))
    if both and (not a - b or not b - a):
        return 100.0
    left = (both + " " + " ".join(sorted(a - b))).strip()
    right = (both + " " + " ".join(sorted(b - a))).strip()
    scores = [ratio(left, right)]
    if both:
        scores += [ratio(both, left), ratio(both, right)]
    return max(scores)


def brute(code, entries):
    scores = [token_set_ratio(code, e) for e in entries]
    best = max(scores)
    return (entries[scores.index(best)], round(best)) if best > 0 else (None, 0)


def test_lcs():
    words = ["motor", "rotor", "tom", "", "mmotorr"]
    assert lcs_lengths("motor", words).tolist() == [lcs("motor", w) for w in words]


def run(spark, codes, entries):
    code_rows = spark.createDataFrame([(c,) for c in codes], "cod_articulo string")
    catalogue = spark.createDataFrame(list(enumerate(entries)), "catalogue_pos int, CODART string")
    return {r["cod_articulo"]: (r["CODART_A3"], r["Fuzzy_Score"]) for r in best_matches(code_rows, catalogue).collect()}


def test_edge_rows(spark):
    entries = ["AZ-1 motor", "motor azul", "motor", "panel 20", "panel 21", "!!"]
    codes = ["AZ-1 MOTOR", "az 1 (motor)", "azul", "motor nuevo", "azul motor", "panl 20", "panel 2", "", "--", None, "zzz"]
    found = run(spark, codes, entries)
    assert None not in found
    assert found[""] == found["--"] == (None, 0)
    for code in codes[:-4]:
        assert found[code] == brute(code, entries), code
    assert found["zzz"] == brute("zzz", entries)


def random_texts(rng, n):
    words = ["motor", "rotor", "panel", "az", "20", "21", "azul", "rojo", "válvula", "x"]

    def text():
        t = " ".join(rng.choices(words, k=rng.randint(1, 4)))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(max(len(t), 1))
            t = t[:at] + rng.choice(["", "a", " ", "-"]) + t[at + 1 :]
        return t

    return [text() for _ in range(n)]


@pytest.mark.parametrize("limit", [50_000, 8])
def test_random_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(matching, "MAX_CATALOGUE_SLICE", limit)
    rng = random.Random(limit)
    entries, codes = sorted(set(random_texts(rng, 60)), key=str), random_texts(rng, 120)
    entries = [e for e in entries if re.search(r"\w", e)]
    found = run(spark, codes, entries)
    for code in codes:
        wanted = brute(code, entries)
        assert found[code] == wanted, (code, found[code], wanted)
