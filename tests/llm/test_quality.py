"""The additive model: figures and trees against plain loops, quality on held-out rows, rows at the edge."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from faultline.llm import quality
from faultline.llm.text_stats import FEATURES, text_stats

SCHEMA = "doc_id long, text string, lang string, source string, good int, stats binary, id long, quality int, score double"


def plain_stats(text):
    text = text or ""
    data = text.encode()
    words = [w for w in "".join(" " if c in " \t\n\x0b\f\r" else c for c in text).split(" ") if w]
    low = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    sizes = [len(w.encode()) for w in words]
    lines = [x for x in text.split("\n") if x.strip("\x00")]
    n, b, m = max(len(words), 1), max(len(data), 1), max(len(lines), 1)
    upper, lower = sum(65 <= c <= 90 for c in data), sum(97 <= c <= 122 for c in data)
    symbols = [c for c in data if c < 128 and not chr(c).isalnum() and c not in b" \t\n\x0b\f\r.,;:'\"()-"]
    return {
        "log_words": np.log1p(len(words)),
        "mean_word": sum(sizes) / n,
        "short_words": sum(s <= 3 for s in sizes) / n,
        "long_words": sum(s > 12 for s in sizes) / n,
        "distinct_words": len(set(low)) / n,
        "commonest_word": max(Counter(low).values(), default=0) / n,
        "same_as_before": sum(x == y for x, y in zip(low, low[1:])) / n,
        "upper": upper / max(upper + lower, 1),
        "digit": sum(48 <= c <= 57 for c in data) / b,
        "prose": sum(c in b".,;:'\"()-" for c in data) / b,
        "symbol": len(symbols) / b,
        "signs_a_word": len(symbols) / n,
        "high": sum(c >= 128 for c in data) / b,
        "commonest_symbol": max(Counter(symbols).values(), default=0) / n,
        "stops": data.count(b".") / n,
        "commas": data.count(b",") / n,
        "words_a_line": np.log1p(len(words) / m),
        "distinct_lines": len(set(lines)) / m,
        "commonest_line": max(Counter(lines).values(), default=0) / m,
        "word_spread": np.std(sizes) if sizes else 0,
    }


def test_figures_match_plain_loops():
    random.seed(4)
    signs = "aAbZé0 \n\t.,!|$%ß"
    texts = [None, "", "\n\n", " ", "one", "A\nA\nB\n", "x " * 5000]
    texts += ["".join(random.choice(signs) for _ in range(random.randrange(60))) for _ in range(300)]
    found = text_stats(pa.array(texts))
    for text, row in zip(texts, found, strict=True):
        wanted = plain_stats(text)
        assert row.tolist() == pytest.approx([wanted[f] for f in FEATURES], abs=1e-7), text
    alone = np.concatenate([text_stats(pa.array([t], pa.string())) for t in texts])
    assert np.array_equal(alone, found)


def gain(g, h):
    return g.sum() ** 2 / (h.sum() + quality.RIDGE)


def test_cuts_match_all_cuts():
    rng = np.random.default_rng(0)
    for _ in range(50):
        g, h = rng.standard_normal(9), rng.uniform(0.5, 2, 9)
        best, at = quality.best_cut(g, h)
        ways = {
            i: gain(g[:i], h[:i]) + gain(g[i:], h[i:]) - gain(g, h)
            for i in range(1, 9)
            if min(h[:i].sum(), h[i:].sum()) >= quality.MIN_CURVATURE
        }
        assert at == max(ways, key=ways.get) and best == pytest.approx(ways[at])
        step = quality.tree(g, h)
        assert len(set(np.round(step, 12))) <= quality.LEAVES


def test_pair_trees_match_all_trees():
    rng = np.random.default_rng(1)
    for _ in range(10):
        g, h = rng.standard_normal((4, 5)), rng.uniform(1, 2, (4, 5))
        found, step = quality.pair_tree(g, h)
        ways = []
        for a, b in ((g, h), (g.T, h.T)):
            for i in range(1, len(a)):
                for upper in range(a.shape[1]):
                    for lower in range(a.shape[1]):
                        total = 0.0
                        for rows, cut in ((slice(0, i), upper), (slice(i, None), lower)):
                            halves = [slice(0, cut), slice(cut, None)] if cut else [slice(None)]
                            total += sum(gain(a[rows, c], b[rows, c]) for c in halves)
                        ways.append(total - gain(g, h))
        assert found == pytest.approx(max(ways))
        # The steps are those of a tree with that gain.
        leaves = {v: (g[step == v], h[step == v]) for v in np.unique(step)}
        assert sum(gain(*leaf) for leaf in leaves.values()) - gain(g, h) == pytest.approx(found)


def test_an_interaction_needs_a_pair(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.uniform(-1, 1, (4000, 4))
    good = (x[:, 1] * x[:, 3] > 0).astype(float)
    model = quality.fit(x, good)
    assert model.pairs[0] == (1, 3)
    accuracy = ((model.margin(x) > 0) == (good == 1)).mean()
    monkeypatch.setattr(quality, "PAIRS", 0)
    alone = ((quality.fit(x, good).margin(x) > 0) == (good == 1)).mean()
    assert accuracy > 0.95 > 0.7 > alone


def test_margin_is_a_sum_of_table_entries():
    rng = np.random.default_rng(6)
    x = np.round(rng.standard_normal((500, 3)), 1)
    model = quality.fit(x, (x.sum(axis=1) > 0).astype(float))
    for row, margin in zip(x[:40], model.margin(x[:40]), strict=True):
        total = model.intercept
        for value, cuts, entries in zip(row, model.cuts, model.tables, strict=True):
            total += entries[sum(c <= value for c in cuts)]
        for (i, j), entries in zip(model.pairs, model.pair_tables, strict=True):
            at = [sum(c <= row[k] for c in model.pair_cuts[k]) for k in (i, j)]
            total += entries[at[0], at[1]]
        assert margin == pytest.approx(total)


def test_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").select("quality", "predicted", "score")
    rows = scored.toPandas()
    assert len(rows) > 500
    good, bad = rows[rows["quality"] == 1], rows[rows["quality"] == 0]
    assert good["predicted"].mean() > 0.99 and bad["predicted"].mean() < 0.05
    wins = (good["score"].to_numpy()[:, None] > bad["score"].to_numpy()[None]).mean()
    assert wins > 0.995


def test_edges(spark):
    texts = [None, "", "Some words of prose, here.", "BAD!! BAD!! BAD!!", "Some words of prose, here.", "w " * 200_000]
    rows = [(i, t, None, "s", 9, b"y", 1, 2, 3.0) for i, t in enumerate(texts)]
    rows += [(100 + i, "BAD!! NEWS!! " * (i + 1) if i % 3 == 0 else "good words, " * (i + 1), "l", "s", 9, b"y", 1, 2, 3.0) for i in range(200)]
    rows += [(None, "BAD!!", None, None, None, None, None, None, None)] + rows[5:6] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    known = [(100 + i, 0 if i % 3 == 0 else 1) for i in range(200)] + [(101, 0), (102, None), (None, 1), (99_999, 1)]
    labels = spark.createDataFrame(known, "doc_id long, quality int")
    found = quality.quality(docs, labels).collect()
    assert len(found) == len(rows)
    for r in found:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
        assert r["held_out"] is (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    by_id = {r["doc_id"]: r["score"] for r in found}
    assert by_id[0] == by_id[1] and by_id[2] == by_id[4] and by_id[103] < 0.3 < 0.7 < by_id[104]
    assert quality.quality(docs.where("1 = 0"), labels).collect() == []
    assert {r["score"] for r in quality.quality(docs, labels.where("1 = 0")).collect()} == {0.5}
    one_kind = {r["score"] for r in quality.quality(docs, labels.where("quality = 1")).collect()}
    assert len(one_kind) == 1 and one_kind.pop() > 0.9
    # Labels of held-out ids change nothing.
    turned = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality.quality(docs, turned).collect()}
    assert again == by_id
