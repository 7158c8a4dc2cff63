"""Links within one cell, where texts are alike but not alike enough."""

import time

import numpy as np

from faultline.llm import ngram_join

PERCENT = 85


def brute_force(sets):
    root = list(range(len(sets)))
    for i, one in enumerate(sets):
        for j in range(i):
            common = len(np.intersect1d(one, sets[j]))
            if 100 * common >= PERCENT * (len(one) + len(sets[j]) - common):
                least, most = sorted((root[i], root[j]))
                root = [least if r == most else r for r in root]
    return root


def variants(rng, base, n, share):
    kept = [base[rng.random(len(base)) < share] for _ in range(n)]
    return [np.unique(np.append(k, rng.integers(1, 1 << 62, 6).astype(np.uint64))) for k in kept]


def test_links_equal_brute_force():
    rng = np.random.default_rng(0)
    for share in (0.9, 0.95, 0.99):
        base = rng.integers(0, 1 << 62, 90).astype(np.uint64)
        sets = variants(rng, base, 25, share) + variants(rng, base[:30], 10, share) + [np.array([7], np.uint64)] * 2
        assert ngram_join.link(sets, PERCENT) == brute_force(sets)


def test_many_texts_that_share_most_grams():
    """No two of them link, so every one is searched among all before it."""
    rng = np.random.default_rng(1)
    sets = variants(rng, rng.integers(0, 1 << 62, 400).astype(np.uint64), 700, 0.88)
    began = time.process_time()
    assert ngram_join.link(sets, PERCENT) == list(range(700))
    assert time.process_time() - began < 10
