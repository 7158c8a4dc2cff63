"""The manifest against a tree built in plain Python."""

import hashlib
import random
import zlib

import pytest

from faultline.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos long, node string, n int"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(doc):
    return digest("".join(field(doc[f]) for f in ("doc_id", "source", "lang", "n_chars", "text")))


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """The root, and per node its way: place and run on each level."""
    ways, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for way, i in zip(ways, at, strict=True):
            way.append((i % 8, level[i // 8 * 8 : i // 8 * 8 + 8]))
        level = [digest("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
        at = [i // 8 for i in at]
    return level[0], ways


def expected(docs):
    trees = {}
    for doc in docs:
        trees.setdefault(doc["lang"], []).append(doc)
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    below = {}
    for name in names:
        trees[name].sort(key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, leaf(d)))
        below[name] = climb([leaf(d) for d in trees[name]])
    root, above = climb([below[name][0] for name in names])
    out = []
    for name, over in zip(names, above, strict=True):
        for doc, way in zip(trees[name], below[name][1], strict=True):
            way, i = way + over, doc["doc_id"]
            changed = i is not None and zlib.crc32(str(i).encode()) % 3 == 0
            node = leaf(doc | {"text": lowered(doc["text"])}) if changed else leaf(doc)
            for place, run in way:
                node = digest("".join(run[:place] + [node] + run[place + 1 :]))
            proof = digest("".join("".join(run[:place] + run[place + 1 :]) for place, run in way))
            out.append((i, leaf(doc), below[name][0], root, proof, node, node == root))
    return out


def table(spark, docs):
    rows = [(d["doc_id"], d["text"], d["lang"], d["source"], d["n_chars"], "t", 5, "x", 6) for d in docs]
    return spark.createDataFrame(rows, SCHEMA)


def doc(i, lang="en", text="One Text", source="s"):
    return {"doc_id": i, "text": text, "lang": lang, "source": source, "n_chars": None if text is None else len(text)}


def held(spark, docs):
    found = [tuple(r) for r in merkle.manifest(table(spark, docs).repartition(5)).collect()]
    assert sorted(found, key=str) == sorted(expected(docs), key=str)
    return found


def test_one_tree(spark):
    for n in (1, 9, 70):
        held(spark, [doc(i, text=f"Text {i}") for i in range(n)])


def test_edges(spark):
    random.seed(1)
    docs = [doc(i, random.choice([None, "en", "de", "", "ß", "zz"]), random.choice([None, "", "abc", "Ünd A"])) for i in range(150)]
    docs += [doc(None), doc(None, None, "B"), doc(7, "en", "other"), doc(3, "fr", "A" * 300_000)]
    docs += [doc(40, "de", "Same") for _ in range(60)] + [doc(6, "de", "same", None)]
    found = held(spark, docs)
    assert {r[-1] for r in found} == {True, False}
    assert merkle.manifest(table(spark, docs).where("1 = 0")).collect() == []


@pytest.mark.parametrize("depth", [1, 2])
def test_small_superblocks(spark, monkeypatch, depth):
    """Nodes are exchanged several times, for rows and for languages."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "BLOCK", 8**depth)
    docs = [doc(i, "en", f"T {i}") for i in range(600)] + [doc(1000 + i, f"l{i % 70}", f"U {i}") for i in range(150)]
    held(spark, docs)
