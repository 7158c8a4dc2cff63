"""What the pipeline's operators leave to the driver: components of few edges without rounds, training without texts."""

import numpy as np
import pytest

from faultline.llm import components as C
from faultline.llm import toxicity


def brute_force(edges):
    root = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            least = min(root[a], root[b])
            if (root[a], root[b]) != (least, least):
                root[a] = root[b] = least
                changed = True
    return root


def graph():
    rng = np.random.default_rng(4)
    path = [(i, i + 1) for i in range(1000, 1300)]
    star = [(5000, int(i)) for i in rng.permutation(60)]
    return path + star + [tuple(map(int, e)) for e in rng.integers(9000, 9120, (50, 2))] + [(7, 7), (8000, 8001), (8001, 8000)]


@pytest.mark.parametrize("few", [1 << 20, 150, 0])
def test_components_are_those_of_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(C, "FEW_EDGES", few)
    edges = [e for e in graph() if e[0] != e[1]]
    found = C.components(spark.createDataFrame(graph(), "a long, b long").repartition(3)).collect()
    assert len(found) == len({n for e in edges for n in e})
    assert {r["node"]: r["component"] for r in found} == brute_force(edges)


def test_few_edges_take_one_step(spark, monkeypatch):
    made, durable = [], C.durable
    monkeypatch.setattr(C, "durable", lambda df: made.append(df) or durable(df))
    edges = spark.createDataFrame(graph(), "a long, b long")
    C.components(edges).collect()
    assert len(made) == 2  # the edges and their ends
    assert C.components(edges.where("a = b")).collect() == []


def test_the_driver_gets_the_model_only(spark, monkeypatch):
    words = ["clean", "text", "about", "motors", "and", "panels"]
    rows = [(i, " ".join(words[(i * j) % 6] for j in range(1, 9)) + (" nasty slur word" if i % 4 == 0 else f" n{i}")) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(0, 200, 2)], "doc_id long, toxic int")
    frame, collected = type(docs), []
    collect = frame.collect

    def counted(df):
        out = collect(df)
        collected.append((len(out), df.columns))
        return out

    monkeypatch.setattr(frame, "collect", counted)
    monkeypatch.setattr(frame, "toArrow", lambda df: pytest.fail("rows go to the driver"))
    model = toxicity.train(docs, labels)
    assert max(n for n, _ in collected) == 1 and (1, ["model"]) in collected
    assert model.shape == (toxicity.BUCKETS + 1,) and (model[:-1] > 0).any()
    again = toxicity.train(docs.repartition(5), labels)
    assert np.array_equal(model, again)
