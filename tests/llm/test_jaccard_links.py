"""Links of the Jaccard join, counted inside families of near copies too, against all pairs."""

import numpy as np
from llm_tables import documents
from test_text_operators import REPEATED, ROWS, components

from codestrata.llm import jaccard_join, queries


def link_numbers(rows):
    sets = []
    for _, text, _ in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))} if w else set())
    near = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    return [sum(bool(near(a, b)) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)]


def expected(rows):
    ids = sorted((r[0], n) for r, n in zip(rows, link_numbers(rows)))
    return [(*c, n) for c, (_, n) in zip(components(rows), ids)]


def test_links_of_every_document(spark, monkeypatch):
    want = expected(REPEATED)
    assert max(w[3] for w in want) > 10  # a family, in which one link a node would give fewer
    assert sorted(map(tuple, jaccard_join.linked(documents(spark, REPEATED)).collect())) == want
    monkeypatch.setattr(jaccard_join, "LEAF", 4)  # several leaves a family, compared in several steps
    assert sorted(map(tuple, jaccard_join.linked(documents(spark, ROWS)).collect())) == expected(ROWS)


def test_shared(monkeypatch):
    rng = np.random.default_rng(2)
    a, b = ([np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(n)] for n in (5, 9))
    for columns in (4096, 7):
        monkeypatch.setattr(jaccard_join, "COLUMNS", columns)
        assert jaccard_join.shared(a, b).tolist() == [[len(set(x.tolist()) & set(y.tolist())) for y in b] for x in a]


def test_query_gives_links(spark, tmp_path):
    documents(spark, ROWS).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op8_jaccard_join"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert sorted(map(tuple, got.collect())) == expected(ROWS)
