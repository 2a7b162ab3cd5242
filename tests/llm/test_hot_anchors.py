"""Short lines in many texts: their anchors are found and split, and nothing else changes."""

import random

import numpy as np
import pyarrow as pa
import pytest
from llm_tables import documents
from test_text_operators import PASSAGE, REPEATED, prose

from codestrata.llm import relative_lz, spans, suffix_levels

LINE = prose(24)


def with_line(n):
    rnd = random.Random(3)
    words = [f"v{i}" for i in range(5000)]
    some = lambda k: " ".join(rnd.choices(words, k=k))
    return [(1000 + i, some(rnd.randrange(20, 60)) + " " + LINE + " " + some(rnd.randrange(20, 60)), "hot") for i in range(n)]


def found(operator, spark, rows):
    return sorted((tuple(r)[:4] for r in operator(documents(spark, rows)).collect()), key=str)


@pytest.mark.parametrize("operator", [relative_lz.without_repeats, suffix_levels.without_shared])
def test_splitting_changes_nothing(spark, operator, monkeypatch):
    rows = REPEATED + with_line(60) + [(None, LINE + " " + PASSAGE, None), (None, None, None)]
    monkeypatch.setattr(spans, "HOT", 2.0)
    plain = found(operator, spark, rows)
    monkeypatch.setattr(spans, "HOT", 0.0)
    monkeypatch.setattr(spans, "HOT_LEAST", 1)  # every anchor of two pieces is hot
    assert found(operator, spark, rows) == plain
    monkeypatch.setattr(spans, "CHUNK", 3_000)  # and its windows meet across chunks
    assert found(operator, spark, rows) == plain
    assert operator(documents(spark, rows).where("false")).count() == 0


@pytest.mark.parametrize("words,length,gram", [(True, 20, 4), (False, 200, 24)])
def test_no_group_holds_the_pieces_of_a_line(spark, words, length, gram):
    rows = with_line(2_000)
    docs = documents(spark, rows)
    hot = spans.hot_anchors(docs, "text", words, length, gram)
    p = spans.cut([(i, 0, 0, t.encode()) for i, t, _ in rows], words, length, gram)
    size = (p.end - p.begin).astype(float)
    anchors, at = np.unique(p.anchor, return_inverse=True)
    share = np.bincount(at, size) / size.sum()
    assert share.max() > 0.02  # the line's own anchors
    assert share[~np.isin(anchors, hot)].max() < 0.01
    # and its windows are spread: by far most of them stand in one text only
    groups = spans.exchange(docs, "text", words, length, gram, True, 16).toArrow()
    loose = groups.filter(pa.compute.greater_equal(groups["bucket"], 16))
    sizes = loose.group_by("bucket").aggregate([("n", "sum")])["n_sum"].to_pylist()
    assert len(sizes) == 16 and max(sizes) < 3 * min(sizes)


@pytest.mark.parametrize("crowd", [0, 2, 48])
def test_suffix_scans_and_lookups_agree(spark, crowd, monkeypatch):
    """Common prefixes and ends of sorted suffixes mark what looking up every window does."""
    rows = REPEATED + with_line(40) + [(3000 + i, "ab" * (100 + i) + "cd" * (150 - i), "a") for i in range(20)]
    monkeypatch.setattr(suffix_levels, "CROWD", 0)
    plain = found(suffix_levels.without_shared, spark, rows)
    monkeypatch.setattr(suffix_levels, "CROWD", crowd)
    assert found(suffix_levels.without_shared, spark, rows) == plain
    for batches in (1, 7):
        again = suffix_levels.without_shared(documents(spark, rows), batches=batches).collect()
        assert sorted((tuple(r)[:4] for r in again), key=str) == plain


def test_common_beginnings_and_ends():
    rnd = random.Random(1)
    for _ in range(2000):
        a, b = (bytes(rnd.choices(b"ab", weights=(9, 1), k=rnd.randrange(12))) for _ in range(2))
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert suffix_levels.agreeing(a, b) == n
        assert suffix_levels.agreeing_end(a[::-1], b[::-1]) == n
