"""Phrases against a plain count of all n-grams."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from codestrata.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, w1 int, a string, score int"


def brute(rows, least, keep, cover):
    out = []
    name = lambda lang: "und" if lang is None else lang
    for lang in {name(lang) for _, _, lang in rows}:
        grams, n = Counter(), 0
        for _, text, own in rows:
            if name(own) != lang or text is None:
                continue
            lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            for piece in re.split(r"[.,;:!?\n-\r]", lower):
                words = [w for w in re.split(r"[ \t]", piece) if w]
                n += len(words)
                grams.update(tuple(words[i : i + k]) for k in (1, 2, 3, 4) for i in range(len(words) - k + 1))
        found = {}
        for p, a in grams.items():
            if len(p) > 1 and a >= least:
                cuts = [(2_000_000 * a // (grams[p[:k]] + grams[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found[p] = (a, grams[p[:k]], grams[p[k:]], score)
        covered = {p[i : i + m] for p, v in found.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * v[0] >= cover * found[p[i : i + m]][0]}
        order = sorted((p for p in found if p not in covered), key=lambda p: (-found[p][3], -found[p][0], " ".join(p).encode()))
        out += [(lang, i + 1, " ".join(p), *found[p][:3], n, found[p][3]) for i, p in enumerate(order[:keep])]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", 9) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    words = ["a", "B", "b", "é", "É", "x\x00y", "\u00a0", "\x1c", "long" * 30, "é\u2028"] + [f"w{i}" for i in range(30)]
    texts = []
    for i in range(300):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"]) for _ in range(rnd.randrange(60)))
        texts.append((i % 250, text, rnd.choice(["en", "en", "de", None, "und", ""])))
    texts += [(1, "New York City is big. " * 40, "en")] * 3 + [(2, None, "en"), (3, "", "fr"), (None, "x y x y x y", None), (9, ". , \n", "xx")]
    return texts + [(10, "p q r s t u " * 2_000, "de")]  # one very long piece


@pytest.mark.parametrize("listed", [C.LISTED, 15, 0])
def test_against_all_ngrams(spark, rows, listed, monkeypatch):
    monkeypatch.setattr(C, "FREQUENT", 500)  # some words are very frequent
    monkeypatch.setattr(C, "BUCKET", 1_000)
    monkeypatch.setattr(C, "SORTED", 700)
    got = C.collocations(table(spark, rows), least=4, keep=60, cover=80, listed=listed)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 4, 60, 80)


def test_production_limits(spark, rows):
    got = sorted(map(tuple, C.collocations(table(spark, rows)).collect()))
    assert got and got == brute(rows, 30, 2_000, 80)


def test_no_rows_and_no_phrases(spark):
    assert C.collocations(table(spark, [])).count() == 0
    assert C.collocations(table(spark, [(1, None, None), (2, "a b c", "en")])).count() == 0


def test_hashes_equal_those_of_the_engine(spark):
    words = spark.createDataFrame([("en", b"a"), ("", "é".encode()), ("de", b"x" * 50)], "lang string, word binary")
    for r in words.withColumn("id", C.hashed_column(3)).collect():
        assert r.id == C.hashed_id(3, r.lang.encode(), bytes(r.word)) >= C.HASHED


def test_longest_windows_only(spark):
    ids = C.Ids(spark.createDataFrame([("en", bytes([w]), 9) for w in b"abcd"], "lang string, word binary, n long"), 1, 10, C.Scratch(spark, "t"))
    name = {r.id: r.word for r in ids.table.collect()}
    rows = spark.createDataFrame([("en", "a b c d a. z b"), ("en", "b c d a")], "lang string, text string")
    show = lambda least: sorted(("".join(name.get(w, "-") for w in r[:4]), r.a) for r in C.longest_windows(rows, ids, least).collect())
    assert show(1) == [("a---", 2), ("abcd", 1), ("b---", 1), ("bcda", 2), ("cda-", 2), ("da--", 2)]
    assert show(2) == [("a---", 3), ("b---", 1), ("bcda", 2), ("cda-", 2), ("da--", 2)]  # one "ab": cut back


def test_windows_survive_packing():
    rng = np.random.default_rng(2)
    for top in (50, 1 << 62):
        windows = rng.integers(0, top, (4, 1000))
        windows = windows[:, C.in_order(windows)]
        assert windows.T.tolist() == sorted(windows.T.tolist())
        counts = rng.integers(1, 9, 1000)
        a, b = C.unpacked(C.packed(windows, counts), 1000)
        assert (a == windows).all() and (b == counts).all()


def test_prefixes_keep_their_counts():
    """Whatever is cut, every prefix that reaches the limit keeps its count over all buckets, with and without very frequent words."""
    rng = np.random.default_rng(4)
    codes = np.concatenate([np.minimum(rng.zipf(1.4, 20_000) - 1, 40), np.zeros(3, np.int64)])
    windows = C.lead(codes)
    want = Counter(tuple(w[:k]) for w in windows.T.tolist() for k in (1, 2, 3, 4) if w[k - 1])
    for frequent in (0, 3, 100):
        bucket, got = C.bucket_of(windows, frequent, 7), Counter()
        for b in range(7):
            own = windows[:, bucket == b]
            own = own[:, C.in_order(own)]
            for w, a in zip(*(x.T.tolist() for x in C.cut_back(*C.summed(own, np.ones(own.shape[1], np.int64)), frequent, 30))):
                for k in (1, 2, 3, 4):
                    if w[k - 1]:
                        got[tuple(w[:k])] += a
        assert {p: a for p, a in got.items() if a >= 30} == {p: a for p, a in want.items() if a >= 30}
        assert sum(got[p] for p in got if len(p) == 4) < sum(want[p] for p in want if len(p) == 4)
