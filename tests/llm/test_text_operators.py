"""Operators against brute force, on a small table with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from llm_tables import documents

from codestrata.llm import decontamination, jaccard_join, relative_lz, spans, suffix_levels, token_counts, token_ids
from codestrata.llm.common import Scratch

R = random.Random(5)
VOCABULARY = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(4000)]


def prose(n):
    return " ".join(R.choices(VOCABULARY, k=n))


PASSAGE = prose(70)
BASE = prose(120)


def edited(text, n):
    words = text.split(" ")
    for _ in range(n):
        words[R.randrange(len(words))] = f"edit{R.random()}"
    return " ".join(words)


ROWS = [
    (1, BASE, "a"), (2, edited(BASE, 1), "a"), (3, edited(BASE, 2), "b"), (4, BASE, "b"), (5, None, "a"), (6, "", None),
    (7, prose(50) + "\n" + PASSAGE + "\t" + prose(30), "c"), (8, PASSAGE + " " + prose(40), None), (9, "a a a " * 60, "c"), (10, "one Two three", "a"),
    (11, "one  two three", "a"), (12, prose(3000) + " " + PASSAGE, "hot"), (13, "ß" * 250 + " " + "ß" * 250, "hot"), (14, " \n ", "a"),
] + [(20 + i, edited(BASE, i % 9), "hot") for i in range(30)]
REPEATED = ROWS + [(1, BASE, "a")]


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_substring_dedup(spark):
    got = by_id(relative_lz.without_repeats(documents(spark, ROWS)))
    seen = set()
    for i, text, _ in ROWS:
        words = (text or "").encode().split()
        keep = [True] * len(words)
        for a in range(len(words) - 19):
            window = tuple(words[a : a + 20])
            if window in seen:
                keep[a : a + 20] = [False] * 20
            seen.add(window)
        kept = b" ".join(w for w, k in zip(words, keep) if k)
        r = got[i]
        assert (r.n_words, r.n_removed, r.kept_sha256, r.kept) == (len(words), keep.count(False), hashlib.sha256(kept).hexdigest(), kept.decode())
        assert sum(b - a for a, b in r.removed) == r.n_removed
    assert len(got) == len(ROWS)


def test_suffix_array_dedup(spark):
    got = by_id(suffix_levels.without_shared(documents(spark, ROWS)))
    count = Counter()
    for _, text, _ in ROWS:
        b = (text or "").encode()
        count.update(b[a : a + 200] for a in range(len(b) - 199))
    for i, text, _ in ROWS:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for a in range(len(b) - 199):
            if count[b[a : a + 200]] > 1:
                gone[a : a + 200] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        assert tuple(got[i])[1:4] == (len(b), int(gone.sum()), runs) and bytes(got[i].kept) == kept


@pytest.mark.parametrize("operator", [relative_lz.without_repeats, suffix_levels.without_shared])
def test_repeated_rows_are_one_document(spark, operator):
    once, twice = (sorted(tuple(r)[:4] for r in operator(documents(spark, rows)).collect()) for rows in (ROWS, REPEATED))
    assert set(once) == set(twice) and len(twice) == len(once) + 1


def test_long_texts_are_cut_without_loss(spark, monkeypatch):
    whole = sorted(tuple(r)[:4] for r in suffix_levels.without_shared(documents(spark, ROWS)).collect())
    pieces = {(i, k, a) for i, k, a, _ in spans.segments([(1, 0, b"x" * 5_000_000)], False, 200)}
    assert len(pieces) == 3
    monkeypatch.setattr(spans, "CHUNK", 700)
    texts = [(i, 0, (t or "").encode()) for i, t, _ in ROWS]
    covered = Counter()
    for chunk in spans.chunks(texts, False, 200):
        p = spans.cut(chunk, False, 200, 24)
        if p is not None:
            for i, s, n in zip(p.ids.tolist(), p.start.tolist(), p.count.tolist()):
                covered.update((i, s + k) for k in range(n))
    assert covered == Counter({(i, a): 1 for i, _, t in texts for a in range(len(t) - 199)}) and whole


def components(rows):
    sets = []
    for _, text, _ in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[a : a + 5]) for a in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    members = {}
    for i, r in enumerate(rows):
        members.setdefault(find(i), []).append(r[0])
    return sorted((r[0], len(s), min(members[find(i)])) for i, (r, s) in enumerate(zip(rows, sets)))


def test_jaccard_join(spark, monkeypatch):
    assert sorted(map(tuple, jaccard_join.groups(documents(spark, REPEATED)).collect())) == components(REPEATED)
    monkeypatch.setattr(jaccard_join, "REGION", 3)  # every larger region is dealt out, into leaves of a few nodes
    monkeypatch.setattr(jaccard_join, "LEAF", 2)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 0)  # nothing is joined before the search
    assert sorted(map(tuple, jaccard_join.groups(documents(spark, ROWS)).collect())) == components(ROWS)


def test_decontamination(spark, monkeypatch):
    short = [(100, "Two three"), (101, " ".join(BASE.split()[10:17])), (102, None), (103, ""), (None, BASE)]
    items = [(1, PASSAGE), (2, " ".join(BASE.split()[30:60])), (2, " ".join(BASE.split()[30:60])), (3, prose(20))]
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    lower = str.maketrans(decontamination.UPPER, decontamination.LOWER)
    for benchmark in (items, items + short, []):
        windows = {}
        for i, text in benchmark:
            w = word.findall((text or "").translate(lower))
            n = min(10, len(w))
            for a in range(len(w) - n + 1 if n and i is not None else 0):
                windows.setdefault(tuple(w[a : a + n]), set()).add(str(i))
        for limit in (decontamination.BROADCAST_ROWS, 0):
            monkeypatch.setattr(decontamination, "BROADCAST_ROWS", limit)
            got = by_id(decontamination.contamination(documents(spark, ROWS), spark.createDataFrame(benchmark, "item_id long, text string")))
            for i, text, _ in ROWS:
                w = word.findall((text or "").translate(lower))
                hit, found = [False] * len(w), set()
                for n in {len(k) for k in windows}:
                    for a in range(len(w) - n + 1):
                        if tuple(w[a : a + n]) in windows:
                            hit[a : a + n] = [True] * n
                            found |= windows[tuple(w[a : a + n])]
                sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
                r = got[i]
                assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(w), sum(hit), len(found), sha, any(hit))


def test_decontamination_runs_no_python(spark):
    df = decontamination.contamination(documents(spark, ROWS), spark.createDataFrame([(1, PASSAGE)], "item_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and "CartesianProduct" not in plan


ODD = ["", "It's <|endoftext|> x<|startoftext|>y", "\x1c!\x1c ñandú Σίσυφος ΣΑΣ İI", "é café", "日本語 テスト １２ ①", "a b c\u0085d  e", "\x00\x01 \x7f",
       "don't DON'T ''s 'S", "× ÷ ª º µ", "x▁y ▁▁ z  \n\n \t w ", "   lead", "trail   ", "\n", "😀😀 👨‍👩 ok", "ﬁ Ⅷ", "<s> </s> <unk> <0x0A>"]


def test_token_counts(spark):
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = ROWS + [(1000 + i, t, "a") for i, t in enumerate(ODD)]
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    for cache in (50, 600_000):
        token_counts._COUNTERS.clear()
        got = by_id(token_counts.count_tokens(documents(spark, rows), model, cache=cache))
        assert {i: tuple(r)[1:] for i, r in got.items()} == {i: (len((t or "").encode()), len(library.encode(t or ""))) for i, t, _ in rows}


def test_token_ids_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = ROWS + [(1000 + i, t, "a") for i, t in enumerate(ODD)]
    folder = token_ids.write_ids(documents(spark, rows), path, f"{tmp_path}/ids", block_bytes=2_000)
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t, _ in rows}
    assert {r.doc_id: r.ids for r in token_ids.read_ids(spark, folder).collect()} == want
    assert token_ids.lookup(spark, folder, 10) == [want[10]] and token_ids.lookup(spark, folder, -5) == []
    at = 0
    for r in sorted(token_ids.digest(spark, folder).collect()):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(want[r.doc_id]), zlib.crc32(np.array(want[r.doc_id], "<u4").tobytes()))
        at += r.n_tokens


def test_empty_tables(spark):
    empty = documents(spark, ROWS).where("false")
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    folder = token_ids.write_ids(empty, public_tokenizers.path("word_bpe_49k.json"), Scratch(spark, "empty").path)
    for df in (
        relative_lz.without_repeats(empty), suffix_levels.without_shared(empty), jaccard_join.groups(empty), decontamination.contamination(empty, items),
        token_counts.count_tokens(empty, public_tokenizers.path("piece_bpe_32k.model")), token_ids.digest(spark, folder),
    ):
        assert df.count() == 0
