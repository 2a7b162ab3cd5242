"""The manifest against trees built in lists."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from codestrata.llm import merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, level int, tree string, at long"


def audit(df):
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return M.audit(df, changed, n_chars=F.col("n_chars") + 1)


def digest(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, text, lang, source, n = row
    values = (doc_id, source, lang, None if n is None else n + more, text)
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def brute(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels([leaf(r) for r in sorted(langs[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for x in order}
    top = levels([trees[x][-1][0] for x in order])
    out = []
    for j, x in enumerate(order):
        for i, r in enumerate(sorted(langs[x], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))):
            node = leaf(r, 1 if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else 0)
            siblings = []
            for tree, at in ((trees[x], i), (top, j)):
                for level in tree[:-1]:
                    other = level[at ^ 1 : (at ^ 1) + 1]
                    siblings += other
                    node = digest(other + [node] if at & 1 else [node] + other)
                    at >>= 1
            out.append((r[0], leaf(r), trees[x][-1][0], top[-1][0], digest(siblings), node, node == top[-1][0]))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)


@pytest.fixture
def rows():
    rnd = random.Random(3)
    some = lambda *values: rnd.choice([None, *values])
    out = [(some(*range(400)), some("", "ä", "x" * 70_000), some("", "en", "en", "en", "*", "=", "ü"), some("s"), some(3)) for _ in range(350)]
    return out + [out[0]] * 3 + [(5_000, "t", "alone", "s", 1)]


@pytest.mark.parametrize("step", [12, 3, 2])
def test_against_lists(spark, rows, monkeypatch, step):
    monkeypatch.setattr(M, "STEP", step)  # small steps: several tiers, and nodes high up handed out in parts
    got = audit(table(spark, rows))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_few_rows(spark):
    for rows in ([], [(1, "a", "en", "s", 1)], [(None, None, None, None, None)], [(1, "a", "en", "s", 1), (2, "b", None, "s", 1)]):
        got = audit(table(spark, rows))
        assert sorted(map(tuple, got.collect()), key=str) == (brute(rows) if rows else [])


def test_union_is_smallest():
    for n in (1, 2, 3, 7, 8, 13, 64):
        rnd = random.Random(n)
        for _ in range(20):
            known = set(rnd.sample(range(n), rnd.randint(1, n)))
            need = set(M.missing(known, n))
            have = {(0, at) for at in known}
            for level in range(M.height(n)):
                width = ((n - 1) >> level) + 1
                for at in range(0, width, 2):
                    pair = {(level, at), (level, at + 1)} if at + 1 < width else {(level, at)}
                    inside = any((level, a) in have for _, a in pair)
                    assert not inside or pair <= have | need  # enough to go up
                    assert inside or not pair & need  # nothing for a path nobody needs
                    if inside:
                        have.add((level + 1, at >> 1))
            assert not need & have  # nothing that can be derived


def test_proofs_of_some_rows_from_a_stored_manifest(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "STEP", 3)
    manifest = M.Manifest(spark, str(tmp_path)).write(table(spark, rows))
    some = M.folded(manifest.prove(manifest.leaves.where("doc_id % 37 = 5")))
    want = [(r[0], r[1], r[2], r[3], r[4], r[3], True) for r in brute(rows) if r[0] is not None and r[0] % 37 == 5]
    assert want and sorted(map(tuple, some.collect()), key=str) == sorted(want, key=str)
    stored = spark.read.parquet(f"{tmp_path}/leaves")
    assert stored.count() == len(rows)


def test_one_fetch_of_a_node_by_a_stretch(spark, rows, monkeypatch):
    monkeypatch.setattr(M, "STEP", 3)
    manifest = M.Manifest(spark).write(table(spark, rows))
    place = spark.read.parquet(f"{manifest.scratch.path}/leaves").where("tree = '=en'")
    for r in place.groupBy((F.col("at") / 8).cast("long").alias("s")).agg(F.collect_set("at").alias("known"), F.max("n").alias("n")).collect():
        need = M.missing(set(r.known), r.n)
        assert len(need) == len(set(need)) <= M.height(r.n)  # a whole stretch lacks a sibling of its top at each level
