"""Null and repeated ids, columns with the operators' own names, and extreme values, through every operator and stage."""

import hashlib
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from codestrata.llm import decontamination, jaccard_join, mixing, neighbours, quality, relative_lz, suffix_levels, token_counts, token_ids, toxicity
from codestrata.llm.common import Scratch

#: names that operators use themselves
OWN = ["__id", "__key", "__k", "__size", "__source", "__block", "__draw", "__row", "__shard", "__position", "__words", "__at", "bytes", "lang_", "n", "tree", "at", "level"]
PASSAGE = " ".join(f"w{i}" for i in range(40))
ROWS = [
    (1, PASSAGE + " one", "a"), (2, "x " + PASSAGE, "a"), (2, "other text of the same id", "b"), (2, "other text of the same id", "b"), (None, PASSAGE, None), (None, None, ""),
    (None, "null id too", ""), (3, "", "a"), (4, None, "b"), (5, "ünï " * 30, ""), (6, "q", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, "en", len(r[1] or ""), *(f"{c}{i}" for c in OWN)) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(f"`{c}` string" for c in OWN))


def rows_of(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_token_operators(spark, docs):
    from tokenizers import Tokenizer
    import sentencepiece

    word = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [word.encode(t or "", add_special_tokens=False).ids + [1] for _, t, _ in ROWS]
    folder = Scratch(spark, "odd").path
    token_ids.write_ids(docs, public_tokenizers.path("word_bpe_49k.json"), folder, end_id=1)
    got = token_ids.digest(spark, folder).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(d), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (d, _, _), x in zip(ROWS, ids))
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1].tolist()]
    assert [r.doc_id for r in ordered if r.doc_id is not None] == sorted(d for d, _, _ in ROWS if d is not None)
    piece = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = rows_of(token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model")), ["doc_id", "n_bytes", "n_tokens"])
    assert got == sorted(((d, len((t or "").encode()), len(piece.encode(t or ""))) for d, t, _ in ROWS), key=str)


def test_text_operators(spark, docs):
    items = spark.createDataFrame([(7, " ".join(PASSAGE.split()[5:25]), "x"), (None, PASSAGE, "y"), (8, None, "z"), (9, "q", "w"), (9, "q", "w")], "item_id long, text string, __words string")
    got = rows_of(decontamination.contamination(docs, items), ["doc_id", "n_words", "n_hit", "n_items", "contaminated"])
    assert got == sorted([(1, 41, 20, 1, True), (2, 41, 20, 1, True), (2, 6, 0, 0, False), (2, 6, 0, 0, False), (None, 40, 20, 1, True), (None, 0, 0, 0, False), (None, 3, 0, 0, False), (3, 0, 0, 0, False), (4, 0, 0, 0, False), (5, 30, 0, 0, False), (6, 1, 1, 1, True)], key=str)
    clean = decontamination.clean(docs, items)
    assert clean.columns == docs.columns and rows_of(clean, docs.columns) == rows_of(docs.where("text IS NULL OR NOT (text LIKE '%w39%' OR text = 'q')"), docs.columns)
    # the null id comes first: its passage stays, and the others' goes
    got = rows_of(relative_lz.without_repeats(docs), ["doc_id", "n_words", "n_removed"])
    assert got == sorted([(1, 41, 40), (2, 41, 40), (2, 6, 0), (2, 6, 0), (None, 40, 0), (None, 0, 0), (None, 3, 0), (3, 0, 0), (4, 0, 0), (5, 30, 29), (6, 1, 0)], key=str)
    got = rows_of(suffix_levels.without_shared(docs, length=100), ["doc_id", "n_bytes", "n_removed"])
    n = len(PASSAGE)
    assert got == sorted([(1, n + 4, n), (2, n + 2, n), (2, 25, 0), (2, 25, 0), (None, n, n), (None, 0, 0), (None, 11, 0), (3, 0, 0), (4, 0, 0), (5, 180, 180), (6, 1, 0)], key=str)
    got = rows_of(jaccard_join.linked(docs), ["doc_id", "n_shingles", "component_id"])
    assert (1, 37, 1) in got and (2, 37, 1) in got and got.count((2, 2, 2)) + got.count((2, 2, 1)) == 2 and len(got) == len(ROWS)


def test_classifiers_and_mix(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0, "x"), (6, 0, 1, "y"), (None, 1, 1, "z")], "doc_id long, quality int, toxic int, text string").withColumnRenamed("text", "__key")
    for m in (toxicity, quality):
        assert m.score(docs, m.train(docs, labels)).count() == len(ROWS)
    assert rows_of(toxicity.without_toxic(docs, toxicity.train(docs, labels.where("toxic = 0"))), docs.columns) == rows_of(docs, docs.columns)
    mix = mixing.Mix(docs, block_words=10, shards=2)
    rows = mix.rows()
    assert rows.columns == [*docs.columns, "___shard", "___position"]
    given = {tuple(r[c] for c in docs.columns) for r in docs.collect()}
    assert {tuple(r[c] for c in docs.columns) for r in rows.collect()} <= given  # every column as it was
    report = mix.counted().collect()
    assert len(report) == len(ROWS) and {r.source for r in report} == {"a", "b", "c", "", None}
    assert all(r.taken <= 2 * r["size"] for r in report)


def test_stages_keep_columns_of_any_name(spark, docs):
    import corpus_pipeline

    folder = os.path.join(os.path.dirname(SF_DIR), "sf0.01")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, folder)
        assert kept.columns == docs.columns
        kept = spark.createDataFrame(kept.collect(), docs.schema)
    given = {tuple(r) for r in docs.collect()}
    assert kept.count() and {tuple(r) for r in kept.collect()} <= given


def test_small_and_large_vectors(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 8))
    factors = [1e-320 / 3, 1e-200, 1e-30, 1.0, 1e30, 1e200, 1e300]
    rows = [(i, (v / np.abs(v).max() * factors[i % 7]).tolist()) for i, v in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    whole = {i: np.array(v) / np.abs(v).max() for i, v in rows}
    assert set(got) == {0, 50}
    for q, found in got.items():
        score = {i: float(v @ whole[q] / np.linalg.norm(v) / np.linalg.norm(whole[q])) for i, v in whole.items() if i != q}
        best = sorted(score, key=lambda i: (-score[i], i))[:5]
        assert [(n, i) for n, i, _ in sorted(found)] == list(enumerate(best, 1))
        assert all(abs(s - score[i]) < 1e-9 for _, i, s in found)
    two = spark.createDataFrame([(0, [1e-200, 2e-200]), (1, [1e200, 2e200]), (2, [2.0, 1.0])], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.score for r in neighbours.nearest(two, F.col("vec_id") == 0).collect()}
    assert found == {1: pytest.approx(1.0, abs=1e-12), 2: pytest.approx(0.8, abs=1e-12)}


def held_out(spark, name, fold):
    folder = os.path.join(os.path.dirname(SF_DIR), name)
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels.where(f"doc_id % 3 <> {fold}"))
    return toxicity.score(docs, model).join(labels.where(f"doc_id % 3 = {fold}").select("doc_id", F.col("toxic").alias("is_toxic")), "doc_id").collect()


def test_toxic_rows_are_caught_held_out(spark):
    """A third of the toxic labels of these tables stand on texts without a single abusive word, so at most 33 of 51 can be learned."""
    rows = [r for fold in range(3) for r in held_out(spark, "sf0.01", fold)]
    toxic = [r for r in rows if r.is_toxic]
    assert len(toxic) == 51 and sum(r.toxic for r in toxic) >= 0.9 * 33
    assert sum(r.toxic for r in rows if not r.is_toxic) <= 0.01 * len(rows)
    few = [r for fold in range(3) for r in held_out(spark, "sf0.001", fold)]  # eleven toxic labels in all
    assert sum(r.toxic for r in few if r.is_toxic) >= 5 and sum(r.toxic for r in few if not r.is_toxic) <= 2


def test_likelihood_against_a_plain_optimiser():
    """The fit's weights and thresholds against a search by small steps on the likelihood itself."""
    from codestrata.llm import ordinal

    rng = np.random.default_rng(8)
    x = rng.random((400, 3)) < [0.5, 0.3, 0.2]
    score = x @ [2.0, 1.0, -1.5] + rng.logistic(size=400)
    y = (score > 0.5).astype(int) + (score > 2.0)
    model = ordinal.fit([{j for j in range(3) if r[j]} for r in x], y.tolist(), min_rows=1, z=0.0, decay=0.0, steps=3000, rate=0.02)

    def loss(w, t):
        s = x @ w
        upper = np.where(y < 2, 1 / (1 + np.exp(s - np.append(t, 0)[y])), 1.0)
        lower = np.where(y > 0, 1 / (1 + np.exp(s - np.append(t, 0)[y - 1])), 0.0)
        return -np.log(np.maximum(upper - lower, 1e-300)).mean()

    best = np.array([model.weights.get(j, 0.0) for j in range(3)]), np.array(model.thresholds)
    params, step = np.zeros(5), 1.0
    params[4] = 1.0
    value = lambda p: loss(p[:3], p[3:]) if p[3] < p[4] else np.inf
    while step > 1e-5:  # coordinate search
        moved = False
        for i in range(5):
            for d in (step, -step):
                other = params.copy()
                other[i] += d
                if value(other) < value(params):
                    params, moved = other, True
        step = step if moved else step / 2
    assert abs(loss(*best) - value(params)) < 1e-4
    assert np.abs(np.concatenate(best) - params).max() < 0.05
