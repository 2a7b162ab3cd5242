"""Classifiers on held-out rows; mixing and nearest neighbours against brute force; the pipeline stage by stage."""

import math
import os

import numpy as np
from conftest import SF_DIR
from llm_tables import documents
from pyspark.sql import functions as F

from codestrata.llm import mixing, neighbours, ordinal, quality, toxicity


def test_ordinal_recovers_grades():
    rng = np.random.default_rng(1)
    rows, grades = [], []
    for _ in range(1500):
        bad = int(rng.integers(0, 4))
        rows.append({f"noise{i}" for i in rng.integers(0, 300, 30)} | {f"sign{i}" for i in rng.permutation(6)[:bad]})
        grades.append(0 if bad == 0 else 1 if bad < 3 else 2)
    model = ordinal.fit(rows[:1000], grades[:1000])
    assert model.thresholds == sorted(model.thresholds) and not any(f.startswith("noise") for f in list(model.weights)[:6])
    right = sum(model.grade(model.tails(x)) == y for x, y in zip(rows[1000:], grades[1000:]))
    assert right >= 475
    assert ordinal.fit([], []).grade([]) == 0 and ordinal.fit([{"a"}], [2]).expected([]) == 2.0


def held_out(spark, train, score, column, truth):
    folder = os.path.join(os.path.dirname(SF_DIR), "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = train(docs, labels.where("doc_id % 3 <> 0"))
    rows = score(docs, model).join(labels.where("doc_id % 3 = 0").withColumnRenamed("toxic", "is_toxic"), "doc_id").collect()
    return sum(r[column] == truth(r) for r in rows) / len(rows)


def test_toxicity_and_quality_held_out(spark):
    assert held_out(spark, toxicity.train, toxicity.score, "toxic", lambda r: r.is_toxic == 1) >= 0.9
    assert held_out(spark, quality.train, quality.score, "keep", lambda r: r.quality == 1) >= 0.9


def test_classifiers_on_odd_rows(spark):
    docs = documents(spark, [(1, None, "a"), (2, "", "a"), (2, "", "a"), (3, "fine words " * 9000, "b"), (4, "you scum", None)])
    labels = spark.createDataFrame([(3, 1, 0), (4, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for m in (toxicity, quality):
        assert m.score(docs, m.train(docs, labels)).count() == 5
        assert m.score(docs.where("false"), m.train(docs, labels.where("false"))).count() == 0
    assert toxicity.without_toxic(docs, toxicity.train(docs, labels)).columns == docs.columns


def test_targets():
    sizes, weights = [100, 10, 1000, 0], [5, 2, 1, 5]
    got = mixing.targets(sizes, weights, 1.5 * sum(sizes), 2)
    assert math.isclose(sum(got), 1.5 * sum(sizes)) and all(g <= 2 * s for g, s in zip(got, sizes))
    level = {round(g / w, 6) for g, s, w in zip(got, sizes, weights) if g < 2 * s}
    assert len(level) <= 1


def test_split_is_exact():
    quotas = np.array([7, 0, 100, 33])
    parts = mixing.split(quotas, 5, np.random.default_rng(0))
    assert (parts.sum(axis=1) == quotas).all() and (parts >= 0).all() and set(parts.sum(axis=0)) <= {27, 28, 29, 30}


def test_mix(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 50)), f"s{i % 4}" if i % 5 else None) for i in range(300)] + [(900, None, "s1"), (901, "", "s1"), (3, "w " * 22, "s3")]
    docs = documents(spark, rows)
    mix = mixing.Mix(docs, block_words=100, shards=4)
    report = mix.report().collect()
    assert len(report) == len(rows)
    for source in {r.source for r in report}:
        own = [r for r in report if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 25 and sum(r["size"] for r in own) == own[0].source_size
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in report)
    again = mixing.Mix(docs.repartition(3), block_words=100, shards=4)
    assert sorted(map(str, again.report().collect())) == sorted(map(str, report))
    drawn = mix.rows()
    assert drawn.columns == [*docs.columns, "__shard", "__position"]
    words = drawn.select(mixing.word_count().alias("n"), "__shard").collect()
    assert sum(r.n for r in words) == sum(r.taken for r in report) and {r["__shard"] for r in words} == {0, 1, 2, 3}
    assert mixing.Mix(docs.where("false")).report().count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=16).tolist()) for i in range(600)] + [(600 + i, [1.0] * 16) for i in range(120)]
    rows += [(800, None), (850, [0.0] * 16), (900, [float("nan")] * 16), (950, [1.0, None] * 8), (None, [1.0] * 16), (1000, [1.0, 2.0]), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS v", "2 AS h1", "3 AS query")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 50 == 0, code_block=128, query_block=4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    good = {i: np.array(v) for i, v in rows if i is not None and i <= 720 and v is not None}
    assert set(got) == {i for i in good if i % 50 == 0}  # 1000 has no other vector of its length
    right = total = 0
    for q, found in got.items():
        score = {i: round(float(v @ good[q] / np.linalg.norm(v) / np.linalg.norm(good[q])), 12) for i, v in good.items() if i != q}
        want = sorted(score, key=lambda i: (-score[i], i))[:5]
        found.sort()
        right, total = right + sum(a == f[1] for a, f in zip(want, found)), total + 5
        assert [f[0] for f in found] == [1, 2, 3, 4, 5] and all(abs(f[2] - score[f[1]]) < 1e-9 for f in found)
    assert right / total >= 0.99
    assert neighbours.nearest(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from test_text_operators import components

    folder = os.path.join(os.path.dirname(SF_DIR), "sf0.01")  # the smallest folder has too few toxic labels to learn from
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], folder).write.parquet(f"{tmp_path}/{i}")
        kept.append(spark.read.parquet(f"{tmp_path}/{i}"))
    assert all(df.columns == docs.columns for df in kept[:-1])
    ids = [[r.doc_id for r in df.select("doc_id").collect()] for df in kept]
    labels = {r.doc_id: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    gone = set(ids[0]) - set(ids[1])
    assert not [i for i in gone if i in labels and not labels[i].toxic] and gone
    rows = [(r.doc_id, r.text, None) for r in kept[1].collect()]
    assert sorted(ids[2]) == sorted({c for _, _, c in components(rows)})
    assert set(ids[3]) <= set(ids[2]) and 0 < len(ids[3])
    assert set(ids[4]) <= set(ids[3]) and len(ids[5]) == len(ids[4]) > len(ids[3])
