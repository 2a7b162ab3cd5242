"""Mixing with very long documents, against a pass over the rows one by one."""

from conftest import SF_DIR
from llm_tables import documents
from pyspark.sql import functions as F

from codestrata.llm import mixing


def missed(mix):
    """Words each source is short of its target, and the shortest document of which a copy less than most is taken."""
    out = {}
    report = mix.report().collect()
    for source in {r.source for r in report}:
        own = [r for r in report if r.source == source]
        low = min(r.taken // r["size"] for r in own)
        spare = [r["size"] for r in own if r.taken // r["size"] == low]
        out[source] = (own[0].target - sum(r.taken for r in own), min(spare), own[0].source_size)
    return out


def test_need_is_met_beside_very_long_documents(spark):
    long = [(10_000 + i, " ".join(["w"] * 20_000), "a") for i in range(5)]
    rows = [(i, " ".join(["w"] * (5 + i * 7 % 40)), "a") for i in range(2_000)] + long + [(20_000 + i, "w " * 30, "b") for i in range(3_000)]
    short = 0
    for seed in range(4):
        mix = mixing.Mix(documents(spark, rows), weights=(1, 1), factor=0.6, cap=1.0, block_words=500, shards=4, seed=seed)
        for miss, spare, size in missed(mix).values():
            assert -0.5 <= miss < spare and miss < 0.005 * size
        carried = mix.taken_in_part.join(mix.blocks.where(F.col("__rest").isNull()), [mixing.SOURCE, mixing.BLOCK]).count()
        short += carried
        # carried documents are rows of the mix, each copy once and in a shard that exists
        report = {r.doc_id: r.taken // r["size"] for r in mix.report().collect()}
        got = mix.rows().groupBy("doc_id").count().collect()
        assert {r.doc_id: r["count"] for r in got} == {i: n for i, n in report.items() if n}
        assert {r["__shard"] for r in mix.rows().select("__shard").distinct().collect()} == {0, 1, 2, 3}
    assert short  # some draw met a long document


def test_carry_is_a_pass_over_the_rows(spark):
    rows = [(i, " ".join(["w"] * (3 + i * i % 97)), "a") for i in range(800)] + [(900 + i, " ".join(["w"] * 3_000 * (i + 1)), "a") for i in range(6)]
    for seed in range(3):
        mix = mixing.Mix(documents(spark, rows), weights=(1,), factor=0.5, cap=1.0, block_words=200, seed=seed)
        order = mix.placed(mix.sized).join(mix.blocks, [mixing.SOURCE, mixing.BLOCK]).withColumn("o", F.xxhash64(F.lit(seed + 1), mixing.DRAW))
        left, want = 0.5 * sum(len(t.split()) for _, t, _ in rows), set()
        in_order = sorted(order.collect(), key=lambda r: (r["__rank"], not r["__whole"] and r.o, r.doc_id))
        for r in in_order:
            if r[mixing.SIZE] <= left + 0.5:
                want.add(r.doc_id)
                left -= r[mixing.SIZE]
        assert {r.doc_id for r in mix.report().collect() if r.taken} == want


def test_query_makes_the_mix(spark, monkeypatch):
    from codestrata.llm import queries

    made = []
    rows = mixing.Mix.rows
    monkeypatch.setattr(mixing.Mix, "rows", lambda self: made.append(self) or rows(self))
    got = queries.QUERIES["op7_mixing"](spark, SF_DIR)
    assert made  # the whole mix was dealt to shards, not only planned
    assert got.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    assert sorted(map(str, got.collect())) == sorted(map(str, made[0].report().collect()))


def test_counted_copies(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 50)), f"s{i % 4}" if i % 5 else None) for i in range(300)]
    rows += [(900, None, "s1"), (900, None, "s1"), (901, "", None), (None, "w w", "s2"), (3, "w " * 22, "s3"), (3, "w " * 22, "s3")]
    mix = mixing.Mix(documents(spark, rows), block_words=100, shards=4)
    assert sorted(map(str, mix.counted().collect())) == sorted(map(str, mix.report().collect()))
    assert mixing.Mix(documents(spark, rows).where("false")).counted().count() == 0


def test_every_shard_has_a_partition(spark):
    rows = [(i, "w " * (5 + i % 9), "a") for i in range(2_000)]
    mix = mixing.Mix(documents(spark, rows), block_words=50, shards=12)
    placed = mix.dealt(mix.rows()).select(F.spark_partition_id().alias("at"), "__shard", "__position").collect()
    assert {(r["at"], r["__shard"]) for r in placed} == {(i, i) for i in range(12)}
    for i in range(12):
        own = [r["__position"] for r in placed if r["at"] == i]
        assert own == sorted(own)
