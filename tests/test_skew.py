"""Hot keys: same rows as without them, split and bounded."""

from pyspark.sql import functions as F

from codestrata.operators import skew


def hot_table(spark, n=3000):
    """A third of all rows under one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(n).select(key.cast("string").alias("k"), F.col("id").alias("v"))


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_join_hot_equals_plain_join(spark):
    left = hot_table(spark)
    right = left.select("k", F.length("k").alias("w")).distinct().where("k not like '%7'")
    for how in ["inner", "left", "left_semi", "left_anti"]:
        split = skew.join_hot(left, right, ["k"], how, floor=100)
        assert "_salt" in split._jdf.queryExecution().toString()
        assert rows(split) == rows(left.join(right, "k", how)), how


def test_join_hot_deals_rows_out(spark):
    left = hot_table(spark)
    hot = skew.hot_keys(skew.row_counts(left, ["k"]), ["k"], floor=100)
    assert rows(hot) == [("0", 1000, 10)]
    assert skew.hot_keys(skew.row_counts(left, ["k"]), ["k"], floor=1000) is None


def test_join_listed_checks_the_size(spark):
    left = hot_table(spark)
    right = left.select("k", F.length("k").alias("w")).distinct()
    want = rows(left.join(right, "k"))
    for limit in [0, 10_000]:
        assert rows(skew.join_listed(left, right, ["k"], limit=limit)) == want


def test_no_hot_key_goes_unsplit(spark, monkeypatch):
    """Every key above its part of all rows is split, however many there are."""
    monkeypatch.setattr(skew, "HOT_KEYS", 8)
    counts = spark.range(20).selectExpr("cast(id as string) as k", "if(id < 7, 100, 1) as n")
    hot = skew.hot_keys(counts, ["k"], floor=10)  # an eighth of 713 rows is 89
    assert sorted(r.k for r in hot.collect()) == [str(i) for i in range(7)]


def test_positions(spark):
    table = hot_table(spark).unionByName(spark.createDataFrame([(None, 5), (None, 4)], "k string, v long"))
    got = skew.positions(table.repartition(7), ["k"], [F.col("v").desc()]).collect()
    of = {}
    for r in got:
        of.setdefault(r.k, []).append((r.position, r.v, r.total))
    assert len(of["0"]) == 1000 and sorted(of["0"]) == [(i, 2997 - 3 * i, 1000) for i in range(1000)]
    assert sorted(of[None]) == [(0, 5, 2), (1, 4, 2)] and of["7"] == [(0, 7, 1)]


def test_list_parts(spark):
    parts = skew.list_parts(hot_table(spark), ["k"], "v", 64).where("k = '0'").orderBy("part").collect()
    assert [r.part for r in parts] == list(range(16)) and [r.n for r in parts] == [64] * 15 + [40]
    assert [v for r in parts for v in r["items"]] == list(range(0, 3000, 3))
    assert all((r["first"], r["last"]) == (r["items"][0], r["items"][-1]) for r in parts)


def test_collect_parts(spark):
    table = hot_table(spark).unionByName(spark.range(40).selectExpr("'m' as k", "id as v"))
    lists, more = skew.collect_parts(table, ["k"], "v", "vs")
    whole = {r.k: (r.n_vs, r.vs) for r in lists.collect()}
    assert more is None and whole["0"] == (1000, list(range(0, 3000, 3))) and whole["m"] == (40, list(range(40)))
    lists, more = skew.collect_parts(table, ["k"], "v", "vs", size=30)
    cut = {r.k: (r.n_vs, r.vs) for r in lists.collect()}
    assert {k: (n, vs[:30]) for k, (n, vs) in whole.items()} == cut  # the first part, never null
    for r in more.orderBy("k", "part").collect():
        cut[r.k][1].extend(r["items"])
    assert cut == whole


def test_first_rows_small_and_large(spark):
    table = hot_table(spark)
    order = [F.col("v").desc()]
    small = skew.first_rows(table, ["k"], order, 2)
    assert "WindowGroupLimit" in small._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in small.where("k = '0'").orderBy("rank").collect()] == [
        ("0", 2997, 1), ("0", 2994, 2)
    ]
    early = skew.EARLY_LIMIT
    try:
        skew.EARLY_LIMIT = 1
        large = skew.first_rows(table, ["k"], order, 2)
        assert rows(large) == rows(small)
        assert "Window" not in large._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[0]
    finally:
        skew.EARLY_LIMIT = early


def test_large_limit_of_a_hot_key(spark):
    """A million first rows of one key: no task sorts or ranks more than its share of them."""
    table = spark.range(1_200_000).selectExpr("'r' as k", "id as v").unionByName(hot_table(spark))
    first = skew.first_rows(table.repartition(8), ["k"], [F.col("v")], 1_000_000)
    sizes = [r["count"] for r in first.where("k = 'r'").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1_000_000
    assert first.where("k = 'r'").agg(F.max("v"), F.max("rank")).first() == (999_999, 1_000_000)
