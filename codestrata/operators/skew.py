"""Joins, ranks and list building that survive a key holding a large share of all rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from codestrata.session import materialize, unsent

#: a key with more than one part in this many of all rows is hot: so there are fewer hot keys than this
HOT_KEYS = 1000
#: and no key below this many rows is hot
HOT_ROWS = 100_000
#: longest list built as one array value; longer ones go on in further parts
PART_ROWS = 100_000
#: a table up to this long, and of so many bytes of text, is sent to every task
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
#: window limits up to this value are applied by Spark before the shuffle
EARLY_LIMIT = 1000


def row_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def hot_keys(counts: DataFrame, keys: list[str], floor: int = HOT_ROWS) -> DataFrame | None:
    """The keys of ``counts`` (keys + ``n``) above ``floor`` rows and above their part of all rows, with the number of ``parts`` to deal
    them to, or None.  Fewer than ``HOT_KEYS`` keys can have such a share, so all of them come to the driver and go
    out again as a literal table."""
    most = max(floor, (counts.agg(F.sum("n")).first()[0] or 0) // HOT_KEYS)
    parts = F.ceil(F.col("n") / most).cast("int").alias("parts")
    top = counts.where(F.col("n") > most).select(*keys, "n", parts)
    found = top.collect()
    return counts.sparkSession.createDataFrame(found, top.schema) if found else None


def join_hot(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    counts: DataFrame | None = None,
    floor: int = HOT_ROWS,
) -> DataFrame:
    """Join many rows to a table with one row per key.  Rows of hot keys are dealt out over
    salts, and only the matching rows of ``right`` are repeated, once per salt.  ``counts``
    (keys + ``n``) may be given if the caller has them, or larger ones, already.  ``right`` and ``full``
    joins are refused: a repeated row without a match would come out once per salt."""
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"join_hot cannot do a {how} join")
    hot = hot_keys(row_counts(left, on) if counts is None else counts, on, floor)
    if hot is None:
        return left.join(unsent(right), on, how)
    hot = hot.select(*on, F.col("parts").alias("_salts"))
    # a hash of the row, not a random number: a re-run task deals its rows out the same way
    seed = F.xxhash64(*[c for c, t in left.dtypes if not t.startswith("map")])
    salt = F.coalesce(F.pmod(seed, F.col("_salts")), F.lit(0)).cast("int")
    salted_left = left.join(F.broadcast(hot), on, "left").withColumn("_salt", salt)
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted_right = right.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(copies))
    return (
        salted_left.drop("_salts")
        .join(unsent(salted_right.drop("_salts")), [*on, "_salt"], how)
        .drop("_salt")
    )


def join_listed(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", limit: int = BROADCAST_ROWS
) -> DataFrame:
    """Join to a stored table of short rows, one per key, whose size is checked: up to ``limit`` rows and
    ``BROADCAST_BYTES`` it is sent to every task, beyond that :func:`join_hot` takes over."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, t in right.dtypes if t == "string"]
    size = F.coalesce(F.sum(sum(texts, F.lit(0))), F.lit(0))
    rows, size = right.agg(F.count(F.lit(1)), size).first()
    if rows <= limit and size <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), on, how)
    return join_hot(left, right, on, how)


def positions(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``rows`` with ``position``, their place in their key from 0 on by ``order``, and ``total``, the rows of the key.  Rows are sorted
    in ranges over key and order, so one large key is spread over many tasks; only the counts of each key in each
    range are summed over the ranges.  Rows equal in all of ``order`` take any order."""
    by = [*map(F.col, keys), *order]
    ranges = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    # written, as a range is not cut a second time at the same places
    ranges = materialize(ranges.withColumn("_row", F.monotonically_increasing_id()), "ranges")
    ranges = ranges.withColumn("_range", F.shiftright("_row", 33))
    sizes = ranges.groupBy(*keys, "_range").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys)
    before = F.sum("_n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.withColumns({"_before": F.coalesce(before, F.lit(0)), "total": F.sum("_n").over(whole)})
    offsets = offsets.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], F.col("_range").alias("_r"), "_first", "_before", "total")
    same = F.col("_range") == F.col("_r")
    for i, c in enumerate(keys):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    joined = ranges.join(unsent(offsets), same)
    return joined.select(*rows.columns, (F.col("_row") - F.col("_first") + F.col("_before")).alias("position"), "total")


def list_parts(rows: DataFrame, keys: list[str], value: str, size: int = PART_ROWS) -> DataFrame:
    """The sorted list of each key's values in parts of at most ``size``: ``keys, part, first, last, n, items``, parts numbered from
    0.  A part holds the values from ``first`` to ``last``, so a search needs one part only."""
    placed = positions(rows.select(*keys, value), keys, [F.col(value)])
    part = F.expr(f"position div {size}").cast("int").alias("part")
    items = F.array_sort(F.collect_list(value))
    found = placed.select(*keys, part, value).groupBy(*keys, "part").agg(items.alias("items"))
    return found.select(*keys, "part", F.get("items", 0).alias("first"), F.element_at("items", -1).alias("last"), F.size("items").cast("bigint").alias("n"), "items")


def collect_parts(rows: DataFrame, keys: list[str], value: str, name: str, size: int = PART_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Per key the number of rows ``n_<name>`` and the sorted list ``<name>`` up to its ``size``-th value; and the
    further parts of longer lists as of :func:`list_parts` (None if there is no longer list).  Only the keys whose list is
    longer are sorted in ranges, and those never meet in a group."""
    counts = row_counts(rows, keys)
    count, listed = f"n_{name}", F.array_sort(F.collect_list(value)).alias(name)
    long = counts.where(F.col("n") > size)
    if long.isEmpty():
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count), listed), None
    long = materialize(long, "long_lists")
    hot = hot_keys(long, keys, floor=size)
    narrow = rows.select(*keys, value)
    # the largest keys' rows leave before the shuffle, the others' after it
    short = (narrow.join(F.broadcast(hot.select(*keys)), keys, "left_anti") if hot is not None else narrow).join(long.select(*keys), keys, "left_anti")
    parts = materialize(list_parts(join_hot(narrow, long.select(*keys), keys, "left_semi", counts=long, floor=size), keys, value, size), "parts")
    first = parts.where("part = 0").select(*keys, F.col("items").alias(name))
    lists = short.groupBy(*keys).agg(listed).unionByName(first)
    return counts.withColumnRenamed("n", count).join(unsent(lists), keys, "left"), parts.where("part > 0")


def first_rows(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per key with their rank.  Small ``n``: Spark cuts each map task's rows to ``n`` before the
    shuffle.  Large ``n``: ranks come from :func:`positions`, with no window over a key."""
    if n <= EARLY_LIMIT:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
    placed = positions(df, keys, order).where(F.col("position") < n)
    return placed.withColumn(rank, (F.col("position") + 1).cast("int")).drop("position", "total")
