"""URL filters by propagation over the link graph of hosts (operator 11).

Rules judge what they name.  Every page that a rule allows gives its host trust, and every page that a rule blocks
distrust.  Trust flows along the links between hosts (personalised PageRank from the trusted seeds); distrust flows against them, from
a host to those that link to it.  A host's other pages are blocked where its distrust is above its trust.

Amounts are whole numbers (`UNIT` a page) and every share is rounded down, so sums do not depend on their order and reruns agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codestrata.llm.common import Scratch
from codestrata.operators.skew import join_hot

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hosts of links in a page: absolute ones or ones that take over the scheme.
LINK = r"""(?i)href[ \t\n\x0c\r]*=[ \t\n\x0c\r]*["']?[ \t\n\x0c\r]*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<> \t\n\x0c\r]+)"""
#: Trust or distrust of one seed page.
UNIT = 100_000
#: Percent of what a host has that flows on.
FLOW = 85
#: Rows of one host that one task takes of its arcs.
ARCS = 100_000
#: Rules are a policy and go into the plan as literals; a longer one is refused.
MOST_RULES = 1_000

#: The rules of the contract, with what they do.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z as a-z) and path; both empty for null or a text without ``://``."""
    rest = F.coalesce(F.expr(f"IF(locate('://', `{url}`) > 0, substring(`{url}`, locate('://', `{url}`) + 3), '')"), F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def longest_rule(rules: Sequence[tuple[str, str]], host: str = "host", path: str = "path") -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits, or null.  A rule, ``host/path``, fits its host and all
    subdomains where the path starts with the rule's."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest last, so outermost
        name, slash, start = rule.partition("/")
        fits = ((F.col(host) == name) | F.endswith(F.col(host), F.lit("." + name))) & F.startswith(F.col(path), F.lit(slash + start))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``src, dst``: which host links to which other one, once however many pages do so."""
    host = host_and_path(url)[0]
    targets = F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)))
    found = pages.select(host.alias("src"), F.explode(targets).alias("dst")).select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
    return found.where((F.col("src") != "") & (F.col("src") != F.col("dst"))).distinct()


def propagated(seeds: DataFrame, links: DataFrame, steps: int, scratch: Scratch) -> DataFrame:
    """``host, trust, distrust`` of every host that either reaches in ``steps`` steps.  ``seeds``: host, trust, distrust.

    Each step is a join of what hosts have with their arcs and a sum; each host keeps ``100 - FLOW`` percent of its seed, and
    hands out ``FLOW`` percent of what it has in equal shares.  A hub's arcs are dealt to parts, and what it has is handed to
    each part.  Every step is written, which cuts the lineage; the one before is removed then."""
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("has")) for k in ("trust", "distrust")])).alias("k")
    start = scratch.keep(seeds.select("host", kinds).select("host", "k.*").where("has > 0"), "seeds")
    both = F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("src").alias("from"), F.col("dst").alias("to")),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("from"), F.col("src").alias("to")),
    )
    arcs = scratch.keep(links.select(F.explode(both).alias("a")).select("a.*"), "arcs")
    state = start
    if not arcs.isEmpty():
        degrees = scratch.keep(arcs.groupBy("kind", "from").agg(F.count(F.lit(1)).alias("arcs")), "degrees")
        count = F.ceil(F.col("arcs") / ARCS).cast("int")
        dealt = join_hot(arcs, degrees, ["kind", "from"], "inner", degrees.withColumnRenamed("arcs", "n"), ARCS)
        dealt = scratch.keep(dealt.select("kind", "from", "to", F.pmod(F.xxhash64("to"), count).cast("int").alias("part")), "dealt")
        base = start.select("host", "kind", (F.col("has") * (100 - FLOW)).alias("x")).select("host", "kind", F.expr("x div 100").alias("has"))
        for step in range(steps):
            each = state.join(degrees, (F.col("host") == F.col("from")) & (state["kind"] == degrees["kind"])).select(
                "from", degrees["kind"], F.expr(f"has * {FLOW} div (100 * arcs)").alias("share"), F.explode(F.sequence(F.lit(0), count - 1)).alias("part")
            )
            flow = dealt.join(each, ["kind", "from", "part"]).select(F.col("to").alias("host"), "kind", F.col("share").alias("has"))
            sums = base.unionByName(flow).groupBy("host", "kind").agg(F.sum("has").alias("has")).where("has > 0")
            state = scratch.keep(sums, f"step-{step}")
            if step:
                scratch.drop(f"step-{step - 1}")
    amount = lambda k: F.sum(F.when(F.col("kind") == k, F.col("has")).otherwise(0)).alias(k)
    return state.groupBy("host").agg(amount("trust"), amount("distrust"))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, steps: int = 10, url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every page: the verdict of the longest rule, or else ``block`` where
    the host's distrust is above its trust, and ``allow`` where not, so also where nothing is known.

    A null url, or one without ``://``, has an empty host, which takes no part in the graph.  Null or empty html has no links, links of a
    host to itself do not count.  Null ids stay, repeated rows are judged each (and count each as seeds), other columns are not
    read, an empty table gives no rows."""
    scratch = Scratch(pages.sparkSession, "link-graph")
    host, path = host_and_path(url)
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rows = scratch.keep(rows.withColumn("r", longest_rule(rules)).select("page_id", "host", "path", "r.rule", "r.verdict"), "ruled")
    seeds = rows.where((F.col("host") != "") & F.col("verdict").isNotNull()).groupBy("host").agg(
        (F.count_if(F.col("verdict") == "allow") * UNIT).alias("trust"), (F.count_if(F.col("verdict") == "block") * UNIT).alias("distrust")
    )
    amounts = scratch.keep(propagated(seeds, host_links(pages, url, html), steps, scratch), "amounts")
    out = join_hot(rows, amounts, ["host"], "left").na.fill(0, ["trust", "distrust"])
    own = F.when(F.col("distrust") > F.col("trust"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"), "trust", "distrust")
