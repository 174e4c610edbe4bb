"""URL filters: allow/block rules on (host, path prefix), as a sort-merge
range join on reversed-host keys.

Every host becomes a canonical key of its labels in reverse order, each
followed by ``/`` (``blog.example.net`` -> ``net/example/blog/``), so a host
and its subdomains are exactly the keys that start with the host's key: one
interval of the sort order.  Intervals of a prefix code are nested or
disjoint.  One sweep over the sorted keys of rules and urls therefore needs
only the stack of rules that are open: each rule carries the stack as it is
after its push (itself and the rules it is nested in), the sweep hands every
url the stack of the last rule before it, and the rules whose interval has
ended are popped by the prefix test.  The sweep runs twice: over distinct
hosts, and over the paths of those hosts below each open rule host.

The sweep is distributed: keys are range-partitioned, each range is swept by
itself, and the stack that is open where a range begins is the last one pushed
in the ranges before it (one row per range).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import LOWER, UPPER, hide, prepare, saved, show

DEFAULT_VERDICT = "allow"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty without ``://`` and for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, "^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty as for the host."""
    return F.coalesce(F.regexp_extract(url, "^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """``a.b.c`` -> ``c/b/a/``.  No host holds ``/``, so keys are a prefix code."""
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "/"), F.lit("/"))


def _prefixes_of(rules: DataFrame, key: str, lengths: Column) -> DataFrame:
    """Rules with ``_stack``: the rules that contain them and themselves,
    outermost first (the stack right after their push).  ``lengths``: where a
    containing rule's key may end; a rule has few of them (labels of a host,
    characters of a path), so a stack is small."""
    own = rules.select(F.col(key).alias("_own"), F.explode(lengths).alias("_n"))
    own = own.select("_own", F.expr("substring(_own, 1, _n)").alias(key))
    found = own.join(rules, key).groupBy("_own").agg(F.sort_array(F.collect_list(F.struct(F.length(key).alias("n"), *rules.columns))).alias("_stack"))
    return found.select(F.col("_own").alias(key), "_stack")


def _sweep(points: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """``points`` (distinct, with column ``key``) with ``_stack``: the rules
    (``key``, ``_stack``) whose key starts the point's key, outermost first."""
    spark = points.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    events = rules.select(key, "_stack", F.lit(0).alias("_kind")).unionByName(points.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    # the sampled ranges must be the same for the sweep and its carry: fix them in the shared folder
    ranged = saved(events.repartitionByRange(n, key, "_kind").withColumn("_range", F.spark_partition_id()))
    order = Window.partitionBy("_range").orderBy(key, "_kind")
    swept = ranged.repartitionByRange(n, "_range").withColumn("_open", F.last("_stack", ignorenulls=True).over(order))
    pushed = ranged.filter("_kind = 0").groupBy("_range").agg(F.max_by("_stack", key).alias("_last"))
    ranges = spark.range(n).select(F.col("id").cast("int").alias("_range")).join(pushed, "_range", "left")
    carry = ranges.select("_range", F.last("_last", ignorenulls=True).over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    # the carry has one row for each range
    joined = swept.filter("_kind = 1").join(F.broadcast(carry), "_range", "left")
    stack = F.filter(F.coalesce("_open", "_carry"), lambda r: F.startswith(F.col(key), r[key]))
    return joined.select(*points.columns, stack.alias("_stack")).filter(F.size("_stack") > 0)


def normalised_rules(rules: DataFrame) -> DataFrame:
    """(host, path, verdict) as rows of key, path, rule and verdict, one per
    (host, path).  Rules with a null part never fit; if the same rule is given
    with both verdicts, ``block`` holds."""
    r = rules.select(F.translate(F.col("host"), UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "verdict").na.drop()
    return r.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """``pages`` with columns host, path, rule and verdict (columns of these
    names in the input are replaced).

    A rule (host, path) fits its host and all subdomains if the url's path
    starts with the rule's path; the longest fitting rule (its host and path
    together, then its host) decides.  No rule fits: rule is null and the
    verdict is ``default``.  Null urls and urls without ``://`` have an empty
    host and path; repeated rows are judged alike and all returned; empty
    tables give an empty result (no pages) or the default for all (no rules).
    """
    prepare(pages.sparkSession)
    pages, names = hide(pages)
    judged = pages.withColumns({"host": url_host(F.col(names[url_col])), "path": url_path(F.col(names[url_col]))})
    rules = saved(normalised_rules(rules).withColumn("key", host_key(F.col("rule_host"))))
    # first sweep: distinct hosts against rule hosts
    hosts = judged.select("host").distinct().withColumn("key", host_key(F.col("host")))
    rule_hosts = rules.select("key").distinct()
    ends = F.expr("filter(sequence(1, length(key)), i -> substring(key, i, 1) = '/')")
    open_hosts = _sweep(hosts, _prefixes_of(rule_hosts, "key", ends), "key").select("host", F.explode("_stack.key").alias("_rule_key"))
    # second sweep: the paths below each open rule host against its path rules
    # "?" is in no host and no path, so it ends the host part of the key
    paths = judged.select("host", "path").distinct().join(open_hosts, "host")
    points = paths.select("host", "path", F.concat("_rule_key", F.lit("?"), "path").alias("key2"))
    path_rules = rules.select(F.concat("key", F.lit("?"), "rule_path").alias("key2"), "rule_host", "rule_path", "verdict")
    ends2 = F.expr("sequence(instr(key2, '?'), length(key2))")
    stacks = _prefixes_of(path_rules, "key2", ends2)
    fits = _sweep(points, stacks, "key2").select("host", "path", F.element_at("_stack", -1).alias("_top"))
    best = fits.groupBy("host", "path").agg(
        F.max(F.struct((F.length("_top.rule_host") + F.length("_top.rule_path")).alias("n"), F.length("_top.rule_host").alias("h"), F.col("_top.rule_host").alias("rule_host"), F.col("_top.rule_path").alias("rule_path"), F.col("_top.verdict").alias("verdict"))).alias("_best")
    )
    best = best.select("host", "path", F.concat("_best.rule_host", "_best.rule_path").alias("rule"), F.col("_best.verdict").alias("verdict"))
    judged = judged.join(best, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    return show(judged, names, "host", "path", "rule", "verdict")
