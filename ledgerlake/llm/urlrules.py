"""URL rules by a sort-merge range join.

A host is turned round label by label (``www.example.com`` -> ``com.example.www.``),
so a rule for a host and its subdomains is the interval of all keys that start
with the rule's key.  Intervals of rules nest or are disjoint.  Rules become two
events each: at the start of its interval the stack of active rules is that of
its host and all hosts around it, after the end it is that of the host around
it.  Events and URLs are sorted by key, and a running window carries the last
stack forward: each URL meets the rules that fit its host without a join on
ranges.  The longest of them whose path starts the URL's path wins.

URLs are dealt to sorted shards by a hash of the row, never by host, so a host
with a third of all rows is spread evenly; each shard gets all rule events
(rules x shards rows).  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DEFAULT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def _key(host: Column) -> Column:
    """Labels last to first, each followed by a dot; empty for an empty host."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _events(rules: DataFrame) -> DataFrame:
    """key, stack: from this key on, these rules are active."""
    parsed = rules.select(
        F.translate(F.substring_index("rule", "/", 1), _UPPER, _LOWER).alias("host"),
        F.expr("substring(rule, instr(rule, '/'))").alias("path"), "rule", "verdict") \
        .where("rule is not null and instr(rule, '/') > 1").distinct().withColumn("key", _key(F.col("host")))
    own = parsed.groupBy("key").agg(F.collect_list(F.struct(
        F.length("rule").alias("size"), F.length("host").alias("host_size"), "rule", "path", "verdict")).alias("own"))
    # all prefixes of a key that end with a label, the key itself last
    labels = F.split(F.expr("substring(key, 1, length(key) - 1)"), r"\.")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")))
    nodes = own.select("key", F.explode(prefixes).alias("around"))
    around = nodes.join(own.withColumnRenamed("key", "around"), "around").groupBy("key").agg(
        F.flatten(F.collect_list("own")).alias("stack"),
        F.flatten(F.collect_list(F.when(F.col("around") != F.col("key"), F.col("own")))).alias("outer"))
    start = around.select("key", "stack")
    # '/' follows '.', and no key holds it: the first string after all keys of the interval
    end = around.select(F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/")).alias("key"), F.col("outer").alias("stack"))
    return start.union(end)


def judge(spark: SparkSession, pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """pages (page_id, url, ..), rules (rule, verdict) -> page_id, host, path, rule, verdict; a row for each input row.

    A rule ``host/path`` fits its host and all subdomains where the URL's path
    starts with ``/path``; the longest rule wins (at equal length, the longer host, then
    the greater text).  No rule: rule is null and verdict is ``default``.  A null URL, or one without ``://``,
    has an empty host and path and meets no rule; rules without a host or slash are
    ignored.  Repeated rows are judged each on its own.  Other columns are ignored.
    """
    shards = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", F.col("url").cast("string").alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    events = _events(rules)
    urls = urls.select(F.pmod(F.xxhash64("page_id", "url"), F.lit(shards)).cast("int").alias("shard"), _key(F.col("host")).alias("key"),
                       F.lit(1).alias("kind"), "page_id", "host", "path")
    spread = events.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "key", F.lit(0).alias("kind"), "stack")
    sweep = Window.partitionBy("shard").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = urls.unionByName(spread, allowMissingColumns=True).withColumn("active", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    fits = F.filter("active", lambda r: F.col("path").startswith(r["path"]))
    best = swept.withColumn("best", F.array_max(F.transform(fits, lambda r: F.struct(r["size"], r["host_size"], r["rule"], r["verdict"]))))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict"))
