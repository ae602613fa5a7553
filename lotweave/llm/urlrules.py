"""URL rules as a sort-merge range join of prefix intervals, in DataFrame functions only.

A host is written with its labels reversed and each closed by a dot (``com.example.``), so
"this host and its subdomains" is the interval of keys with that prefix; with the path
appended, "path starts with" is one too. Prefix intervals nest or are disjoint. Rule starts,
probes and rule ends are dealt by key range and sorted; a window walks each range and keeps
the stack of open rules as one ``last`` value for each nesting level. What is open where a
range begins is found from the prefixes of its first key, so ranges are independent.

Two sweeps: over distinct hosts (which rule hosts are open), then over distinct pairs of open
rule host and path (which rule is innermost). Probes are distinct before they are dealt, so a
host with a third of the rows is one probe; the join back is an ordinary equi join that
adaptive execution splits. Nothing is broadcast by hint.

Defined cases: null url or one without ``://`` has empty host and path; a rule given twice
counts once, and blocks if both verdicts are given; rules with a null host, path or verdict
are left out; with no rules, every url gets the default. Among fitting rules the longest
rule string wins, then the longer host. Further columns of the input are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotweave.session import durable

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.translate(F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _binary(key: Column) -> Column:
    return F.encode(key, "utf-8")


def nested(probes: DataFrame, rules: DataFrame, prefixes: Column) -> DataFrame:
    """(key, stack): the rule keys whose prefix intervals hold ``key``, outermost first.

    ``probes`` and ``rules`` have one distinct string column ``key``. ``prefixes`` lists, from
    a column ``first``, every prefix of a key that may be a rule key.
    """
    empty = F.array().cast("array<string>")
    marks = (
        probes.select("key", F.lit(1).alias("kind"), _binary(F.col("key")).alias("at"))
        .unionByName(rules.select("key", F.lit(0).alias("kind"), _binary(F.col("key")).alias("at")))
        .unionByName(rules.select("key", F.lit(2).alias("kind"), F.concat(_binary(F.col("key")), F.unhex(F.lit("FF"))).alias("at")))
    )
    # written down once: where ranges are cut depends on a sample
    marks = durable(marks.repartitionByRange("at", "kind").withColumn("range", F.spark_partition_id()))
    heads = marks.groupBy("range").agg(F.min(F.struct("at", "kind")).alias("head"))
    # an end's key is its rule's key and one byte that no text has
    head = F.when(F.col("head.kind") == 2, F.expr("substring(head.at, 1, length(head.at) - 1)")).otherwise(F.col("head.at"))
    heads = heads.select("range", F.col("head.kind").alias("head_kind"), F.decode(head, "utf-8").alias("first"))
    open_ = (
        heads.select("range", "head_kind", "first", F.explode(prefixes).alias("key"))
        .join(rules, "key")
        .where((F.col("head_kind") != 0) | (F.col("key") != F.col("first")))
        .groupBy("range")
        .agg(F.sort_array(F.collect_set(F.struct(F.length("key").alias("n"), "key"))).alias("held"))
        .select("range", F.col("held.key").alias("carry"))
    )
    walk = Window.partitionBy("range").orderBy("at", "kind")
    placed = marks.join(open_, "range", "left").withColumn("carry", F.coalesce("carry", empty))
    step = F.when(F.col("kind") == 0, 1).when(F.col("kind") == 2, -1).otherwise(0)
    depth = F.size("carry") + F.sum(step).over(walk)
    leveled = placed.withColumn("depth", depth)
    deepest = leveled.agg(F.max("depth")).first()[0] or 0
    slots = [
        F.coalesce(
            F.last(F.when((F.col("kind") == 0) & (F.col("depth") == d), F.col("key")), ignorenulls=True).over(walk),
            F.try_element_at("carry", F.lit(d)),
        )
        for d in range(1, deepest + 1)
    ]
    stack = F.slice(F.array(*slots), F.lit(1), F.col("depth")) if slots else empty
    return leveled.withColumn("stack", stack).where("kind = 1").select("key", "stack")


def _host_prefixes() -> Column:
    labels = F.split(F.col("first"), r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit("."))
    )


def _text_prefixes() -> Column:
    return F.transform(F.sequence(F.lit(1), F.length("first")), lambda n: F.substring(F.col("first"), F.lit(1), n))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict) for every row of ``pages``; ``rules`` has host, path, verdict."""
    urls = pages.select(key, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rules = (
        rules.dropna(subset=["host", "path", "verdict"])
        .select(F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "verdict")
        .groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("hkey", host_key(F.col("rule_host")))
        .withColumn("rule_key", F.concat("hkey", F.lit("\u0000"), "rule_path"))
    )
    hosts = urls.select("host").distinct().withColumn("key", host_key(F.col("host")))
    stacks = nested(hosts.select("key"), rules.select(F.col("hkey").alias("key")).distinct(), _host_prefixes())
    open_hosts = stacks.where(F.size("stack") > 0).join(hosts, "key").select("host", F.explode("stack").alias("hkey"))

    spots = urls.select("host", "path").distinct().join(open_hosts, "host")
    spots = spots.withColumn("key", F.concat("hkey", F.lit("\u0000"), "path"))
    inner = nested(spots.select("key").distinct(), rules.select(F.col("rule_key").alias("key")), _text_prefixes())
    inner = inner.where(F.size("stack") > 0).select("key", F.try_element_at("stack", F.lit(-1)).alias("rule_key"))
    fitting = (
        spots.join(inner, "key")
        .join(rules, "rule_key")
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.length("rule_host") + F.length("rule_path")).alias("n"),
                    F.length("rule_host").alias("h"),
                    F.concat("rule_host", "rule_path").alias("rule"),
                    "verdict",
                )
            ).alias("best")
        )
    )
    judged = urls.join(fitting, ["host", "path"], "left")
    return judged.select(
        key, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
