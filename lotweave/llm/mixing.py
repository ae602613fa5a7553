"""Mixing sources to target weights: how often the mix takes each document, by pivotal dependent rounding.

Sources in the order of their code points (null last) weigh ``weights``, repeating, and share ``budget`` times all
sizes; a target stops at ``limit`` times its source's size and the excess goes to the others by weight. A source's target
over its size is the number of copies each of its documents should have: a whole part, and a fraction that is rounded.

Pivotal rounding pairs two fractional documents and moves words from one to the other, up to where
one of them is taken or left. Of the two directions one is drawn so that neither expectation changes. The words of
the pair stay what they were, whatever their sizes, so a source's total is exact but for half
of the one document that remains fractional at the end, and every other document's expectation is its fraction.

The reduction tree: a source's documents are dealt into groups of about ``GROUP`` by a hash, each group settles
all but one, and the remaining ones are dealt again, until one a source is left, which goes to the
nearer whole number. A hot source is many groups. Groups follow from ids, texts and counts, and draws from a document's
place in its group by size, id and text, so reruns agree however the rows are partitioned.

Large documents meet first, so that what stays fractional can be filled by smaller ones.

Equal rows (id, source, text) are numbered, so each is a document of its own. Defined cases: a null or wordless text has size 0 and nothing is taken; a source without words has target 0; null ids are carried; an empty table gives no rows; further columns are
not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotweave.session import durable, ship_package

GROUP = 4096
#: A table of so many sources at most is broadcast.
SOURCES = 1 << 14
WORDS = r"[^\x20\x09-\x0D]+"


def ranked(sources: DataFrame, order: Column) -> DataFrame:
    """Add ``rank`` from 0 along ``order``: a range sort, then the rows of the partitions before."""
    at = F.monotonically_increasing_id()
    ranged = durable(sources.repartitionByRange(order).sortWithinPartitions(order).withColumn("_at", at))
    parts = ranged.groupBy(F.shiftright("_at", 33).alias("_part")).count()
    before = F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # one row a partition
    starts = parts.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    placed = ranged.withColumn("_part", F.shiftright("_at", 33)).join(starts, "_part")
    return placed.withColumn("rank", F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_start")


def targets(sources: DataFrame, weights: tuple[int, ...], budget: float, limit: float) -> DataFrame:
    """Add ``target`` to (source, source_size): shares of the budget by weight, none above ``limit`` times its size.

    All sources below their limit have one target a unit of weight. Each round works it out from those still
    below and stops those that it would lift over their limit.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    order = F.col("source").asc_nulls_last()
    known = durable(ranked(sources, order).withColumn("_weight", weight).withColumn("_cap", F.col("source_size") * float(limit)))
    total = known.agg(F.sum("source_size")).first()[0] or 0
    unit = 0.0
    while True:
        full = F.col("_cap") <= F.col("_weight") * F.lit(unit)
        held, open_weight = known.agg(F.sum(F.when(full, F.col("_cap"))), F.sum(F.when(~full, F.col("_weight")))).first()
        if not open_weight:
            break
        raised = (budget * total - (held or 0.0)) / open_weight
        if raised <= unit * (1 + 1e-12):
            break
        unit = raised
    return known.withColumn("target", F.least("_cap", F.col("_weight") * F.lit(unit))).withColumnRenamed("rank", "place").drop("_weight", "_cap")


def settle(share: np.ndarray, size: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounded shares, and the place of the one that stays fractional (-1: none).

    ``share`` lies in [0, 1]; words move between the one that stayed fractional so far and the next.
    """
    share = share.copy()
    open_ = -1
    for k in np.flatnonzero((share > 0) & (share < 1) & (size > 0)).tolist():
        if open_ < 0:
            open_ = k
            continue
        i, si, sk = open_, size[open_], size[k]
        up = min((1 - share[i]) * si, share[k] * sk)
        down = min(share[i] * si, (1 - share[k]) * sk)
        if draws[k] * (up + down) < down:
            full, other = (1 - share[i]) * si, share[k] * sk
            share[i], share[k] = (1.0 if full <= other else share[i] + up / si), (0.0 if other <= full else share[k] - up / sk)
        else:
            empty, other = share[i] * si, (1 - share[k]) * sk
            share[i], share[k] = (0.0 if empty <= other else share[i] - down / si), (1.0 if other <= empty else share[k] + down / sk)
        still = [x for x in (i, k) if 0 < share[x] < 1]
        open_ = still[0] if still else -1
    return share, open_


def _settle_group(level: int, seed: int, last: bool):
    """A group's documents, all but one settled; the last group of a source settles that one too."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "descending"), ("mark", "ascending"), ("nth", "ascending")])
        place, own = group.column("place")[0].as_py(), group.column("grp")[0].as_py()
        draws = np.random.default_rng([seed, level, place, own]).random(len(group))
        share, open_ = settle(group.column("share").to_numpy(), group.column("size").to_numpy(), draws)
        if last and open_ >= 0:
            share[open_] = np.round(share[open_])
        return group.set_column(group.column_names.index("share"), "share", pa.array(share))

    return run


def numbered(docs: DataFrame, key: str) -> DataFrame:
    """(key, source, size, mark, nth): equal rows are added up before the shuffle and numbered, so no group of them is one key."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = docs.select(
        key, F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("size"),
        F.xxhash64(F.col(key).cast("string"), text).alias("mark"),
    )
    equal = named.groupBy(key, "source", "size", "mark").count()
    return equal.select(key, "source", "size", "mark", F.explode(F.sequence(F.lit(1).cast("long"), "count")).alias("nth"))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, limit: float = 2.0, seed: int = 20240229, key: str = "doc_id"
) -> DataFrame:
    """(key, source, size, source_size, target, copies, taken) for every document."""
    ship_package(docs.sparkSession)
    rows = durable(numbered(docs, key))
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("n"))
    shares = F.coalesce(F.expr("target / nullif(source_size, 0)"), F.lit(0.0))
    known = durable(targets(totals, weights, budget, limit).withColumn("share", shares))
    n_sources, most = known.agg(F.count("*"), F.max("n")).first()
    sources = known.withColumnRenamed("source", "_source")
    if n_sources <= SOURCES:
        sources = F.broadcast(sources)
    whole = F.floor("share")
    each = rows.join(sources, rows["source"].eqNullSafe(sources["_source"])).drop("_source")
    each = each.withColumn("whole", whole).withColumn("share", F.when(F.col("size") > 0, F.col("share") - whole).otherwise(0.0))
    fractional = (F.col("share") > 0) & (F.col("share") < 1)

    done, left, level = each.where(~fractional), each.where(fractional), 0
    while most:
        groups = F.ceil(F.col("n") / F.lit(float(GROUP)))
        dealt = left.withColumn("grp", F.pmod(F.xxhash64("mark", "nth", F.lit(level)), groups))
        run = _settle_group(level, seed, most <= GROUP)
        settled = durable(dealt.groupBy("place", "grp").applyInArrow(run, dealt.schema).drop("grp"))
        done = done.unionByName(settled.where(~fractional))
        left = settled.where(fractional).withColumn("n", groups)
        most, level = (-(-most // GROUP) if most > GROUP else 0), level + 1
    copies = (F.col("whole") + F.col("share").cast("long")).alias("copies")
    named = done.select(key, "source", "size", "source_size", "target", copies)
    return named.withColumn("taken", F.col("copies") * F.col("size"))
