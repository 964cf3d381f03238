"""Mixing sources to target weights by subset-sum budget fitting.

Targets: the sources in code point order (null last) weigh 3, 1, 2, repeating, and share a budget
by weight; none gets more than ``MOST`` times its own words, the excess is shared again by weight.
Each source takes all its documents as often as its target holds its whole size. What remains of
the target is fitted by document lengths: the documents of each exact length are counted, each
length gives its proportional share, the longest lengths that still fit bring the rest under a
bound, and a bounded-knapsack dynamic program over the remaining counts finds the sum nearest to
the rest. The documents of a length are taken in seeded order, as many as its count says.

Only length counts reach the program (one group of distinct lengths for each source); documents
are ranked within (source, length) cell by cell, so a hot length or source is not one task.

Defined results: null or blank texts have size 0 and are never taken; a null source is a source
of its own; equal rows are taken in no particular order among themselves, so the rows of a result
are the same at each run; an empty table gives an empty result; other columns are passed through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logengine.llm.common import cell_counts, checkpointed, n_words, ranked, seed_bucket, seeded, source_key

WEIGHTS = (3, 1, 2)
#: Words that the mix shares out, as a part of all words, in percent.
SHARE_PERCENT = 150
#: Times its own size that a source (and so a document) gives at most.
MOST = 2
SEED = 20_240_611
#: Words that are left to the dynamic program, beside the longest document.
DP_WORDS = 20_000
#: Cells that the seeded order of one (source, length) is ranked in.
BUCKETS = 1024

_PICKS = "_source string, _size long, _rounds long, _picked long, source_size long, target double"


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (_source, source_size) with ``target``. One row per source is all that the
    two unpartitioned windows see."""
    order = Window.orderBy("_source")
    weights = F.array(*(F.lit(w) for w in WEIGHTS))
    share = sources.withColumn(
        "weight", F.get(weights, ((F.row_number().over(order) - 1) % len(WEIGHTS)).cast("int")).cast("long")
    ).withColumn("cap", F.col("source_size") * MOST)
    # Sources fill up in the order of cap / weight; the first that does not fill up sets the level.
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "_source")
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    level = share.select(
        "*",
        (F.sum("source_size").over(every) * (SHARE_PERCENT / 100)).alias("budget"),
        F.coalesce(F.sum("cap").over(upto), F.lit(0)).alias("cap_before"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0))).alias("weight_left"),
    ).withColumn("level", (F.col("budget") - F.col("cap_before")) / F.col("weight_left"))
    open_level = F.min_by(
        F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level")),
        F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("cap") / F.col("weight")),
    ).over(every)
    return level.withColumn("open", open_level).select(
        "_source",
        "source_size",
        F.when(F.col("open").isNull(), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("cap").cast("double"), F.col("open") * F.col("weight")))
        .alias("target"),
    )


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int, dp_words: int = DP_WORDS) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest to ``budget``."""
    total = int((lengths * counts).sum())
    picked = np.zeros(len(lengths), np.int64)
    if budget <= 0 or not total:
        return picked
    picked[:] = [int(c) * budget // total for c in counts]
    left = budget - int((picked * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if left <= dp_words:
            break
        more = min(int(counts[i] - picked[i]), (left - dp_words) // int(lengths[i]))
        picked[i] += more
        left -= more * int(lengths[i])
    # reachable[k]: bit s is set if the first k items can add up to s words.
    most = 2 * left + 1
    mask, reachable, items = (1 << most) - 1, [1], []
    for i in np.argsort(lengths, kind="stable"):
        size, free, many = int(lengths[i]), int(counts[i] - picked[i]), 1
        while free and size < most and not reachable[-1] >> left & 1:
            many = min(many, free, (most - 1) // size)  # counts as 1, 2, 4, ... together
            if not many:
                break
            items.append((i, many))
            reachable.append((reachable[-1] | reachable[-1] << size * many) & mask)
            free, many = free - many, 2 * many
    best = next(s for d in range(left + 1) for s in (left - d, left + d) if reachable[-1] >> s & 1)
    for k in range(len(items), 0, -1):
        if not reachable[k - 1] >> best & 1:
            i, many = items[k - 1]
            picked[i] += many
            best -= many * int(lengths[i])
    return picked


def _fit(group: pd.DataFrame) -> pd.DataFrame:
    size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    group = group.sort_values("_size")
    rounds = int(target // size) if size else 0
    rest = int(np.floor(target - rounds * size + 0.5)) if size else 0
    lengths, counts = group["_size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
    some = lengths > 0
    group["_rounds"], group["_picked"] = rounds, 0
    group.loc[some, "_picked"] = fit_lengths(lengths[some], counts[some], rest)
    return group[["_source", "_size", "_rounds", "_picked", "source_size", "target"]]


def mix(docs: DataFrame, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with ``size``, ``source_size``, ``target``, ``taken``
    (words, copies counted) and ``copies``."""
    own = [c for c in docs.columns if c not in {"size", "source_size", "target", "taken", "copies"}]
    return mix_sized(docs.select(*own, n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_text")),
                     seed, buckets).drop("_text")


def mix_sized(docs: DataFrame, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """:func:`mix` of documents whose ``size`` and text hash ``_text`` are known."""
    keyed = docs.select(
        "*", source_key(F.col("source")).alias("_source"), F.col("size").alias("_size"),
        seeded(seed, F.col("doc_id"), F.col("_text")).alias("_seeded"),
    ).withColumn("_bucket", seed_bucket(F.col("_seeded"), buckets))
    cells = checkpointed(cell_counts(keyed, ["_source", "_size"], "_bucket"))
    lengths = cells.groupBy("_source", "_size").agg(F.sum("_n").alias("n"))
    sources = targets(lengths.groupBy("_source").agg(F.sum(F.col("_size") * F.col("n")).alias("source_size")))
    picks = lengths.join(sources, "_source").groupBy("_source").applyInPandas(_fit, _PICKS)
    rows = ranked(
        keyed, cells.join(picks, ["_source", "_size"]), ["_source", "_size"], "_bucket",
        [F.col("_seeded"), F.col("doc_id"), F.col("_text")], "_rank",
    )
    copies = F.when(F.col("size") == 0, 0).otherwise(
        F.col("_rounds") + F.when(F.col("_rank") <= F.col("_picked"), 1).otherwise(0)
    )
    return rows.select(
        *docs.columns, "source_size", "target", (F.col("size") * copies).cast("long").alias("taken"),
        copies.cast("int").alias("copies"),
    )
