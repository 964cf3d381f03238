"""Quality rules with adaptive thresholds.

Every document is measured by a few whole-text figures. For each language and source the
figures are gathered in mergeable quantile sketches (counts of log-linear integer buckets,
relative width under 1/128; sketches merge by adding counts, so they are the same in any
order and for any partitioning). A document is rejected where a figure lies far outside what is
usual in its own language and source: beyond the group's 9th decile by more than ``FENCE`` times
the way from its median to there, or below its 1st decile likewise. Where half a group or more has
a figure of zero, the rest of it makes the deciles, and zero is never an outlier. No limit is a
constant; a fixed base rule removes texts that are too short or mostly repeats. Thresholds come
from the sketches, joined back on the group.

Sketches of few documents are unsure. To every group's counts those of its language are added,
scaled to ``PRIOR`` documents, and to every language's those of the corpus; a group with many
documents speaks for itself, one with few mostly for its language, with no step in between.

Everything is built from DataFrame functions; no Python runs on the executors.

Defined results: null or blank text has no words and fails the base rule; null languages and
sources are groups of their own; where no document of a group, its language or the corpus has a
figure, or all have zero, the figure rejects nothing; repeated rows are judged one by one; an empty table gives an empty result; other columns are passed through untouched
(columns named like a result column are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logengine.llm.common import source_key, words

MIN_WORDS = 50
#: Documents that a group's language counts for in its sketch, and the corpus in a language's.
PRIOR = 100
#: A figure is an outlier beyond so many times the way from the median to the outer decile.
FENCE = 2
#: Sketch weight of one document of the group itself; PRIOR of them weigh SHARES.
SHARES = 1_000_000
_OWN = SHARES // PRIOR
#: Figures are whole numbers of parts of a million.
SCALE = 1_000_000
FIGURES = ["symbols", "dup_lines", "repeats", "capitals", "word_length"]
#: Threshold tables of up to so many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_GROUPS = 100_000

LONGS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _ratio(top: str, bottom: str) -> Column:
    return F.when(F.col(bottom) > 0, F.expr(f"{SCALE}L * {top} div {bottom}")).otherwise(F.lit(0).cast("long"))


def measure(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the base counts, ``base_failed`` and the figures ``_f_*`` (millionths)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    has_word = r"[^\x20\x09-\x0D]"
    own = [c for c in docs.columns if c not in {*LONGS, "base_failed", "kept"}]
    wide = docs.select(
        *own,
        words(text).alias("_w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(has_word)).alias("_lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("_upper"),
    ).withColumn("n_words", F.size("_w").cast("long"))
    # Three-word windows as (hash, start), sorted; equal neighbours are windows found more than once.
    windows = wide.withColumn(
        "_win",
        F.expr(
            "sort_array(CASE WHEN n_words < 3 THEN array() ELSE transform(sequence(0, size(_w) - 3), "
            "i -> named_struct('h', xxhash64(_w[i], _w[i + 1], _w[i + 2]), 'i', i)) END)"
        ),
    )
    starts = windows.withColumn(
        "_starts",
        F.expr(
            "sort_array(transform(filter(_win, (x, k) -> (k > 0 AND _win[k - 1].h = x.h) "
            "OR (k + 1 < size(_win) AND _win[k + 1].h = x.h)), x -> x.i))"
        ),
    )
    counted = starts.select(
        *own,
        "n_words",
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        # Each start covers the words up to the next start, three at most.
        F.expr(
            "CASE WHEN size(_starts) = 0 THEN 0L ELSE aggregate(_starts, "
            "named_struct('n', 3L, 'last', _starts[0]), (a, s) -> named_struct("
            "'n', a.n + least(3, s - a.last), 'last', s), a -> a.n) END"
        ).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("_n_lines"),
        "_upper",
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    figures = F.struct(
        *(F.col(c) for c in LONGS),
        failed.alias("base_failed"),
        _ratio("n_symbols", "n_words").alias("_f_symbols"),
        _ratio("n_dup_lines", "_n_lines").alias("_f_dup_lines"),
        _ratio("n_repeat_words", "n_words").alias("_f_repeats"),
        _ratio("_upper", "word_chars").alias("_f_capitals"),
        _ratio("word_chars", "n_words").alias("_f_word_length"),
        F.coalesce(source_key(F.col("lang")), F.lit("1")).alias("_lang"),
        source_key(F.col("source")).alias("_source"),
    )
    # The one-element explode keeps later filters on the figures from being moved below the
    # projections, where the optimizer would write the whole word array into each lambda.
    return counted.select(*own, F.explode(F.array(figures)).alias("_m")).select(*own, "_m.*")


def sketch_key(value: Column) -> Column:
    """Bucket of a non-negative integer: its eight leading binary digits, the rest zero."""
    drop = F.greatest(F.length(F.bin(value)) - 8, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(measured: DataFrame) -> DataFrame:
    """Quantile sketches of all documents that pass the base rule: rows
    (``_lang``, ``_source``, ``figure``, ``key``, ``n``); null source: the whole language,
    null language: the whole corpus."""
    values = measured.where(~F.col("base_failed")).select(
        "_lang",
        "_source",
        F.explode(
            F.array(
                *(F.struct(F.lit(f).alias("figure"), sketch_key(F.col(f"_f_{f}")).alias("key")) for f in FIGURES)
            )
        ).alias("v"),
    )
    cells = values.groupBy("_lang", "_source", "v.figure", "v.key").agg(F.count(F.lit(1)).alias("n"))
    return cells.groupingSets(
        [["_lang", "_source", "figure", "key"], ["_lang", "figure", "key"], ["figure", "key"]],
        "_lang", "_source", "figure", "key",
    ).agg(F.sum("n").alias("n"))


def _share(weight: str, total: str) -> Column:
    """Part of a total in SHARES, rounded down; decimals, as the product may exceed 64 bits."""
    return F.expr(f"(cast({SHARES} as decimal(7, 0)) * cast({weight} as decimal(20, 0))) div cast({total} as decimal(20, 0))")


def smoothed(sketch: DataFrame) -> DataFrame:
    """(``_lang``, ``_source``, ``figure``, ``key``, ``w``): each group's counts with those of its
    language, as weights; ``sketch`` (checkpointed) is read for each of its levels."""
    per_figure = Window.partitionBy("figure")
    corpus = sketch.where("_lang IS NULL").select(
        "figure", "key", F.col("n").alias("_n"), F.sum("n").over(per_figure).alias("_t")
    ).select("figure", "key", _share("_n", "_t").alias("_corpus"))
    of_lang = sketch.where("_lang IS NOT NULL AND _source IS NULL").select("_lang", "figure", "key", "n")
    # Keys that a group lacks are those of the levels above it: every level's keys are in the next.
    langs = _filled(of_lang, ["_lang"], corpus, [], "_corpus")
    total = Window.partitionBy("_lang", "figure")
    shares = langs.select("_lang", "figure", "key", "w", F.sum("w").over(total).alias("_t")).select(
        "_lang", "figure", "key", _share("w", "_t").alias("_language")
    )
    own = sketch.where("_source IS NOT NULL").select("_lang", "_source", "figure", "key", "n")
    return _filled(own, ["_lang", "_source"], shares, ["_lang"], "_language")


def _filled(own: DataFrame, group: list[str], above: DataFrame, on: list[str], share: str) -> DataFrame:
    """Weights of each group at all keys of the level above it."""
    figures = own.select(*group, "figure").distinct()
    every = figures.join(above, [*on, "figure"])
    return every.join(own, [*group, "figure", "key"], "left").select(
        *group, "figure", "key", (F.lit(_OWN) * F.coalesce("n", F.lit(0)) + F.col(share)).alias("w")
    ).where("w > 0")


def thresholds(sketch: DataFrame, fence: int = FENCE) -> DataFrame:
    """Per (``_lang``, ``_source``) the limits ``_low_*`` and ``_high_*`` of each figure."""
    group = Window.partitionBy("_lang", "_source", "figure")
    weighed = smoothed(sketch).select(
        "*", (2 * F.sum(F.when(F.col("key") == 0, F.col("w")).otherwise(0)).over(group) >= F.sum("w").over(group)).alias("_zeros")
    )
    ranked = weighed.where("NOT (_zeros AND key = 0)").select(
        "*",
        F.sum("w").over(group.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        F.sum("w").over(group).alias("total"),
    )

    def quantile(tenths: int) -> Column:
        return F.min(F.when(10 * F.col("upto") >= tenths * F.col("total"), F.col("key"))).alias(f"q{tenths}")

    deciles = ranked.groupBy("_lang", "_source", "figure").agg(quantile(1), quantile(5), quantile(9), F.max("_zeros").alias("_zeros"))
    width = F.expr("q5 div 128 + 1")  # of the median's bucket, the least that a sketch can tell apart
    low = F.when(F.col("_zeros"), F.lit(0)).otherwise(F.col("q1") - F.greatest(fence * (F.col("q5") - F.col("q1")), width))
    high = F.col("q9") + F.greatest(fence * (F.col("q9") - F.col("q5")), width)
    limits = deciles.withColumn("low", low).withColumn("high", high)
    return limits.groupBy("_lang", "_source").agg(
        *(
            F.max(F.when(F.col("figure") == f, F.col(side))).alias(f"_{side}_{f}")
            for f in FIGURES
            for side in ("low", "high")
        )
    )


def judge(measured: DataFrame, limits: DataFrame, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """``measured`` with ``kept``; ``limits`` (checkpointed) is broadcast only if it is small."""
    small = limits.limit(broadcast_groups + 1).count() <= broadcast_groups
    joined = measured.join(F.broadcast(limits) if small else limits, ["_lang", "_source"], "left")
    inside = F.lit(True)
    for f in FIGURES:
        inside &= F.coalesce(F.col(f"_f_{f}").between(F.col(f"_low_{f}"), F.col(f"_high_{f}")), F.lit(True))
    kept = joined.withColumn("kept", ~F.col("base_failed") & inside)
    return kept.drop("_lang", "_source", *(c for c in kept.columns if c.startswith(("_f_", "_low_", "_high_"))))
