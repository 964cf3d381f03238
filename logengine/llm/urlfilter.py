"""URL filters: listed rules first, then association rules mined by FP-growth.

A listed rule names a host (and all its subdomains) and the beginning of a path; the longest one
that fits decides. The URLs that listed rules decide are the labels: Spark's FP-growth mines
combinations of URL tokens and a verdict from them. Rules with a verdict as consequent are kept by
support and confidence, and dropped if a rule with one token less is as confident. The kept rules
are put into an inverted index (token -> rules); the distinct token sets of all URLs look their
tokens up there, a rule matches where all its tokens were found, and the most confident match
decides what no listed rule has decided.

Every URL has one token of each of ``KINDS`` at most, so a set has under ``2 ** len(KINDS)``
subsets, and there are under ``2 ** len(KINDS) / MIN_SUPPORT`` frequent sets: the index has a
proven bound, whatever the data, and is broadcast. URLs are grouped to distinct token sets before
they are matched; a host or URL with most rows is one of them.

Defined results: a null url or one without ``://`` has empty host and path and no tokens, and gets
the default verdict; repeated rows are judged alike; without labels there are no learned rules;
an empty table gives an empty result; other columns are passed through unless named like a result.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logengine.llm.common import checkpointed

#: Listed rules: (verdict, host and path).
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
KINDS = ("tld", "domain", "sub", "host", "first", "depth", "leaf", "ext", "query")
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.9
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MARK = "= "
_RESULTS = ("host", "path", "rule", "verdict", "learned", "confidence")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), _UPPER, _LOWER)
    return host, F.regexp_extract(url, pattern, 2)


def listed(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest listed rule that fits, or null."""
    chosen = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):  # longer ones are asked first
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Sorted tokens ``kind:value`` of a URL, one of each kind at most."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    leaf = F.coalesce(F.get(segments, F.size(segments) - 1), F.lit(""))
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    names = F.array_join(
        F.array_sort(F.array_distinct(F.transform(F.split(query, "&"), lambda q: F.substring_index(q, "=", 1)))), "&"
    )
    values = {
        "tld": F.get(labels, n - 1),
        "domain": F.when(n >= 2, F.array_join(F.slice(labels, n - 1, F.lit(2)), ".")),
        "sub": F.when(n >= 3, F.get(labels, F.lit(0))),
        "host": F.when(n >= 3, host),
        "first": F.get(segments, F.lit(0)),
        "depth": F.size(segments).cast("string"),
        # Runs of digits are all alike but for their first digit and their number.
        "leaf": F.regexp_replace(F.regexp_replace(leaf, r"\p{L}+", "a"), r"(?<=\d)\d", "9"),
        "ext": F.regexp_extract(leaf, r"\.(\w+)$", 1),
        "query": names,
    }
    made = [F.when(values[k] != "", F.concat(F.lit(f"{k}:"), values[k])) for k in KINDS]
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_compact(F.array(*made))))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (tokens, verdict, confidence, support) mined from (tokens, verdict)."""
    schema = "tokens array<string>, verdict string, confidence double, support double"
    baskets = checkpointed(
        labelled.where("verdict IS NOT NULL").select(
            F.concat("tokens", F.array(F.concat(F.lit(_MARK), F.col("verdict")))).alias("items")
        )
    )
    if not baskets.limit(1).count():
        return baskets.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    mark = F.get("consequent", F.lit(0))
    found = model.associationRules.where(mark.startswith(_MARK)).select(
        F.array_sort("antecedent").alias("tokens"),
        F.substring(mark, len(_MARK) + 1, 1 << 20).alias("verdict"),
        "confidence",
        "support",
    )
    # A verdict may be among the conditions of a rule for it only if verdicts could go together.
    found = checkpointed(found.where(~F.exists("tokens", lambda t: t.startswith(_MARK))))
    shorter = found.select("tokens", "verdict", F.col("confidence").alias("_c"))
    less = found.select(
        "tokens", "verdict", "confidence", "support",
        F.explode_outer(F.transform("tokens", lambda t: F.array_except("tokens", F.array(t)))).alias("_less"),
    )
    beaten = (
        less.join(shorter.withColumnRenamed("tokens", "_less"), ["_less", "verdict"])
        .where("_c >= confidence").select("tokens", "verdict").distinct()
    )
    return found.join(beaten, ["tokens", "verdict"], "left_anti").select("tokens", "verdict", "confidence", "support")


def match(baskets: DataFrame, rules: DataFrame) -> DataFrame:
    """(basket, learned, verdict, confidence) of each of ``baskets`` (basket, tokens) that a rule
    matches: the most confident, then best supported, then longest, then last by name."""
    index = rules.select(
        F.explode("tokens").alias("token"), F.array_join("tokens", " ").alias("learned"),
        F.size("tokens").alias("size"), "verdict", "confidence", "support",
    )
    hits = baskets.select("basket", F.explode("tokens").alias("token")).join(F.broadcast(index), "token")
    whole = (
        hits.groupBy("basket", "learned", "verdict")
        .agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size"), F.first("confidence").alias("confidence"),
             F.first("support").alias("support"))
        .where("n = size")
    )
    best = whole.groupBy("basket").agg(F.max(F.struct("confidence", "support", "size", "learned", "verdict")).alias("b"))
    return best.select("basket", "b.learned", F.col("b.verdict").alias("_verdict"), "b.confidence")


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]] = RULES,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    default: str = DEFAULT,
) -> DataFrame:
    """``pages`` (url, ...) with host, path, rule (listed or null), verdict, learned (the tokens of
    the mined rule that decided, or null) and confidence."""
    host, path = split_url(F.col("url"))
    own = [c for c in pages.columns if c not in _RESULTS]
    parsed = pages.select(*own, host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("_listed", listed(F.col("host"), F.col("path"), rules)).withColumn(
        "_tokens", tokens(F.col("url"), F.col("host"), F.col("path"))
    )
    parsed = checkpointed(parsed.withColumn("basket", F.array_join("_tokens", " ")))
    mined = mine(
        parsed.select(F.col("_tokens").alias("tokens"), F.col("_listed.verdict").alias("verdict")),
        min_support, min_confidence,
    )
    open_ = parsed.where("_listed IS NULL").groupBy("basket").agg(F.first("_tokens").alias("tokens"))
    learned = match(open_, mined)
    joined = parsed.join(learned, "basket", "left")
    free = F.col("_listed").isNull()
    return joined.select(
        *own, "host", "path", F.col("_listed.rule").alias("rule"),
        F.coalesce(F.col("_listed.verdict"), F.col("_verdict"), F.lit(default)).alias("verdict"),
        F.when(free, F.col("learned")).alias("learned"), F.when(free, F.col("confidence")).alias("confidence"),
    )
