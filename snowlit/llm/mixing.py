"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

The mix has as many words as its documents (or ``budget``), shared out to sources by
weight. A source is taken at most ``most`` times: what its share has beyond that goes to the
others by weight, until no share is above its bound. A source whose share is e + f times its size
(0 <= f < 1) is taken in e complete epochs; the fraction f is then filled in the order of
exponential keys -ln(u) / w, w a document's quality weight and u a uniform number made of a
hash of its id and text, so reruns agree. The document in which the budget is reached gives its
first words only, so a source's words differ from its share by less than one.

Sources are never ranked in one task, nor sorted as a whole if they are large: ranks and
budgets are running sums, dealt over ranges (:mod:`snowlit.operators.prefix`). Shares are found by
rounds of one small aggregate over the sources, of which only sums reach the driver.

Defined cases. Null or empty text: size 0, nothing taken. Null source: a source like others,
the last one. Null id: mixed like others. Null, negative or zero quality weight: the document comes
after all others of its source. Rows that repeat an id and text have equal keys; which of them is
cut is not defined, but all other rows are. All sizes 0, or an empty table: targets 0, or no rows.
Columns named as the result's are replaced; others stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snowlit.llm.common import stored
from snowlit.operators.prefix import quoted, running_sums
from snowlit.operators.skew import hot_keys, split_join

WEIGHTS, MOST = (5, 2, 1), 3
# A source with more documents is dealt over ranges of its keys.
ROWS_PER_GROUP = 10_000
WORD = r"[^\x20\x09-\x0D]+"
# A word that starts with a letter.
LETTER_WORD = r"(^|[\x20\x09-\x0D])\p{L}"

_RESULT = ("size", "source_size", "target", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def letter_share(text: Column) -> Column:
    """A plain quality weight in (0, 1]: the share of words that start with a letter."""
    letters = F.coalesce(F.regexp_count(text, F.lit(LETTER_WORD)), F.lit(0))
    return (letters + 1) / (word_count(text) + 1).cast("double")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1] made of the MD5 of the parts, each NULL an empty one."""
    digest = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + 1) / F.lit(float(1 << 52))


def sampling_key(u: Column, weight: Column) -> Column:
    """The exponential key of a document; the smallest keys are taken first."""
    usable = (weight > 0) & ~F.isnan(weight.cast("double"))
    return F.when(usable, -F.log(u) / weight.cast("double")).otherwise(F.lit(float("inf")))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, budget: int | None = None
) -> DataFrame:
    """``sizes`` (source, source_size) of distinct sources -> the same with ``weight`` and
    ``target``. Weights are given to the sources in code point order, the null one last, and
    repeat. A budget that all bounds together don't reach leaves every source at its bound."""
    order = [F.col("source").isNull(), "source"]
    ranked = running_sums(sizes, [], order, {"before": F.lit(1)})
    given = F.array(*[F.lit(w) for w in weights])
    ranked = stored(
        ranked.withColumn("weight", F.get(given, (F.col("before") % len(weights)).cast("int"))).drop("before"), "ranked-sources"
    )
    bound = F.col("source_size") * most
    total = ranked.agg(F.sum("source_size")).first()[0] or 0 if budget is None else budget
    rest, share, bounded = total, None, -1
    level = None  # words per unit of weight, as an exact fraction of two sums
    while True:
        above = F.lit(False) if level is None else bound * F.lit(level[1]) < F.col("weight") * F.lit(level[0])
        got = ranked.agg(
            F.count_if(above).alias("n"), F.sum(F.when(above, bound)).alias("bounds"),
            F.sum(F.when(~above, F.col("weight"))).alias("weights"),
        ).first()
        if got.n == bounded or not got.weights:
            break
        # Each round bounds more sources; what is left per weight only grows.
        bounded, rest, share = got.n, total - (got.bounds or 0), got.weights
        level = (float(rest), float(share))
    if share is None:
        return ranked.withColumn("target", F.lit(0.0))
    part = F.col("weight") * F.lit(float(rest)) / F.lit(float(share))
    return ranked.withColumn("target", F.least(bound.cast("double"), part))


def mix(
    docs: DataFrame,
    source: str = "source",
    size: Column | None = None,
    quality: Column | None = None,
    identity: Sequence[str] = ("doc_id", "text"),
    weights: Sequence[float] = WEIGHTS,
    most: int = MOST,
    budget: int | None = None,
    keep: Sequence[str] | None = None,
    rows_per_group: int = ROWS_PER_GROUP,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` (its source's) and ``taken``.

    ``size`` is a whole number per document, by default its words; ``quality`` its weight, by
    default :func:`letter_share` of its text. ``keep`` names the columns to be returned, by default all.
    Text moves only if it is kept.
    """
    size = word_count(F.col("text")) if size is None else size
    quality = letter_share(F.col("text")) if quality is None else quality
    columns = [c for c in (docs.columns if keep is None else keep) if c not in _RESULT]
    # One group per source, null included, as a key that is never null.
    group = F.when(quoted(source).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), quoted(source).cast("string")))
    measured = stored(
        docs.select(
            F.struct(*[quoted(c) for c in columns]).alias("row"), quoted(source).alias("source"), group.alias("group"),
            size.cast("bigint").alias("size"), sampling_key(uniform(*[quoted(c) for c in identity]), quality).alias("key"),
            F.xxhash64(*[quoted(c) for c in identity]).alias("tie"),
        ),
        "measured",
    )
    sizes = stored(
        measured.groupBy("group").agg(F.max("source").alias("source"), F.sum("size").alias("source_size")), "source-sizes"
    )
    targets = stored(source_targets(sizes, weights, most, budget), "targets").select("group", "source_size", "target")
    placed = running_sums(measured, ["group"], ["key", "tie"], {"before": F.col("size")}, rows_per_group)
    met = split_join(placed, targets, "group", ["tie"], hot_keys(measured, "group"))
    words = F.round(F.col("target")).cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size")).cast("bigint")).otherwise(F.lit(0))
    left = words - epochs * F.col("source_size") - F.col("before")
    taken = epochs * F.col("size") + F.least(F.greatest(left, F.lit(0)), F.col("size"))
    return met.select("row.*", "size", "source_size", "target", taken.cast("bigint").alias("taken"))
