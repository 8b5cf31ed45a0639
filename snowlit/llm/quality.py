"""Quality rules with thresholds that follow each language and source.

Every text is measured once. Each (language, source) group then gets a quantile sketch
per measure: counts over buckets with a fixed relative width of 1/32, so two sketches
merge by adding counts, in any order, with one result. The fences of a group come from
its own quartiles, drawn towards and bounded by those of its language and of all documents, whose
sketches are the merged ones, and a join brings them back to the measured documents.

Defined cases. Null text: no words, all counts 0, so the base rules fail it. Null
language or source: a group of its own. Null or repeated ids: every row is measured and
returned by itself. Empty table: empty result. Columns beside the four named are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from snowlit.llm.common import map_rows, slices, stored, type_of

SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"

# Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Measure -> (fences on both sides, least spread). Integers in thousandths.
MEASURES = {
    "word_length": (True, 1000),
    "symbol_rate": (False, 20),
    "dup_line_rate": (False, 100),
    "repeat_rate": (False, 100),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
# A fence stands this many spreads beyond its quartile.
REACH = 3
# Documents of the larger group that count with those of a smaller one, and how many spreads
# of the language a fence may be out.
PRIOR, BOUND = 4, 3


def measure_text(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines with a word."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space only
    n = len(words)
    packed = raw.translate(None, SPACES)
    n_symbols = len(packed) - len(packed.translate(None, SYMBOLS))
    word_chars = len(text or "") - (len(raw) - len(packed))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n_dup = len(lines) - len(set(lines))
    repeat = 0
    if n >= 3:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            many = {w for w, c in Counter(windows).items() if c > 1}
            covered = 0  # words before this position are counted already
            for i, window in enumerate(windows):
                if window in many:
                    repeat += i + 3 - max(i, covered)
                    covered = i + 3
    return n, word_chars, n_symbols, n_dup, repeat, len(lines)


def measure(docs: DataFrame, doc_id="doc_id", text="text", lang="lang", source="source") -> DataFrame:
    """One row of counts for each document: its keys and the measures of its whole text."""
    kept = ["doc_id", "lang", "source"]
    keys = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"),
        F.col(lang).alias("lang"), F.col(source).alias("source"),
    )
    def make():
        def run(c):
            rows = [measure_text(t) for t in c["text"]]
            out = {k: c[k] for k in kept}
            return out | {name: [r[i] for r in rows] for i, name in enumerate(COUNTS)}

        return run

    schema = ", ".join(f"{k} {type_of(keys, k)}" for k in kept)
    return map_rows(keys, make, schema + "".join(f", {n} BIGINT" for n in COUNTS))


def measure_rows(docs: DataFrame, text="text", lang="lang", source="source") -> DataFrame:
    """As :func:`measure`, with the whole row as a struct ``row`` in place of its id."""
    fields = docs.schema.fields
    at = {name: docs.columns.index(name) for name in (text, lang, source)}
    schema = T.StructType([
        T.StructField("row", docs.schema), T.StructField("lang", fields[at[lang]].dataType),
        T.StructField("source", fields[at[source]].dataType), *[T.StructField(n, T.LongType()) for n in COUNTS],
    ])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for piece in slices(batch):
                rows = [measure_text(None if t is None else str(t)) for t in piece.column(at[text]).to_pylist()]
                row = pa.StructArray.from_arrays(piece.columns, fields=list(arrow.field("row").type))
                counts = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(COUNTS))]
                yield pa.RecordBatch.from_arrays([row, piece.column(at[lang]), piece.column(at[source]), *counts], schema=arrow)

    return docs.mapInArrow(run, schema)


def _rates() -> dict[str, F.Column]:
    """The measures as integers, 0 where there is nothing to divide by."""
    def rate(a: str, b: str):
        return F.when(F.col(b) > 0, F.expr(f"{a} * 1000 div {b}")).otherwise(0).cast("bigint")

    return {
        "word_length": rate("word_chars", "n_words"),
        "symbol_rate": rate("n_symbols", "word_chars"),
        "dup_line_rate": rate("n_dup_lines", "n_lines"),
        "repeat_rate": rate("n_repeat_words", "n_words"),
    }


def _bucket(x: F.Column) -> F.Column:
    """Exact below 64, then 32 buckets for each doubling."""
    shift = F.length(F.bin(x)) - 6
    return F.when(x < 64, x).otherwise(shift * 32 + F.call_function("shiftright", x, shift)).cast("int")


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the mergeable counts of every group."""
    rates = _rates()
    pairs = F.array(*[
        F.struct(F.lit(name).alias("measure"), _bucket(rates[name]).alias("bucket")) for name in MEASURES
    ])
    return (
        measured.select("lang", "source", F.inline(pairs))
        .groupBy("lang", "source", "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))
    )


def merge_sketches(*parts: DataFrame) -> DataFrame:
    """One sketch from several: counts of equal buckets add up."""
    all_parts = parts[0]
    for part in parts[1:]:
        all_parts = all_parts.unionByName(part)
    return all_parts.groupBy("lang", "source", "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, by: Sequence[str] = ("lang", "source")) -> DataFrame:
    """(*by, measure, q1, q3, total) of the sketches merged to the groups of ``by``."""
    merged = sketches.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    below = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    floor = F.when(F.col("bucket") < 64, F.col("bucket").cast("bigint")).otherwise(
        F.expr("shiftleft(CAST(bucket - 32 * (bucket div 32 - 1) AS BIGINT), CAST(bucket div 32 - 1 AS INT))")
    )
    ranked = merged.select(*by, "measure", floor.alias("value"), below.alias("below"), F.sum("n").over(group).alias("total"))
    return ranked.groupBy(*by, "measure").agg(
        F.min(F.when(F.col("below") * 4 >= F.col("total"), F.col("value"))).alias("q1"),
        F.min(F.when(F.col("below") * 4 >= F.col("total") * 3, F.col("value"))).alias("q3"),
        F.max("total").alias("total"),
    )


def _least() -> F.Column:
    """The least spread of the measure of a row."""
    return F.coalesce(*[F.when(F.col("measure") == name, F.lit(least)) for name, (_, least) in MEASURES.items()]).cast("bigint")


def _by_group(limits: DataFrame) -> DataFrame:
    """(lang, source, measure, low, high) -> (lang, source, <measure>_low, <measure>_high)."""
    columns = [
        F.max(F.when(F.col("measure") == name, F.col(side))).alias(f"{name}_{side}") for name in MEASURES for side in ("low", "high")
    ]
    return limits.groupBy("lang", "source").agg(*columns)


def fences(sketches: DataFrame, reach: int = REACH) -> DataFrame:
    """(lang, source, <measure>_low, <measure>_high) from the quartiles of each sketch."""
    spread = F.greatest(F.col("q3") - F.col("q1"), _least()) * reach
    return _by_group(quartiles(sketches).select("*", (F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high")))


def pooled_fences(sketches: DataFrame, reach: int = REACH, prior: int = PRIOR, bound: int = BOUND) -> DataFrame:
    """As :func:`fences`, steadied by the sketches of the language and of all documents.

    Where quartiles of a group lie further out than those of its language they are drawn towards
    them, and these towards those of all documents, as if ``prior`` documents of the larger group were in
    the smaller one. No fence is further out than ``bound`` spreads beyond the quartiles of the
    language, so a group that is mostly junk, or too small to tell, does not set its own standard.
    """

    def drawn(groups: DataFrame, larger: DataFrame, on: F.Column) -> DataFrame:
        met = groups.join(larger.withColumnsRenamed({c: f"_{c}" for c in larger.columns}), on)
        toward = lambda q: F.expr(f"(total * {q} + {prior} * _{q}) div (total + {prior})")
        return met.withColumns({"q1": F.greatest("q1", toward("q1")), "q3": F.least("q3", toward("q3"))})

    same = F.col("measure") == F.col("_measure")
    all_ = quartiles(sketches, ())
    langs = drawn(quartiles(sketches, ("lang",)), all_, same).select("lang", "measure", "q1", "q3")
    langs = langs.withColumn("spread", F.greatest(F.col("q3") - F.col("q1"), _least()))
    own = drawn(quartiles(sketches), stored(langs, "language-quartiles"), same & F.col("lang").eqNullSafe(F.col("_lang")))
    spread = F.greatest(F.col("q3") - F.col("q1"), _least()) * reach
    return _by_group(own.select(
        "lang", "source", "measure", F.greatest(F.col("q1") - spread, F.col("_q1") - F.col("_spread") * bound).alias("low"),
        F.least(F.col("q3") + spread, F.col("_q3") + F.col("_spread") * bound).alias("high"),
    ))


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Add base_failed, kept and, for those the fences stop, ``reasons``."""
    # The join has to find null groups too, and may be split where a group is large.
    keyed = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = measured.join(
        keyed, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left"
    )
    rates = _rates()
    outside = [
        F.when(
            (rates[name] > F.col(f"{name}_high")) | ((rates[name] < F.col(f"{name}_low")) if both else F.lit(False)),
            F.lit(name),
        )
        for name, (both, _) in MEASURES.items()
    ]
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    reasons = F.filter(F.array(*outside), lambda r: r.isNotNull())
    return joined.select(
        *measured.columns, failed.alias("base_failed"),
        (~failed & (F.size(reasons) == 0)).alias("kept"), reasons.alias("reasons"),
    )


def quality(docs: DataFrame, doc_id="doc_id", text="text", lang="lang", source="source", reach: int = REACH) -> DataFrame:
    """Measures and verdict of every document; see the module for the defined cases."""
    measured = stored(measure(docs, doc_id, text, lang, source), "quality-measures")
    limits = stored(pooled_fences(stored(sketch(measured), "quality-sketches"), reach), "quality-fences")
    return judge(measured, limits)


def keep_good(docs: DataFrame, doc_id="doc_id", text="text", lang="lang", source="source", reach: int = REACH) -> DataFrame:
    """The rows of ``docs`` that :func:`quality` keeps, with their columns. The second pass
    measures again instead of moving whole texts to their verdicts."""
    sketches = stored(sketch(measure(docs, doc_id, text, lang, source)), "quality-sketches")
    limits = stored(pooled_fences(sketches, reach), "quality-fences")
    return judge(measure_rows(docs, text, lang, source), limits).filter("kept").select("row.*")
