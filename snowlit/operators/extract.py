"""Tables from parsed bibliographies and from model answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snowlit.functions.answers import answer_question, answer_response
from snowlit.functions.text import strip
from snowlit.operators.keys import with_plain_keys

# The bibliography entry, what is read from it, and the columns,
# header and missing-value mark of the requested CSV lines.
ENTRY = "biblStruct"
TITLE = "//title"
DOI = '//idno[@type="DOI"]'
MEASUREMENT_FIELDS = ("polymer", "drug", "water_ph", "concentration", "capacity")
NUMBER_FIELDS = ("water_ph", "concentration", "capacity")
HEADER = "POLYMER_USED,DRUG,WATER_PH,CONCENTRATION,CAPACITY"
MISSING = "NaN"

# Not allowed in XML text, so it can part the values of one evaluation.
_MARK = "\x01"

# Start and end tags of entries; comments and literal text come first, so that tags inside of
# them are none. An attribute may hold the sign that ends a tag.
_TAG = (
    r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
    rf"|</{ENTRY}\s*+>|<{ENTRY}(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
)

# Entries that need no XML parser: elements up to some depth with plain ASCII names, at most one attribute each
# and text without references, carriage returns or control characters, all tags paired. Whatever else an entry holds
# (namespaces, comments, CDATA, references, errors), the parser looks at it.
_NAME = r"[A-Za-z_][A-Za-z0-9_.-]*+"
_ATTRIBUTE = r"""(?: (?!xmlns)[A-Za-z_][A-Za-z0-9_.-]*+="[^"<&\x00-\x1F\x{D800}-\x{DFFF}\uFFFE\uFFFF]*+")?+"""
_TEXT = r"[^<>&\x00-\x08\x0B-\x1F\x{D800}-\x{DFFF}\uFFFE\uFFFF]++"
_DEPTH = 6


def _element(depth: int, name: str = _NAME) -> str:
    inner = f"|{_element(depth - 1)}" if depth > 1 else ""
    return rf"<(?<n{depth}>{name}){_ATTRIBUTE} ?>(?:{_TEXT}|<{_NAME}{_ATTRIBUTE} ?/>{inner})*+</\k<n{depth}> ?>"


def _plain_entry() -> str:
    return rf"\A{_element(_DEPTH, ENTRY)}\z"


# The first title, and the first DOI, of such an entry if there is one and it holds text only.
_PLAIN_TITLE = rf"(?s)\A(?:(?!<title[ />]).)*+<title{_ATTRIBUTE} ?>([^<]*+)</title"
_PLAIN_DOI = r"""(?s)\A(?:(?!<idno type="DOI"[ />]).)*+<idno type="DOI" ?>([^<]*+)</idno"""


def once(**columns: Column) -> list[Column]:
    """Costly columns, computed once per row even if later filters use them.

    A filter is moved below a plain projection and would compute them again; it
    cannot move below a generator.
    """
    return [F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))]


def _spans(tags: Column) -> Column:
    """The first and last tag of every entry, by first tag; no last one if it never ends.

    One pass over the tags with the open entries as a stack: an end tag closes the innermost
    one. End tags without an open entry, and entries that end in their own tag, are passed over.
    """
    numbers = F.array().cast("array<int>")
    pairs = F.array().cast("array<struct<first: int, last: int>>")
    start = F.struct(F.lit(0).alias("at"), numbers.alias("open"), pairs.alias("done"))

    def step(state: Column, tag: Column) -> Column:
        depth = F.size(state["open"])
        opens = tag.startswith(f"<{ENTRY}") & ~tag.endswith("/>")
        closes = tag.startswith(f"</{ENTRY}") & (depth > 0)
        pair = F.struct(F.get(state["open"], depth - 1).alias("first"), state["at"].alias("last"))
        return F.struct(
            (state["at"] + 1).alias("at"),
            F.when(opens, F.array_append(state["open"], state["at"]))
            .when(closes, F.slice(state["open"], 1, depth - 1))
            .otherwise(state["open"]).alias("open"),
            F.when(closes, F.array_append(state["done"], pair)).otherwise(state["done"]).alias("done"),
        )

    endless = lambda at: F.struct(at.alias("first"), F.lit(None).cast("int").alias("last"))
    return F.aggregate(
        tags, start, step, lambda state: F.array_sort(F.concat(state["done"], F.transform(state["open"], endless)))
    )


def bibliography_entries(docs: DataFrame) -> DataFrame:
    """One row per entry ``(paper_id, pos, entry, error, plain)``, those inside of others too, in the
    order in which they begin. Each has its own text, that of inner entries included; an entry
    that never ends, or is malformed XML, is flagged here because evaluating a path on it would fail
    the job. ``plain`` entries are well-formed by their pattern, which costs a small part of a parse."""
    # The text is cut once at its tags; an entry is put together from the pieces.
    cut = docs.select(
        "paper_id", *once(tags=F.regexp_extract_all("xml", F.lit(_TAG), F.lit(0)), between=F.split("xml", _TAG, -1))
    )
    units = F.transform("tags", lambda tag, i: F.concat(tag, F.get(F.col("between"), i + 1)))
    cut = cut.select("paper_id", *once(tags=F.col("tags"), units=units, spans=_spans(F.col("tags"))))

    def text(span: Column) -> Column:
        whole = F.array_join(F.slice("units", span["first"] + 1, span["last"] - span["first"]), "")
        return F.when(span["last"].isNotNull(), F.concat(whole, F.get(F.col("tags"), span["last"]))).otherwise(
            F.get(F.col("tags"), span["first"])
        )

    found = F.transform("spans", lambda s: F.struct(text(s).alias("entry"), s["last"].isNull().alias("endless")))
    entries = cut.select("paper_id", F.posexplode(found).alias("pos", "found")).select(
        "paper_id", "pos", "found.entry", "found.endless"
    )
    entries = entries.select("*", *once(plain=~F.col("endless") & F.col("entry").rlike(_plain_entry())))
    check = F.from_xml(
        F.col("entry"),
        "_bad STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"},
    )
    return entries.withColumn(
        "error",
        F.when(F.col("plain"), F.lit(None)).when(F.col("endless"), F.lit("no end tag")).when(check["_bad"].isNotNull(), F.lit("malformed XML")),
    ).drop("endless")


def extract_references(docs: DataFrame) -> DataFrame:
    """References ``(paper_id, pos, title, doi)``: first title at any depth and first
    DOI of each entry. Entries with neither are dropped; malformed ones are left to
    :func:`rejected_entries`."""
    # Of several nodes, XPath's string() takes the first in document order.
    path = (
        f"concat(boolean({TITLE}), '{_MARK}', string({TITLE}), '{_MARK}', "
        f"boolean({DOI}), '{_MARK}', string({DOI}))"
    )
    entries = bibliography_entries(docs)
    # One parse per entry; guarded so that a malformed entry is never evaluated. Of a plain entry
    # a pattern reads the same, unless its first title or DOI holds elements.
    none = F.array(F.lit("false"), F.lit(""))

    def leaf(tag: str, pattern: str) -> Column:
        value = F.regexp_extract_all("entry", F.lit(pattern), F.lit(1))
        return F.when(~F.col("entry").rlike(tag), none).when(
            F.size(value) > 0, F.array(F.lit("true"), F.get(value, F.lit(0)))
        )

    parsed = F.split(F.when(F.col("error").isNull(), F.xpath_string("entry", F.lit(path))), _MARK)
    read = F.concat(leaf("<title[ />]", _PLAIN_TITLE), leaf('<idno type="DOI"[ />]', _PLAIN_DOI))
    entries = entries.select("*", *once(read=F.when(F.col("plain"), read)))
    found = F.when(F.col("read").isNotNull(), F.col("read")).otherwise(parsed)
    values = entries.select("paper_id", "pos", *once(v=found))

    def value(at: int) -> Column:
        return F.when(F.col("v")[at] == "true", strip(F.col("v")[at + 1]))

    return values.select(
        "paper_id", "pos", value(0).alias("title"), value(2).alias("doi")
    ).filter("title IS NOT NULL OR doi IS NOT NULL")


def rejected_entries(docs: DataFrame) -> DataFrame:
    return bibliography_entries(docs).filter("error IS NOT NULL").drop("plain")


def parse_answers(documents: DataFrame) -> DataFrame:
    """Saved answer documents (column ``value``) back to question and response."""
    return documents.withColumns({
        "question": answer_question(F.col("value")),
        "response": answer_response(F.col("value")),
    }).drop("value")


def measurement_lines(responses: DataFrame) -> DataFrame:
    """Every non-empty line of every response, with its CSV fields.

    A comma inside double quotes does not part fields.
    """
    lines = responses.select(
        "paper_id", "q_idx", F.posexplode(F.split("response", "\n")).alias("line_no", "line")
    ).withColumn("line", strip(F.col("line")))
    quoted = F.contains("line", F.lit('"'))
    fields = F.when(
        quoted, F.split("line", r',(?=(?:[^"]*"[^"]*")*[^"]*\z)')
    ).otherwise(F.split("line", ","))
    return lines.filter("line <> ''").select("*", *once(fields=fields))


# A plain decimal number, whatever else a cast would take.
NUMBER = r"\A[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"


def _text(i: int) -> Column:
    value = F.regexp_replace(strip(F.col("fields")[i]), r'\A"(.*)"\z', "$1")
    return F.when(F.lower(value) != MISSING.lower(), value)


def extract_measurements(responses: DataFrame) -> DataFrame:
    """Typed measurement rows from five-field lines.

    A repeated header is dropped, the missing-value mark becomes NULL, and a line
    whose numeric fields hold anything else than numbers is prose, not data.
    """
    lines = measurement_lines(responses).filter(
        (F.size("fields") == len(MEASUREMENT_FIELDS)) & (F.upper("line") != HEADER)
    )
    values = lines.select("paper_id", "q_idx", "line_no", *once(**{
        name: _text(i) for i, name in enumerate(MEASUREMENT_FIELDS)
    }))
    for name in NUMBER_FIELDS:
        text = F.col(name)
        values = values.filter(text.isNull() | text.rlike(NUMBER))
    return values.withColumns({
        name: F.col(name).try_cast("double") for name in NUMBER_FIELDS
    })


def dedup_measurements(measurements: DataFrame) -> DataFrame:
    """One row per experimental condition, with how many lines reported it."""
    return measurements.groupBy(*MEASUREMENT_FIELDS).agg(F.count(F.lit(1)).alias("n_rows"))


def compare_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Outcome per (paper, question): same, different, only_a or only_b.

    Each run is shuffled and sorted once. Of several responses of a run to one question
    the greatest counts.
    """
    keys = ("paper_id", "q_idx")
    nullable = [k for k in keys if a.schema[k].nullable or b.schema[k].nullable]

    def side(df: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
        keyed, names = with_plain_keys(df.select(*keys, "response"), keys, nullable)
        ranked = Window.partitionBy(*names).orderBy(F.col("response").desc_nulls_last())
        first = F.lag(F.lit(True)).over(ranked).isNull()
        return keyed.withColumn("_first", first).filter("_first").select(
            *names, *[F.col(c).alias(f"{c}_{name}") for c in (*keys, "response")], F.lit(True).alias(f"has_{name}")
        ), names

    (left, names), (right, _) = side(a, "a"), side(b, "b")
    outcome = (
        F.when(F.col("has_b").isNull(), F.lit("only_a"))
        .when(F.col("has_a").isNull(), F.lit("only_b"))
        .when(F.col("response_a").eqNullSafe(F.col("response_b")), F.lit("same"))
        .otherwise(F.lit("different"))
    )
    return left.join(right, names, "full_outer").select(
        F.coalesce("paper_id_a", "paper_id_b").alias("paper_id"), F.coalesce("q_idx_a", "q_idx_b").alias("q_idx"),
        "response_a", "response_b", outcome.alias("outcome"),
    )


def run_agreement(compared: DataFrame) -> DataFrame:
    """How many pairs had each outcome, per question."""
    return compared.groupBy("q_idx", "outcome").agg(F.count(F.lit(1)).alias("n"))
