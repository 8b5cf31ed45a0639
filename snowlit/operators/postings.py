"""Set algebra and counts over posting tables ``(term, doi)``.

Both sides of every set operation are made distinct first. That aggregation
combines copies before its shuffle, so a DOI repeated in a third of the rows
costs one row per map task, and the join after it reuses the same partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snowlit.checkpoints import work_path, write_step
from snowlit.functions.doi import graph_key
from snowlit.operators.fanout import fan_out
from snowlit.operators.skew import split_join

# Sub-groups that each term is split into before the final cut of cap_per_term.
SUBGROUPS = 32

# Unknown terms that an error shows; it counts them all.
SHOWN_TERMS = 20


def _dois(df: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """The distinct keys of the DOIs; a missing or empty one is none."""
    return df.select(graph_key(df, "doi", case_sensitive).alias("doi")).filter("doi IS NOT NULL").distinct()


def a_and_b(a: DataFrame, b: DataFrame, case_sensitive: bool = False) -> DataFrame:
    return _dois(a, case_sensitive).join(_dois(b, case_sensitive), "doi", "left_semi")


def a_or_b(a: DataFrame, b: DataFrame, case_sensitive: bool = False) -> DataFrame:
    return _dois(a.select("doi").unionAll(b.select("doi")), case_sensitive)


def complement(universe: DataFrame, a: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """DOIs of ``universe`` that are not in ``a``."""
    return _dois(universe, case_sensitive).join(_dois(a, case_sensitive), "doi", "left_anti")


def seen_universe(postings: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Every DOI that occurs in any posting."""
    return _dois(postings, case_sensitive)


def term_counts(postings: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Distinct DOIs per term. Counted per (term, doi) first, so hot terms spread."""
    key = graph_key(postings, "doi", case_sensitive)
    return postings.groupBy("term").agg(F.count_distinct(key).alias("n_dois"))


def cap_per_term(postings: DataFrame, n: int) -> DataFrame:
    """At most ``n`` DOIs per term, the first in DOI order; one row per (term, doi).

    Ranked in two steps: inside sub-groups of a term, then over the survivors, of
    which no term has more than ``n * SUBGROUPS``.
    """
    sub = F.pmod(F.xxhash64("doi"), F.lit(SUBGROUPS))
    within = Window.partitionBy("term", "_sub").orderBy("doi")
    overall = Window.partitionBy("term").orderBy("doi")
    return (
        postings.withColumn("_sub", sub)
        .withColumn("_rank", F.row_number().over(within))
        .filter(F.col("_rank") <= n)
        .withColumn("_rank", F.row_number().over(overall))
        .filter(F.col("_rank") <= n)
        .drop("_sub", "_rank")
    )


def unknown_terms(terms: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Terms with no entry in the catalogue's ``code`` column; each is checked."""
    known = catalogue.select(F.col("code").alias("term")).distinct()
    return terms.select("term").distinct().join(known, "term", "left_anti")


def require_known_terms(terms: DataFrame, catalogue: DataFrame) -> None:
    """Raise ``ValueError`` with the number of unknown terms and the first of them, if
    there are any."""
    unknown = unknown_terms(terms, catalogue)
    bad = [row.term for row in unknown.orderBy("term").take(SHOWN_TERMS)]
    if bad:
        n = len(bad) if len(bad) < SHOWN_TERMS else unknown.count()
        more = f" and {n - len(bad)} more" if n > len(bad) else ""
        raise ValueError(f"{n} terms not found in the catalogue: {', '.join(map(str, bad))}{more}")


def _whole_searches(searches: DataFrame) -> DataFrame:
    """(search_id, terms, needed): the distinct terms of each search that has an id, and how
    many of them are required."""
    return (
        searches.filter("search_id IS NOT NULL")
        .groupBy("search_id").agg(F.collect_set(F.struct("term", "required")).alias("terms"))
        .withColumn("needed", F.size(F.filter("terms", lambda t: t["required"])))
    )


def _pairs(postings: DataFrame, case_sensitive: bool) -> DataFrame:
    return postings.select("term", graph_key(postings, "doi", case_sensitive).alias("doi")).filter("doi IS NOT NULL")


def match_saved_searches(
    postings: DataFrame,
    searches: DataFrame,
    case_sensitive: bool = False,
    ban_only: bool = True,
    hot: DataFrame | None = None,
) -> DataFrame:
    """All saved searches ``(search_id, term, required)`` at once, with the keys of DOIs.

    A DOI matches a search if it has every required term and none of the banned
    ones. A search with only banned terms matches every other DOI seen; where there
    are none, ``ban_only=False`` saves the work of looking for them.

    Postings and searches meet straight from their shuffles, so adaptive execution can
    split a hot term; without it, pass ``hot_keys(postings, "term")`` as ``hot``.
    """
    terms = _whole_searches(searches).filter("needed > 0").select("search_id", "needed", F.inline("terms"))
    hits = split_join(_pairs(postings, case_sensitive), terms, "term", ["doi"], hot)
    found = (
        hits.groupBy("search_id", "needed", "doi")
        .agg(
            F.size(F.collect_set(F.when(F.col("required"), F.col("term")))).alias("hits"),
            F.count_if(~F.col("required")).alias("banned"),
        )
        .filter("hits = needed and banned = 0")
        .select("search_id", "doi")
    )
    return found.unionAll(match_ban_searches(postings, searches, case_sensitive, hot)) if ban_only else found


def match_ban_searches(
    postings: DataFrame, searches: DataFrame, case_sensitive: bool = False, hot: DataFrame | None = None
) -> DataFrame:
    """Of :func:`match_saved_searches` the searches with only banned terms: every DOI seen
    that has none of them. Each DOI gets the searches that ban it, once, and then all others."""
    bans = _whole_searches(searches).filter("needed = 0")
    terms = bans.select("search_id", F.inline("terms")).filter(~F.col("required")).select("search_id", "term")
    met = split_join(_pairs(postings, case_sensitive), terms, "term", ["doi"], hot, "left")
    seen = met.groupBy("doi").agg(F.collect_set("search_id").alias("banned"))
    everything = bans.agg(F.collect_list("search_id").alias("searches"))  # ids of searches, whatever the corpus holds
    slots = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = F.explode(F.array_except("searches", "banned")).alias("search_id")
    return fan_out(seen, everything, ["doi"], slots).select(left, "doi")


@dataclass(frozen=True)
class Complements:
    """The answer to searches with only banned terms, as what it is not.

    ``searches``: ``(search_id)``; ``seen``: ``(doi)``, the keys of all DOIs, once for all searches;
    ``exceptions``: ``(search_id, doi)``, those that a search bans. All are stored tables, whose rows grow
    with the DOIs and with what is banned, not with searches times DOIs.
    """

    searches: DataFrame
    seen: DataFrame
    exceptions: DataFrame

    def counts(self) -> DataFrame:
        """``(search_id, n_dois)``: how many DOIs each search matches. No pair is made."""
        banned = self.exceptions.groupBy("search_id").agg(F.count(F.lit(1)).alias("n"))
        matched = (F.lit(self.seen.count()) - F.coalesce("n", F.lit(0))).alias("n_dois")
        return self.searches.join(banned, "search_id", "left").select("search_id", matched)

    def matching(self, pairs: DataFrame) -> DataFrame:
        """Those of the ``pairs`` (search_id, doi) that match. DOIs are keys, as in ``seen``."""
        known = pairs.join(self.searches, "search_id", "left_semi").join(self.seen, "doi", "left_semi")
        return known.join(self.exceptions, ["search_id", "doi"], "left_anti").select(*pairs.columns)

    def of(self, chosen: DataFrame) -> DataFrame:
        """``(search_id, doi)``: all DOIs of the ``chosen`` (search_id) searches."""
        wanted = self.searches.join(chosen, "search_id", "left_semi")
        banned = self.exceptions.join(chosen, "search_id", "left_semi")
        pairs = fan_out(self.seen, write_step(wanted, work_path(chosen.sparkSession, "chosen-searches")), ["doi"])
        return pairs.join(banned, ["search_id", "doi"], "left_anti").select("search_id", "doi")


def ban_complements(
    postings: DataFrame, searches: DataFrame, case_sensitive: bool = False, hot: DataFrame | None = None
) -> Complements:
    """:func:`match_ban_searches` without its pairs: what is seen and what is banned, stored."""
    spark = postings.sparkSession
    bans = _whole_searches(searches).filter("needed = 0")
    ids = write_step(bans.select("search_id"), work_path(spark, "ban-searches"))
    terms = bans.select("search_id", F.inline("terms")).filter(~F.col("required")).select("search_id", "term")
    pairs = _pairs(postings, case_sensitive)
    seen = write_step(pairs.select("doi").distinct(), work_path(spark, "seen-dois"))
    banned = split_join(pairs, terms, "term", ["doi"], hot).select("search_id", "doi").distinct()
    return Complements(ids, seen, write_step(banned, work_path(spark, "banned-dois")))
