"""Boolean search, set operations and the worklist."""

import pytest
from pyspark.sql import functions as F

from snowlit.functions.terms import all_of, any_of, has_concept, has_keyword, has_topic
from snowlit.operators.postings import (
    a_and_b,
    a_or_b,
    ban_complements,
    cap_per_term,
    complement,
    match_saved_searches,
    require_known_terms,
    seen_universe,
    term_counts,
)
from snowlit.operators.works import (
    filter_open_access,
    filter_relevant,
    filter_year,
    find_topics,
    matching_works,
    search_works,
)
from snowlit.operators.worklist import (
    check_dois,
    first_occurrence,
    merge_worklists,
    split_errors,
    write_split,
)
from snowlit.schemas import WORKS

ROWS = [
    ("10.1/a", "Polymer sponges", ("u",), 2001, True, ["T1", "T2"], ["C9"], "poly text"),
    ("10.1/b", "Water", (None,), 2005, True, ["T1"], None, None),
    ("10.1/c", None, None, None, None, None, ["C9"], "POLYMER in the text"),
    ("10.1/d", "polymers", ("u",), 2010, False, ["T2"], [], ""),
    ("", "no doi", ("u",), 2001, True, ["T1"], [], "polymer"),
    (None, "no doi", ("u",), 2001, True, ["T1"], [], "polymer"),
]


@pytest.fixture(scope="module")
def works(spark):
    return spark.createDataFrame(ROWS, WORKS)


def found(df):
    return sorted(r.doi for r in df.select("doi").distinct().collect())


def matching(works, condition):
    return found(works.filter("doi <> ''").filter(condition))


def test_terms_are_never_null(works):
    flags = works.select(has_topic("T1"), has_concept("C9"), has_keyword("polymer"))
    assert all(v is not None for row in flags.collect() for v in row)


def test_keyword_is_a_case_insensitive_phrase(works):
    assert matching(works, has_keyword("POLYMER")) == ["10.1/a", "10.1/c", "10.1/d"]
    assert matching(works, has_keyword("in the text")) == ["10.1/c"]


def test_boolean_identities(works):
    a, b = has_topic("T1"), has_keyword("poly")
    assert matching(works, ~(a & b)) == matching(works, ~a | ~b)
    assert matching(works, ~(a | b)) == matching(works, ~a & ~b)
    assert matching(works, ~a & b) == matching(works, b & ~a)
    assert sorted(matching(works, a) + matching(works, ~a)) == ["10.1/a", "10.1/b", "10.1/c", "10.1/d"]


def test_conditions_equal_set_operations(works):
    a, b = has_topic("T1"), has_keyword("poly")
    rows = works.filter("doi <> ''")
    left, right = rows.filter(a).select("doi"), rows.filter(b).select("doi")
    assert found(a_and_b(left, right)) == matching(works, a & b)
    assert found(a_or_b(left, right)) == matching(works, a | b)
    assert found(complement(rows.select("doi"), left)) == matching(works, ~a)


def test_empty_term_lists_match_nothing(works):
    assert matching(works, all_of([])) == []
    assert matching(works, any_of([])) == []


def test_search(works):
    everything = {"open_access_only": False}
    assert found(search_works(works, topics="T1", **everything)) == ["10.1/a", "10.1/b"]
    assert found(search_works(works, topics=["T1", "T2"], **everything)) == ["10.1/a"]
    assert found(search_works(works, keywords="polymer", **everything)) == ["10.1/a", "10.1/c", "10.1/d"]
    assert found(search_works(works, keywords="polymer")) == ["10.1/a"]
    assert found(search_works(works, "T1", "water")) == ["10.1/b"]
    assert found(search_works(works, "T1", year_min=2002, year_max=2005)) == ["10.1/b"]
    assert [r.doi for r in search_works(works, "T1", max_papers=1).collect()] == ["10.1/a"]


def test_search_without_terms_is_empty(works):
    for terms in ({}, {"topics": []}, {"topics": " "}, {"topics": "T1", "keywords": []}):
        assert found(search_works(works, open_access_only=False, **terms)) == []


def test_topic_identifiers_are_checked(works):
    with pytest.raises(ValueError):
        search_works(works, topics="polymer")


def test_documented_search(works):
    three = any_of([has_keyword(k) for k in ("poly", "polymer", "polymers")])
    assert found(search_works(works, ["T1", "T2"], three)) == ["10.1/a"]


def test_open_bounds_still_drop_unknown_years(works):
    assert found(filter_year(works, 0, None).filter("doi <> ''")) == ["10.1/a", "10.1/b", "10.1/d"]


def test_open_access_drops_null(works):
    assert found(filter_open_access(works).filter("doi <> ''")) == ["10.1/a", "10.1/b"]


def test_copies_count_once(works):
    copies = works.unionAll(works).unionAll(works)
    assert matching_works(copies, "T1").count() == 6
    assert [r.doi for r in search_works(copies, "T1").collect()] == ["10.1/a", "10.1/b"]


def test_find_topics_keeps_last_code_of_a_name(spark):
    rows = [
        ("https://openalex.org/T1", "Water treatment"),
        ("https://openalex.org/T2", "Water treatment"),
        ("https://openalex.org/T3", "Treatment of water"),
        ("https://openalex.org/T4", "Fire"),
    ]
    topics = spark.createDataFrame(rows, "id STRING, display_name STRING")
    got = {(r.name, r.code, r.score) for r in find_topics(topics, " water  Treatment").collect()}
    assert got == {("Water treatment", "T2", 3), ("Treatment of water", "T3", 2)}
    assert find_topics(topics, "water treatment", 2).count() == 1


def test_unreadable_reply_is_not_relevant(spark):
    rows = [(1, '{"relevant": true}'), (2, '{"relevant": false}'), (3, "yes"), (4, None), (5, "{}")]
    replies = spark.createDataFrame(rows, "paper_id INT, reply STRING")
    assert [r.paper_id for r in filter_relevant(replies).collect()] == [1]


def posting_rows():
    hot = [("hot", f"10.1/{i:05d}") for i in range(3000)]
    return hot + [("a", f"10.1/{i:05d}") for i in range(0, 3000, 3)] + [("b", "10.1/00000"), ("b", "10.1/00007")]


@pytest.fixture(scope="module")
def postings(spark):
    return spark.createDataFrame(posting_rows(), "term STRING, doi STRING").repartition(7)


def test_cap_per_term(postings):
    kept = {}
    for row in cap_per_term(postings, 10).collect():
        kept.setdefault(row.term, []).append(row.doi)
    assert sorted(kept["hot"]) == [f"10.1/{i:05d}" for i in range(10)]
    assert sorted(kept["a"]) == [f"10.1/{i:05d}" for i in range(0, 30, 3)]
    assert sorted(kept["b"]) == ["10.1/00000", "10.1/00007"]


def saved(postings, spark, rows):
    searches = spark.createDataFrame(rows, "search_id INT, term STRING, required BOOLEAN")
    got = {}
    for row in match_saved_searches(postings, searches).collect():
        got.setdefault(row.search_id, []).append(row.doi)
    return {k: sorted(v) for k, v in got.items()}


def test_saved_searches(postings, spark, monkeypatch):
    from snowlit.operators import skew

    sets = {}
    for term, doi in posting_rows():
        sets.setdefault(term, set()).add(doi)
    rows = [
        (1, "hot", True), (1, "a", True), (1, "a", True),
        (2, "hot", True), (2, "a", False),
        (3, "none", True), (3, "hot", True),
        (4, "a", False), (4, "b", False),
        (5, "a", True), (5, "a", False),
    ]
    expected = {
        1: sorted(sets["hot"] & sets["a"]),
        2: sorted(sets["hot"] - sets["a"]),
        4: sorted(sets["hot"] - sets["a"] - sets["b"]),
    }
    assert saved(postings, spark, rows) == expected
    monkeypatch.setattr(skew, "ROWS_PER_SPLIT", 100)
    assert saved(postings.unionAll(postings), spark, rows) == expected


def test_ban_searches_as_complements(postings, spark):
    sets = {}
    for term, doi in posting_rows():
        sets.setdefault(term, set()).add(doi)
    rows = [(n, "b", False) for n in range(100, 150)]
    rows += [(4, "a", False), (4, "b", False), (5, "a", False), (6, "none", False), (7, "a", True), (None, "a", False)]
    kept = ban_complements(postings, spark.createDataFrame(rows, "search_id INT, term STRING, required BOOLEAN"))
    seen = set().union(*sets.values())
    banned = {4: sets["a"] | sets["b"], 5: sets["a"], 6: set()} | {n: sets["b"] for n in range(100, 150)}
    # What is stored grows with what is banned, not with searches times DOIs.
    assert kept.seen.count() == len(seen) and kept.exceptions.count() == sum(map(len, banned.values()))
    assert {r.search_id: r.n_dois for r in kept.counts().collect()} == {k: len(seen - v) for k, v in banned.items()}
    chosen = spark.createDataFrame([(4,), (6,), (7,)], "search_id INT")
    expected = sorted((n, d) for n in (4, 6) for d in seen - banned[n])
    assert sorted(map(tuple, kept.of(chosen).collect())) == expected
    asked = spark.createDataFrame([(n, d) for n in (4, 6, 7) for d in [*seen, "other"]], "search_id INT, doi STRING")
    assert sorted(map(tuple, kept.matching(asked).collect())) == expected



def test_universe_drops_missing(spark):
    df = spark.createDataFrame([("t", "a"), ("t", ""), ("u", None), ("u", "a")], "term STRING, doi STRING")
    assert found(seen_universe(df)) == ["a"]


def test_unknown_terms_are_named(spark):
    terms = spark.createDataFrame([("T1",), ("T9",), ("C7",)], "term STRING")
    catalogue = spark.createDataFrame([("T1",)], "code STRING")
    with pytest.raises(ValueError, match="C7, T9"):
        require_known_terms(terms, catalogue)
    require_known_terms(terms.filter("term = 'T1'"), catalogue)


def test_a_search_checks_its_topics(spark, works):
    catalogue = spark.createDataFrame([("T1",)], "code STRING")
    with pytest.raises(ValueError, match="1 terms not found in the catalogue: T404"):
        search_works(works, ["T1", "T404", has_topic("T9")], catalogue=catalogue)
    search_works(works, "T1", catalogue=catalogue)
    search_works(works, has_topic("T404"), catalogue=catalogue)


def test_worklist_keeps_first_spelling_in_order(spark):
    refs = spark.createDataFrame(
        [(2, "10.1/A"), (1, " https://doi.org/10.1/a"), (3, None), (4, ""), (5, "10.1/z")],
        "pos INT, doi STRING",
    )
    search = spark.createDataFrame([("10.1/B",), ("10.1/Z",)], "doi STRING")
    got = [tuple(r) for r in merge_worklists(refs, search).orderBy("source", "pos", "doi").collect()]
    assert got == [("10.1/a", "10.1/a", 0, 1), ("10.1/z", "10.1/z", 0, 5), ("10.1/b", "10.1/B", 1, 0)]
    exact = merge_worklists(refs, search, case_sensitive=True)
    assert sorted(r.doi for r in exact.collect()) == ["10.1/A", "10.1/B", "10.1/Z", "10.1/a", "10.1/z"]


def test_first_occurrence_keeps_the_whole_row(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z")], "doi STRING, pos INT, t STRING")
    assert sorted(map(tuple, first_occurrence(df).collect())) == [("a", 1, "y"), ("b", 2, "z")]


def test_rejected_rows_do_not_stop_the_rest(spark, tmp_path):
    rows = [(i, doi) for i, doi in enumerate(["10.1/a", None, "", "x", "https://doi.org/10.2/b"])]
    checked = check_dois(spark.createDataFrame(rows, "pos INT, doi STRING"))
    for good, bad in (split_errors(checked), write_split(checked, f"{tmp_path}/t")):
        assert sorted(r.pos for r in good.collect()) == [0, 4]
        assert good.columns == ["pos", "doi"]
        assert {r.pos: r.error for r in bad.collect()} == {
            1: "missing DOI", 2: "missing DOI", 3: "not a DOI"
        }


def test_sets_compare_dois_by_key(spark):
    left = spark.createDataFrame([("t", "10.1/A"), ("t", "https://doi.org/10.1/a"), ("t", ""), ("t", None), ("u", "10.1/b")], "term STRING, doi STRING")
    right = spark.createDataFrame([("t", " 10.1/a ")], "term STRING, doi STRING")
    dois = lambda df: sorted(r.doi for r in df.collect())
    assert dois(a_and_b(left, right)) == ["10.1/a"]
    assert dois(complement(left, right)) == ["10.1/b"]
    assert dois(a_and_b(left, right, case_sensitive=True)) == ["10.1/a"]
    assert dois(seen_universe(left)) == ["10.1/a", "10.1/b"]
    assert {r.term: r.n_dois for r in term_counts(left).collect()} == {"t": 1, "u": 1}
    searches = spark.createDataFrame([(1, "t", True)], "search_id INT, term STRING, required BOOLEAN")
    assert [tuple(r) for r in match_saved_searches(left, searches).collect()] == [(1, "10.1/a")]
