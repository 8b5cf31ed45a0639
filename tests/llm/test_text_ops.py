"""Quality rules, fingerprints and personal data against plain Python."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from snowlit.llm import pii, quality, simhash
from tests.llm.conftest import SCHEMA, clashing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_quality(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered), failed


@pytest.mark.parametrize("table", ["documents", "odd", "none"])
def test_quality_measures(table, request):
    df = request.getfixturevalue(table)
    got = quality.quality(clashing(df)).collect()
    want = Counter((r.doc_id, *plain_quality(r.text)) for r in df.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    assert table != "documents" or sum(r.kept for r in got) > len(got) / 2


def test_quality_fences_are_exact_to_a_bucket_and_merge(spark, documents):
    measured = quality.measure(documents)
    half = measured.filter("doc_id % 3 = 0"), measured.filter("doc_id % 3 <> 0")
    whole = quality.sketch(measured)
    merged = quality.merge_sketches(*map(quality.sketch, half))
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, merged.collect()))
    limits = {(r.lang, r.source): r for r in quality.fences(whole).collect()}
    values = {}
    for r in measured.collect():
        values.setdefault((r.lang, r.source), []).append(r.word_chars * 1000 // r.n_words if r.n_words else 0)
    for key, v in values.items():
        v.sort()
        q1, q3 = v[-(-len(v) // 4) - 1], v[-(-3 * len(v) // 4) - 1]
        high = q3 + 3 * max(q3 - q1, 1000)
        assert abs(limits[key].word_length_high - high) <= 8 * q3 / 32 + 8


def test_quality_verdict_depends_on_the_group(spark):
    word = lambda n, i: " ".join(f"w{i}x{k}" + "a" * n for k in range(60))
    rows = [(i, word(2, i), "en", "a", 0) for i in range(20)] + [(100 + i, word(12, i), "en", "b", 0) for i in range(20)]
    rows += [(50, word(12, 50), "en", "a", 0), (51, word(2, 51), "en", "b", 0)]
    kept = {r.doc_id: r.kept for r in quality.quality(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not kept.pop(50) and not kept.pop(51) and all(kept.values())


def test_junk_does_not_set_its_own_standard(spark):
    """Three quarters of one source, and half of a tiny one, are symbols."""
    clean = lambda i: " ".join(f"w{i}x{k}" for k in range(80))
    junk = lambda i: " ".join(f"w{i}z{k} ###$$$|||" for k in range(40))
    rows = [(i, clean(i), "en", "ok", 0) for i in range(300)] + [(1000 + i, clean(1000 + i), "en", "bad", 0) for i in range(10)]
    rows += [(2000 + i, junk(i), "en", "bad", 0) for i in range(30)] + [(1500, clean(1500), "en", "tiny", 0), (2500, junk(99), "en", "tiny", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {(r.doc_id >= 2000, r.kept) for r in quality.quality(docs).collect()} == {(False, True), (True, False)}
    assert quality.keep_good(docs).count() == 311


def test_keep_good_returns_whole_rows(odd, documents):
    for df in (documents, odd):
        good = Counter(r.doc_id for r in quality.quality(df).collect() if r.kept)
        assert quality.keep_good(df).columns == df.columns
        assert Counter(r.doc_id for r in quality.keep_good(df).collect()) == good


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_groups(rows):
    fps = [(r.doc_id, plain_fingerprint(r.text)) for r in rows]
    distinct = sorted({f for _, f in fps})
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                parent[root(b)] = root(a)
    least = {}
    for doc, f in fps:
        if doc is not None:
            least[root(f)] = min(doc, least.get(root(f), doc))
    return Counter((d, f"{f:016x}", least.get(root(f))) for d, f in fps)


@pytest.mark.parametrize("table", ["documents", "odd", "none"])
def test_simhash_groups(table, request):
    df = request.getfixturevalue(table)
    got = simhash.groups(clashing(df)).select("doc_id", simhash.hex_fingerprint(simhash.F.col("fp")), "component_id")
    assert Counter(map(tuple, got.collect())) == plain_groups(df.collect())


@pytest.mark.parametrize("block", [4096, 16])
def test_simhash_links_lose_nothing(spark, block):
    import random

    draw = random.Random(5)
    seeds = [draw.getrandbits(64) for _ in range(20)]
    fps = {s ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 6))) for s in seeds for _ in range(40)}
    fps = sorted({f - (f >> 63 << 64) for f in fps})
    nodes = spark.createDataFrame([(f,) for f in fps], "fp BIGINT")
    found = simhash.links(nodes, block).collect()
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for r in found:
        parent[root(r.a)] = root(r.b)
    mask = (1 << 64) - 1
    near = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if ((a ^ b) & mask).bit_count() <= 4]
    assert near and all(root(a) == root(b) for a, b in near)
    want = {f: f for f in fps}

    def top(f):
        while want[f] != f:
            f = want[f]
        return f

    for a, b in near:
        want[top(a)] = top(b)
    assert len({root(f) for f in fps}) == len({top(f) for f in fps})


def test_components_of_a_chain_and_a_star(spark):
    from snowlit.llm.components import components

    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()}
    assert len({got[i] for i in range(61)}) == 1 and len({got[i] for i in range(100, 160)}) == 1
    assert got[0] != got[100] and got[200] == 200
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def test_one_of_each_group_stays(odd, documents, none):
    for df in (documents, odd, none):
        rows = df.collect()
        kept = simhash.drop_near_copies(df)
        assert kept.columns == df.columns
        groups = {}
        for doc, _, component in plain_groups(rows):
            groups.setdefault(component, set()).add(doc)
        ids = [r.doc_id for r in kept.collect()]
        if df is documents:
            assert len(ids) == len(set(ids))
        assert set(ids) == {c for c in groups if c is not None} | ({None} if None in groups else set())


def test_rows_that_share_an_id_stay_by_their_group(spark):
    """A repeated or missing id names several groups: each keeps one of its own rows."""
    one, two, three, four = ("alpha beta gamma", "delta epsilon zeta", "eta theta iota", "kappa lambda mu")
    rows = [(4, one), (4, one), (4, two), (2, two), (4, three), (None, three), (None, four), (None, four), (None, one), (None, "nu xi omicron")]
    df = clashing(spark.createDataFrame([(d, t, "en", None, 1) for d, t in rows], SCHEMA))
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(4, one), (2, two), (4, three), (None, four), (None, "nu xi omicron")]
    )


LOCAL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def plain_spans(text):
    text = text or ""
    digits = lambda m: [int(c) for c in m.group() if c in "0123456789"]

    def luhn(d):
        return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])) % 10 == 0

    found = [("email", *m.span()) for m in re.finditer(LOCAL, text)]
    found += [("ip", *m.span()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [("card", *m.span()) for m in re.finditer(CARD, text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [("phone", *m.span()) for m in re.finditer(PHONE, text) if 9 <= len(digits(m)) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


TRICKY = [
    "a@b.c_d@e.f", "@x.y a@@b.c x@y", "a@b a@b.c.d. x@y..z", "1.2.3.4.5.6.7.8", "256.1.1.1 01.002.3.255", "1.2.3 .4",
    "4539 1488 0343 6467", "4539-1488-0343-6467-", "45391488034364671", "+1 (499) 555-6503", "++12345678901", "+1+23456789012",
    "+1 2", "+12(((((", "a.b%c+d-e@f-g.h-i.j", "+49 30 123456.", "0 0 0 0 0 0 0 0 0 0 0 0", "1 2 3 4  5", "é1.2.3.4ü", "٣.1.2.3.4",
]


def test_base_spans_of_tricky_texts(documents):
    for text in [*TRICKY, " ".join(TRICKY), "".join(TRICKY), *(r.text for r in documents.collect())]:
        assert pii.base_spans(text) == plain_spans(text), text[:80]


@pytest.mark.parametrize("table", ["documents", "odd", "none"])
def test_pii_query_columns(table, request, documents):
    df = request.getfixturevalue(table)
    crf = pii.train(pii.label_by_patterns(documents))
    got = pii.find(clashing(df), crf).collect()
    want = Counter()
    for r in df.collect():
        spans = plain_spans(r.text)
        n = Counter(s[0] for s in spans)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want[r.doc_id, *(n[k] for k in pii.KINDS), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter(tuple(r)[:-1] for r in got) == want


def test_crf_finds_held_out_data_and_leaves_clean_text(documents):
    crf = pii.train(pii.label_by_patterns(documents))
    hit = total = 0
    for r in documents.collect():
        base = plain_spans(r.text)
        for run in pii.runs(r.text):
            path = crf.viterbi([crf.number(run)])[0]
            for word, label in zip(run, path):
                gold = [k for k, a, b in base if a < word[1] and word[0] < b]
                if gold:
                    total += 1
                    hit += pii.LABELS[label][2:] in gold
    assert total > 20 and hit / total > 0.9
    (base, spans), = pii.all_spans(crf, ["Plain words, with no data at all. In 1999 we sold 20 of 300."])
    assert base == [] and spans == []


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np

    crf = pii.Crf().fit([(pii.runs("12 34-5 a@b.c 7")[0], [0, 7, 1, 0]), (pii.runs("+1 2")[0], [7, 8])])
    run = crf.number(pii.runs("12 +1 a@b.c")[0])
    emit = crf.weights[np.array(run)].sum(axis=1)
    n = len(pii.LABELS)

    def score(path):
        if not all(crf.allowed[a, b] for a, b in zip((n, *path), path)):
            return -np.inf
        return sum(crf.moves[a, b] for a, b in zip((n, *path), path)) + sum(emit[i, b] for i, b in enumerate(path))

    best = max(itertools.product(range(n), repeat=3), key=score)
    assert tuple(crf.viterbi([run])[0]) == best


def test_mask_keeps_columns_and_rows(odd, none, documents):
    crf = pii.train(pii.label_by_patterns(documents))
    for df in (odd, none):
        got = pii.mask(df, crf)
        assert got.columns == df.columns and got.count() == df.count()
    eight = pii.mask(odd, crf).filter("doc_id = 8").first().text
    assert "@b.c" not in eight and "<EMAIL>" in eight and "<CARD>" in eight and "<IP>" in eight
    untrained = pii.train(pii.label_by_patterns(none))
    assert not untrained.trained and pii.find(odd, untrained).count() == odd.count()


def test_spans_from_long_lists_stay_apart():
    taken = sorted((i * 10, i * 10 + 5) for i in range(50))
    added = [("ip", i * 3, i * 3 + 2) for i in range(200)]
    assert pii._apart(added, taken) == [s for s in added if not any(a < s[2] and s[1] < b for a, b in taken)]


@pytest.mark.parametrize("first", [1, 255, 256, 300, 700])
def test_simhash_compares_all_of_both_sides(first):
    """Two blocks of a long list, of lengths that are no multiple of a step."""
    rng = np.random.default_rng(first)
    base = rng.integers(0, 1 << 63, first, dtype=np.uint64)
    other = rng.permutation(base) ^ np.uint64(1 << 60)
    fps = np.concatenate([base, other, rng.integers(0, 1 << 63, 150, dtype=np.uint64)])
    side = np.repeat([0, 1], [first, len(other) + 150])
    ((a, b),) = simhash._forest(fps, side)
    assert {frozenset(p) for p in zip(a.tolist(), b.tolist())} == {frozenset((x, x ^ 1 << 60)) for x in base.tolist()}
