"""Near copies of the pipeline against all pairs of five-word shingle sets."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from snowlit.llm import nearcopies
from tests.llm.conftest import SCHEMA, clashing


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(texts):
    """Least place of each place's group, and the similar pairs of different texts."""
    sets, label, pairs = list(map(shingles, texts)), list(range(len(texts))), []

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] == sets[j] or 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both) > 0:
            pairs += [(i, j)] * (texts[i] != texts[j])
            a, b = sorted((top(i), top(j)))
            label[b] = a
    return [top(i) for i in range(len(texts))], pairs


@pytest.fixture(scope="module")
def edited():
    """Families of texts with 1 to 8 of 120 words changed: similarities on both sides of 0.8."""
    rng, out = random.Random(3), []
    for _ in range(25):
        words = [f"w{rng.randrange(5000)}" for _ in range(120)]
        out.append(" ".join(words))
        for changed in (1, 2, 2, 3, 3, 4, 5, 8):
            other = list(words)
            for at in rng.sample(range(120), changed):
                other[at] = f"x{rng.randrange(10**6)}"
            out.append(" ".join(other))
    return out


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)


@pytest.mark.parametrize("block", [2048, 3])
def test_all_similar_pairs_are_linked_and_no_others(spark, edited, block):
    want, pairs = brute(edited)
    assert len(pairs) > 50 and 25 < len(set(want)) < len(edited)
    got = nearcopies.rooted(clashing(frame(spark, edited)), block=block).collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(want))


def test_pipeline_stage_drops_similar_texts_whatever_their_fingerprints(spark, edited):
    kept = corpus_pipeline.keep_one_of_near_copies(spark, frame(spark, edited), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute(edited)[0]))


def test_stage_on_odd_tables(spark, odd, none, documents):
    for df in (documents, odd, none):
        rows = df.collect()
        group, _ = brute([r.text for r in rows])
        ids = {}
        for r, g in zip(rows, group):
            ids.setdefault(g, []).append(r.doc_id)
        want = Counter(min((i for i in v if i is not None), default=None) for v in ids.values())
        kept = nearcopies.drop_near_copies(df)
        assert kept.columns == df.columns
        assert Counter(r.doc_id for r in kept.collect()) == want


def test_forest_finds_the_components_of_exact_similarity():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 62, 100, dtype=np.uint64))
    sets = [base[:80], base[:64], base[:63], base[8:88], base[20:], np.unique(rng.integers(0, 1 << 62, 80, dtype=np.uint64))]
    # 64 of 80 and 72 of 88 are similar enough; 63 of 80 is not, but 63 of 64 is; 60 of 100 and 68 of 92 are not.
    found = nearcopies.forest(sets)
    assert len(found) == 3 and {i for p in found for i in p} == {0, 1, 2, 3}


def close(x, y):
    shared = [(x ^ y) >> 8 * i & 255 == 0 for i in range(8)]
    return sum(shared[:7]) >= 3 and (x ^ y).bit_count() <= 10


def test_fingerprints_of_five_words_propose_what_they_are_close_in(spark, edited, monkeypatch):
    # Without the bands, what fingerprints alone link is compared by sets.
    monkeypatch.setattr(nearcopies, "band_keys", lambda hashes: [])
    sims = [nearcopies.simhash.fingerprint(t, shingle=5) for t in edited]
    loose = list(range(len(edited)))
    for i, j in combinations(range(len(edited)), 2):
        if close(sims[i], sims[j]):
            a, b = sorted((loose[i], loose[j]))
            loose = [a if x == b else x for x in loose]
    want = {}
    for g in set(loose):
        members = [i for i, x in enumerate(loose) if x == g]
        want |= {members[i]: members[top] for i, top in enumerate(brute([edited[m] for m in members])[0])}
    got = nearcopies.rooted(frame(spark, edited)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    _, pairs = brute(edited)
    found = sum(want[i] == want[j] for i, j in pairs)
    assert len(pairs) / 4 < found < len(pairs)  # why the bands are there
