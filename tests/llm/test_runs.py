"""Periodic runs against every period at every place."""

import hashlib
import random
import zlib

from tests.llm.conftest import clashing
from snowlit.llm import queries, runs


def brute(words, min_length, min_exponent):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i >= q:
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items() if n >= max(min_length, min_exponent * q))


def cut(words, found):
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in drop]


def test_runs_equal_brute_force():
    draw = random.Random(5)
    for _ in range(250):
        texts = []
        for _ in range(draw.randint(0, 6)):
            words = [draw.choice([b"a", b"b", b"c", b"d"][: draw.randint(1, 4)]) for _ in range(draw.randint(0, 60))]
            if words and draw.random() < 0.6:
                at, p = draw.randrange(len(words)), 1 + draw.randrange(9)
                words = words[:at] + words[at : at + p] * draw.randint(1, 12) + words[: draw.randrange(len(words))]
            texts.append(words)
        length, exponent = draw.choice([(24, 3), (2, 2), (5, 2), (10, 3), (7, 4)])
        got = [[] for _ in texts]
        for doc, *run in runs.document_runs(texts, length, exponent):
            got[doc].append(tuple(run))
        assert [sorted(g) for g in got] == [brute(t, length, exponent) for t in texts]


def test_one_word_and_fibonacci_words():
    assert list(runs.document_runs([[b"1"] * 30_000])) == [(0, 0, 30_000, 1)]
    a, b = [b"a"], [b"b"]
    while len(b) < 400:
        a, b = b, b + a
    assert sorted(r[1:] for r in runs.document_runs([b], 4, 2)) == brute(b, 4, 2)


def test_small_arrays_and_questions(monkeypatch):
    draw = random.Random(2)
    texts = [[str(draw.randrange(3)).encode() for _ in range(90)] for _ in range(20)]
    whole = list(runs.document_runs(texts, 6, 2))
    monkeypatch.setattr(runs, "ARRAY_WORDS", 50)
    monkeypatch.setattr(runs, "ASKED", 7)
    assert sorted(runs.document_runs(texts, 6, 2)) == sorted(whole)


def test_odd_rows(odd, none):
    got = sorted(map(tuple, runs.find_runs(clashing(odd)).collect()), key=str)
    assert len(got) == odd.count()
    by_id = {r[0]: r for r in got}
    assert by_id[None][1:] == by_id[2][1:] == by_id[3][1:] == (0, [], "")
    assert by_id[7][1] == 30_000 and [tuple(r) for r in by_id[7][2]] == [(0, 30_000, 1)] and by_id[7][3] == "1"
    assert by_id[6][3] == "a" * 50_000
    assert runs.find_runs(none).collect() == []


def changed(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_query_equals_brute_force(spark, sf, documents, odd, tmp_path):
    odd.filter("doc_id IS NULL OR doc_id <> 7").unionByName(documents.filter("length(text) < 1500").select(odd.columns)).write.parquet(f"{tmp_path}/documents.parquet")
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = []
    for r in table.collect():
        words = changed(r.doc_id, (r.text or "").encode().split())
        found = brute(words, 24, 3)
        best = max(found, key=lambda f: (f[1] / f[2], -f[0], -f[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(found, key=lambda f: (f[0], f[2])))
        digest = lambda b: hashlib.sha256(b).hexdigest()
        rows.append((
            r.doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
            digest(lines.encode()), digest(b" ".join(cut(words, found))),
        ))
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(rows, key=str)
    assert sum(r[1] for r in rows) > 5
