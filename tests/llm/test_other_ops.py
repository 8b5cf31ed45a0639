"""Archives, search, preferences, secrets and the pipeline."""

import gzip
import hashlib
import io
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from snowlit.llm import preferences, queries, secrets, topk, warc
from tests.llm.conftest import SCHEMA, clashing

PAGES = [
    (1, "http://a", "x" * 2000), (2, "http://b", "x" * 2000), (3, None, "x" * 2000), (3, None, "x" * 2000), (4, "u\r\nv", None), (5, "", ""),
    (None, "n", "x" * 2000), (None, "n", "y" * 1500), (6, "s", "z" * 999), (7, "s", "z" * 999), (8, "w", "é" * 500), (9, "w", "é" * 500),
    (10, "long", "WARC/1.1\r\n\r\n" * 30_000),
]


def plain_warc(rows):
    first = {}
    for r in rows:
        if r.page_id is not None:
            first[r.html] = max(r.page_id, first.get(r.html, r.page_id))
    counts = Counter(r.html for r in rows)
    out = Counter()
    for r in rows:
        raw = (r.html or "").encode()
        revisit = len(raw) >= 1000 and counts[r.html] > 1 and r.html in first and r.page_id != first[r.html]
        out[r.page_id, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first[r.html] if revisit else None] += 1
    return out


@pytest.mark.parametrize("archive_bytes", [300, 8 << 20])
def test_warc_round_trip(spark, sf, archive_bytes):
    odd = spark.createDataFrame(PAGES, "page_id BIGINT, url STRING, html STRING")
    for pages in (odd, spark.read.parquet(f"{sf}/pages.parquet"), odd.limit(0)):
        archives = warc.write_archives(warc.assign_revisits(clashing(pages)), archive_bytes)
        read = warc.read_archives(archives)
        rows = read.select(
            warc.page_of(F.col("record_id"), pages), "payload_bytes", "payload_digest", "record_type",
            warc.page_of(F.col("refers_to"), pages), "payload", "error",
        ).collect()
        assert Counter(tuple(r)[:5] for r in rows) == plain_warc(pages.collect())
        assert all(r.error is None for r in rows)
        assert all(hashlib.sha1(r.payload).hexdigest() == r.payload_digest for r in rows if r.payload is not None)


def test_warc_reader_in_any_portions_and_broken_archives():
    archive = warc.record(1, "http://a", b"one" * 500) + warc.record(2, None, b"", None) + warc.record(3, "http://c", b"one" * 500, 1)
    whole = list(warc.read_members([archive]))
    for size in (1, 7, 100):
        assert list(warc.read_members(archive[i : i + size] for i in range(0, len(archive), size))) == whole
    assert [r["record_type"] for r in whole] == ["response", "response", "revisit"] and whole[2]["payload_bytes"] == 1500
    plain = gzip.GzipFile(fileobj=io.BytesIO(archive)).read()
    assert plain.count(b"WARC/1.1\r\n") == 3
    assert list(warc.read_members([archive[:-5]]))[-1]["error"]
    assert list(warc.read_members([b"junk"]))[-1]["error"]
    assert list(warc.read_members([])) == []
    changed = gzip.compress(gzip.decompress(warc.record(1, "u", b"abcdef")).replace(b"abcdef", b"abcdeg"))
    assert "digest" in list(warc.read_members([changed]))[0]["error"]
    short = gzip.compress(gzip.decompress(warc.record(1, "u", b"abcdef"))[:-8])
    assert "early" in list(warc.read_members([short]))[0]["error"]
    bomb = warc.record(1, "u", b"0" * 3_000_000)
    assert list(warc.read_members([bomb]))[0]["payload_bytes"] == 3_000_000


def plain_top(rows, k=5):
    fine = [(r.vec_id, [math.floor(256 * float(x)) for x in r.embedding]) for r in rows
            if r.vec_id is not None and r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding)]
    out = Counter()
    for q, v in fine:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in fine if i != q and len(w) == len(v))[:k]
            for rank, (s, i) in enumerate(scores, 1):
                out[q, rank, i, -s] += 1
    return out


def test_top_k_matches_brute_force(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = vectors.collect()
    for sizes in ((8192, 1024), (64, 3)):
        got = topk.top_k(clashing(vectors), F.col("vec_id") % 50 == 0, 5, vector_rows=sizes[0], query_rows=sizes[1])
        assert Counter(map(tuple, got.collect())) == plain_top(rows)


def test_top_k_repeated_ids_in_several_blocks(spark, conf):
    """Blocks with the same ids and other vectors, one after the other in a task."""
    rows = [(1, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [0.0, 5.0]), (100, [0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>").coalesce(1)
    conf("spark.sql.shuffle.partitions", "1")
    got = topk.top_k(vectors, F.col("vec_id") == 100, 5, vector_rows=2)
    # Both rows of the query's id ask, and each meets both rows of the other.
    assert [r.score for r in got.orderBy("rank").collect()] == [327680, 327680, 0, 0]


def test_top_k_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -2.0]), (1, [1.0, -2.0]), (2, [1.0, -2.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, None), (6, [None, 1.0]),
            (None, [1.0, 1.0]), (7, [0.0, 0.0]), (8, [-1.0, 2.0]), (9, [0.001, -0.001]), (50, [0.0, 0.0]), (100, [3.0]), (150, [])]
    vectors = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>")
    got = topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)
    assert Counter(map(tuple, got.collect())) == plain_top(vectors.collect())
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_index_stops_early_on_proof():
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(40, 64))
    values = np.floor(40 * (centres[draw.integers(0, 40, 2000)] + 0.3 * draw.normal(size=(2000, 64)))).astype(np.int64)
    index = topk.ImpactIndex(values)
    ids = np.arange(2000)
    q, v, s = topk.best_of_block(index, ids, ids[:20], values[:20], 5)
    scores = values[:20] @ values.T
    for i in range(20):
        best = sorted((-scores[i, j], j) for j in range(2000) if j != i)[:5]
        assert [(-a, b) for a, b in best] == list(zip(s[q == i].tolist(), v[q == i].tolist()))


def plain_pairs(rows):
    """{(pair, part): text} with whole parts, and the trained pieces."""
    sides = defaultdict(lambda: (set(), set()))
    for pair, chosen, turn, role, text in rows:
        sides[pair][0 if chosen else 1].add(((turn is not None, turn or 0), role or "", text or ""))
    out, trained = {}, {}
    for pair, (c, r) in sides.items():
        ends = [t for t, _, _ in c ^ r]
        end = min(ends) if ends else None
        parts = {"prompt": [x for x in c if end is None or x[0] < end], "chosen": [x for x in c if end is not None and x[0] >= end],
                 "rejected": [x for x in r if end is not None and x[0] >= end]}
        for part, turns in parts.items():
            if turns:
                out[pair, part] = "".join(f"<|{role}|>\n{text}<|end|>\n" for _, role, text in sorted(turns))
                trained[pair, part] = [f"{text}<|end|>" for _, role, text in sorted(turns) if role == "assistant" and part != "prompt"]
    return out, trained


SIDES = [
    (1, True, 0, "user", "hi"), (1, False, 0, "user", "hi"), (1, True, 1, "assistant", "good"), (1, False, 1, "assistant", "bad"), (1, True, 1, "assistant", "good"),
    (2, True, 0, "user", "only"), (3, True, None, "system", None), (3, False, None, "system", None), (3, True, 4, None, "x"), (3, False, 5, None, "x"),
    (None, True, 0, "user", "a"), (None, False, 0, "user", "a"), (4, True, 0, "user", "same"), (4, False, 0, "user", "same"),
    *((5, side, i, "assistant" if i % 2 else "user", f"t{i}" + ("!" if i > 700 and side else "")) for side in (True, False) for i in range(1000)),
]


@pytest.mark.parametrize("block", [256, 3])
def test_preferences(spark, sf, block):
    odd = spark.createDataFrame(SIDES, "pair_id BIGINT, chosen BOOLEAN, turn BIGINT, role STRING, text STRING")
    given = preferences.sides_of(clashing(spark.read.parquet(f"{sf}/conversations.parquet")))
    for sides in (odd, given, odd.limit(0)):
        text, spans = defaultdict(str), defaultdict(list)
        for r in sorted(preferences.format_pairs(sides, block).collect(), key=lambda r: r.block):
            assert r.start == len(text[r.pair_id, r.part])
            text[r.pair_id, r.part] += r.text
            spans[r.pair_id, r.part] += [r.text[s.start : s.end] for s in r.trained]
        assert (dict(text), dict(spans)) == plain_pairs([tuple(r) for r in sides.select("pair_id", "chosen", "turn", "role", "text").collect()])


def test_secrets_on_held_out_findings(spark, sf):
    import random

    draw = random.Random(6)
    word = lambda: "".join(draw.choice(["th", "in", "er", "an", "re", "on", "at", "en"]) for _ in range(draw.randint(1, 10)))
    rows = []
    for i in range(300):
        words = [word() for _ in range(60)]
        if i % 3 == 0:
            words.insert(20, f'{draw.choice(["token", "api_key", "password"])} = "{draw.getrandbits(160):040x}"')
        if i % 3 == 1:
            words.insert(20, f"commit {draw.getrandbits(160):040x}")
        rows.append((i, " ".join(words), "en", "src/app.py", 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    surprise, dictionary = secrets.statistics(docs)
    found = secrets.candidates(docs, surprise, dictionary)
    truth = F.col("candidate").rlike("^[0-9a-f]{40}$") & (F.col("doc_id") % 3 == 0)
    labelled = found.filter("doc_id < 150").select("features", truth.cast("int").alias("label"))
    judged = secrets.judge(found.filter("doc_id >= 150"), secrets.train(labelled)).withColumn("truth", truth).collect()
    assert sum(r.truth for r in judged) == 50
    assert sum(r.kept == r.truth for r in judged) / len(judged) > 0.95
    assert sum(r.kept and r.truth for r in judged) >= 48


def test_secrets_odd_tables(odd, none, spark):
    for df in (odd, none):
        got = secrets.scan(clashing(df)).collect()
        texts = defaultdict(set)
        for r in df.collect():
            texts[r.doc_id].add(r.text)
        assert all(any(t and t[r.start : r.end] == r.candidate for t in texts[r.doc_id]) for r in got)
    want = Counter((r.doc_id, m.span()) for r in odd.collect() for m in secrets.CANDIDATE.finditer(r.text or ""))
    assert Counter((r.doc_id, (r.start, r.end)) for r in secrets.scan(odd).collect()) == want


def test_pipeline_stages(spark, sf, odd, none):
    import json

    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd, none):
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            got = queries.stored(stage(spark, docs, sf), f"test-stage-{i}")
            if i < len(corpus_pipeline.STAGES) - 1:
                assert got.dtypes == docs.dtypes
                assert {json.dumps(r.doc_id) for r in got.collect()} <= {json.dumps(r.doc_id) for r in docs.collect()}
            docs = got


def test_pipeline_stages_with_clashing_names(spark, sf, odd):
    """Extra columns with the operators' own names, and a map, go through all stages."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60).unionByName(odd)
    docs = queries.stored(clashing(docs).withColumn("a map", F.map_from_arrays(F.array(F.lit("k")), F.array("doc_id"))), "test-clashing")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        got = queries.stored(stage(spark, docs, sf), f"test-clash-{i}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert got.dtypes == docs.dtypes
        docs = got
    assert docs.count() > 50


def test_queries_are_whole(spark, sf):
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in ("op2_pii", "op3_quality_rules", "op7_simhash", "op8_token_ids", "op9_bpe"):
        assert queries.QUERIES[name](spark, sf).count() == n, name
    assert corpus_pipeline.run(spark, sf).select("doc_id").distinct().count() <= n


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_queries_match_their_sql(spark, sf, name):
    from checks.compare import compare, duck

    problem, n = compare(spark, duck(sf), sf, name, queries.QUERIES[name], queries.ORACLES[name])
    assert problem is None and n > 0
