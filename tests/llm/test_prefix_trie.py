"""The trie of conversations against one made of plain dictionaries."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import clashing
from snowlit.llm import prefixtrie, queries


def brute(conversations):
    """conversations: {id: [(role, text)]} -> rows of the trie."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)

    def below(path):
        leaves, saved = 0, 0
        todo = [path]
        while todo:
            p = todo.pop()
            leaves += not kids[p]
            saved += (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
            todo += kids[p]
        return leaves, saved

    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), *below(p),
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def table(spark, conversations):
    rows = [(c, t, *turn) for c, turns in conversations.items() for t, turn in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")


def nodes_of(spark, conversations, width=None):
    turns = prefixtrie.ordered_turns(table(spark, conversations))
    lengths = spark.createDataFrame([(c, len(t)) for c, t in conversations.items()], "conv_id BIGINT, len BIGINT")
    nodes = prefixtrie.with_ends(*prefixtrie.trie(turns, lengths, width))
    return sorted(tuple(r) for r in nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes", "ends_sha256"
    ).collect())


@pytest.fixture(scope="module")
def made():
    """Long, equal, nested, single and turnless conversations; a third share a first turn."""
    out = {}
    for c in range(120):
        start = [("user", "hello é")] if c % 3 == 0 else [("user", f"start {c % 7}")]
        out[c * 3 - 50] = start + [("assistant", f"r{(c * k) % 4}") for k in range(c % 6)]
    out[1000] = [("user", "long")] * 90
    out[1001] = [("user", "long")] * 80 + [("user", "")]
    out[1002], out[1003] = [], [("", "")]
    return out


def test_trie_equals_brute_force(spark, made):
    assert nodes_of(spark, made) == brute(made)


def test_hot_nodes_long_conversations_and_a_full_sketch(spark, made, monkeypatch):
    # Every prefix looks shared, every join and sum is split, and ids come in pieces of three.
    for name, value in (("ROWS_PER_SPLIT", 5), ("TURNS", 10), ("MEMBERS", 3), ("SPLITS", 10**9)):
        monkeypatch.setattr(prefixtrie, name, value)
    assert nodes_of(spark, made, 1 << 14) == brute(made)


def test_collisions_of_the_sketch_change_nothing(spark, made, monkeypatch):
    monkeypatch.setattr(prefixtrie, "_cells", lambda depth, d1, d2, width: [
        F.pmod(F.xxhash64(F.lit(row), depth, d1, d2), F.lit(97)) + row * width for row in (0, 1)
    ])
    assert nodes_of(spark, made, 1 << 14) == brute(made)


def test_estimates_of_one_are_single(spark, made):
    rows = prefixtrie.prefixes(prefixtrie.ordered_turns(table(spark, made)))
    seen = prefixtrie.screened(rows)
    counts = seen.groupBy("depth", "d1", "d2").agg(F.count("*").alias("n"), F.bool_or("maybe_shared").alias("shared"))
    assert counts.filter("n > 1 AND NOT shared").count() == 0
    assert counts.filter("n = 1 AND NOT shared").count() > 0.9 * counts.filter("n = 1").count()


ODD = [
    (None, 0, "user", "x"), (1, None, None, None), (1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, "a", "b"), (2, None, "", ""),
    (2, 0, "a", "b"), (2, 3, "user", "z" * 100_000), (6, None, "q", None), (3, 1, "user", ""), (10, 5, None, "t"), (-4, 0, "user", "n"),
]


def test_odd_conversations(spark, tmp_path):
    rows = spark.createDataFrame(ODD, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    clashing(rows).withColumns({n: F.lit("x") for n in ("pos", "depth", "d1", "_node", "_row", "_split", "k1")}).write.parquet(f"{tmp_path}/conversations.parquet")
    (tmp_path / "none").mkdir()
    rows.limit(0).write.parquet(f"{tmp_path}/none/conversations.parquet")
    got = sorted(tuple(r) for r in queries.op11_prefix_trie(spark, str(tmp_path)).collect())

    import zlib

    plain = defaultdict(list)
    for c, t, role, text in ODD:
        if c is not None:
            plain[c].append((t is not None, t or 0, role or "", text or ""))
    plain = {c: [r[2:] for r in sorted(v)] for c, v in plain.items()}
    built = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = plain.get(base, [])[:h] + own[h:]
    assert got == brute(built)
    assert queries.op11_prefix_trie(spark, f"{tmp_path}/none").collect() == []
