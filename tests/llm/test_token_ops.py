"""Tokens, BPE, packing and id files against the tokenizers library."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from snowlit.llm import bpe, idfiles, packing, simple8b, tokens
from snowlit.llm.common import stored
from tests.llm.conftest import clashing

BYTE, WORD = tokens.tokenizer_path("byte_bpe_50k.json"), tokens.tokenizer_path("word_bpe_49k.json")


def random_texts(n=400):
    draw = random.Random(3)
    pool = [" ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", "\x1c", "\x1f", "\x85", "​", "'s", "'LL", "ab", "É", "é", "́",
            "12", "½", "漢字", "😀", "!?", "<|endoftext|>", "<|startoftext|>", "_", "x", "İ", "ß", "Σ", "\u0000", "�", "᠎", "﻿"]
    return ["".join(draw.choice(pool) for _ in range(draw.randint(0, 25))) for _ in range(n)]


def characters():
    """Characters between letters and blanks: all blocks but the long ones of one kind."""
    blocks = [(0, 0x3400), (0xA000, 0xAC40), (0xD780, 0x11400), (0x1D000, 0x20040), (0xE0000, 0xE0200)]
    for at in (a for start, end in blocks for a in range(start, end, 64)):
        chars = [chr(c) for c in range(at, at + 64) if not 0xD800 <= c < 0xE000]
        yield " ".join(f"a{c}b {c}{c} 1{c}" for c in chars)


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_cached_parts_give_the_library_ids(path, documents):
    plain = tokens.load_tokenizer(path)
    texts = [r.text for r in documents.collect()] + random_texts() + list(characters())
    encode = tokens.encoder(path, 7)
    for text, raw in zip(texts, encode(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == [*plain.encode(text, add_special_tokens=False).ids, 7], text[:60]


def test_own_bpe_gives_the_library_ids(documents):
    plain, own = tokens.load_tokenizer(BYTE), bpe.BytePairs(BYTE)
    texts = [r.text for r in documents.collect()] + random_texts() + ["aaaaaaa" * 999, "a" * 5001, "<|endoftext|>" * 3]
    for text, ids in zip(texts, own.encode(texts)):
        want = plain.encode(text, add_special_tokens=False).ids
        assert list(ids) == want, text[:60]
        assert own.decode(ids) == plain.decode(want, skip_special_tokens=False)


def test_own_bpe_splits_every_character_alike():
    plain, own = tokens.load_tokenizer(BYTE), bpe.BytePairs(BYTE)
    texts = list(characters())
    bad = [t for t, ids in zip(texts, own.encode(texts)) if list(ids) != plain.encode(t, add_special_tokens=False).ids]
    assert not bad, [hex(ord(t[1])) for t in bad][:20]


def test_decoding_of_broken_ids():
    plain, own = tokens.load_tokenizer(BYTE), bpe.BytePairs(BYTE)
    draw = random.Random(1)
    for _ in range(300):
        ids = [draw.randrange(50257) if draw.random() < 0.5 else own.first[draw.randrange(256)] for _ in range(8)]
        assert own.decode(ids) == plain.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("table", ["documents", "odd", "none"])
def test_round_trip_query(table, request):
    df = request.getfixturevalue(table)
    plain = tokens.load_tokenizer(BYTE)
    want = Counter()
    for r in df.collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want[r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(plain.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(map(tuple, bpe.round_trip(clashing(df), BYTE).collect())) == want


def test_encode_and_decode_tables(odd):
    encoded = bpe.encode(odd, BYTE)
    back = bpe.decode(encoded, BYTE)
    assert Counter(map(tuple, back.collect())) == Counter((r.doc_id, r.text or "") for r in odd.collect())


@pytest.mark.parametrize("values", [
    [], [0], [1] * 500, [0] * 1000, [2**64 - 1, 0, 1, 2**60, 2**60 - 1, 1], list(range(3000)), [1, 2**63] * 70, [0] * 239 + [1] * 3,
    [1 << k for k in range(64)],
])
def test_simple8b_round_trip(values):
    words = simple8b.encode(np.array(values, dtype=np.uint64))
    assert simple8b.decode(words, len(values)).tolist() == values


def test_simple8b_random_round_trip_and_size():
    draw = np.random.default_rng(4)
    for bits in (1, 3, 8, 16, 33, 60, 64):
        values = draw.integers(0, 2**bits, 5000, dtype=np.uint64) >> draw.integers(0, bits, 5000).astype(np.uint64)
        assert np.array_equal(simple8b.decode(simple8b.encode(values), 5000), values)
    assert len(simple8b.encode(np.zeros(2400, dtype=np.uint64))) == 10
    assert len(simple8b.encode(np.full(3000, 60000, dtype=np.uint64))) == 1000
    block = simple8b.pack_block([np.array([1, 2]), np.array([]), np.array([3])])
    ids, starts = simple8b.unpack_block(block)
    assert ids.tolist() == [1, 2, 3] and starts.tolist() == [0, 2, 2, 3]
    with pytest.raises(ValueError):
        simple8b.unpack_block(b"x" * 40)


@pytest.mark.parametrize("table,block_ids", [("documents", 1 << 18), ("documents", 500), ("odd", 50), ("none", 50)])
def test_id_files(table, block_ids, request):
    df = request.getfixturevalue(table)
    shards = stored(idfiles.encode_shards(clashing(df), BYTE, 0, block_ids=block_ids), "test-shards")
    got = idfiles.documents_of(stored(idfiles.decode_shards(shards), "test-ids")).collect()
    plain = tokens.load_tokenizer(BYTE)
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.doc_id, [*plain.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in df.collect()), key=lambda r: r[:2])
    starts = defaultdict(int)
    crc = lambda ids: zlib.crc32(np.array(ids, dtype="<u4").tobytes())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((k, len(ids), crc(ids)) for _, _, k, ids in rows)
    at = 0
    for _, _, key, ids in rows:
        starts[key] = min(starts.get(key, at), at)
        at += len(ids)
    lowest = {}
    for r in got:
        lowest[r.doc_id] = min(lowest.get(r.doc_id, r.start), r.start)
    assert lowest == dict(starts)
    ordered = sorted(got, key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))


def test_plan_places_each_remainder_once():
    draw = np.random.default_rng(2)
    for units, n in ((16, 300), (64, 5000), (64, 0), (256, 20000)):
        lengths = draw.integers(1, units + 1, n)
        histogram = np.bincount(lengths, minlength=units + 1)
        planned = packing.plan(histogram, units)
        used = np.zeros_like(histogram)
        for combo, k in planned:
            assert sum(combo) <= units and k > 0
            for v in combo:
                used[v] += k
        assert np.array_equal(used, histogram)
        if n >= 5000:
            bins = sum(k for _, k in planned)
            assert bins <= lengths.sum() / units * 1.02 + 3


def test_repeat_counts_are_a_least_squares_optimum():
    histogram = np.array([0, 40, 10, 25, 30, 8, 12, 3, 5])
    combos = packing.combinations(8)
    x = packing.repeat_counts(histogram, combos, 5000)
    a = np.zeros((9, len(combos)))
    for j, c in enumerate(combos):
        for v in c[c > 0]:
            a[v, j] += 1
    gradient = a.T @ (a @ x - histogram)
    assert (x >= 0).all() and gradient.min() > -0.05 and abs(gradient[x > 0.1]).max() < 0.05


@pytest.mark.parametrize("table,window", [("documents", 2048), ("documents", 256), ("odd", 2048), ("none", 2048)])
def test_packing(table, window, request):
    df = request.getfixturevalue(table)
    got = packing.pack(clashing(df), WORD, window=window).collect()
    plain = tokens.load_tokenizer(WORD)
    ids = [[*plain.encode(r.text or "", add_special_tokens=False).ids, 1] for r in df.collect()]
    want = Counter()
    for r, all_ids in zip(df.collect(), ids):
        for s in range(0, len(all_ids), window):
            part = all_ids[s : s + window]
            want[r.doc_id, s, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes()), len(all_ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    if table == "documents":
        assert sum(map(len, ids)) > 0.93 * window * (len(sequences) - 1)
