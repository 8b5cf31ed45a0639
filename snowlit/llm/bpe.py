"""Byte-level BPE over a pair occurrence index, and its decoding.

A slice of a partition gives its distinct words that are not known yet. They are laid end
to end as one row of symbols, and an index maps every adjacent pair that has a merge to
all positions where it stands. The active ranks are applied in ascending order, each to
all its positions at once (numpy); the pairs beside a merge are added to their own lists,
and positions whose pair has gone are skipped when their list comes up.

Defined cases. Null or empty text: no ids, decoded text empty. Null or repeated ids of
documents: each row is encoded by itself. Empty table: no rows. A very long word costs in
proportion to its length and the logarithm of the ranks in it.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowlit.llm.common import map_rows, type_of
from snowlit.llm.tokens import PartTable

# Text bytes that share one index.
INDEX_BYTES = 24 << 20

# Fixed value: how a byte-level tokenizer of this kind splits words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairs:
    """Vocabulary and merges of a tokenizer file, with encoding and decoding."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]
        added = spec["added_tokens"]
        if (
            model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]
            or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        ):
            raise ValueError("a plain byte-level BPE file is needed")
        byte_of, vocab = byte_characters(), model["vocab"]
        self.first = np.zeros(256, dtype=np.int32)
        for character, byte in byte_of.items():
            self.first[byte] = vocab[character]
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]]
        keys = np.array([a << 32 | b for a, b, _ in self.merges], dtype=np.int64)
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        self.special = {t["content"]: t["id"] for t in added}
        self.bytes_of = {i: bytes(byte_of[c] for c in token) for token, i in vocab.items()}
        self.bytes_of |= {i: content.encode() for content, i in self.special.items()}
        names = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.words = regex.compile(WORDS)
        self.table = PartTable(self.encode_parts)
        self.pieces = [b""] * (max(self.bytes_of) + 1)
        for i, piece in self.bytes_of.items():
            self.pieces[i] = piece

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it has no merge."""
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank_of[at], -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, how many each word has)."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        n = len(symbols)
        ends = np.cumsum(lengths)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[ends[lengths > 0] - 1] = -1
        before[(ends - lengths)[lengths > 0]] = -1
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(positions: np.ndarray, ranks: np.ndarray) -> None:
            """List positions under the rank of their pair."""
            known = ranks >= 0
            if not known.all():
                positions, ranks = positions[known], ranks[known]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranks)]):
                rank = int(ranks[a])
                if rank not in places:
                    places[rank] = []
                    heapq.heappush(active, rank)
                places[rank].append(positions[a:b])

        start = np.flatnonzero(after >= 0)
        note(start, self.ranks(symbols[start], symbols[start + 1]))
        while active:
            rank = heapq.heappop(active)
            a, b, joined = self.merges[rank]
            found = places.pop(rank)
            p = np.unique(found[0] if len(found) == 1 else np.concatenate(found))
            q = after[p]
            whole = (symbols[p] == a) & (q >= 0) & (symbols[q] == b)
            p, q = p[whole], q[whole]
            if a == b and len(p) > 1:  # in a run of equal symbols every other pair, from the left
                new = np.r_[True, q[:-1] != p[1:]]
                place = np.arange(len(p))
                even = (place - np.maximum.accumulate(np.where(new, place, 0))) % 2 == 0
                p, q = p[even], q[even]
            if not len(p):
                continue
            symbols[p], symbols[q] = joined, -1
            last = after[q]
            after[p] = last
            right = last >= 0
            before[last[right]] = p[right]
            previous = before[p]
            left = previous >= 0
            at = np.concatenate([p[right], previous[left]])
            note(at, self.ranks(symbols[at], symbols[after[at]]))
        kept = symbols >= 0
        counts = np.diff(np.r_[0, np.cumsum(kept)][np.r_[0, ends]])
        return symbols[kept], counts

    def encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Parts of texts: their words go through one index, special tokens stay as they are."""
        numbers: dict[bytes, int] = {}
        words, of_part, fixed = [], np.zeros(len(parts), dtype=np.int64), {}
        for i, part in enumerate(parts):
            found = self._words(part)
            of_part[i] = len(found)
            for w in found:
                if isinstance(w, int):
                    fixed[len(words)] = w
                    w = b"\x00"
                words.append(numbers.setdefault(w, len(numbers)))
        ids, counts = self.encode_words(list(numbers))
        starts = np.cumsum(counts) - counts
        words = np.array(words, dtype=np.int64)
        each = counts[words]
        ends = np.cumsum(each)
        out = ids[np.repeat(starts[words] - ends + each, each) + np.arange(int(ends[-1]) if len(ends) else 0)]
        for word, special in fixed.items():  # one symbol stood in for it
            out[ends[word] - 1] = special
        cuts = np.r_[0, ends][np.r_[0, np.cumsum(of_part)]]
        return out, np.diff(cuts)

    def _words(self, part: str) -> list:
        """Words of a part as bytes; a special token as its id."""
        if self.split is None or "<" not in part:
            return [w.encode() for w in self.words.findall(part)]
        found = []
        for piece in self.split.split(part):
            if piece in self.special:
                found.append(self.special[piece])
            else:
                found += [w.encode() for w in self.words.findall(piece)]
        return found

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        return self.table.encode(texts)

    def decode(self, ids) -> str:
        """The text of ids, special tokens included; broken characters become U+FFFD."""
        return b"".join(map(self.pieces.__getitem__, np.asarray(ids, dtype=np.int64).tolist())).decode("utf-8", "replace")


_LOADED: dict[str, BytePairs] = {}


def load(path: str) -> BytePairs:
    """One table for each worker process."""
    if path not in _LOADED:
        _LOADED[path] = BytePairs(path)
    return _LOADED[path]


def _rows(docs: DataFrame, doc_id: str, text: str, kind: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast(kind).alias("text"))


def encode(docs: DataFrame, path: str, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, ids): the ids of every whole text."""
    rows = _rows(docs, doc_id, text, "string")

    def make():
        pairs = load(path)
        return lambda c: {"doc_id": c["doc_id"], "ids": [i.astype("i4") for i in pairs.encode(c["text"])]}

    return map_rows(rows, make, f"doc_id {type_of(rows, 'doc_id')}, ids array<int>", INDEX_BYTES)


def decode(encoded: DataFrame, path: str, doc_id="doc_id", ids="ids") -> DataFrame:
    """(doc_id, text): the text of every list of ids; null is empty."""
    rows = encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids"))

    def make():
        pairs = load(path)
        return lambda c: {"doc_id": c["doc_id"], "text": [pairs.decode(i or []) for i in c["ids"]]}

    return map_rows(rows, make, f"doc_id {type_of(rows, 'doc_id')}, text STRING")


def round_trip(docs: DataFrame, path: str, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids of every whole
    text and of the text decoded from these ids, without moving the ids."""
    rows = _rows(docs, doc_id, text, "string")

    def make():
        pairs = load(path)
        digits = list(map(str, range(len(pairs.pieces))))

        def run(c):
            out = {"doc_id": c["doc_id"], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for ids in pairs.encode(c["text"]):
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(",".join(map(digits.__getitem__, ids.tolist())).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(pairs.decode(ids).encode()).hexdigest())
            return out

        return run

    return map_rows(
        rows, make, f"doc_id {type_of(rows, 'doc_id')}, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING",
        INDEX_BYTES,
    )
