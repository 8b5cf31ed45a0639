"""Token ids of whole texts with a public tokenizer, each distinct word encoded once.

A text is cut only where the tokenizer cuts too, whatever stands around: after a run of
letters that an ASCII sign follows, and before a single blank or line feed between two
characters that are no white space. The parts repeat from text to text, so a task numbers
them, encodes the new ones together and puts the ids of a text together from a table.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable

import numpy as np

# Letters of one script up to an ASCII sign, or what lies before the next blank or line
# feed; other white space stays inside a part.
PART = re.compile(
    r" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+(?=[\x00-@\[-`{-\x7f]|\Z)"
    r"|(?:[ \n]?\S+|\s+\S*)(?:(?![ \n]\S)\s+\S*)*"
)
# Distinct parts a task keeps, and characters of them.
KEPT_PARTS = 900_000
KEPT_CHARACTERS = 14_000_000
# Distinct parts given to the tokenizer in one text.
TOGETHER = 4096


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Numbers(dict):
    """Numbers of distinct parts, given out as they come."""

    def __missing__(self, part: str) -> int:
        self[part] = number = len(self)
        return number


class PartTable:
    """Ids of distinct parts in one array, and texts put together from them.

    ``encode_parts(parts) -> (ids of all parts one after the other, ids of each: how many)``.
    """

    def __init__(self, encode_parts: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        self.encode_parts = encode_parts
        self._clear()

    def _clear(self) -> None:
        self.numbers, self.characters = Numbers(), 0
        self.ids, self.starts, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        if len(self.numbers) > KEPT_PARTS or self.characters > KEPT_CHARACTERS:
            self._clear()
        known, number = len(self.numbers), self.numbers.__getitem__
        cut = []
        for text in texts:
            parts = PART.findall(text or "")
            cut.append(np.fromiter(map(number, parts), np.int32, len(parts)))
        if len(self.numbers) > known:
            new = list(self.numbers)[known:]
            self.characters += sum(map(len, new))
            ids, counts = self.encode_parts(new)
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        return [self._gather(parts) for parts in cut]

    def _gather(self, parts: np.ndarray) -> np.ndarray:
        counts = self.counts[parts]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.starts[parts] - ends + counts, counts) + np.arange(total)]


def library_parts(path: str) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """Parts encoded by the tokenizers library, many in one text with a special token, which
    always stands alone, between them."""
    tokenizer = load_tokenizer(path)
    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items() if t.special}
    between, mark = next(iter(special.items()))

    def encode(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = [], []
        for at in range(0, len(parts), TOGETHER):
            some = parts[at : at + TOGETHER]
            if any(s in p for s in special for p in some):
                for e in tokenizer.encode_batch_fast(some, add_special_tokens=False):
                    ids.append(np.array(e.ids, dtype=np.uint32))
                    counts.append([len(e.ids)])
                continue
            (whole,) = tokenizer.encode_batch_fast([between.join(some)], add_special_tokens=False)
            got = np.array(whole.ids, dtype=np.uint32)
            cuts = np.flatnonzero(got == mark)
            ids.append(got[got != mark])
            counts.append(np.diff(np.r_[-1, cuts, len(got)]) - 1)
        return np.concatenate(ids), np.concatenate(counts).astype(np.int64)

    return encode


# Kept for the next task of the same worker process.
_TABLES: dict[str, PartTable] = {}


def encoder(path: str, end_id: int | None = None) -> Callable[[list[str | None]], list[bytes]]:
    """texts -> the little-endian 32-bit ids of each, ``end_id`` last. Null is empty."""
    if path not in _TABLES:
        _TABLES[path] = PartTable(library_parts(path))
    table = _TABLES[path]
    end = b"" if end_id is None else np.uint32(end_id).astype("<u4").tobytes()
    return lambda texts: [ids.astype("<u4").tobytes() + end for ids in table.encode(texts)]
