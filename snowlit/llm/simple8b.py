"""Simple-8b: whole numbers packed into 64-bit words, word by word.

The top 4 bits of a word select how many numbers it holds and how wide they are; the
other 60 bits hold them, the first one lowest. Selector 15 stands for one number of
up to 60 bits. A larger number is escaped: a word with selector 0 (240 zeros) whose 60 bits
are 1 instead of 0, followed by the number as a whole word.

A block is a header, then its words: 8 bytes magic ``S8BLOCK1``, numbers in all, words in
all and the number of documents (three little-endian 32-bit), then per document its start
in numbers (little-endian 32-bit, one more at the end), then the words.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the format: numbers in a word and bits of each, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
MAGIC = b"S8BLOCK1"
ESCAPE = np.uint64(1)
_STEPS = np.append(COUNTS, 1)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    if len(values) and values.max() < 1 << 16:
        return _SMALL[values.astype(np.int64)]
    width = np.zeros(len(values), dtype=np.uint8)
    rest = values.copy()
    for bits in (32, 16, 8, 4, 2, 1):
        high = rest >= np.uint64(1 << bits)
        width[high] += bits
        rest[high] >>= np.uint64(bits)
    return width + (rest > 0).astype(np.uint8)


_SMALL = np.array([i.bit_length() for i in range(1 << 16)], dtype=np.uint8)


def encode(values: np.ndarray) -> np.ndarray:
    """Words (uint64) that hold the values (unsigned, at most 64 bits)."""
    values = np.asarray(values, dtype=np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    width = _widths(values)
    # The greatest width in windows of each length, zeros beyond the end.
    ahead = lambda m, by: np.concatenate([m[by:], np.zeros(min(by, n), dtype=np.uint8)])[:n]
    widest = {1: width}
    for count, (a, b) in {
        2: (1, 1), 3: (2, 1), 4: (2, 2), 5: (4, 1), 6: (4, 2), 7: (4, 3), 8: (4, 4), 10: (8, 2), 12: (8, 4), 15: (8, 7),
        20: (10, 10), 30: (15, 15), 60: (30, 30), 120: (60, 60), 240: (120, 120),
    }.items():
        widest[count] = np.maximum(widest[a], ahead(widest[b], a))
    # The first selector whose numbers all fit, for a word that would start here.
    choice = np.full(n, 16, dtype=np.uint8)
    for selector in range(15, -1, -1):
        choice[widest[int(COUNTS[selector])] <= WIDTHS[selector]] = selector
    # Where words really start: each word says where the next one does.
    step = _STEPS[choice].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts)
    kinds = choice[starts]
    place = np.cumsum(np.where(kinds == 16, 2, 1)) - np.where(kinds == 16, 2, 1)
    words = np.zeros(int(place[-1]) + (2 if kinds[-1] == 16 else 1), dtype=np.uint64)
    padded = np.concatenate([values, np.zeros(240, dtype=np.uint64)])
    for selector in range(16):
        mine = kinds == selector
        if not mine.any():
            continue
        word = np.full(int(mine.sum()), np.uint64(selector) << np.uint64(60))
        if WIDTHS[selector]:
            first = starts[mine]
            for k in range(int(COUNTS[selector])):
                word |= padded[first + k] << np.uint64(k * int(WIDTHS[selector]))
        words[place[mine]] = word
    raw = kinds == 16
    words[place[raw]] = ESCAPE
    words[place[raw] + 1] = values[starts[raw]]
    return words


def decode(words: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` values held by the words."""
    words = np.asarray(words, dtype=np.uint64)
    raw = np.zeros(len(words), dtype=bool)
    for i in np.flatnonzero(words == ESCAPE).tolist():  # in order: a raw word may look like an escape
        if not raw[i]:
            raw[i + 1] = True
    escape = (words == ESCAPE) & ~raw
    selectors = np.where(raw, 15, words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selectors]
    counts[escape] = 0
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    starts = ends - counts
    for selector in range(2, 16):
        mine = (selectors == selector) & ~raw & ~escape
        if mine.any():
            width, count = int(WIDTHS[selector]), int(COUNTS[selector])
            mask = np.uint64((1 << width) - 1)
            first, some = starts[mine], words[mine]
            for k in range(count):
                out[first + k] = (some >> np.uint64(k * width)) & mask
    out[starts[raw]] = words[raw]
    if n > len(out):
        raise ValueError("the words hold fewer numbers than the header says")
    return out[:n]


def pack_block(documents: list[np.ndarray]) -> bytes:
    """A block with the numbers of some documents."""
    starts = np.zeros(len(documents) + 1, dtype="<u4")
    np.cumsum([len(d) for d in documents], out=starts[1:])
    values = np.concatenate(documents) if documents else np.zeros(0)
    words = encode(values)
    head = np.array([len(values), len(words), len(documents)], dtype="<u4")
    return MAGIC + head.tobytes() + starts.tobytes() + words.astype("<u8").tobytes()


def unpack_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of the block, the start of each document and the end of the last)."""
    if block[:8] != MAGIC:
        raise ValueError("not a block of packed numbers")
    n, n_words, n_docs = np.frombuffer(block, "<u4", 3, 8).tolist()
    starts = np.frombuffer(block, "<u4", n_docs + 1, 20)
    words = np.frombuffer(block, "<u8", n_words, 20 + 4 * (n_docs + 1))
    return decode(words, n), starts
