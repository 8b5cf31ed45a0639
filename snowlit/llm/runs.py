"""Periodic runs of words: stretches that repeat with a period.

A run is a stretch of words with smallest period q (words q apart are identical) and at least
``min_exponent`` periods and ``min_length`` words, which no neighbouring word extends. They
are found in an enhanced suffix array (sorted suffixes, their inverse ISA, and the common
prefixes of neighbours); its LCP intervals stand for the nodes of a suffix tree, and no node
is ever built:

1. A square of period q that the next word ends starts at i exactly if i and i + q lie in
   different children of the LCP interval of depth q. So for every interval the suffixes of all
   children but the largest ask whether ISA[i + q] or ISA[i - q] is in the interval and
   outside of their child: n log n questions at most, all in numpy.
2. Each such square is rotated left as far as its words agree, which gives the run it ends.
3. Squares of several periods that give the same stretch are one run, that of the least period.

Documents are taken in slices. The suffix array is made only of stretches in which some window
of words occurs twice: any window of a run does, one period on, and the windows cover the run.
Window hashes only propose stretches; equal windows have equal hashes, so no run is lost, and
what follows compares words by their numbers, exactly.

Defined cases. Null text: no words. Null id, repeated ids: each row is a document of its own.
Empty table: no rows. Other columns are neither read nor returned, so their names don't matter.
A document is analysed whole, in one task, with about 4 bytes x log2(n) for each of the n words that
lie in repeating stretches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowlit.llm.common import map_rows, type_of

MIN_LENGTH, MIN_EXPONENT = 24, 3
# Words of stretches put into one suffix array; a longer stretch has one of its own.
ARRAY_WORDS = 1 << 20
# Questions about suffixes asked at once.
ASKED = 1 << 21

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class Numbers(dict):
    """The number of each distinct word, in order of first sight."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def split_words(text: str | None) -> list[bytes]:
    """Words between blanks and the control characters 9 to 13, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def window_words(min_length: int, min_exponent: int) -> int:
    """The largest power of two that two neighbouring periods of any run share as a window: a
    run of period q has equal words q apart over its length less q."""
    shared = min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 2))
    return 1 << max(0, shared.bit_length() - 1)


def stretches(words: np.ndarray, owner: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the maximal stretches covered by windows that occur at least twice for
    one owner. ``owner`` rises along the words; windows that span two owners don't count."""
    with np.errstate(over="ignore"):
        h = (words.astype(np.uint64) + owner.astype(np.uint64) * _A + np.uint64(1)) * _B
        h ^= h >> np.uint64(31)
        step = 1
        while step < window:
            if len(h) <= step:
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            h = (h[:-step] * _A + h[step:]) * _C
            h ^= h >> np.uint64(29)
            step *= 2
    inside = owner[: len(h)] == owner[window - 1 :]
    ordered = np.sort(h[inside])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
    starts = np.flatnonzero((twice[at] == h) & inside)
    # Windows that overlap or touch within one owner are one stretch.
    new = np.r_[True, (starts[1:] > starts[:-1] + window) | (owner[starts[1:]] != owner[starts[:-1]])]
    first = np.flatnonzero(new)
    return starts[first], starts[np.r_[first[1:] - 1, len(starts) - 1]] + window


class SuffixArray:
    """Enhanced suffix array of numbers that end in one that occurs only once.

    ``levels[k]`` names the 2**k numbers from each place on: equal names, equal numbers.
    """

    def __init__(self, numbers: np.ndarray):
        n = len(numbers)
        order = np.argsort(numbers, kind="stable")
        ordered = numbers[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]]
        rank = np.empty(n, np.int32)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        self.levels = [rank]
        open_ = order[~(new & np.r_[new[1:], True])]
        step = 1
        while len(open_):
            # Only suffixes that still share their name are sorted on.
            rank = self.levels[-1]
            group = rank[open_].astype(np.int64)
            key = group * (n + 1) + rank[np.minimum(open_ + step, n - 1)]
            by = np.argsort(key, kind="stable")
            open_, group, key = open_[by], group[by], key[by]
            at = np.arange(len(open_))
            old = np.r_[True, group[1:] != group[:-1]]
            new = np.r_[True, key[1:] != key[:-1]]
            named = rank.copy()
            named[open_] = group + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(old, at, 0))
            self.levels.append(named)
            open_ = open_[~(new & np.r_[new[1:], True])]
            step *= 2
        self.isa = self.levels[-1]
        self.sa = np.empty(n, np.int64)
        self.sa[self.isa] = np.arange(n)
        # -1 closes both ends, so that every search for a smaller value ends.
        self.lcp = np.full(n + 1, -1, np.int64)
        self.lcp[1:n] = self.common(self.sa[:-1], self.sa[1:])

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many numbers from two different places on are equal."""
        start, x, y = x, x.copy(), y.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            same = (self.levels[k][x] == self.levels[k][y]).astype(np.int64) << k
            x += same
            y += same
        return x - start

    def common_before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many numbers before two different places are equal."""
        start, x, y = x, x.copy(), y.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            size = 1 << k
            fits = (x >= size) & (y >= size)
            a, b = np.where(fits, x - size, 0), np.where(fits, y - size, 0)
            same = (fits & (self.levels[k][a] == self.levels[k][b])).astype(np.int64) << k
            x -= same
            y -= same
        return start - x


def smaller_before(values: np.ndarray, or_equal: bool) -> np.ndarray:
    """For each place the last one before it with a smaller (or equal) value, or -1. Pointers
    jump over pointers until all stand still."""
    found = np.arange(-1, len(values) - 1)
    todo = np.arange(1, len(values))
    while len(todo):
        seen = found[todo]
        on = (seen >= 0) & (values[seen] > values[todo] if or_equal else values[seen] >= values[todo])
        todo, seen = todo[on], seen[on]
        found[todo] = found[seen]
    return found


def branching_squares(array: SuffixArray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the squares of periods up to ``most`` that the next number ends."""
    sa, isa, lcp = array.sa, array.isa, array.lcp
    n = len(sa)
    last = len(lcp) - 1
    left, left_equal = smaller_before(lcp, False), smaller_before(lcp, True)
    back = lcp[::-1]
    right, right_equal = (last - smaller_before(back, e)[::-1] for e in (False, True))
    bound = np.flatnonzero((lcp > 0) & (lcp <= most))
    lb, rb, depth = left[bound], right[bound] - 1, lcp[bound]
    # A child begins at each border of an interval, and one at the interval's own start.
    opens = left_equal[bound] == lb
    a = np.r_[bound, lb[opens]]
    b = np.r_[right_equal[bound] - 1, bound[opens] - 1]
    lb, rb, depth = (np.r_[v, v[opens]] for v in (lb, rb, depth))
    order = np.lexsort((b - a, rb, lb))
    a, b, lb, rb, depth = (v[order] for v in (a, b, lb, rb, depth))
    largest = np.r_[(lb[1:] != lb[:-1]) | (rb[1:] != rb[:-1]), True] if len(a) else np.zeros(0, bool)
    a, b, lb, rb, depth = (v[~largest] for v in (a, b, lb, rb, depth))
    starts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    sizes = b - a + 1
    total = np.cumsum(sizes)
    first = 0
    while first < len(a):
        end = max(first + 1, int(np.searchsorted(total, (total[first - 1] if first else 0) + ASKED, "right")))
        size = sizes[first:end]
        child = np.repeat(np.arange(first, end), size)
        place = np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size) + a[child]
        i, q = sa[place], depth[child]
        for other, start in ((i + q, i), (i - q, i - q)):
            rank = isa[np.clip(other, 0, n - 1)]
            met = (other >= 0) & (other < n) & (rank >= lb[child]) & (rank <= rb[child]) & ((rank < a[child]) | (rank > b[child]))
            starts.append(start[met])
            periods.append(q[met])
        first = end
    return np.concatenate(starts), np.concatenate(periods)


def runs_of(numbers: np.ndarray, min_length: int, min_exponent: int, longest: int) -> tuple[np.ndarray, ...]:
    """(start, length, period) of the runs of numbers that end in one that occurs only once;
    ``longest`` is the longest stretch without such a number."""
    array = SuffixArray(numbers)
    start, period = branching_squares(array, longest // min_exponent)
    begin = start - array.common_before(start, start + period)
    length = start + 2 * period - begin
    kept = (length >= min_length) & (length >= min_exponent * period)
    begin, length, period = begin[kept], length[kept], period[kept]
    order = np.lexsort((period, length, begin))
    begin, length, period = begin[order], length[order], period[order]
    one = np.r_[True, (begin[1:] != begin[:-1]) | (length[1:] != length[:-1])] if len(begin) else np.zeros(0, bool)
    return begin[one], length[one], period[one]


def document_runs(
    texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> Iterator[tuple[int, int, int, int]]:
    """(document, start, length, period) of all runs of several documents, given as words."""
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    numbers = Numbers()
    words = np.fromiter((numbers[w] for t in texts for w in t), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), sizes)
    window = window_words(min_length, min_exponent)
    first, end = stretches(words, owner, window)
    if len(first):
        # Again with stretches as owners: passages that only recur far apart go.
        size = end - first
        place = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        inner, inner_end = stretches(words[place], np.repeat(np.arange(len(first)), size), window)
        first, end = place[inner], place[inner_end - 1] + 1 if len(inner) else inner
    size = end - first
    long = size >= min_length
    first, size = first[long], size[long]
    at = 0
    while at < len(first):
        total = np.cumsum(size[at:] + 1)
        stop = at + max(1, int(np.searchsorted(total, ARRAY_WORDS, "right")))
        f, n = first[at:stop], size[at:stop]
        where = np.repeat(f - (np.cumsum(n) - n), n) + np.arange(n.sum())
        part = np.repeat(np.arange(len(f)), n)
        # Words of different stretches differ, and each stretch ends in a number of its own.
        coded = np.full(int(n.sum()) + len(f), -1, np.int64)
        coded[np.arange(len(where)) + part] = part * len(numbers) + words[where]
        ends = np.cumsum(n + 1) - 1
        coded[ends] = len(f) * len(numbers) + np.arange(len(f))
        for begin, length, period in zip(*runs_of(coded, min_length, min_exponent, int(n.max()))):
            which = int(np.searchsorted(ends, begin))
            word = f[which] + begin - (ends[which] - n[which])
            doc = int(owner[word])
            yield doc, int(word - begins[doc]), int(length), int(period)
        at = stop


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run has after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def find_runs(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> DataFrame:
    """(id, n_words, runs, collapsed) for each document: its runs by start and period, and the
    words that remain if each run is cut to its first period, joined by blanks."""
    if min_length < 2 or min_exponent < 2:
        raise ValueError("a run has two words and two periods at least")

    def make():
        def found(columns: dict[str, list]) -> dict[str, list]:
            texts = [split_words(t) for t in columns["text"]]
            runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for doc, *run in document_runs(texts, min_length, min_exponent):
                runs[doc].append(tuple(run))
            for of_doc in runs:
                of_doc.sort(key=lambda r: (r[0], r[2]))
            return {
                id: columns["id"],
                "n_words": [len(t) for t in texts],
                "runs": [[{"start": s, "length": n, "period": q} for s, n, q in of_doc] for of_doc in runs],
                "collapsed": [b" ".join(collapse(t, r)).decode("utf-8", "surrogatepass") for t, r in zip(texts, runs)],
            }

        return found

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = f"`{id}` {type_of(docs, id)}, n_words BIGINT, runs ARRAY<STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>>, collapsed STRING"
    return map_rows(rows, make, schema)


def best_run(runs: F.Column) -> F.Column:
    """The run with the most periods, compared exactly; the first, then that of the least period,
    among equals. NULL if there is none."""

    def better(best, run):
        more, same = run["length"] * best["period"], best["length"] * run["period"]
        return F.when(best.isNull() | (more > same), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), better)


def run_lines(runs: F.Column) -> F.Column:
    """``start,length,period`` and a line feed for each run."""
    return F.array_join(
        F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), ""
    )
