"""Personal data: fixed patterns, and a linear-chain CRF that adds what they miss.

The patterns give the base spans. The CRF labels the words that hold a digit or ``@``
(all others are O by definition, so the chain falls into independent runs of such words).
Its features are word shapes: of the word, of parts of it, and of its neighbours. It is
trained by gradient ascent on a small labelled table, and decoded by Viterbi in numpy, many
runs at a time. A decoded span that touches no base span and has the characters its kind
needs is added.

Defined cases. Null or empty text: no spans. Null or repeated ids: each row by itself.
Empty table: no rows; without labelled rows the CRF adds nothing. Very long texts and words
are read whole, in time that grows with their length.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowlit.llm.common import map_rows, type_of

KINDS = ("email", "ip", "card", "phone")
ORDER = {kind: i for i, kind in enumerate(KINDS)}
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
# Labelled rows that a model is trained on, at most, and runs of words taken from them.
TRAIN_ROWS = 1000
TRAIN_RUNS = 4000
TRAIN_LENGTH = 24

# The base patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Only run starts are tried: what fails there fails inside the run too.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str):
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of what the fixed patterns find, by start and kind."""
    text = text or ""
    found = [("email", a, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = _digits(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], ORDER[s[0]]))


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# Runs of words with a digit or "@"; the words around a run are read for their shapes.
HOT_WORD = re.compile(r"(?<!\S)[^\s0-9@]*[0-9@]\S*")
_CLASS = {ord(c): "d" for c in "0123456789"} | {ord(c): "x" for c in "abcdefghijklmnopqrstuvwxyz"}
_CLASS |= {ord(c): "X" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
_REPEAT = re.compile(r"(.)\1+", re.S)


def shape(word: str) -> str:
    """Digits as d, letters as x and X, others as they are; at most 48 characters long."""
    mapped = word.translate(_CLASS)
    return mapped if len(mapped) <= 48 else _REPEAT.sub(r"\1", mapped)[:48]


@lru_cache(200_000)
def features(before: str, own: str, after: str) -> tuple[str, ...]:
    """Names of what holds for a word with this shape between these shapes."""
    short = lambda s: _REPEAT.sub(r"\1", s)
    core = own.strip(".,;:!?\"'#*$%&|<>")
    digits = own.count("d")
    return (
        "bias", f"s={core}", f"c={short(core)}", f"d={min(digits, 20)}", f"l={min(len(own), 24)}",
        f"a={core[:1]}", f"z={core[-1:]}", f"@={'@' in own}", f".={min(own.count('.'), 4)}",
        f"p={short(before)}", f"n={short(after)}", f"pc={short(before)}/{short(core)}", f"cn={short(core)}/{short(after)}",
    )


def runs(text: str) -> list[list[tuple[int, int, str, str, str]]]:
    """Runs of (start, end, shape before, shape, shape after), one entry for each word."""
    found, last = [], None
    for m in HOT_WORD.finditer(text):
        start, end = m.span()
        if last is not None and text[last:start].isspace():
            found[-1].append((start, end))
        else:
            found.append([(start, end)])
        last = end
    out = []
    for run in found:
        left = text[max(0, run[0][0] - 40) : run[0][0]].split()[-1:]
        right = text[run[-1][1] : run[-1][1] + 40].split()[:1]
        shapes = [shape(w) for w in left or [""]] + [shape(text[a:b]) for a, b in run] + [shape(w) for w in right or [""]]
        out.append([(a, b, *shapes[i : i + 3]) for i, (a, b) in enumerate(run)])
    return out


def run_labels(run, spans) -> list[int]:
    """Label numbers of the words of a run, from labelled spans."""
    out = []
    for a, b, *_ in run:
        label = "O"
        for kind, s, e in spans:
            if s < b and a < e:
                label = f"{'B' if s >= a else 'I'}-{kind}"
                break
        out.append(LABELS.index(label))
    return out


class Crf:
    """Weights of features and transitions. ``allowed`` transitions: I only after B or I of
    its kind."""

    def __init__(self):
        n = len(LABELS)
        self.names: dict[str, int] = {}
        self.weights = np.zeros((1, n))  # the last row stands for unknown features
        self.moves = np.zeros((n + 1, n))  # the last row: from the start
        self.allowed = np.array([
            [not to.startswith("I-") or (i < n and LABELS[i][2:] == to[2:] and i > 0) for to in LABELS] for i in range(n + 1)
        ])
        self.trained = False

    def _pad(self, sequences: list[list[tuple[int, ...]]]) -> tuple[np.ndarray, np.ndarray]:
        length = max(map(len, sequences))
        width = len(sequences[0][0])
        ids = np.full((len(sequences), length, width), len(self.weights) - 1, dtype=np.int32)
        here = np.zeros((len(sequences), length), dtype=bool)
        for i, s in enumerate(sequences):
            ids[i, : len(s)] = s
            here[i, : len(s)] = True
        return ids, here

    def number(self, run) -> list[tuple[int, ...]]:
        unknown = len(self.weights) - 1
        return [tuple(self.names.get(f, unknown) for f in features(*word[2:])) for word in run]

    def fit(self, labelled: list[tuple[list, list[int]]], rounds: int = 120, rate: float = 0.3, decay: float = 1e-3) -> "Crf":
        """Gradient ascent (Adagrad) on the log-likelihood of labelled runs."""
        labelled = [(run[:TRAIN_LENGTH], labels[:TRAIN_LENGTH]) for run, labels in labelled if run]
        if not labelled:
            return self
        names = sorted({f for run, _ in labelled for word in run for f in features(*word[2:])})
        self.names = {f: i for i, f in enumerate(names)}
        n = len(LABELS)
        self.weights = np.zeros((len(names) + 1, n))
        ids, here = self._pad([self.number(run) for run, _ in labelled])
        gold = np.zeros(here.shape, dtype=np.int64)
        for i, (_, labels) in enumerate(labelled):
            gold[i, : len(labels)] = labels
        rows, length = here.shape
        hot = np.eye(n)[gold] * here[..., None]
        seen = np.zeros_like(self.moves)
        np.add.at(seen, (np.full(rows, n), gold[:, 0]), 1)
        for t in range(1, length):
            np.add.at(seen, (gold[:, t - 1], gold[:, t]), here[:, t])
        flat = ids[here]
        sum_w, sum_m = np.full_like(self.weights, 1e-8), np.full_like(self.moves, 1e-8)
        for _ in range(rounds):
            emit = self.weights[ids].sum(axis=2)
            moves = np.where(self.allowed, self.moves, -1e9)
            forward = np.zeros((rows, length, n))
            forward[:, 0] = moves[n] + emit[:, 0]
            for t in range(1, length):
                x = forward[:, t - 1, :, None] + moves[None, :n]
                top = x.max(axis=1)
                now = top + np.log(np.exp(x - top[:, None]).sum(axis=1)) + emit[:, t]
                forward[:, t] = np.where(here[:, t, None], now, forward[:, t - 1])
            top = forward[:, -1].max(axis=1, keepdims=True)
            total = top[:, 0] + np.log(np.exp(forward[:, -1] - top).sum(axis=1))
            backward = np.zeros((rows, n))
            share = np.zeros_like(forward)
            expected = np.zeros_like(self.moves)
            for t in range(length - 1, -1, -1):
                share[:, t] = np.exp(forward[:, t] + backward - total[:, None]) * here[:, t, None]
                if t == 0:
                    break
                x = moves[None, :n] + (emit[:, t] + backward)[:, None, :]
                both = np.exp(forward[:, t - 1, :, None] + x - total[:, None, None]) * here[:, t, None, None]
                expected[:n] += both.sum(axis=0)
                top = x.max(axis=2)
                now = top + np.log(np.exp(x - top[..., None]).sum(axis=2))
                backward = np.where(here[:, t, None], now, backward)
            expected[n] = share[:, 0].sum(axis=0)
            error = (hot - share)[here]
            grad = np.stack([
                np.bincount(flat.ravel(), np.repeat(error[:, j], flat.shape[1]), len(self.weights)) for j in range(n)
            ], axis=1) / rows - decay * self.weights
            grad[-1] = 0
            sum_w += grad**2
            self.weights += rate * grad / np.sqrt(sum_w)
            grad = (seen - expected) / rows - decay * self.moves
            sum_m += grad**2
            self.moves += rate * grad / np.sqrt(sum_m)
        self.trained = True
        return self

    def viterbi(self, sequences: list[list[tuple[int, ...]]]) -> list[np.ndarray]:
        """The best labels of each run, runs of like length together."""
        out: list[np.ndarray] = [None] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        n = len(LABELS)
        moves = np.where(self.allowed, self.moves, -1e9)
        at = 0
        while at < len(order):
            most = max(8, 2 * len(sequences[order[at]]))
            end = at
            while end < len(order) and end - at < 4096 and len(sequences[order[end]]) <= most:
                end += 1
            some = [sequences[i] for i in order[at:end]]
            ids, here = self._pad(some)
            emit = self.weights[ids].sum(axis=2)
            rows, length = here.shape
            score = moves[n] + emit[:, 0]
            back = np.zeros((rows, length, n), dtype=np.int8)
            for t in range(1, length):
                x = score[:, :, None] + moves[None, :n]
                best = x.argmax(axis=1)
                now = np.take_along_axis(x, best[:, None], axis=1)[:, 0] + emit[:, t]
                back[:, t] = np.where(here[:, t, None], best, np.arange(n))
                score = np.where(here[:, t, None], now, score)
            labels = np.zeros((rows, length), dtype=np.int8)
            labels[:, -1] = score.argmax(axis=1)
            for t in range(length - 1, 0, -1):
                labels[:, t - 1] = np.take_along_axis(back[:, t], labels[:, t, None].astype(np.int64), axis=1)[:, 0]
            for row, i in enumerate(order[at:end]):
                out[i] = labels[row, : len(sequences[i])]
            at = end
        return out


def _needed(kind: str, piece: str) -> bool:
    """The characters that a span of this kind must have."""
    n = len(_digits(piece))
    if kind == "email":
        return re.search(r"[^\s@]@[^\s@]", piece) is not None
    if kind == "ip":
        return re.fullmatch(r"[0-9]{1,3}(?:[^\w\s]{1,3}[0-9]{1,3}){3}", piece) is not None
    return (12 <= n <= 19 if kind == "card" else 9 <= n <= 15) and not re.search(r"[^0-9 ().+-]", piece)


def decoded_spans(text: str, run, labels) -> list[tuple[str, int, int]]:
    """Spans of a labelled run, without marks at their ends."""
    found, open_span = [], None
    for (a, b, *_), label in zip(run, labels):
        name = LABELS[label]
        if name.startswith("I-") and open_span and open_span[0] == name[2:]:
            open_span[2] = b
            continue
        open_span = [name[2:], a, b] if name != "O" else None
        if open_span:
            found.append(open_span)
    out = []
    for kind, a, b in found:
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while b > a and not text[b - 1].isalnum():
            b -= 1
        if a < b and _needed(kind, text[a:b]):
            out.append((kind, a, b))
    return out


def all_spans(crf: Crf, texts: list[str | None]) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    found = [runs(t) if t and crf.trained else [] for t in texts]
    flat = [(i, run) for i, own in enumerate(found) for run in own]
    labels = crf.viterbi([crf.number(run) for _, run in flat]) if flat else []
    more: list[list] = [[] for _ in texts]
    for (i, run), path in zip(flat, labels):
        if path.any():
            more[i] += decoded_spans(texts[i], run, path)
    out = []
    for own, added in zip(base, more):
        taken = sorted((a, b) for _, a, b in own)
        new = [s for s in added if not any(a < s[2] and s[1] < b for a, b in taken)] if len(taken) * len(added) < 10_000 else _apart(added, taken)
        out.append((own, sorted(own + new, key=lambda s: (s[1], ORDER[s[0]])) if new else own))
    return out


def _apart(added, taken):
    """Spans that touch no taken one; both are long lists."""
    starts = np.array([a for a, _ in taken])
    furthest = np.maximum.accumulate([b for _, b in taken])
    keep = []
    for s in added:
        i = int(np.searchsorted(starts, s[2]))
        if i == 0 or furthest[i - 1] <= s[1]:
            keep.append(s)
    return keep


def train(labelled: DataFrame, text="text", spans="spans", rows: int = TRAIN_ROWS) -> Crf:
    """A model from ``labelled`` (text, spans), at most ``rows`` rows of it, chosen by a
    hash; spans as ``kind:start:end`` joined by commas."""
    some = labelled.select(F.col(text).alias("text"), F.col(spans).alias("spans")).filter("text IS NOT NULL")
    picked = some.orderBy(F.xxhash64("text"), "spans").limit(rows)
    taken: list[tuple[list, list[int]]] = []

    def make():
        def run(c):
            kept = {"run": [], "labels": []}
            for text, spans in zip(c["text"], c["spans"]):
                known = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in (spans or "").split(",") if s)]
                for found in runs(text):
                    kept["run"].append([[str(x) for x in word] for word in found[:TRAIN_LENGTH]])
                    kept["labels"].append(run_labels(found, known)[:TRAIN_LENGTH])
            return kept

        return run

    cut = map_rows(picked, make, "run array<array<string>>, labels array<int>")
    for row in cut.limit(TRAIN_RUNS).collect():  # bounded by TRAIN_RUNS
        taken.append(([(int(a), int(b), *rest) for a, b, *rest in row["run"]], row["labels"]))
    return Crf().fit(sorted(taken, key=repr))


def label_by_patterns(docs: DataFrame, rows: int = TRAIN_ROWS, doc_id="doc_id", text="text") -> DataFrame:
    """A labelled table (text, spans) where none was made by hand: up to ``rows`` documents,
    chosen by a hash of their id, with the spans of the fixed patterns."""
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    keys = docs.select(F.col("id").alias("key")).distinct().orderBy(F.xxhash64("key")).limit(rows)
    some = docs.join(F.broadcast(keys), F.col("id").eqNullSafe(F.col("key")), "left_semi")  # ``rows`` keys

    def make():
        return lambda c: {"text": c["text"], "spans": [written(base_spans(t)) for t in c["text"]]}

    return map_rows(some.select("text"), make, "text STRING, spans STRING")


def find(docs: DataFrame, crf: Crf, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def make():
        def run(c):
            both = all_spans(crf, c["text"])
            out = {"doc_id": c["doc_id"]}
            for kind in KINDS:
                out[f"n_{kind}"] = [sum(s[0] == kind for s in base) for base, _ in both]
            out["base_sha256"] = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in both]
            return out | {"spans": [written(spans) for _, spans in both]}

        return run

    counts = "".join(f"n_{k} BIGINT, " for k in KINDS)
    return map_rows(rows, make, f"doc_id {type_of(rows, 'doc_id')}, {counts}base_sha256 STRING, spans STRING")


def masked(text: str, spans) -> str:
    """The text with each span, or spans that overlap, replaced by the first one's kind."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, crf: Crf, text="text") -> DataFrame:
    """The same rows and columns, personal data in ``text`` replaced by its kind."""
    names = docs.columns
    schema = ", ".join(f"`{n.replace('`', '``')}` {type_of(docs, n)}" for n in names)

    def make():
        def run(c):
            c = dict(c)
            c[text] = [t if t is None else masked(t, spans) for t, (_, spans) in zip(c[text], all_spans(crf, c[text]))]
            return c

        return run

    return map_rows(docs, make, schema)
