"""Secret scan: patterns propose candidates, a random forest drops the false ones.

Candidates, one row each, are the whole values that follow a secret's name and an assignment
or ``Bearer``, quoted or unspaced, of any sign and at least 6 characters; elsewhere unbroken
runs of 16 or more token characters, without the identifier of a ``name=value``. The
features say how long a candidate is, how unusual its character transitions are (by
the transitions inside the words of the whole corpus), how much of it dictionary words
cover (the most frequent words of the corpus), what the path tells and which words stand
beside it. A random forest learns from labelled findings which candidates are real; where
none are given, from a small table of lines labelled by hand (``hand_made``).

Defined cases. Null or empty text: no candidates. Null path: no path features. Null or
repeated ids: each row by itself. Empty table: no findings; labelled findings of one
class only: nothing is dropped or everything is, as they say. Very long texts and runs are
read whole.
"""

from __future__ import annotations

import math
import random
import re
import string
from collections import Counter

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowlit.llm.common import map_rows, stored, type_of

MIN_LENGTH, MIN_NAMED, MAX_WORD = 16, 6, 16
DICTIONARY_WORDS = 20_000
# Labelled findings of each class that the forest is trained on, at most.
TRAIN_PER_CLASS = 5000
TREES, DEPTH, SEED = 24, 8, 42

CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/=.@-])[A-Za-z0-9_+/=.@-]{%d,}" % MIN_LENGTH)
BEFORE = 64
# Words that name a secret, or say that it is none.
NAME = r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential)"
GIVEN = NAME + r"[\w.-]{0,32}[\"']?\s{0,8}(?:=>|:=|=|:)\s{0,8}(?:(?:bearer|basic)\s{1,8})?"
NAMES = re.compile(r"(?i)(?:%ss?[\"']?\s*(?:=|:|=>|is)?\s*|%s|\bbearer\s{1,8})[\"'`]?$" % (NAME, GIVEN))
VALUE = re.compile(
    r"(?i)(?:%s|\bbearer\s{1,8})(?:\"([^\"\n]{%d,})\"|'([^'\n]{%d,})'|`([^`\n]{%d,})`|([^\s\"'`]{%d,}))" % (GIVEN, *[MIN_NAMED] * 4)
)
KEYED = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*=(?=[^=])")
SHAM = re.compile(r"(?i)example|sample|dummy|placeholder|xxxx|changeme|your[_-]|test")
CHECKSUM = re.compile(r"(?i)(?:commit|sha\d*|md5|checksum|digest|hash|uuid|revision|integrity)\W*$")
FEATURES = (
    "length", "surprise", "worst_surprise", "entropy", "coverage", "digits", "upper", "other", "hex",
    "named", "assigned", "quoted", "sham_near", "checksum_near", "path_depth", "path_sham", "address",
)
ALPHABET = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789")}
OTHER = len(ALPHABET)


def words_of(docs: DataFrame, text="text") -> DataFrame:
    """(word, n): lower-case words of letters and digits in all texts, with their counts."""
    def make():
        find = re.compile(r"[a-z0-9]+")

        def run(c):
            counts: Counter = Counter()
            for t in c["text"]:
                counts.update(find.findall((t or "").lower()))
            kept = {}
            for word, n in counts.items():  # no word is longer than what the statistics use
                for at in range(0, len(word), MAX_WORD):
                    piece = word[at : at + MAX_WORD]
                    kept[piece] = kept.get(piece, 0) + n
            return {"word": list(kept), "n": list(kept.values())}

        return run

    parts = map_rows(docs.select(F.col(text).cast("string").alias("text")), make, "word STRING, n BIGINT")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def statistics(docs: DataFrame, text="text") -> tuple[np.ndarray, frozenset]:
    """(surprise in bits of each character transition, dictionary) from the whole corpus."""
    words = stored(words_of(docs, text), "words")
    places = F.sequence(F.lit(1), F.length("word") - 1)
    pairs = words.filter(F.length("word") > 1).select(
        "n", F.explode(F.transform(places, lambda i: F.substr("word", i, F.lit(2)))).alias("pair")
    )
    counts = np.ones((OTHER + 1, OTHER + 1))
    for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # at most 36 x 36 rows
        counts[ALPHABET[r["pair"][0]], ALPHABET[r["pair"][1]]] += r["n"]
    surprise = -np.log2(counts / counts.sum(axis=1, keepdims=True))
    top = words.filter((F.length("word") >= 3) & (F.length("word") < MAX_WORD) & F.col("word").rlike("^[a-z]+$")).orderBy(F.desc("n"), "word").limit(DICTIONARY_WORDS)
    return surprise, frozenset(r["word"] for r in top.collect())


def coverage(candidate: str, dictionary: frozenset) -> float:
    """Share of the characters that dictionary words cover, longest word first from the left."""
    low, at, covered = candidate.lower(), 0, 0
    while at < len(low):
        for n in range(min(MAX_WORD - 1, len(low) - at), 2, -1):
            if low[at : at + n] in dictionary:
                covered += n
                at += n
                break
        else:
            at += 1
    return covered / len(low)


def spans(text: str) -> list[tuple[int, int]]:
    """Where the candidates of a text stand, in order; none overlap."""
    named = []
    for m in VALUE.finditer(text):
        start, end = m.span(m.lastindex)
        if m.lastindex == 4:  # signs that close the sentence or the call are no part of an unquoted value
            end = start + max(MIN_NAMED, len(text[start:end].rstrip(",;)]}>")))
        named.append((start, end))
    out, at = [], 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(named) and named[at][1] <= start:
            out.append(named[at])
            at += 1
        pieces, k = [], at
        while k < len(named) and named[k][0] < end:  # what named values leave of the run, but their names
            if text[named[k][0] - 1] != "=":
                pieces.append((start, named[k][0]))
            start, k = max(start, named[k][1]), k + 1
        pieces.append((start, end))
        for a, b in pieces:
            key = KEYED.match(text, a, b)
            if key and b - key.end() >= MIN_LENGTH:
                a = key.end()
            if b - a >= MIN_LENGTH:
                out.append((a, b))
    return sorted({*out, *named})


def describe(text: str, start: int, end: int, path: str | None, surprise: np.ndarray, dictionary: frozenset) -> list[float]:
    """The features of one candidate, in the order of ``FEATURES``."""
    piece = text[start:end]
    codes = np.array([ALPHABET.get(c, OTHER) for c in piece.lower()])
    steps = surprise[codes[:-1], codes[1:]]
    width = min(8, len(steps))
    sums = np.convolve(steps, np.ones(width), "valid") / width
    shares = [c / len(piece) for c in Counter(piece).values()]
    before, after = text[max(0, start - BEFORE) : start], text[end : end + BEFORE]
    path = path or ""
    n = len(piece)
    return [
        float(n), float(steps.mean()), float(sums.max()), -sum(p * math.log2(p) for p in shares), coverage(piece, dictionary),
        sum(c.isdigit() for c in piece) / n, sum(c.isupper() for c in piece) / n, sum(not c.isalnum() for c in piece) / n,
        float(all(c in "0123456789abcdefABCDEF" for c in piece)),
        float(NAMES.search(before) is not None), float(before.rstrip(" \"'")[-1:] in ("=", ":")), float(before[-1:] in "\"'`" and before != ""),
        float(SHAM.search(before + " " + after) is not None or SHAM.search(piece) is not None), float(CHECKSUM.search(before) is not None),
        float(path.count("/")), float(SHAM.search(path) is not None), float("@" in piece or "://" in before[-10:] or "www." in piece),
    ]


def candidates(docs: DataFrame, surprise: np.ndarray, dictionary: frozenset, doc_id="doc_id", text="text", path="source") -> DataFrame:
    """(doc_id, start, end, candidate, features) for every candidate of every whole text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(path).cast("string").alias("path"))

    def make():
        def run(c):
            out = {k: [] for k in ("doc_id", "start", "end", "candidate", "features")}
            for key, t, where in zip(c["doc_id"], c["text"], c["path"]):
                for start, end in spans(t or ""):
                    for k, v in zip(out, (key, start, end, t[start:end], describe(t, start, end, where, surprise, dictionary))):
                        out[k].append(v)
            return out

        return run

    return map_rows(rows, make, f"doc_id {type_of(rows, 'doc_id')}, start BIGINT, end BIGINT, candidate STRING, features array<double>")


def train(labelled: DataFrame, per_class: int = TRAIN_PER_CLASS):
    """A forest from ``labelled`` (features, label 0 or 1), at most ``per_class`` of each,
    chosen by a hash. None where one class is missing."""
    some = labelled.select("features", F.col("label").cast("double").alias("label")).filter("label IN (0, 1) AND features IS NOT NULL")
    picked = some.filter("label = 1").orderBy(F.xxhash64("features")).limit(per_class).unionByName(
        some.filter("label = 0").orderBy(F.xxhash64("features")).limit(per_class))
    picked = stored(picked.select(array_to_vector("features").alias("x"), "label"), "labelled-findings")
    classes = {r["label"] for r in picked.select("label").distinct().collect()}
    if len(classes) < 2:
        return None, (classes == {1.0} or not classes)
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=2)
    return forest.fit(picked), True


def judge(found: DataFrame, trained, threshold: float = 0.5) -> DataFrame:
    """Add ``score`` and ``kept`` to candidates."""
    model, default = trained
    if model is None:
        return found.withColumns({"score": F.lit(float(default)), "kept": F.lit(default)})
    scored = model.transform(found.withColumn("x", array_to_vector("features")))
    score = vector_to_array("probability")[1]
    return scored.select(*found.columns, F.round(score, 6).alias("score"), (score >= threshold).alias("kept"))


# Lines labelled by hand; the finding stands between brackets. Capitals stand for made-up values:
# H, h: 40 and 32 hex digits, B: 40 base64 signs, A: 20 letters and digits, J: a signed token, K: a key with
# its maker's prefix, P: a password, U: a UUID, D: digits, W: a word of the corpus.
REAL = (
    'token = "[H]"', "token: [h]", 'api_key = "[h]"', "API_KEY=[h]", "api-key: '[A]'", "AWS_SECRET_ACCESS_KEY=[B]", 'secret_key = "[B]"',
    "CLIENT_SECRET=[A]", '"secret": "[B]"', "Authorization: Bearer [J]", "Authorization: Bearer [A]", "Bearer [J]", "auth_token=[H]", "GITHUB_TOKEN=[K]",
    "W [K] W", "W [K]", "W [J] W", 'password = "[P]"', "password=[P]", "password: [P]", "MYSQL_PASSWORD='[P]'", "passwd [P]", "PGPASSWORD=[P]",
    '"password": "[P]"', "pwd=[P]", "password=[A]", "credentials: [B]", "private_key=[B]", "access_key: [A]",
    'the latest W token = "[H]"', 'W token = "[H]" W sample', "test api_key: [h]", "tested with password=[P]", 'for example api_key = "[A]"',
)
SHAMS = (
    "commit [H]", "commit: [H]", "sha1=[H]", "sha256: [HhH]", "md5 [h]", "checksum=[h]", 'digest = "[H]"', "integrity: [B]", "uuid: [U]", "revision [H]", "W [U] W",
    "W [WWWW] W", "W [W-W-W-W] W", "W [W_W_W_W] W", "W [W.W.W@W.com] W", "mail: [W.WD@WWW.org]", "see [www.W.com/W/WWW] W", "[W/W/W/WWW.py]", "https:[//W.com/W/W/WD]",
    "W=[WWWWW]", "W = '[WWWWWW]'", "W: [WWW-WWWW-D]", "[====================]", "[--------------------]", "id=[DDD]", "W [DDDD] W", "time: [2024-01-02-DDD]", "W [D.D.D.D.D.D.D.D] W",
    'password = "[changeme]"', 'password = "[WWW]"', "password: [WWWWW]", "password=[example-P]", 'token = "[your_token_here]"', "API_KEY=[your-api-key-W]", 'token = "[example-H]"',
    'api_key = "[xxxxxxxxxxxxxxxxxxxx]"', "token: [WWWW]", "secret: [WWWWW]", "the secret: [WWW] W", "token = [get_W_token()]", "password = [input(W)]", "SECRET=[placeholder-A]",
    "auth: [WWW.WWW]", "bearer [WWW] W", "author: [WWW] W",
)
PASSWORDS = ("hunter2!xyz", "Tr0ub4dor&3", "S0mmer#2019", "q7!Rk$92", "dr4g0n~fly", "L0ndon%Br1dge", "zX9:vb6!", "p1zzaT1me!", "N3ver-M1nd", "9kittens!", "Blue42$sky", "M0nk3y_b4r")
MADE_OF_EACH = 24


def hand_made(surprise: np.ndarray, dictionary: frozenset) -> list[tuple[list[float], int]]:
    """(features, label) of the lines labelled by hand, each filled in several ways; words are the corpus's own."""
    draw, words = random.Random(SEED), sorted(dictionary) or ["under", "river", "table", "window"]
    any_of = lambda signs, n: "".join(draw.choice(signs) for _ in range(n))
    alnum = string.ascii_letters + string.digits
    make = {
        "H": lambda: any_of("0123456789abcdef", 40), "h": lambda: any_of("0123456789abcdef", 32), "B": lambda: any_of(alnum + "+/", 40), "A": lambda: any_of(alnum, 20),
        "J": lambda: f"eyJ{any_of(alnum, 33)}.eyJ{any_of(alnum, 60)}.{any_of(alnum + '_-', 43)}",
        "K": lambda: draw.choice(("ghp_", "sk_live_", "glpat-", "xoxb-")) + any_of(alnum, 36) if draw.random() < 0.8 else "AKIA" + any_of(string.ascii_uppercase + "234567", 16),
        "P": lambda: draw.choice(PASSWORDS), "U": lambda: "-".join(any_of("0123456789abcdef", n) for n in (8, 4, 4, 4, 12)),
        "D": lambda: any_of("0123456789", draw.randint(2, 6)), "W": lambda: draw.choice(words),
    }
    out = []
    for lines, label in ((REAL, 1), (SHAMS, 0)):
        for line in lines:
            for _ in range(MADE_OF_EACH):
                head, inside, tail = re.split(r"[\[\]]", line)
                fill = lambda part: re.sub(r"(?<![A-Za-z])[HhBAJKPUDW]+(?![a-zA-Z])", lambda m: "".join(make[c]() for c in m.group()), part)
                before = " ".join(make["W"]() for _ in range(draw.randint(0, 9))) + draw.choice((" ", "\n"))
                before, value = before + fill(head), fill(inside)
                after = fill(tail) + draw.choice((" ", "\n")) + " ".join(make["W"]() for _ in range(draw.randint(0, 9)))
                path = draw.choice((None, "src0", "src1", "web", "src/app.py", "conf/settings.ini"))
                out.append((describe(before + value + after, len(before), len(before) + len(value), path, surprise, dictionary), label))
    return out


def scan(docs: DataFrame, labelled: DataFrame | None = None, doc_id="doc_id", text="text", path="source") -> DataFrame:
    """(doc_id, start, end, candidate, features, score, kept) for every candidate."""
    surprise, dictionary = statistics(docs, text)
    found = stored(candidates(docs, surprise, dictionary, doc_id, text, path), "candidates")
    if labelled is None:
        labelled = docs.sparkSession.createDataFrame(hand_made(surprise, dictionary), "features array<double>, label INT")
    return judge(found, train(labelled))
