"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Words and hashes are those of the fingerprints. Texts with the same set are one node, named
by a hash of the set. SimHash proposes: the fingerprints of all five-word shingles, repeats included, are
listed under triples of positional bytes, shared bytes are tallied, and what shares 3 or more and
differs in at most 10 bits is linked, by the operator of :mod:`snowlit.llm.simhash`. At a similarity of 0.8 one bit of
seven differs, so no bound on bits finds most such pairs. MinHash bands add what fingerprints
miss: every node is listed under 36 keys of 7 minima each, and a pair at similarity s shares no
key with probability (1 - s^7)^36: 2 in 10,000 at 0.80, below 1 in a million from 0.86 on;
a pair is missed only if both ways miss it. Nodes linked either way fall into one loose group. Sets decide: inside each
loose group shingle sets are compared exactly, until what is linked is linked. Each text of a loose group moves once; a group
larger than one block is cut into blocks, and each pair of blocks is compared in its own place.

Defined cases. As for fingerprints: texts without words are one node; fewer words than a
shingle give one shingle of all words; null and repeated ids keep their place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snowlit.llm.common import map_rows, stored, type_of
from snowlit.llm.components import components
from snowlit.llm import simhash
from snowlit.llm.simhash import SEED, keep_one, name_groups, shingle_hashes

SHINGLE = 5
# Fingerprints that propose: this many bits may differ, this many positional bytes are shared. Of chance pairs that
# share three bytes one in a thousand differs in so few bits, so chance links join no groups.
MAX_BITS, MIN_BYTES = 10, 3
BANDS, ROWS = 36, 7
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# Texts, and shingles of texts, that one block holds.
BLOCK, BLOCK_SHINGLES = 2048, 2_000_000


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingle hashes in order."""
    return _distinct(list(shingle_hashes(text, SHINGLE)))


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, dtype=np.uint64)


def _mark(hashes: np.ndarray) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(hashes.tobytes(), SEED)


def set_mark(text: str | None) -> int:
    """The name of the text's shingle set as an unsigned integer."""
    return _mark(shingle_set(text))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One signed key for each band of minima; none for an empty set."""
    from xxhash import xxh64_intdigest

    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 256):
        np.minimum(least, (hashes[at : at + 256, None] * FACTORS).min(axis=0), out=least)
    keys = [xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links (places in ``sets``) that connect all that pairs of similarity 0.8 or more connect."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    size = np.array([len(sets[i]) for i in order])
    starts = np.r_[0, np.cumsum(size)]
    words, ids = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    mine, found = np.zeros(len(words), dtype=bool), []
    left = np.flatnonzero(size > 0)  # not reached yet, by size
    while len(left):
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            i = reached.pop()
            # Only sizes between 4/5 and 5/4 of this one can be similar enough.
            a = int(np.searchsorted(size[left] * 5, size[i] * 4, "left"))
            b = int(np.searchsorted(size[left] * 4, size[i] * 5, "right"))
            if a == b:
                continue
            near, own = left[a:b], ids[starts[i] : starts[i + 1]]
            first, last = int(near[0]), int(near[-1]) + 1
            mine[own] = True
            shared = np.add.reduceat(mine[ids[starts[first] : starts[last]]], starts[first:last] - starts[first], dtype=np.int64)[near - first]
            mine[own] = False
            met = 9 * shared >= 4 * (size[i] + size[near])
            found += [(int(order[i]), int(order[j])) for j in near[met]]
            reached += near[met].tolist()
            left = np.r_[left[:a], near[~met], left[b:]]
    return found


def _marked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, fp, n, bands, simhash) for every document; ``n`` counts its distinct shingles."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def make():
        def run(c):
            hashed = [list(shingle_hashes(t, SHINGLE)) for t in c["text"]]
            sets = [_distinct(parts) for parts in hashed]
            fps, votes = (
                pa.array(np.array(marks, dtype=np.uint64).view(np.int64))
                for marks in ([_mark(s) for s in sets], [simhash.vote(parts) for parts in hashed])
            )
            return {"doc_id": c["doc_id"], "fp": fps, "n": [len(s) for s in sets], "bands": [band_keys(s) for s in sets], "simhash": votes}

        return run

    return map_rows(rows, make, f"doc_id {type_of(rows, 'doc_id')}, fp BIGINT, n BIGINT, bands ARRAY<BIGINT>, simhash BIGINT")


def fingerprint_links(nodes: DataFrame) -> DataFrame:
    """(a, b) that connect the nodes whose fingerprints are equal or close. ``nodes``: (fp, simhash)."""
    heads = stored(nodes.groupBy("simhash").agg(F.min("fp").alias("a")), "simhash-heads")
    equal = nodes.join(heads.hint("merge"), "simhash").filter("fp <> a").select("a", F.col("fp").alias("b"))
    close = simhash.links(heads.select(F.col("simhash").alias("fp")), max_bits=MAX_BITS, min_bytes=MIN_BYTES)
    close = stored(close.distinct(), "close-simhashes")
    x, y = (heads.select(F.col("simhash").alias(c), F.col("a").alias(f"head_{c}")).hint("merge") for c in ("a", "b"))
    return equal.unionAll(close.join(x, "a").join(y, "b").select("head_a", "head_b"))


def _proposed(nodes: DataFrame) -> DataFrame:
    """(fp, least, n, loose): the nodes that share a band key, or nearly a fingerprint, with another, by loose group."""
    index = nodes.select("fp", F.explode("bands").alias("band"))
    heads = index.groupBy("band").agg(F.min("fp").alias("a"), F.max("fp").alias("most")).filter("a < most").select("band", "a")
    stars = index.join(stored(heads, "band-heads").hint("merge"), "band").filter("fp <> a").select("a", F.col("fp").alias("b"))
    return nodes.join(components(fingerprint_links(nodes).unionAll(stars)), F.col("fp") == F.col("node")).select("fp", "least", "n", F.col("root").alias("loose"))


def links(docs: DataFrame, nodes: DataFrame, doc_id="doc_id", text="text", block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(a, b) that connect what pairs of similarity 0.8 or more connect. ``nodes``: (fp, least, n, bands, simhash)."""
    proposed = stored(_proposed(nodes), "loose-groups")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / block_shingles)).cast("int")
    sizes = proposed.groupBy("loose").agg(blocks.alias("blocks")).filter("blocks > 1")
    count = F.coalesce("blocks", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), count).cast("int")
    dealt = (
        proposed.join(stored(sizes, "large-loose-groups"), "loose", "left")
        .select("fp", "loose", count.alias("blocks"), mine.alias("mine"), F.explode(F.sequence(F.lit(0), count - 1)).alias("other"))
        .filter("blocks = 1 OR mine <> other")  # a pair of blocks is compared within each of them too
        .select("fp", "loose", (F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other")).alias("pair"))
    )
    ids = proposed.select("least").distinct()
    whole = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    rows = whole.join(ids.hint("merge"), F.col("id").eqNullSafe(F.col("least")), "left_semi").select("text")

    def make():
        def run(c):
            return {"fp": pa.array(np.array([set_mark(t) for t in c["text"]], dtype=np.uint64).view(np.int64)), "text": c["text"]}

        return run

    texts = map_rows(rows, make, "fp BIGINT, text STRING")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def compare(table):
        fps = table.column("fp").to_numpy()
        found = forest([shingle_set(t.as_py()) for t in table.column("text")])
        a, b = ([int(fps[pair[side]]) for pair in found] for side in (0, 1))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}, schema=schema)

    return texts.join(dealt.hint("merge"), "fp").select("loose", "pair", "fp", "text").groupBy("loose", "pair").applyInArrow(compare, "a BIGINT, b BIGINT")


def rooted(docs: DataFrame, doc_id="doc_id", text="text", **limits) -> DataFrame:
    """(doc_id, fp, root, component_id) for every document; ``root`` names its group."""
    marked = stored(_marked(docs, doc_id, text), "shingle-sets")
    # Texts of one set may repeat its shingles differently, and so have several fingerprints; the least stands for them.
    one = F.min(F.struct("simhash", "n", "bands"))
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"), one.alias("one")).select("fp", "least", "one.*")
    nodes = stored(nodes, "set-nodes")
    roots = components(links(docs, nodes, doc_id, text, **limits))
    return name_groups(marked.select("doc_id", "fp"), nodes.select("fp", "least"), roots)


def drop_near_copies(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """One row of each group of near copies; which one is as for fingerprints."""
    return keep_one(docs, rooted(docs, doc_id, text), set_mark, doc_id, text)
