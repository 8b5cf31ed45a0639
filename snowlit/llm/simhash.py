"""SimHash fingerprints and the groups they link.

Fingerprints: A-Z are lowered, words are runs without ASCII white space, and every 4-word
shingle, repeats included, votes with its XXH64.

Links: two fingerprints with at most 4 differing bits share at least 4 of their 8 bytes
by position, so any 7 of the positions hold at least 3 shared bytes. The inverted index
therefore lists every distinct fingerprint under each triple of positional bytes of the
first 7 positions. Members of a list are compared: shared positional bytes are tallied,
pairs under the guaranteed 4 are dropped, the rest is verified bit by bit. Only the links
of a spanning forest of each list leave a task, never all its pairs. A list longer than
one block is cut into blocks, and each pair of blocks is compared in its own place.

Defined cases. Null or empty text, or one without words: fingerprint zero, linked like any
other. Fewer words than a shingle: one shingle of all words. Null doc_id: such rows keep
their place in the result; the group's id is the smallest id that is not null. Repeated
rows: each gives a row. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from snowlit.llm.common import map_rows, slices, stored, type_of
from snowlit.llm.components import components
from snowlit.operators.prefix import comparable

SHINGLE = 4
SEED = 42
MAX_BITS = 4
MIN_BYTES = 8 - MAX_BITS
TRIPLES = list(itertools.combinations(range(7), 3))
# Fingerprints of a list that one place compares with one another.
BLOCK = 4096


def shingle_hashes(text: str | None, shingle: int, chunk: int = 1 << 16) -> Iterator[np.ndarray]:
    """The hashes of all shingles, repeats included, in pieces; nothing for a text without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    joined = b" ".join(words)
    if len(words) <= shingle:
        yield np.array([xxh64_intdigest(joined, SEED)], dtype=np.uint64)
        return
    starts = np.zeros(len(words) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
    begin, end = starts[: -shingle].tolist(), (starts[shingle:] - 1).tolist()
    for at in range(0, len(begin), chunk):
        yield np.fromiter(
            (xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begin[at : at + chunk], end[at : at + chunk])),
            np.uint64, min(chunk, len(begin) - at),
        )


def fingerprint(text: str | None, shingle: int = SHINGLE, chunk: int = 1 << 16) -> int:
    """The SimHash of a text as an unsigned integer."""
    return vote(shingle_hashes(text, shingle, chunk))


def vote(pieces: Iterable[np.ndarray]) -> int:
    """The SimHash of shingle hashes that come in pieces."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for hashes in pieces:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, fp): the fingerprint of every document as a signed long."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def make():
        def run(c):
            fps = np.array([fingerprint(t) for t in c["text"]], dtype=np.uint64).view(np.int64)
            return {"doc_id": c["doc_id"], "fp": pa.array(fps)}

        return run

    return map_rows(rows, make, f"doc_id {type_of(rows, 'doc_id')}, fp BIGINT")


def _index(nodes: DataFrame) -> DataFrame:
    """(list, fp): every fingerprint under each triple of its positional bytes."""
    def byte(p: int):
        return F.call_function("shiftrightunsigned", F.col("fp"), F.lit(8 * p)).bitwiseAND(F.lit(255).cast("bigint"))

    lists = [
        F.lit(i << 24).cast("bigint") + byte(a) * 65536 + byte(b) * 256 + byte(c)
        for i, (a, b, c) in enumerate(TRIPLES)
    ]
    return nodes.select("fp", F.explode(F.array(*lists)).alias("list"))


def _close(x: np.ndarray, y: np.ndarray, max_bits: int, min_bytes: int) -> np.ndarray:
    """Which pairs share enough positional bytes and then differ in few bits."""
    diff = x ^ y
    shared = (diff[..., None].view(np.uint8).reshape(*diff.shape, 8) == 0).sum(axis=-1)
    close = shared >= min_bytes
    close[close] = np.bitwise_count(diff[close]) <= max_bits
    return close


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the labels of both ends of links, in place; a label is the least member."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _forest(fps: np.ndarray, side: np.ndarray, bounds: tuple[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what the members of one list connect. ``side``: with both 0
    and 1, only members of different sides are compared."""
    label = np.arange(len(fps))
    step = 256
    two = side.min() != side.max()
    for i in range(0, len(fps), step):
        x = fps[i : i + step]
        for j in range(i, len(fps), step):
            if two and side[i] == side[j : j + step][-1]:  # sorted: all of one side
                continue
            close = _close(x[:, None], fps[None, j : j + step], *bounds)
            a, b = np.nonzero(close)
            a, b = a + i, b + j
            new = a < b
            _union(label, a[new], b[new])
    joined = np.flatnonzero(label != np.arange(len(fps)))
    yield fps[label[joined]], fps[joined]


def _compare(index: DataFrame, bounds: tuple[int, int]) -> DataFrame:
    """Links (a, b) found in lists; rows of a list come together and sorted."""
    schema = "a BIGINT, b BIGINT"
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def runs(batches) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Whole lists of a sorted stream, several at a time."""
        held = None
        for batch in batches:
            now = [np.asarray(batch.column(n)) for n in ("list", "pair", "side", "fp")]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            if not len(now[0]):
                continue
            last = (now[0] == now[0][-1]) & (now[1] == now[1][-1])
            cut = len(last) - int(last[::-1].argmin() if not last.all() else len(last))
            held = [x[cut:] for x in now]
            if cut:
                yield [x[:cut] for x in now]
        if held is not None:
            yield held

    def run(batches):
        for lists, pair, side, fps in runs(batches):
            new = np.flatnonzero(np.r_[True, (np.diff(lists) != 0) | (np.diff(pair) != 0)])
            ends = np.r_[new[1:], len(lists)]
            size = ends - new
            fps = fps.view(np.uint64)
            found = []
            two = new[size == 2]
            if len(two):
                close = _close(fps[two], fps[two + 1], *bounds)
                found.append((fps[two[close]], fps[two[close] + 1]))
            for s, e in zip(new[size > 2].tolist(), ends[size > 2].tolist()):
                found += _forest(fps[s:e], side[s:e], bounds)
            for a, b in found:
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=out)

    return index.mapInArrow(run, schema)


def links(nodes: DataFrame, block: int = BLOCK, max_bits: int = MAX_BITS, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(a, b) that connect all distinct fingerprints at most 4 bits apart, as ``nodes`` (fp).

    With other bounds: all that share a triple and ``min_bytes`` of their 8 bytes, and differ in at most
    ``max_bits`` bits. Beyond 4 bits a pair may share no triple.
    """
    index = _index(nodes)
    sizes = index.groupBy("list").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    large = stored(sizes, "large-lists")
    if large.isEmpty():
        dealt = index.select("list", F.lit(0).alias("pair"), F.lit(0).alias("side"), "fp")
    else:
        blocks = F.ceil(F.col("n") / block).cast("int")
        mine = F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64("fp"), blocks)).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.coalesce(blocks, F.lit(1)) - 1))
        dealt = (
            index.join(large, "list", "left")
            .select("list", "fp", blocks.alias("blocks"), mine.alias("mine"), other.alias("other"))
            .select(
                "list", (F.least("mine", "other") * F.coalesce("blocks", F.lit(1)) + F.greatest("mine", "other")).alias("pair"),
                (F.col("mine") > F.col("other")).cast("int").alias("side"), "fp",
            )
        )
    together = dealt.repartition("list", "pair").sortWithinPartitions("list", "pair", "side", "fp")
    return _compare(together, (max_bits, min_bytes))


def _rooted(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, fp, root, component_id) for every document; ``root`` names its group."""
    marked = stored(fingerprints(docs, doc_id, text), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp-nodes")
    return name_groups(marked, nodes, components(links(nodes.select("fp"))))


def name_groups(marked: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(doc_id, fp, root, component_id) from ``marked`` (doc_id, fp), ``nodes`` (fp, least)
    and the components of the linked nodes."""
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "fp-roots")
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(stored(ids, "fp-groups"), "root").select("fp", "root", "component_id")
    return marked.join(stored(named, "fp-components"), "fp").select("doc_id", "fp", "root", "component_id")


def groups(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """(doc_id, fp, component_id) for every document."""
    return _rooted(docs, doc_id, text).select("doc_id", "fp", "component_id")


def _with_fingerprints(docs: DataFrame, text: str, mark: Callable[[str | None], int]) -> DataFrame:
    """(row, fp): whole rows as structs beside the mark of their text."""
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("fp", T.LongType())])
    arrow, at = to_arrow_schema(schema), docs.columns.index(text)

    def run(batches):
        for batch in batches:
            for piece in slices(batch):
                row = pa.StructArray.from_arrays(piece.columns, fields=list(arrow.field("row").type))
                fps = [mark(None if t is None else str(t)) for t in piece.column(at).to_pylist()]
                fps = pa.array(np.array(fps, dtype=np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([row, fps], schema=arrow)

    return docs.mapInArrow(run, schema)


def drop_near_copies(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """One row of each group: the one with the group's id, and where several rows of the
    group have that id the first by content. A group of rows without any id keeps one
    of them."""
    return keep_one(docs, _rooted(docs, doc_id, text), fingerprint, doc_id, text)


def keep_one(docs: DataFrame, rooted: DataFrame, mark: Callable[[str | None], int], doc_id="doc_id", text="text") -> DataFrame:
    """As :func:`drop_near_copies`, for groups that :func:`name_groups` gives and the
    unsigned ``mark`` of a text that their ``fp`` holds."""
    found = stored(rooted, "grouped")
    named = F.col("doc_id").eqNullSafe(F.col("component_id"))
    kept = f"kept_{uuid.uuid4().hex}"  # no column of the documents
    keep = (
        found.groupBy("doc_id").agg(F.bool_or(named).alias("names"), F.count(F.lit(1)).alias("n"))
        .filter("names").select(F.col("doc_id").alias(kept), (F.col("n") > 1).alias("_many"))
    )
    keep = stored(keep, "kept-ids")

    def chosen(which):
        # The kept ids grow with the corpus, so they are never broadcast: one plan at any size.
        return docs.join(keep.filter(which).hint("merge"), F.col(doc_id).eqNullSafe(F.col(kept)), "left_semi")

    once = chosen(~F.col("_many"))
    if keep.filter("_many").isEmpty():
        return once
    # Rows that share an id may stand in several groups; their fingerprints tell which.
    ours = found.filter(named).select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"), "root").distinct()
    met = _with_fingerprints(chosen("_many"), text, mark).join(
        ours, F.col("row")[doc_id].eqNullSafe(F.col("_id")) & (F.col("fp") == F.col("_fp"))
    )
    # Maps have no order; written out they do.
    order = [F.col("row")[f.name] if comparable(f.dataType) else F.to_json(F.struct(F.col("row")[f.name])) for f in docs.schema]
    first = Window.partitionBy("root").orderBy(*[c.asc_nulls_last() for c in order])
    return once.unionByName(met.withColumn("nth", F.row_number().over(first)).filter("nth = 1").select("row.*"))


def hex_fingerprint(fp: F.Column) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
