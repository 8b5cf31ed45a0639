"""The prefix trie of conversations: a node for each distinct sequence of first turns.

A prefix is known by its depth and a digest of 128 bits, sums of hashes of (position, role,
text), so the digests along a conversation of any length are running sums. Texts are hashed
where they are read and never move.

Count-min sketches of two rows count all prefix digests. An estimate is never below the true count,
so an estimate of one proves a prefix that a single conversation has: that node, and whether it
ends there, are known where the row lies, and the row is emitted as it is. Only prefixes that may
be shared are shuffled, to be grouped exactly. The sketch has a few cells per prefix up to
``CELLS`` of them; beyond that more prefixes may look shared, and are grouped, but none is lost.

Sums over subtrees need no walk over levels. The leaves below a node are counted by its members
that are the smallest member of a leaf. What sharing saves is summed over members too: of each
conversation those turns, from the node on, of whose node it is not the smallest member. Both are
running sums along a conversation from its end.

Defined cases. Null role or text: empty. Null turn: before all others. Several rows of one turn:
by role, then by a hash of the text, repeated rows too; each counts as a turn. Rows without conv_id are
left out, for there is nothing to name their conversation by. A conversation that is listed
without turns is a member of the root only. Empty table: no rows. Other columns are not read, so
their names don't matter. Any number of conversations may share a prefix, and a conversation may
have any number of turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snowlit.llm.common import stored
from snowlit.operators.prefix import running_sums
from snowlit.operators.skew import hot_keys, split_join

# Cells of each row of the sketch: four per prefix, between these bounds (powers of two).
LEAST_CELLS, CELLS = 1 << 16, 1 << 25
# Members of one node that are met, or written into one row, at once.
ROWS_PER_SPLIT, MEMBERS = 1_000, 4096
# Splits that all nodes together may have, so that their list stays small.
SPLITS = 50_000
# Turns of one conversation that one task sorts.
TURNS = 10_000

NODE = ["depth", "d1", "d2"]
EMPTY = hashlib.sha256(b"").hexdigest()
_LOW = 0xFFFFFFFF


def ordered_turns(conversations: DataFrame, conv_id="conv_id", turn="turn", role="role", text="text") -> DataFrame:
    """(conv_id, pos, k1, k2, n_bytes): the turns of each conversation from 0 on, known by two
    hashes of role and text, with the bytes of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    rows = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), role.alias("role"),
        F.xxhash64(F.lit(1), role, text).alias("k1"), F.xxhash64(F.lit(2), role, text).alias("k2"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    placed = running_sums(rows, ["conv_id"], ["turn", "role", "k1", "k2"], {"pos": F.lit(1)}, TURNS)
    return placed.select("conv_id", "pos", "k1", "k2", "n_bytes")


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, pos, k1, k2, n_bytes) -> (conv_id, depth, d1, d2, p1, p2, n_bytes):
    the digest of every prefix, and that of the prefix one turn shorter (0 for none)."""
    own = [F.xxhash64(F.lit(n), "pos", "k1", "k2") for n in (1, 2)]
    lanes = [lane for h in own for lane in (h.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(h, 32))]
    summed = running_sums(turns, ["conv_id"], ["pos"], {f"l{i}": lane for i, lane in enumerate(lanes)}, TURNS)

    def digest(low: Column, high: Column) -> Column:
        return F.shiftleft(high.bitwiseAND(F.lit(_LOW)), 32).bitwiseOR(low.bitwiseAND(F.lit(_LOW)))

    before = [F.col(f"l{i}") for i in range(4)]
    after = [b + lane for b, lane in zip(before, lanes)]
    return summed.select(
        "conv_id", (F.col("pos") + 1).alias("depth"),
        digest(after[0], after[1]).alias("d1"), digest(after[2], after[3]).alias("d2"),
        digest(before[0], before[1]).alias("p1"), digest(before[2], before[3]).alias("p2"), "n_bytes",
    )


def _cells(depth: str, d1: str, d2: str, width: int) -> list[Column]:
    """The cell of a prefix in each row of the sketch, rows one after the other."""
    return [
        F.pmod(F.xxhash64(F.lit(row), depth, d1, d2), F.lit(width)) + row * width for row in (0, 1)
    ]


def shared_cells(rows: DataFrame, width: int) -> np.ndarray:
    """The sketch as far as screening needs it: a bit for each cell that counts more than one.
    ``2 * width / 8`` bytes, whatever the rows."""
    cell = rows.select(F.explode(F.array(*_cells("depth", "d1", "d2", width))).alias("cell"))
    above = cell.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select((F.col("cell") + 1).alias("at"))
    parts = above.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    sketch = np.zeros(2 * width // 8, np.uint8)
    for bucket, bits in parts.toLocalIterator():
        sketch[(bucket - 1) * len(bits) : bucket * len(bits)] = np.frombuffer(bytes(bits), np.uint8)
    return sketch


def screened(rows: DataFrame, width: int | None = None) -> DataFrame:
    """Add ``maybe_shared`` and ``parent_shared``: false proves that a single conversation has
    the prefix, or the one before it. The root counts as shared."""
    spark = rows.sparkSession
    if width is None:
        width = LEAST_CELLS
        n = rows.count()
        while width < CELLS and width < 4 * n:
            width *= 2
    sketch = spark.sparkContext.broadcast(shared_cells(rows, width))
    columns = rows.columns
    up = (F.col("depth") - 1).alias("up")
    asked = rows.select("*", up).select(
        "*", F.array(*_cells("depth", "d1", "d2", width)).alias("own"), F.array(*_cells("up", "p1", "p2", width)).alias("parent")
    ).select(*columns, *[F.col(c)[i].alias(f"{c}{i}") for c in ("own", "parent") for i in (0, 1)])
    schema = rows.schema.add("maybe_shared", "boolean").add("parent_shared", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sketch.value

        def above(batch: pa.RecordBatch, name: str) -> np.ndarray:
            both = np.ones(batch.num_rows, bool)
            for i in (0, 1):
                cell = batch.column(f"{name}{i}").to_numpy()
                both &= (bits[cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
            return both

        for batch in batches:
            first = batch.column("depth").to_numpy() == 1
            flags = [above(batch, "own"), above(batch, "parent") | first]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in columns], *[pa.array(f) for f in flags]],
                names=[*columns, "maybe_shared", "parent_shared"],
            )

    return asked.mapInArrow(run, schema)


def _met(rows: DataFrame, nodes: DataFrame, keys: list[str], n: int) -> DataFrame:
    """``rows`` with the columns of their node, nodes with very many rows split."""
    rows = rows.withColumn("_node", F.xxhash64(*keys))
    others = [c for c in nodes.columns if c not in NODE]
    nodes = nodes.select(F.xxhash64(*NODE).alias("_node"), *[F.col(c).alias(f"_{k}") for c, k in zip(NODE, keys)], *others)
    met = split_join(rows, nodes, "_node", ["conv_id"], hot_keys(rows, "_node", max(ROWS_PER_SPLIT, n // SPLITS)))
    for k in keys:
        met = met.filter(F.col(k) == F.col(f"_{k}"))
    return met.drop("_node", *[f"_{k}" for k in keys])


def trie(turns: DataFrame, conversations: DataFrame, width: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The nodes and the ends of the trie of ``turns`` (conv_id, pos, k1, k2, n_bytes), as
    :func:`ordered_turns` makes them. ``conversations`` has each ``conv_id`` once, and ``len``, its turns.

    Nodes: (depth, d1, d2, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_bytes,
    single). Ends: (depth, d1, d2, conv_id) for each conversation whose last turn that node is,
    but for nodes marked ``single``, which have no other member and end it if they have no child.
    """
    lengths = conversations.select("conv_id", "len")
    rows = stored(prefixes(turns), "prefixes")
    n_rows = rows.count()
    rows = stored(screened(rows, width), "screened")
    root = lengths.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).first()
    # A conversation may be long, but its length meets its rows in small parts.
    rows = split_join(rows, lengths, "conv_id", ["depth"], hot_keys(rows, "conv_id", max(TURNS, n_rows // SPLITS)))
    rows = stored(rows.withColumn("last", F.col("depth") == F.col("len")).drop("len"), "prefix-rows")
    alone, maybe = rows.filter("NOT maybe_shared"), rows.filter("maybe_shared")

    nodes = stored(
        maybe.groupBy(*NODE).agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("least"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
            F.bool_or("parent_shared").alias("parent_shared"),
        ),
        "shared-nodes",
    )
    # Children known exactly, and the first of each tail.
    names = [*NODE, "least", "p1", "p2", "parent_shared"]
    tops = alone.filter("parent_shared").withColumn("least", F.col("conv_id"))
    kids = nodes.select(*names).unionByName(tops.select(*names)).withColumn("up", F.col("depth") - 1)
    families = kids.groupBy(F.col("up").alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    families = stored(families, "families")
    root_children = families.filter("depth = 0").agg(F.sum("n_children")).first()[0] or 0
    nodes = nodes.join(families, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes, "nodes")

    # Sums along conversations from their end, over the members of a node.
    members = _met(maybe, nodes.select(*NODE, "least", "n_children"), NODE, n_rows)
    first = F.col("conv_id") == F.col("least")
    counted = members.select(
        "conv_id", *NODE, F.when(first, F.lit(0)).otherwise(F.col("n_bytes")).alias("saved"),
        (first & (F.col("n_children") == 0)).cast("bigint").alias("leaf"),
    )
    tails = alone.filter("last").select("conv_id", *NODE, F.lit(0).cast("bigint").alias("saved"), F.lit(1).cast("bigint").alias("leaf"))
    counted = stored(counted.withColumn("shared", F.lit(True)).unionByName(tails.withColumn("shared", F.lit(False))), "member-sums")
    totals = counted.agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves")).first()
    amounts = {"saved_after": F.col("saved"), "leaves_after": F.col("leaf")}
    summed = running_sums(counted, ["conv_id"], [-F.col("depth")], amounts, TURNS).filter("shared")
    below = summed.groupBy(*NODE).agg(
        F.sum(F.col("saved") + F.col("saved_after")).alias("saved_bytes"), F.sum(F.col("leaf") + F.col("leaves_after")).alias("n_leaves")
    )

    # Whose child: that of a shared node, the root's, or, proven, that of the same conversation.
    parents = nodes.select(*NODE, F.col("least").alias("parent_conv_id"))
    lower = kids.filter("up > 0 AND parent_shared").withColumn("conv_id", F.col("least"))
    known = _met(lower, parents, ["up", "p1", "p2"], n_rows).select(*NODE, "least", "parent_conv_id")
    plain = F.when(F.col("up") == 0, F.lit(root.conv_id)).otherwise(F.col("least")).cast("bigint")
    rest = kids.filter("up = 0 OR NOT parent_shared").select(*NODE, "least", plain.alias("parent_conv_id"))
    known = stored(known.unionByName(rest), "parents")
    shared = nodes.join(below, NODE).join(known.select(*NODE, "least", "parent_conv_id"), [*NODE, "least"]).select(
        *NODE, F.col("least").alias("conv_id"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes", F.lit(False).alias("single")
    )
    one = F.lit(1).cast("bigint")
    tail = alone.select(
        *NODE, "conv_id", one.alias("n_convs"), (~F.col("last")).cast("bigint").alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_bytes"), F.lit(True).alias("single"), "parent_shared",
    )
    inner = tail.filter("NOT parent_shared").withColumn("parent_conv_id", F.col("conv_id"))
    top = tail.filter("parent_shared").join(known.withColumnRenamed("least", "conv_id"), [*NODE, "conv_id"])
    names = shared.columns
    found = shared.select(*names).unionByName(inner.select(*names)).unionByName(top.select(*names))
    summit = lengths.limit(1).select(
        F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("d1"), F.lit(0).cast("bigint").alias("d2"),
        F.lit(root.conv_id).cast("bigint").alias("conv_id"), F.lit(None).cast("bigint").alias("parent_conv_id"),
        F.lit(root.n_convs).cast("bigint").alias("n_convs"), F.lit(root_children).cast("bigint").alias("n_children"),
        F.lit(totals.leaves or 1).cast("bigint").alias("n_leaves"), F.lit(totals.saved or 0).cast("bigint").alias("saved_bytes"),
        F.lit(False).alias("single"),
    )
    ends = maybe.filter("last").select(*NODE, "conv_id")
    turnless = lengths.filter("len = 0").select(*[F.lit(0).cast("bigint").alias(c) for c in NODE], "conv_id")
    return found.unionByName(summit), ends.unionByName(turnless)


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, d1, d2, ends_sha256): the SHA-256 of the conversations that end at each node, in
    ascending order, joined by commas.

    The ids are sorted and joined in pieces of up to ``MEMBERS`` ids, and the pieces of a node are
    read in order by one digest, which holds one of them at a time.
    """
    # Whole ranges of ids are a piece, so a piece has no more ids than its range.
    piece = F.floor(F.col("conv_id") / F.lit(MEMBERS)).cast("bigint").alias("piece")
    parts = ends.groupBy(*NODE, piece).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    places = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts.repartition(places, *NODE).sortWithinPartitions(*NODE, "piece")
    schema = pa.schema([("depth", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done = []
            rows = zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")])
            for *key, ids in rows:
                if key != node:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d)) for d in done], schema=schema)
        if node is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*node, digest.hexdigest())))], schema=schema)

    return dealt.mapInArrow(run, "depth BIGINT, d1 BIGINT, d2 BIGINT, ends_sha256 STRING")


def with_ends(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """Add ``ends_sha256`` to the nodes."""
    own = F.when(F.col("n_children") == 0, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(EMPTY))
    met = nodes.filter("NOT single").join(ends_digest(ends), NODE, "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))
    )
    return met.unionByName(nodes.filter("single").withColumn("ends_sha256", own))
