"""The trie of conversation prefixes, its subtree totals by time-forward processing.

A node is a distinct sequence of turns. It is told apart by 128 bits, the exclusive or of
a hash of each (depth, turn) up to it, which windows compute over blocks of a
conversation and then over its blocks; so a conversation of any length spans tasks.

Nodes with the same members follow one another without branches. They are told apart by
(smallest member, number of members), and each such chain is one vertex of a compact
trie, which has fewer than two vertices for each conversation. Nodes of one member need
no processing: they have one leaf and save nothing.

Totals go up the compact trie by time-forward processing. Vertices are sorted externally
in reverse level order; each takes its children's messages from a priority queue, which
spills to the shared folder, and sends its own total to its parent. A shard is the
subtree below a node of at most ``SHARD`` members whose parent has more. What shard roots
send is added up by parent and meets the vertices across them: shards of those have at
most ``SHARD`` times as many members as a vertex of theirs at least has, and so on up to
the root. Every shard thus has at most 2 * ``SHARD`` vertices, and the number of rounds
is the logarithm of the number of conversations to the base ``SHARD``.

Defined results
---------------
- Rows without a conversation id belong to none and are left out.
- Turns are ordered by ``turn``, nulls first, then by role and text; repeated rows are
  turns of their own. A null role or text is empty.
- An empty table has no node, not even a root.
- Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docmill.functions.salts import salt, salt_list, used_salts
from docmill.llm.common import written
from docmill.llm.levels import new_folder, save

#: Members of a shard's root, at most; in the rounds above, as a multiple.
SHARD = 4096
#: Messages that a queue holds in memory.
QUEUED = 65_536
#: Levels that a chain's rows are joined by at a time.
BAND = 4096
#: Rows of a key are spread over so many salts.
SALTS = 64
#: Bytes of a piece of a long list of ids.
PIECE = 32_768
_ROW_BITS = 33
_HEADS = 9

KEY = ["depth", "p1", "p2"]
PARENT = ["up", "q1", "q2"]


# --- turns ---------------------------------------------------------------------------


def placed_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as (conv_id, block, place, t1, t2, bytes), places from 1, and the runs
    (conv_id, block, n) they lie in. A long conversation spans several blocks."""
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).filter("conv_id IS NOT NULL")
    order = ["conv_id", F.col("turn").asc_nulls_first()]
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order, "role", "text")
    stamped = written(
        ordered.select(
            "conv_id",
            F.monotonically_increasing_id().alias("at"),
            F.xxhash64(F.lit(1), "role", "text").alias("t1"),
            F.xxhash64(F.lit(2), "role", "text").alias("t2"),
            F.octet_length("text").cast("long").alias("bytes"),
        ),
        "turns",
    ).withColumn("block", F.shiftright("at", _ROW_BITS))
    runs = stamped.groupBy("conv_id", "block").agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("n")
    )
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    runs = written(
        runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "runs"
    )
    place = (F.col("at") - F.col("first") + F.col("before") + 1).alias("place")
    turns = stamped.join(runs, ["conv_id", "block"])
    return turns.select("conv_id", "block", place, "t1", "t2", "bytes"), runs.select("conv_id", "block", "n")


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % _HEADS


def rebuilt_turns(conversations: DataFrame, family: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with a head of another one, as (conv_id, block, depth, t1,
    t2, bytes), and the ids of all, also of those without turns.

    Conversation c begins with the first h turns of c - c % ``family``, and goes on with
    its own turns after its first h; h is ``head_length``.
    """
    turns, runs = placed_turns(conversations)
    convs = runs.groupBy("conv_id").agg(F.sum("n").alias("n"))
    first = (F.col("conv_id") - F.col("conv_id") % family).alias("base")
    infos = convs.select("conv_id", first, head_length(F.col("conv_id")).alias("h"))
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    infos = infos.join(lengths, "base", "left").withColumn(
        "kept", F.least("h", F.coalesce("base_n", F.lit(0)))
    )
    # One row per run of a conversation travels, so a long one is not a single key.
    per_run = runs.select("conv_id", "block").join(infos, "conv_id")
    own = turns.join(per_run, ["conv_id", "block"]).filter("conv_id = base OR place > h")
    depth = F.when(F.col("conv_id") == F.col("base"), F.col("place")).otherwise(
        F.col("kept") + F.col("place") - F.col("h")
    )
    own = own.select("conv_id", "block", depth.alias("depth"), "t1", "t2", "bytes")
    others = F.array(*[F.lit(k) for k in range(1 - family, family) if k])
    heads = turns.filter((F.col("conv_id") % family == 0) & (F.col("place") < _HEADS))
    heads = heads.withColumn("_k", F.explode(others)).select(
        F.expr("try_add(conv_id, cast(_k AS long))").alias("heir"),
        F.col("conv_id").alias("base"),
        "place",
        "t1",
        "t2",
        "bytes",
    )
    heads = heads.filter(
        F.col("heir").isNotNull()
        & (F.col("heir") - F.col("heir") % family == F.col("base"))
        & (F.col("place") <= head_length(F.col("heir")))
    ).withColumnRenamed("heir", "conv_id")
    heads = heads.join(convs.select("conv_id"), "conv_id", "left_semi").select(
        "conv_id", F.lit(-1).cast("long").alias("block"), F.col("place").alias("depth"), "t1", "t2", "bytes"
    )
    return own.unionByName(heads), convs.select("conv_id")


# --- nodes ---------------------------------------------------------------------------


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, up, q1, q2, bytes, total): for each turn the node it ends,
    that node's parent, its own bytes and those up to it."""
    rows = turns.withColumns(
        {
            "g1": F.xxhash64(F.lit(3), "depth", "t1", "t2"),
            "g2": F.xxhash64(F.lit(4), "depth", "t2", "t1"),
        }
    )
    inside = W.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(
        F.bit_xor("g1").alias("b1"), F.bit_xor("g2").alias("b2"), F.sum("bytes").alias("b")
    )
    zero = F.lit(0).cast("long")
    carried = blocks.select(
        "conv_id",
        "block",
        F.coalesce(F.bit_xor("b1").over(earlier), zero).alias("c1"),
        F.coalesce(F.bit_xor("b2").over(earlier), zero).alias("c2"),
        F.coalesce(F.sum("b").over(earlier), zero).alias("c"),
    )
    run = rows.withColumns(
        {
            "x1": F.bit_xor("g1").over(inside),
            "x2": F.bit_xor("g2").over(inside),
            "x": F.sum("bytes").over(inside),
        }
    ).join(carried, ["conv_id", "block"])
    return run.select(
        "conv_id",
        "depth",
        F.col("x1").bitwiseXOR(F.col("c1")).alias("p1"),
        F.col("x2").bitwiseXOR(F.col("c2")).alias("p2"),
        (F.col("depth") - 1).alias("up"),
        F.col("x1").bitwiseXOR(F.col("c1")).bitwiseXOR(F.col("g1")).alias("q1"),
        F.col("x2").bitwiseXOR(F.col("c2")).bitwiseXOR(F.col("g2")).alias("q2"),
        "bytes",
        (F.col("x") + F.col("c")).alias("total"),
    )


def trie_nodes(paths: DataFrame, convs: DataFrame) -> DataFrame:
    """Every node, the root included, with its parent's id and what it counts itself."""
    least = [F.min(c).alias(c) for c in ("conv_id", *PARENT, "bytes", "total")]
    below = paths.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_convs"), *least)
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    root = root.withColumns({c: zero for c in (*KEY, "q1", "q2", "bytes", "total")})
    nodes = written(below.unionByName(root.withColumn("up", F.lit(-1).cast("long"))), "nodes")
    children = nodes.filter("depth > 0").withColumn("_salt", salt("p1", SALTS))
    kids = children.groupBy(*PARENT).agg(
        F.count(F.lit(1)).alias("n_children"),
        F.count_if(F.col("n_convs") == 1).alias("singles"),
        *[column.alias(name) for name, column in used_salts("_salt", SALTS).items()],
    )
    kids = written(kids, "children")
    as_key = [F.col(a).alias(b) for a, b in zip(PARENT, KEY, strict=True)]
    counts = kids.select(*as_key, "n_children", "singles")
    # A parent of very many children goes to as many of its salts as they use.
    parents = kids.join(
        nodes.select(
            *[F.col(a).alias(b) for a, b in zip(KEY, PARENT, strict=True)],
            F.col("conv_id").alias("parent_conv_id"),
        ),
        PARENT,
    ).select(*PARENT, "parent_conv_id", F.explode(salt_list(SALTS)).alias("_salt"))
    out = nodes.withColumn("_salt", salt("p1", SALTS)).join(parents, [*PARENT, "_salt"], "left")
    out = out.drop("_salt").join(counts, KEY, "left")
    n_children = F.coalesce("n_children", zero)
    return written(
        out.withColumns(
            {
                "n_children": n_children,
                # nodes of one member are not processed: each such child is a leaf of its parent
                "leaves": F.when(n_children == 0, 1).otherwise(F.coalesce("singles", zero)).cast("long"),
                "saved": (F.col("n_convs") - 1) * F.col("bytes"),
            }
        ).drop("singles"),
        "trie",
    )


# --- time-forward processing ---------------------------------------------------------


class SpillingQueue:
    """A priority queue of tuples of whole numbers; what exceeds ``limit`` is sorted,
    written to a folder and merged when it is taken out."""

    def __init__(self, folder: str, limit: int = QUEUED, width: int = 5):
        self.folder, self.limit, self.width = folder, limit, width
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # (least item, number, items of a block, file)
        self.spilled = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            name = save(self.folder, np.array(sorted(self.heap), dtype=np.int64))
            self.heap, self.spilled = [], self.spilled + 1
            self._advance(self._items(name))

    def _items(self, name: str) -> Iterator[tuple]:
        store, base = arrow_fs.FileSystem.from_uri(self.folder)
        width = 8 * self.width
        with store.open_input_stream(f"{base}/{name}") as source:
            while block := source.read(width * 1024):
                yield from map(tuple, np.frombuffer(block, dtype=np.int64).reshape(-1, self.width).tolist())
        store.delete_file(f"{base}/{name}")

    def _advance(self, items: Iterator[tuple]) -> None:
        first = next(items, None)
        if first is not None:
            heapq.heappush(self.runs, (first, id(items), items))

    def least(self) -> tuple | None:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            first, _, items = heapq.heappop(self.runs)
            self._advance(items)
            return first
        return heapq.heappop(self.heap)


def time_forward(rows: DataFrame, limit: int = QUEUED) -> DataFrame:
    """Totals of a forest's vertices: (shard, depth, p1, p2, up, q1, q2, leaves, saved,
    top) with ``top`` true for a shard's root, ``leaves`` and ``saved`` then of subtrees."""
    shard = ["s0", "s1", "s2"]
    ordered = rows.repartition(*shard).sortWithinPartitions(*shard, F.desc("depth"), "p1", "p2")
    folder = new_folder(rows.sparkSession, "queue")
    numbers = [*KEY, *PARENT, "leaves", "saved"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queue = SpillingQueue(folder, limit)
        for batch in batches:
            leaves, saved = [], []
            tops = batch["top"].tolist()
            for row, top in zip(zip(*[batch[c].tolist() for c in numbers], strict=True), tops, strict=True):
                depth, p1, p2, up, q1, q2, own_leaves, own_saved = row
                here = (-depth, p1, p2)
                while (least := queue.least()) is not None and least[:3] == here:
                    message = queue.pop()
                    own_leaves += message[3]
                    own_saved += message[4]
                if not top:
                    queue.push((-up, q1, q2, own_leaves, own_saved))
                leaves.append(own_leaves)
                saved.append(own_saved)
            yield batch.assign(leaves=leaves, saved=saved)
        if queue.least() is not None:
            raise ArithmeticError("a message did not meet its vertex")

    return ordered.mapInPandas(run, ordered.schema)


def chain_totals(nodes: DataFrame, paths: DataFrame, n_convs: int, shard: int, limit: int) -> DataFrame:
    """(conv_id, n_convs, first, last, before, leaves, saved): for each chain of nodes
    with the same members, several of them, its levels and its subtree's totals."""
    bottom = F.max(F.struct(*KEY)).alias("_bottom")
    upper = F.min(F.struct("depth", "up", "q1", "q2", (F.col("total") - F.col("bytes")).alias("before")))
    chains = nodes.filter("n_convs > 1").groupBy("conv_id", "n_convs")
    chains = chains.agg(bottom, upper.alias("_top"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    chains = written(
        chains.select(
            "conv_id",
            "n_convs",
            "_bottom.*",
            F.col("_top.depth").alias("first"),
            "_top.up",
            "_top.q1",
            "_top.q2",
            "_top.before",
            "leaves",
            "saved",
        ),
        "chains",
    )
    done: list[DataFrame] = []
    low = 1
    while low < n_convs:
        high = low * shard
        part = chains.filter(F.col("n_convs").between(low + 1, high))
        if done:
            sent = done[0]
            for others in done[1:]:
                sent = sent.unionByName(others)
            sent = sent.filter("top").groupBy(*PARENT)
            sent = sent.agg(F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
            sent = sent.select(*[F.col(a).alias(b) for a, b in zip(PARENT, KEY, strict=True)], "_leaves", "_saved")
            part = part.join(sent, KEY, "left").withColumns(
                {c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in ("leaves", "saved")}
            )
        if high >= n_convs:
            zero = F.lit(0).cast("long")
            part = part.withColumns({"s0": zero, "s1": zero, "s2": zero})
        else:
            part = part.join(_shards(nodes, paths, part, high), "conv_id")
        part = part.withColumn("top", F.col("first") == F.col("s0")).drop("_leaves", "_saved")
        done.append(written(time_forward(part, limit), "totals"))
        low = high
    out = done[0] if done else chains.withColumn("top", F.lit(True))
    for others in done[1:]:
        out = out.unionByName(others.select(out.columns))
    return out.select("conv_id", "n_convs", "first", F.col("depth").alias("last"), "before", "leaves", "saved")


def _shards(nodes: DataFrame, paths: DataFrame, part: DataFrame, high: int) -> DataFrame:
    """For each smallest member of a chain the shard its chains lie in: the first node on
    its path of at most ``high`` members, as (conv_id, s0, s1, s2)."""
    by_conv = salt("conv_id", SALTS)
    every = F.explode(F.array(*[F.lit(k) for k in range(SALTS)])).alias("_salt")
    bigger = nodes.filter((F.col("n_convs") > high) & (F.col("depth") > 0)).select(*KEY, every)
    wanted = part.select("conv_id").distinct()
    through = paths.select("conv_id", *KEY).join(wanted, "conv_id", "left_semi").withColumn("_salt", by_conv)
    last = through.join(bigger, [*KEY, "_salt"]).groupBy("conv_id").agg(F.max("depth").alias("_big"))
    starts = wanted.join(last, "conv_id", "left").select(
        "conv_id", (F.coalesce("_big", F.lit(0).cast("long")) + 1).alias("depth")
    )
    found = paths.select("conv_id", *KEY).join(starts, ["conv_id", "depth"])
    return found.select("conv_id", *[F.col(a).alias(b) for a, b in zip(KEY, ["s0", "s1", "s2"], strict=True)])


# --- ids of conversations that end in a node -----------------------------------------


def end_digests(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """(depth, p1, p2, ends_sha256) from (depth, p1, p2, conv_id).

    The rows are ranges of the order by node and id, so the ids of a hot node are many
    tasks' rows. Lists that one task holds whole are hashed there; of longer ones, and of
    those that may go on in another task, pieces are written and hashed one after another.
    """
    order = ["p1", "p2", "depth", "conv_id"]
    ordered = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "depth long, p1 long, p2 long, first long, digest string, piece binary"
    names = ["depth", "p1", "p2", "first", "digest", "piece"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, first, held, size, whole = None, None, [], 0, False
        out: list[tuple] = []

        def emit(last: bool) -> None:
            data = b",".join(held)
            if whole and not last:
                out.append((node[2], node[0], node[1], first, hashlib.sha256(data).hexdigest(), None))
            else:
                out.append((node[2], node[0], node[1], first, None, data))

        for batch in batches:
            for p1, p2, depth, conv in zip(*[batch[c].tolist() for c in order], strict=True):
                if (p1, p2, depth) != node:
                    if node is not None:
                        emit(False)
                    # the first list of a task may have begun in the one before
                    whole = node is not None
                    node, first, held, size = (p1, p2, depth), conv, [], 0
                elif size >= piece:
                    emit(True)
                    whole, first, held, size = False, conv, [], 0
                text = str(conv).encode()
                held.append(text)
                size += len(text) + 1
            yield pd.DataFrame(out, columns=names)
            out.clear()
        if node is not None:
            emit(True)
        yield pd.DataFrame(out, columns=names)

    found = written(ordered.mapInPandas(run, schema), "ends")
    pieces = found.filter("digest IS NULL").repartition("p1", "p2", "depth")

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, hasher = None, None
        for batch in batches:
            out = []
            for p1, p2, depth, data in zip(*[batch[c].tolist() for c in ("p1", "p2", "depth", "piece")], strict=True):
                if (p1, p2, depth) == node:
                    hasher.update(b",")
                else:
                    if node is not None:
                        out.append((node[2], node[0], node[1], hasher.hexdigest()))
                    node, hasher = (p1, p2, depth), hashlib.sha256()
                hasher.update(data)
            yield pd.DataFrame(out, columns=[*KEY, "digest"])
        last = [(node[2], node[0], node[1], hasher.hexdigest())] if node is not None else []
        yield pd.DataFrame(last, columns=[*KEY, "digest"])

    ordered_pieces = pieces.sortWithinPartitions("p1", "p2", "depth", "first")
    joined = ordered_pieces.mapInPandas(join, "depth long, p1 long, p2 long, digest string")
    digests = found.filter("digest IS NOT NULL").select(*KEY, "digest").unionByName(joined)
    return digests.withColumnRenamed("digest", "ends_sha256")


# --- all of it -----------------------------------------------------------------------


def trie(turns: DataFrame, convs: DataFrame, shard: int = SHARD, limit: int = QUEUED, piece: int = PIECE) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, block, depth, t1, t2, bytes;
    depths from 1 without gaps, blocks in their order) for the conversations ``convs``."""
    paths = written(prefixes(turns), "paths")
    nodes = trie_nodes(paths, convs)
    n_convs = convs.count()
    totals = chain_totals(nodes, paths, n_convs, shard, limit)
    # A chain goes to every band of levels that it has, so that no long one is a single key.
    bands = totals.withColumn("_band", F.explode(F.sequence(F.expr(f"first div {BAND}"), F.expr(f"last div {BAND}"))))
    bands = bands.select(
        "conv_id", "n_convs", "_band", F.col("before").alias("_before"), F.col("leaves").alias("_leaves"), F.col("saved").alias("_saved")
    )
    last = paths.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("_end")).select("conv_id", "_end.*")
    zero = F.lit(0).cast("long")
    without = convs.join(last.select("conv_id"), "conv_id", "left_anti").withColumns({c: zero for c in KEY})
    digests = end_digests(last.unionByName(without.select(last.columns)), piece)
    rows = nodes.withColumn("_band", F.expr(f"depth div {BAND}")).join(bands, ["conv_id", "n_convs", "_band"], "left")
    rows = rows.join(digests, KEY, "left")
    above = F.col("total") - F.col("bytes") - F.col("_before")
    return rows.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.coalesce("_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce(F.col("_saved") - (F.col("n_convs") - 1) * above, zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(*rebuilt_turns(conversations))
