"""Prefix trie of conversations by double-array tries, one for each prefix shard.

Conversations are sequences of turns (role and text); each distinct sequence of their first d turns is a node. A stream
over each conversation in order gives every prefix a chained digest, and conversations that are equal throughout are one
path with a multiplicity. A shard is the shallowest prefix, among those of 1, 2, 4, 8, ... turns, that at most
`SHARD_TURNS` turns of distinct paths stand under. In a shard the turns get dense ids, BASE and CHECK arrays are packed
over them, the paths are inserted, and a traverse gives the nodes with their aggregates.

Prefixes of no shard (the root, and those with more beneath them: a first turn that a third of all conversations share)
are upper nodes. They are aggregates that tasks reduce before the shuffle; what is summed over their subtrees starts from
the sums of the shards beneath and climbs by doubling distances, so that their number of levels does not matter.

Defined results: turns come by their place; null roles and texts are empty; rows of a null conv_id belong to no
conversation and are left out; a conversation without turns ends at the root; repeated rows are turns like others; an
empty table gives no rows, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sparkledger.llm.common import arrow_schema, in_batches, prepare, store

SHARD_TURNS = 200_000
ROOT = bytes(16)
WORD = r"[^\x20\x09-\x0D]+"
_EMPTY = hashlib.sha256().hexdigest()


# Double array ----------------------------------------------------------------------------------------


class DoubleArray:
    """A trie whose node s has its child by id c (from 1) at base[s] + c, if check there is s."""

    def __init__(self, room: int = 64):
        self.base = np.zeros(room, np.int64)
        self.check = np.full(room, -1, np.int64)
        self.check[0] = 0  # the root
        self.children: dict[int, list[int]] = {}
        self.free = 1  # no free cell lies before it

    def _need(self, last: int) -> None:
        if last >= len(self.base):
            more = max(last + 1, 2 * len(self.base)) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def child(self, s: int, c: int) -> int:
        """The node after s by id c, or -1."""
        t = int(self.base[s]) + c
        return t if s in self.children and 0 <= t < len(self.check) and self.check[t] == s and t != 0 else -1

    def pack(self, s: int, ids: list[int]) -> list[int]:
        """Place all children of s, by ascending ids, at the first base where their cells are free."""
        self._need(self.free + ids[-1] - ids[0] + 1)
        while self.check[self.free] != -1:
            self.free += 1
            self._need(self.free)
        offsets = np.array(ids, np.int64) - ids[0]
        first = self.free
        while True:
            self._need(first + int(offsets[-1]))
            taken = np.flatnonzero(self.check[first + offsets] != -1)
            if not len(taken):
                break
            # The next free cell for the first child.
            first += 1
            self._need(first)
            while self.check[first] != -1:
                first += 1
                self._need(first)
        cells = first + offsets
        self.base[s] = first - ids[0]
        self.check[cells] = s
        self.children[s] = cells.tolist()
        return self.children[s]


def pack_paths(paths: list[tuple[int, list[int]]]) -> tuple[DoubleArray, dict[int, tuple[int, int]]]:
    """The trie of (name, turn ids) paths, and the node where each path ends, as name to (node, turns).

    Nodes are packed level by level: the children of a node are known together, so that no node is ever moved.
    """
    trie, ends = DoubleArray(), {}
    level = [(0, list(range(len(paths))))]
    depth = 0
    while level:
        following = []
        for node, members in level:
            by_id: dict[int, list[int]] = {}
            for m in members:
                ids = paths[m][1]
                if len(ids) == depth:
                    ends[paths[m][0]] = (node, depth)
                else:
                    by_id.setdefault(ids[depth], []).append(m)
            if by_id:
                ids = sorted(by_id)
                following += zip(trie.pack(node, ids), (by_id[c] for c in ids))
        level, depth = following, depth + 1
    return trie, ends


# Rows ------------------------------------------------------------------------------------------------


def turn_rows(turns: DataFrame) -> DataFrame:
    """conv_id, place, `turn_key` (digest of role and text) and `words` of (conv_id, place, role, text), without the texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.substring(F.sha2(F.concat_ws(":", F.octet_length(role), role, text), 256), 1, 32))
    return turns.select("conv_id", "place", key.alias("turn_key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def _prefixes(rows: DataFrame) -> DataFrame:
    """A row for each conversation and depth from 0: conv_id, depth, key, parent, turn_key, words, is_end and `above`.

    `above` has the keys of the prefixes of 1, 2, 4, 8, ... turns up to this one. Rows of place null only say that there
    is such a conversation.
    """
    kind = T.BinaryType()
    schema = T.StructType([
        T.StructField("conv_id", T.LongType()), T.StructField("depth", T.LongType()), T.StructField("key", kind), T.StructField("parent", kind),
        T.StructField("turn_key", kind), T.StructField("words", T.LongType()), T.StructField("is_end", T.BooleanType()),
        T.StructField("above", T.ArrayType(kind)),
    ])
    arrow = arrow_schema(schema)

    def chain(batches: Iterator[pa.RecordBatch]):
        def rows():
            held = None
            for batch in batches:
                for conv, place, turn_key, words in zip(*(c.to_pylist() for c in batch.columns)):
                    if held is None or held[0] != conv:
                        if held is not None:
                            yield (*held[:6], True, held[6])
                        held = (conv, 0, ROOT, None, None, 0, [])
                    if place is None:
                        continue
                    yield (*held[:6], False, held[6])
                    depth, before, above = held[1] + 1, held[2], held[6]
                    key = hashlib.sha256(before + turn_key).digest()[:16]
                    held = (conv, depth, key, before, turn_key, words, [*above, key] if depth & (depth - 1) == 0 else above)
            if held is not None:
                yield (*held[:6], True, held[6])

        return in_batches(rows(), arrow, rows=4096)

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("place"))
    return ordered.select("conv_id", "place", "turn_key", "words").mapInArrow(chain, schema)


def _ends(prefixes: DataFrame) -> DataFrame:
    """For each distinct path: key, conv_id (the smallest), n_ends and ends_sha256 of the conversations that are it."""
    schema = T.StructType([
        T.StructField("key", T.BinaryType()), T.StructField("conv_id", T.LongType()), T.StructField("n_ends", T.LongType()), T.StructField("ends_sha256", T.StringType()),
    ])
    arrow = arrow_schema(schema)

    def digest(batches: Iterator[pa.RecordBatch]):
        def rows():
            held = None
            for batch in batches:
                for key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                    if held is None or held[0] != key:
                        if held is not None:
                            yield (*held[:3], held[3].hexdigest())
                        held = [key, conv, 0, hashlib.sha256()]
                    held[3].update(b",%d" % conv if held[2] else b"%d" % conv)
                    held[2] += 1
            if held is not None:
                yield (*held[:3], held[3].hexdigest())

        return in_batches(rows(), arrow, rows=4096)

    ends = prefixes.filter("is_end").select("key", "conv_id")
    return ends.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(digest, schema)


# Shards ----------------------------------------------------------------------------------------------

_SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
NODE = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("parent", T.BinaryType()), T.StructField("conv_id", T.LongType()), T.StructField("depth", T.LongType()),
    *(T.StructField(c, T.LongType()) for c in _SUMS), T.StructField("parent_conv_id", T.LongType()),
])


def _shard_nodes(rows: list[tuple]) -> Iterator[tuple]:
    """Nodes of one shard from its rows (conv_id, depth, key, parent, turn_key, words, ends), by conversation and depth."""
    dense: dict[bytes, int] = {}
    paths: list[tuple[int, list[int]]] = []
    first_row: list[int] = []
    for i, (conv, _, _, _, turn_key, _, _) in enumerate(rows):
        if not paths or paths[-1][0] != conv:
            paths.append((conv, []))
            first_row.append(i)
        paths[-1][1].append(dense.setdefault(turn_key, len(dense) + 1))
    trie, ends = pack_paths(paths)
    # Walk each path through the arrays; members come by ascending conv_id, so that the first is the smallest.
    row_of: dict[int, int] = {}
    n_convs: dict[int, int] = {}
    order: list[int] = []
    for (conv, ids), start in zip(paths, first_row):
        n, node = rows[start + len(ids) - 1][6], 0
        for i, c in enumerate(ids, start):
            node = trie.child(node, c)
            if node not in row_of:
                row_of[node], n_convs[node] = i, 0
                order.append(node)  # parents before their children
            n_convs[node] += n
        assert ends[conv] == (node, len(ids))
    leaves: dict[int, int] = {}
    saved: dict[int, int] = {}
    for node in reversed(order):
        below = trie.children.get(node, ())
        leaves[node] = sum(leaves[t] for t in below) if below else 1
        saved[node] = sum(saved[t] for t in below) + (n_convs[node] - 1) * rows[row_of[node]][5]
    for node in order:
        conv, depth, key, parent, *_ = rows[row_of[node]]
        over = int(trie.check[node])
        above = rows[row_of[over]][0] if over else None  # the shard's top hangs from an upper node
        yield key, parent, conv, depth, n_convs[node], len(trie.children.get(node, ())), leaves[node], saved[node], above


def _in_shards(rows: DataFrame) -> DataFrame:
    arrow = arrow_schema(NODE)

    def pack(batches: Iterator[pa.RecordBatch]):
        def nodes():
            shard, held = None, []
            for batch in batches:
                for own, *row in zip(*(c.to_pylist() for c in batch.columns)):
                    if own != shard and held:
                        yield from _shard_nodes(held)
                        held = []
                    shard = own
                    held.append(tuple(row))
            if held:
                yield from _shard_nodes(held)

        return in_batches(nodes(), arrow, rows=4096)

    ordered = rows.repartition("shard").sortWithinPartitions("shard", "conv_id", "depth")
    return ordered.select("shard", "conv_id", "depth", "key", "parent", "turn_key", "words", "n_ends").mapInArrow(pack, NODE)


# Upper nodes -----------------------------------------------------------------------------------------


def _climb(nodes: DataFrame) -> DataFrame:
    """Sums of n_leaves and saved_tokens over the subtrees of (key, parent, n_leaves, saved_tokens).

    After round k a node has the sum over what lies less than 2^k levels beneath it, and `up` names the node 2^k levels above.
    """
    now = nodes.select("key", F.col("parent").alias("up"), "n_leaves", "saved_tokens")
    while True:
        now = store(now, "trie-climb")
        if now.filter(F.col("up").isNotNull()).isEmpty():
            return now.drop("up")
        sums = now.filter(F.col("up").isNotNull()).groupBy(F.col("up").alias("key")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
        )
        further = now.select(F.col("key").alias("up"), F.col("up").alias("further"))
        now = now.join(sums, "key", "left").join(further, "up", "left").select(
            "key", F.col("further").alias("up"),
            (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
        )


def prefix_trie(turns: DataFrame, conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node of the conversations' prefix trie.

    `turns` has conv_id (long), place (of any order), role and text; `conversations` the ids of all conversations, those
    without turns included. Gives conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves and
    saved_tokens of the subtree, and ends_sha256 of the conversations that end at the node.
    """
    prepare(turns.sparkSession)
    known = conversations.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long")).distinct()
    heads = known.select("conv_id", F.lit(None).cast("long").alias("place"), F.lit(None).cast("binary").alias("turn_key"), F.lit(0).cast("long").alias("words"))
    rows = turn_rows(turns.filter("conv_id IS NOT NULL")).withColumn("conv_id", F.col("conv_id").cast("long")).withColumn("place", F.col("place").cast("long"))
    prefixes = store(_prefixes(rows.unionByName(heads)), "trie-prefixes")
    ends = store(_ends(prefixes), "trie-ends")
    # One conversation stands for all that equal it.
    paths = prefixes.drop("is_end").join(ends.select("conv_id", "n_ends"), "conv_id")
    paths = store(paths, "trie-paths")
    sizes = paths.select(F.explode("above").alias("over")).groupBy("over").count()
    large = store(sizes.filter(F.col("count") > shard_turns).select("over"), "trie-large")
    # A prefix beneath a large one may be a shard; the shallowest that is not large is it.
    cut = paths.select("conv_id", "depth", F.posexplode("above").alias("at", "over")).join(large, "over", "left_anti")
    cut = cut.groupBy("conv_id", "depth").agg(F.min(F.struct("at", "over"))["over"].alias("shard"))
    dealt = store(paths.drop("above").join(cut, ["conv_id", "depth"], "left"), "trie-dealt")
    lower = store(_in_shards(dealt.filter(F.col("shard").isNotNull())), "trie-lower")

    upper_rows = dealt.filter(F.col("shard").isNull())
    upper = upper_rows.groupBy("key").agg(
        F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
        F.sum("n_ends").alias("n_convs"), F.min("words").alias("words"),
    )
    upper = store(upper, "trie-upper")
    tops = lower.filter("parent_conv_id IS NULL").select(F.col("parent").alias("key"), "n_leaves", "saved_tokens")
    inner = upper.filter(F.col("parent").isNotNull()).select(F.col("parent").alias("key"), F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    below = tops.unionByName(inner).groupBy("key").agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    upper = upper.join(below, "key", "left").select(
        "key", "parent", "conv_id", "depth", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        (F.coalesce("saved_tokens", F.lit(0)) + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    upper = store(upper, "trie-upper")
    sums = _climb(upper.select("key", "parent", "n_leaves", "saved_tokens"))
    upper = upper.drop("n_leaves", "saved_tokens").join(sums, "key")

    hanging = lower.filter("parent_conv_id IS NULL").drop("parent_conv_id").unionByName(upper)
    parents = upper.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    hanging = hanging.join(parents, "parent", "left")
    nodes = lower.filter("parent_conv_id IS NOT NULL").unionByName(hanging)
    found = nodes.join(ends.select("key", "ends_sha256"), "key", "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", *_SUMS, F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256")
    )


# The query's input -----------------------------------------------------------------------------------


def in_place(turns: DataFrame) -> DataFrame:
    """The turns with `place`, 1 for the first of their conversation: by turn, nulls first, then by role and text."""
    filled = (F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text"))
    rows = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), "turn", *filled)
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return rows.withColumn("place", F.row_number().over(order).cast("long")).drop("turn")


def _borrowed(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % 4


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations after the query's contract: the first h turns of conversation c-c%20, then c's own after its first h."""
    placed = store(in_place(turns), "placed-turns")
    own = placed.filter(F.col("place") > _borrowed(F.col("conv_id")))
    given = placed.filter((F.col("conv_id") % 20 == 0) & (F.col("place") <= 3)).withColumnRenamed("conv_id", "base")
    convs = placed.select("conv_id").distinct().withColumn("base", F.col("conv_id") - F.col("conv_id") % 20)
    taken = convs.join(given, "base").filter(F.col("place") <= _borrowed(F.col("conv_id"))).drop("base")
    return own.unionByName(taken)
