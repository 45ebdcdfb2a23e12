"""Prefix trie of conversations, built from its leaves up by peeling off the last turn.

Every distinct sequence of first turns is a node; the root is the empty sequence. Conversations are dealt out by ranges of their paths and
sorted there, so those that share turns are neighbours. A task keeps the nodes of the current path open. Where the next conversation leaves the path, the deepest
node is complete: it gets its figures (members, children, leaves, saved text), loses its last turn, and is merged with what else survives or ends at the
node that remains, and so on up to the turn where the two part. So nodes are found and aggregated in one pass, from the greatest depth up, and a
task holds one path. The depth-first order stands in for one round per depth over the whole table: a single conversation of 400 turns would make
400 rounds.

Only nodes of the first and the last path of a task may go on in another task. Their unfinished figures, two paths a task at most, are peeled the same
way in one more pass. A node that a third of all conversations share is such a node of many tasks, one row in each.

A turn is known by a 128-bit digest of its role and text, and a node by the chained digest of its turns.

Odd input: a null role or text counts as empty; turns of a conversation are ordered by turn number, null first, and equal numbers by the
turns' digests; exactly repeated turn rows are turns of their own. Rows without a conversation id belong to no conversation and are left out. Only
the named columns are read; others, whatever their names, are not touched. No conversations: no nodes, not even a root. Texts are
digested whole, however long; a conversation's digests (some 60 bytes a turn) are held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.tasks import map_rows
from creditloom.runtime import materialise

#: Ids that are joined to one piece of text before the pieces of a node meet.
IDS_A_PIECE = 65_536


def _digest(data: Column) -> Column:
    return F.unhex(F.substring(F.sha2(data, 256), 1, 32))


def sessions(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turn rows as one row per conversation: conv_id, turns (array of digest and size in code points), in order."""
    said, body = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    number = F.col(f"`{turn}`")
    mark = F.struct(
        number.isNotNull().alias("numbered"), number.alias("number"),
        _digest(F.concat(F.length(said).cast("string"), F.lit(":"), said, body).cast("binary")).alias("digest"), F.length(body).alias("size"),
    )
    kept = rows.where(F.col(f"`{conv_id}`").isNotNull()).select(F.col(f"`{conv_id}`").cast("long").alias("conv_id"), mark.alias("mark"))
    grouped = kept.groupBy("conv_id").agg(F.sort_array(F.collect_list("mark")).alias("marks"))
    return grouped.select("conv_id", F.transform("marks", lambda m: F.struct(m["digest"].alias("digest"), m["size"].alias("size"))).alias("turns"))


def _keys(turns: str) -> Column:
    """The chained digests of a conversation's prefixes, the root's left out."""

    def longer(keys: Column, turn: Column) -> Column:
        before = F.when(F.size(keys) > 0, F.element_at(keys, -1)).otherwise(F.lit(b""))
        return F.concat(keys, F.array(_digest(F.concat(before, turn["digest"]))))

    return F.aggregate(turns, F.array().cast("array<binary>"), longer)


class Node:
    """An open node with what has been merged into it so far."""

    __slots__ = ("key", "size", "open", "conv", "n", "kids", "leaves", "saved", "ends")

    def __init__(self, key: bytes, size: int, is_open: bool) -> None:
        self.key, self.size, self.open = key, size, is_open
        self.conv, self.n, self.kids, self.leaves, self.saved, self.ends = None, 0, 0, 0, 0, EMPTY_DIGEST

    def add(self, conv: int | None, n: int, kids: int, leaves: int, saved: int) -> None:
        if conv is not None and (self.conv is None or conv < self.conv):
            self.conv = conv
        self.n, self.kids, self.leaves, self.saved = self.n + n, self.kids + kids, self.leaves + leaves, self.saved + saved


class Peeler:
    """The open nodes of one path; ``peel`` closes those that the next path does not share, deepest first."""

    def __init__(self) -> None:
        self.stack: list[Node] = []

    def peel(self, keys: list[bytes]) -> Iterator[tuple]:
        """Rows of the closed nodes, and of those that may go on in other tasks with what this task knows of them (KIND first)."""
        shared = 0
        while shared < min(len(keys), len(self.stack) - 1) and self.stack[shared + 1].key == keys[shared]:
            shared += 1
        while len(self.stack) > shared + 1:
            yield self._close()

    def _close(self) -> tuple:
        node = self.stack.pop()
        parent, depth = (self.stack[-1].key if self.stack else None), len(self.stack)
        if node.open:
            path = [*self.stack[1:], node] if self.stack else []
            known = node.conv, node.n, node.kids, node.leaves, node.saved, node.ends
            return PARTIAL, node.key, parent, depth, *known, [n.key for n in path], [n.size for n in path], None, None
        leaves, saved = node.leaves or 1, node.saved + (node.n - 1) * node.size
        if self.stack:
            self.stack[-1].add(node.conv, node.n, 1, leaves, saved)
        return CLOSED, node.key, parent, depth, node.conv, node.n, node.kids, leaves, saved, node.ends, None, None, None, None

    def push(self, keys: list[bytes], sizes: list[int], is_open: bool) -> Node:
        """Opens the nodes of a path that are not open yet; returns the last one."""
        if not self.stack:
            self.stack.append(Node(b"", 0, is_open))
        for d in range(len(self.stack) - 1, len(keys)):
            self.stack.append(Node(keys[d], sizes[d], is_open))
        return self.stack[-1]

    def end(self, may_go_on: bool) -> Iterator[tuple]:
        for node in self.stack:
            node.open |= may_go_on
        while self.stack:
            yield self._close()


#: Kinds of rows: a finished node, one that may go on in other tasks, a piece of the ids that end at a node.
CLOSED, PARTIAL, PIECE = 0, 1, 2
EMPTY_DIGEST = hashlib.sha256(b"").hexdigest()
PEELED = (
    "kind int, key binary, parent_key binary, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, "
    "ends_sha256 string, keys array<binary>, sizes array<int>, first bigint, piece string"
)


def _piece(key: bytes, ids: list[int]) -> tuple:
    return PIECE, key, *[None] * 10, ids[0], ",".join(map(str, ids))


def peel_sorted(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows (keys, sizes, conv_id) sorted by path and id, as rows of ``PEELED``.

    The ids that end at a node are digested at once if the task has all of them and they are one piece. Else they are given out in
    pieces, and the node's digest stays null.
    """
    peeler, node, at, ids, is_first = Peeler(), None, None, [], True
    for keys, sizes, conv in rows:
        if keys != at:
            if ids and node.ends is not None and not is_first:
                node.ends = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            elif ids:
                node.ends = None
                yield _piece(node.key, ids)
            is_first = at is None
            yield from peeler.peel(keys)
            # the first path may have begun in another task
            node, at, ids = peeler.push(keys, sizes, is_first), keys, []
        node.add(conv, 1, 0, 0, 0)
        if len(ids) == IDS_A_PIECE:
            node.ends = None
            yield _piece(node.key, ids)
            ids = []
        ids.append(conv)
    if ids:
        node.ends = None
        yield _piece(node.key, ids)
    yield from peeler.end(True)


def peel_partial(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Unfinished nodes (keys, sizes, conv, n, kids, leaves, saved, ends) of all tasks, sorted by path, as finished ones."""
    peeler, node, at = Peeler(), None, None
    for keys, sizes, conv, n, kids, leaves, saved, ends in rows:
        if keys != at:
            yield from peeler.peel(keys)
            node, at = peeler.push(keys, sizes, False), keys
        node.add(conv, n, kids, leaves, saved)
        if ends != EMPTY_DIGEST:
            node.ends = ends
    yield from peeler.end(False)


def _digest_pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Pieces (key, first, piece) in order as the SHA-256 of every key's ids; one piece is held at a time."""
    key, state = None, None
    for at, _, piece in rows:
        if state is None or at != key:
            if state is not None:
                yield key, state.hexdigest()
            key, state = at, hashlib.sha256(piece.encode())
        else:
            state.update(b"," + piece.encode())
    if state is not None:
        yield key, state.hexdigest()


def build(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie over conversations (columns conv_id and turns, as ``sessions`` gives them; turns may be empty).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over the subtree, members beyond the first
    times the code points of the node's last text), ends_sha256 (of the ids that end here, decimal, ascending and comma-joined), key and parent_key.
    """
    spread = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paths = materialise(conversations.select(_keys("turns").alias("keys"), F.transform("turns", lambda t: t["size"]).alias("sizes"), "conv_id"), "trie-paths")
    ordered = paths.repartitionByRange(spread, "keys", "conv_id").sortWithinPartitions("keys", "conv_id")
    peeled = materialise(map_rows(ordered, PEELED, peel_sorted), "trie-peeled")
    figures = ["conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    # two paths a task: few enough for one task, which again holds one path
    partial = peeled.where(F.col("kind") == PARTIAL).select("keys", "sizes", *figures).repartition(1).sortWithinPartitions("keys", F.col("ends_sha256").isNull())
    finished = map_rows(partial, PEELED, peel_partial)
    columns = ["key", "parent_key", "depth", *figures]
    nodes = peeled.where(F.col("kind") == CLOSED).select(*columns).unionByName(finished.select(*columns))
    pieces = peeled.where(F.col("kind") == PIECE).select("key", "first", "piece").repartition(spread, "key").sortWithinPartitions("key", "first")
    digests = map_rows(pieces, "key binary, joined_sha256 string", _digest_pieces)
    open_ends = F.col("ends_sha256").isNull()
    known = nodes.where(~open_ends).unionByName(
        nodes.where(open_ends).drop("ends_sha256").join(digests.withColumnRenamed("joined_sha256", "ends_sha256"), "key")
    )
    stored = materialise(known, "trie-nodes")
    parents = stored.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return stored.join(parents, "parent_key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "key", "parent_key",
    )
