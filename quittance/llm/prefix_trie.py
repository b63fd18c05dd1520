"""The trie of conversations' shared beginnings, with what sharing each of them saves.

A node is a distinct sequence of first turns. In a sorted list of conversations the members of
a node are neighbours, and the length of the prefix common to two neighbours (LCP) is the depth
of the node that joins them. So neighbours are the edges of a union-find: taken by descending
LCP, each merge of components creates, or widens, the branching node at that depth, and the
nodes between it and a component's former top have that component's members.

How it runs on Spark:

1. A turn travels as a digest of role and text and the text's size, so a conversation is one
   narrow row. Conversations are rebuilt by a join with the first turns of their base.
2. They are dealt by ranges of (path, conv_id), where a path is the turns' digests in a row;
   equal paths may spread over partitions.
3. Each partition builds its forest by union-find. Nodes that don't touch its first or last
   path are final. What is left, the forest contracted to the nodes on these two paths, may go
   on in neighbouring partitions.
4. Contracted forests of FAN neighbours are merged by node, until one is left: nodes that are
   no longer on the first or last path of the merged forest become final.
5. Children of nodes that were open when their partition was done meet their parent by a join.
   The members that end at an open node are hashed from their partitions' lists in order; as
   SHA-256 can't be split, one task streams a node's list, holding no more than a piece of it.

A conversation's turns, 16 bytes of path and a size each, are one row; no text is held.

Defined results: null roles and texts are empty; a null turn comes first; rows of one turn come
in the order of a digest of role and text, and equal rows are each a turn. Rows with a null
conv_id are one conversation, without a base and with no turns replaced; it counts as a member,
is no smallest member beside others, and stands in a list of ids as an empty text, first. An
empty table gives an empty result, without a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quittance.llm.common import store

#: Bytes of a turn in a path.
STEP = 16
#: Forests merged by one task.
FAN = 64
#: Bytes of a piece of a list of ids, about.
PIECE = 1 << 20
#: BASE conversations in a row share first turns, fewer than HEADS of them.
BASE, HEADS = 5, 9

# ---- conversations as paths --------------------------------------------------------------


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns`` in order, each the digest of a turn (``key``) and its text's ``size``."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn").isNotNull().alias("known"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("turn"),
        F.substring(F.unhex(F.sha2(told, 256)), 1, STEP).alias("key"),
        F.octet_length(text).cast("long").alias("size"),
    )
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("one"))
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("turns"))


def rebuild(listed: DataFrame) -> DataFrame:
    """Conversations whose first h turns are those of their base; h is told by the conv_id."""
    head = (F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")) % HEADS).cast("int")
    first = listed.where(F.col("conv_id") % BASE == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("first"))
    own = listed.select("conv_id", "turns", head.alias("head"), (F.col("conv_id") - F.col("conv_id") % BASE).alias("base"))
    nothing = F.slice("turns", 1, 0)
    met = own.join(first, "base", "left")
    rest = F.when(F.size("turns") > F.col("head"), F.slice("turns", F.col("head") + 1, F.size("turns"))).otherwise(nothing)
    turns = F.concat(F.slice(F.coalesce("first", nothing), F.lit(1), F.col("head")), rest)
    return met.select("conv_id", turns.alias("turns"))


# ---- nodes of one partition --------------------------------------------------------------

CLOSED, OPEN, ENDS = range(3)
_NODE_NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_NODE_FIELDS = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("part", pa.int64()), *[(n, pa.int64()) for n in _NODE_NAMES[:7]], ("ends_sha256", pa.string())]
    + [("node", pa.binary()), ("parent", pa.binary()), ("is_first", pa.bool_()), ("is_last", pa.bool_()), ("size", pa.int64())]
    + [("number", pa.int64()), ("ids", pa.string())]
)
_FIELDS = (
    f"kind int, part long, {_NODE_FIELDS}, node binary, parent binary, is_first boolean, is_last boolean, size long, number long, ids string"
)
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _batches(found: list[dict], limit: int = 10_000) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(found), limit):
        yield pa.RecordBatch.from_pylist(found[start : start + limit], schema=_SCHEMA)


def lesser(one: int | None, other: int | None) -> int | None:
    return other if one is None else one if other is None else min(one, other)


class Group(NamedTuple):
    """Conversations with one path in one partition."""

    path: bytes
    sizes: list[int]
    n: int
    least: int | None
    ends: str  # the hash of all their ids


class Top:
    """The highest node so far of a component, with what its final children have added up to."""

    __slots__ = ("depth", "n_convs", "least", "children", "leaves", "saved", "ends", "low", "high", "waiting")

    def __init__(self, place: int, group: Group) -> None:
        self.depth, self.n_convs, self.least = len(group.sizes), group.n, group.least
        self.children = self.leaves = self.saved = 0
        self.ends: str | None = group.ends
        self.low = self.high = place
        self.waiting: list[dict] = []  # rows of children that lack their parent's conv_id


def prefix_keys(path: bytes) -> list[bytes]:
    """The name of each node on a path, from the root down."""
    running, found = hashlib.sha256(), []
    for start in range(0, len(path) + 1, STEP):
        found.append(running.digest()[:STEP])
        running.update(path[start : start + STEP])
    return found


def common_turns(one: bytes, other: bytes) -> int:
    low, high = 0, min(len(one), len(other)) // STEP
    while low < high:
        middle = (low + high + 1) // 2
        if one[low * STEP : middle * STEP] == other[low * STEP : middle * STEP]:
            low = middle
        else:
            high = middle - 1
    return low


class Forest:
    """Union-find over a partition's sorted, distinct paths."""

    def __init__(self, groups: list[Group], part: int) -> None:
        self.groups, self.part, self.found = groups, part, []
        self.parent = list(range(len(groups)))
        self.tops = [Top(i, g) for i, g in enumerate(groups)]
        self.last = len(groups) - 1
        self.first_keys, self.last_keys = prefix_keys(groups[0].path), prefix_keys(groups[-1].path)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def close(self, top: Top, depth: int) -> None:
        """Ends a component's nodes below ``depth``; its top is then at ``depth``, one child there."""
        while top.depth > depth:
            size = self.groups[top.low].sizes[top.depth - 1]
            if top.low == 0 or top.high == self.last:
                self._leave_open(top, size)
                top.children = top.leaves = top.saved = 0
                top.waiting = []
            else:
                row = self._final(top, size)
                self.found.append(row)
                top.children, top.leaves, top.saved = 1, row["n_leaves"], row["saved_tokens"]
                top.waiting = [row]
            top.ends = None
            top.depth -= 1

    def _final(self, top: Top, size: int) -> dict:
        for child in top.waiting:
            child["parent_conv_id"] = top.least
        return {
            "kind": CLOSED,
            "conv_id": top.least,
            "depth": top.depth,
            "n_convs": top.n_convs,
            "n_children": top.children,
            "n_leaves": top.leaves or 1,
            "saved_tokens": top.saved + (top.n_convs - 1) * size,
            "ends_sha256": top.ends or _NO_ENDS,
        }

    def _leave_open(self, top: Top, size: int) -> None:
        is_first, is_last = top.low == 0, top.high == self.last
        keys = self.first_keys if is_first else self.last_keys
        for child in top.waiting:
            child["parent"] = keys[top.depth]
        self.found.append(
            {
                "kind": OPEN,
                "part": self.part,
                "conv_id": top.least,
                "depth": top.depth,
                "n_convs": top.n_convs,
                "n_children": top.children,
                "n_leaves": top.leaves,
                "saved_tokens": top.saved,
                "ends_sha256": top.ends,
                "node": keys[top.depth],
                "parent": keys[top.depth - 1] if top.depth else None,
                "is_first": is_first,
                "is_last": is_last,
                "size": size,
            }
        )

    def merge(self, i: int, depth: int) -> None:
        """The edge between neighbours i and i + 1."""
        a, b = self.find(i), self.find(i + 1)
        one, other = self.tops[a], self.tops[b]
        self.close(one, depth)
        self.close(other, depth)
        self.parent[b] = a
        one.n_convs, one.least = one.n_convs + other.n_convs, lesser(one.least, other.least)
        one.children, one.leaves, one.saved = one.children + other.children, one.leaves + other.leaves, one.saved + other.saved
        one.ends = one.ends or other.ends
        one.high = other.high
        # the longer list takes the shorter one
        one.waiting, shorter = sorted((one.waiting, other.waiting), key=len, reverse=True)
        one.waiting += shorter
        self.tops[b] = None

    def build(self) -> list[dict]:
        edges = [(common_turns(a.path, b.path), i) for i, (a, b) in enumerate(zip(self.groups, self.groups[1:], strict=False))]
        for depth, i in sorted(edges, key=lambda e: -e[0]):
            self.merge(i, depth)
        top = self.tops[self.find(0)]
        self.close(top, 0)
        self._leave_open(top, 0)
        return self.found


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by path and conv_id: the partition's nodes, and the lists of its first and last path."""
    part, groups = TaskContext.get().partitionId(), []

    def conversations() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

    edges: list[tuple[Group, list]] = []  # first and latest group with their ids
    for path, same in groupby(conversations(), key=lambda row: row[0]):
        ids, sizes = [], None
        for _, of, conv_id in same:
            ids.append(conv_id)
            sizes = of
        least = next((i for i in ids if i is not None), None)
        listed = ",".join("" if i is None else str(i) for i in ids)
        groups.append(Group(path, sizes, len(ids), least, hashlib.sha256(listed.encode()).hexdigest()))
        edges = [*edges[:1], (groups[-1], ids)]
    if not groups:
        return
    yield from _batches(Forest(groups, part).build())
    for group, ids in edges[:1] if len(groups) == 1 else edges:
        per_piece = max(1, PIECE // 20)
        node = prefix_keys(group.path)[-1]
        for number, start in enumerate(range(0, len(ids), per_piece)):
            listed = ",".join("" if i is None else str(i) for i in ids[start : start + per_piece])
            yield from _batches([{"kind": ENDS, "part": part, "node": node, "number": number, "ids": listed}])


# ---- forests of many partitions ----------------------------------------------------------


def merge_forests(open_nodes: list[dict], part: int, is_whole: bool) -> list[dict]:
    """Nodes of neighbouring contracted forests, in order, merged; final ones are closed."""
    first, last = open_nodes[0]["part"], open_nodes[-1]["part"]
    merged: dict[bytes, dict] = {}
    for row in open_nodes:
        stays_first = bool(row["is_first"]) and row["part"] == first
        stays_last = bool(row["is_last"]) and row["part"] == last
        if (held := merged.get(row["node"])) is None:
            merged[row["node"]] = row | {"part": part, "is_first": stays_first, "is_last": stays_last}
            continue
        for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
            held[name] += row[name]
        held["ends_sha256"] = held["ends_sha256"] or row["ends_sha256"]
        held["conv_id"] = lesser(held["conv_id"], row["conv_id"])
        held["is_first"] |= stays_first
        held["is_last"] |= stays_last
    found = []
    for row in sorted(merged.values(), key=lambda r: -r["depth"]):
        if is_whole or not (row["is_first"] or row["is_last"]):
            row["kind"] = CLOSED
            row["n_leaves"] = row["n_leaves"] or 1
            row["saved_tokens"] += (row["n_convs"] - 1) * row["size"]
            if row["parent"] is not None:
                above = merged[row["parent"]]
                above["n_children"] += 1
                above["n_leaves"] += row["n_leaves"]
                above["saved_tokens"] += row["saved_tokens"]
        found.append(row)
    return found


def _merge_round(open_nodes: DataFrame, is_whole: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by part; those of one ``over`` are a forest."""

        def listed() -> Iterator[dict]:
            for batch in batches:
                yield from batch.to_pylist()

        for over, nodes in groupby(listed(), key=lambda row: row["over"]):
            bare = [{k: v for k, v in row.items() if k != "over"} for row in nodes]
            yield from _batches(merge_forests(bare, over, is_whole))

    over = F.floor(F.col("part") / FAN).cast("long").alias("over")
    dealt = open_nodes.select("*", over).repartition("over").sortWithinPartitions("over", "part")
    return dealt.mapInArrow(run, _FIELDS)


def _hash_lists(lists: DataFrame) -> DataFrame:
    """``node`` and the hash of its ids, streamed piece by piece."""
    schema = pa.schema([("node", pa.binary()), ("ends", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running, done = None, None, []
        for batch in batches:
            for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if key != node:
                    if node is not None:
                        done.append({"node": node, "ends": running.hexdigest()})
                    node, running = key, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ids.encode())
        if node is not None:
            done.append({"node": node, "ends": running.hexdigest()})
        yield pa.RecordBatch.from_pylist(done, schema=schema)

    dealt = lists.select("node", "part", "number", "ids").repartition("node").sortWithinPartitions("node", "part", "number")
    return dealt.mapInArrow(run, "node binary, ends string")


def trie(paths: DataFrame) -> DataFrame:
    """Every node of the trie of ``turns`` by ``conv_id``."""
    digits = F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), "")
    narrow = paths.select(F.unhex(digits).alias("path"), F.col("turns.size").alias("sizes"), "conv_id")
    dealt = narrow.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    built = store(dealt.mapInArrow(_forests, _FIELDS))

    closed, open_nodes = [], built.where(F.col("kind") == OPEN)
    is_whole = False
    while not is_whole:
        forests = open_nodes.agg(F.max("part")).first()[0]
        is_whole = forests is None or forests < FAN
        merged = store(_merge_round(open_nodes, is_whole))
        closed.append(merged.where(F.col("kind") == CLOSED))
        open_nodes = merged.where(F.col("kind") == OPEN)
    spine = closed[0]
    for more in closed[1:]:
        spine = spine.unionByName(more)

    inner = built.where(F.col("kind") == CLOSED)
    # rows whose parent is known take no part in the join, so they aren't dealt by a null key
    settled = inner.where(F.col("parent").isNull())
    above = spine.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    ends = _hash_lists(built.where(F.col("kind") == ENDS))
    # the list of a partition's first or last path may go on in others; other paths have their hash
    told = spine.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends", "ends_sha256", F.lit(_NO_ENDS)))
    names = [*_NODE_NAMES, "parent"]
    orphans = inner.where(F.col("parent").isNotNull()).select(names).unionByName(told.select(names))
    found = orphans.join(above, "parent", "left").withColumn("parent_conv_id", F.col("above"))
    return settled.select(_NODE_NAMES).unionByName(found.select(_NODE_NAMES))


def shared_beginnings(conversations: DataFrame) -> DataFrame:
    return trie(rebuild(sequences(conversations)))


ORACLE = """
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
),
listed as (
    select conv_id, list({'key': sha256(length(role) || ':' || role || text), 'size': strlen(text)} order by turn nulls first) as turns
    from turns group by conv_id
),
-- CRC-32 of the decimal conv_id, bit by bit
heads as (
    select conv_id, turns, xor(list_reduce(
        list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda a, k: xor(a >> 1, (a & 1) * 3988292384))
    ), 4294967295::bigint) % 9 as head
    from listed
),
rebuilt as (
    select own.conv_id, list_concat(coalesce(base.turns[1:own.head], []), own.turns[own.head + 1:]) as turns
    from heads as own left join listed as base on base.conv_id = own.conv_id - own.conv_id % 5
),
members as (
    select conv_id, len(turns) as ends, depth, array_to_string([t.key for t in turns[1:depth]], '') as node,
        case when depth > 0 then array_to_string([t.key for t in turns[1:depth - 1]], '') end as parent,
        case when depth > 0 then turns[depth].size else 0 end as size
    from (select *, unnest(range(len(turns) + 1)) as depth from rebuilt)
),
nodes as (
    select depth, node, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(size) as saved,
        sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends = depth), '')) as ends_sha256
    from members group by depth, node
),
children as (select parent, count(*) as n_children from nodes where depth > 0 group by parent),
known as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join children on nodes.node = children.parent),
-- every node counts for all nodes above it, which its smallest member passes through
subtrees as (
    select above.depth, above.node, sum((known.n_children = 0)::int) as n_leaves, sum(known.saved) as saved_tokens
    from known join members as above on above.conv_id = known.conv_id and above.depth <= known.depth
    group by above.depth, above.node
)
select known.conv_id::bigint as conv_id, known.depth::bigint as depth, up.conv_id::bigint as parent_conv_id,
    known.n_convs::bigint as n_convs, known.n_children::bigint as n_children, subtrees.n_leaves::bigint as n_leaves,
    subtrees.saved_tokens::bigint as saved_tokens, known.ends_sha256
from known join subtrees on subtrees.depth = known.depth and subtrees.node = known.node
left join nodes as up on known.depth > 0 and up.depth = known.depth - 1 and up.node = known.parent
"""
