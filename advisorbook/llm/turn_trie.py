"""The prefix trie of conversations, by adaptive radix trees over fixed-width turn ids.

A turn's id is the first 16 bytes, big-endian, of the SHA-256 of its role and text, so turns are
equal where ids are, and texts never leave the scan. A conversation's key is the ids of its turns
one after the other. The distinct keys, in order, are cut into parts; each part's task builds an
adaptive radix tree (nodes of 4, 16, 48 or 256 children, common bytes kept as one path) and walks it.
Only byte depths at the end of a turn are nodes of the result; a branch inside an id is none.

Parts are cut by range, so a prefix that many conversations share, even all, spreads over parts. The
nodes that two neighbouring parts share lie on the path of a part's first or last key, down to the
turns it has in common with its neighbour. These nodes are summed over parts by the part that
saw them first and their depth; a node or leaf is counted by the part that owns it, so the sums hold
for whole subtrees. All other nodes are complete in one task.

Equal conversations come together sorted by key and id and are folded into blocks of ids; a second
pass streams a key's blocks through SHA-256. So no key is gathered, however many conversations it has.

A null role or text is empty; null turns come first; turns that share a number are ordered by id.
Repeated rows are turns of their own. Rows with a null conv_id belong to no conversation and are
left out, as there is no id to report. An empty table gives no rows, not even a root. A key of 16
bytes a turn, without text, must fit a task. Further columns are left behind.
"""

import bisect
import hashlib
import math
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from advisorbook.llm.common import column, whole_text
from advisorbook.session import cut_lineage

WIDTH = 16
BASE, HEADS = 100, 6
PART_BYTES = 8 << 20
BLOCK_BYTES = 1 << 16
NO_ENDS = hashlib.sha256(b"").hexdigest()


class Node4:
    """Up to ``room`` children: their bytes in order, and the children beside them."""

    room = 4
    __slots__ = ("keys", "kids")

    def __init__(self) -> None:
        self.keys, self.kids = bytearray(), []

    def get(self, byte: int):
        at = self.keys.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, kid) -> bool:
        if len(self.keys) == self.room:
            return False
        at = bisect.bisect_left(self.keys, byte)
        self.keys.insert(at, byte)
        self.kids.insert(at, kid)
        return True

    def items(self) -> list:
        return list(zip(self.keys, self.kids, strict=True))


class Node16(Node4):
    room = 16
    __slots__ = ()


class Node48:
    """A slot for each byte that names one of up to 48 children."""

    none = 255
    __slots__ = ("slots", "kids")

    def __init__(self) -> None:
        self.slots, self.kids = bytearray([self.none]) * 256, []

    def get(self, byte: int):
        slot = self.slots[byte]
        return None if slot == self.none else self.kids[slot]

    def put(self, byte: int, kid) -> bool:
        if len(self.kids) == 48:
            return False
        self.slots[byte] = len(self.kids)
        self.kids.append(kid)
        return True

    def items(self) -> list:
        return [(b, self.kids[s]) for b, s in enumerate(self.slots) if s != self.none]


class Node256:
    """A child for each byte."""

    __slots__ = ("kids",)

    def __init__(self) -> None:
        self.kids = [None] * 256

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid) -> bool:
        self.kids[byte] = kid
        return True

    def items(self) -> list:
        return [(b, kid) for b, kid in enumerate(self.kids) if kid is not None]


_LARGER = {Node4: Node16, Node16: Node48, Node48: Node256}


class Branch:
    """A node: the path of bytes that leads on from its parent's byte, its children, the key that ends here."""

    __slots__ = ("path", "layout", "key")

    def __init__(self, path: bytes, key: int | None = None) -> None:
        self.path, self.layout, self.key = path, None, key

    def child(self, byte: int) -> "Branch | None":
        return self.layout.get(byte) if self.layout else None

    def add(self, byte: int, kid: "Branch") -> None:
        if self.layout is None:
            self.layout = Node4()
        if not self.layout.put(byte, kid):
            larger = _LARGER[type(self.layout)]()
            for b, k in self.layout.items():
                larger.put(b, k)
            self.layout = larger
            larger.put(byte, kid)

    def cut(self, at: int) -> None:
        """Keep ``at`` bytes of the path here and move the rest to a child."""
        below = Branch(self.path[at + 1 :], self.key)
        below.layout = self.layout
        byte, self.path, self.layout, self.key = self.path[at], self.path[:at], None, None
        self.add(byte, below)


class RadixTree:
    """Distinct keys to their numbers."""

    def __init__(self) -> None:
        self.root = Branch(b"")

    def insert(self, key: bytes, number: int) -> None:
        node, at = self.root, 0
        while True:
            if not key.startswith(node.path, at):
                node.cut(len(os.path.commonprefix([node.path, key[at : at + len(node.path)]])))
            at += len(node.path)
            if at == len(key):
                node.key = number
                return
            below = node.child(key[at])
            if below is None:
                node.add(key[at], Branch(key[at + 1 :], number))
                return
            node, at = below, at + 1

    def walk(self) -> Iterator[tuple[int | None, int | None]]:
        """In key order: (above, None) for a new turn-aligned node below node ``above``, whose number is the
        count of nodes before it, and (node, key) where a key ends."""
        count, todo = 1, [(self.root, 0, 0, 0)]
        yield None, None
        while todo:
            branch, depth, edge, node = todo.pop()
            end = depth + edge + len(branch.path)
            for _ in range(end // WIDTH - depth // WIDTH):
                yield node, None
                node, count = count, count + 1
            if branch.key is not None:
                yield node, branch.key
            if branch.layout:
                todo += [(kid, end, 1, node) for _, kid in reversed(branch.layout.items())]


def _owner(runs: list[tuple[int, int]], depth: int) -> int:
    return runs[bisect.bisect_left(runs, (depth,))][1]


def nodes_of_part(rows: list[tuple], part: int, runs: list[tuple[int, int]], after: int) -> Iterator[tuple]:
    """The nodes of a part's sorted rows (key, sizes, n, least, ends).

    ``runs``: the owners, as (greatest depth, part), of the nodes that the first key shares with the part
    before. ``after``: the turns that the last key shares with the part behind, -1 without one.
    A node has an owner where it is shared; what it sums is then this part's share.
    """
    tree = RadixTree()
    for k, row in enumerate(rows):
        tree.insert(row[0], k)
    before = runs[-1][0] if runs else -1
    depth, above, size, first, key_at, visited = [], [], [], [], {}, 0
    for node, key in tree.walk():
        if key is not None:
            key_at[node], visited = key, key + 1
            continue
        d = 0 if node is None else depth[node] + 1
        depth.append(d)
        above.append(node)
        size.append(rows[visited][1][d - 1] if d else 0)
        first.append(visited == 0)
    m = len(depth)
    on_last, node = [False] * m, next(reversed(key_at))
    last_key = node
    while node is not None:
        on_last[node], node = True, above[node]
    convs, least, kids, owned_kids, leaves, saved, ends = [0] * m, [None] * m, [0] * m, [0] * m, [0] * m, [0] * m, [None] * m
    for k in range(m - 1, -1, -1):
        if k in key_at:
            _, _, n, low, ends[k] = rows[key_at[k]]
            convs[k] += n
            least[k] = low if least[k] is None else min(least[k], low)
        owned = not (first[k] and depth[k] <= before)
        if not kids[k] and not (k == last_key and after >= depth[k]):
            leaves[k] += 1
        saved[k] += (convs[k] - owned) * size[k]
        p = above[k]
        if p is not None:
            convs[p] += convs[k]
            least[p] = least[k] if least[p] is None else min(least[p], least[k])
            kids[p] += 1
            owned_kids[p] += owned
            leaves[p] += leaves[k]
            saved[p] += saved[k]

    def owner(k: int) -> int | None:
        if first[k] and depth[k] <= before:
            return _owner(runs, depth[k])
        return part if on_last[k] and depth[k] <= after else None

    owners = [owner(k) for k in range(m)]
    for k, p in enumerate(above):
        known = None if p is None or owners[p] is not None else least[p]
        yield (
            owners[k], depth[k], least[k], known, None if p is None else owners[p],
            convs[k], owned_kids[k], leaves[k], saved[k], ends[k],
        )


_NODE = pa.schema(
    [(c, pa.int64()) for c in ("owner", "depth", "conv_id", "parent", "parent_owner", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string())]
)
_NODE_DDL = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in _NODE)
_KEYS = [("key", pa.binary()), ("sizes", pa.list_(pa.int64()))]
_BLOCK = pa.schema([*_KEYS, ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())])
_ENDS = pa.schema([*_KEYS, ("n", pa.int64()), ("least", pa.int64()), ("ends", pa.string())])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, 1000):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, 1000).columns), strict=True)


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting, strict=True), schema, strict=True)], schema=schema)

    for row in rows:
        waiting.append(row)
        if len(waiting) >= 1000:
            yield made()
            waiting.clear()
    if waiting:
        yield made()


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows key, sizes, conv_id, sorted: equal neighbours as one block of at most ``BLOCK_BYTES`` of ids."""

    def fold() -> Iterator[tuple]:
        at, size, ids = None, 0, []
        for key, sizes, conv in _rows(batches):
            if at is None or key != at[0] or size > BLOCK_BYTES:
                if at is not None:
                    yield *at, len(ids), ",".join(ids)
                at, size, ids = (key, sizes, conv), 0, []
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if at is not None:
            yield *at, len(ids), ",".join(ids)

    return _batches(fold(), _BLOCK)


def _ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of blocks sorted by key and first id: each key once, with the hash of all its ids."""

    def fold() -> Iterator[tuple]:
        at, n, told = None, 0, None
        for key, sizes, first, some, ids in _rows(batches):
            if at is not None and key == at[0]:
                told.update(b",")
                n += some
            else:
                if at is not None:
                    yield at[0], at[1], n, at[2], told.hexdigest()
                at, n, told = (key, sizes, first), some, hashlib.sha256()
            told.update(ids.encode())
        if at is not None:
            yield at[0], at[1], n, at[2], told.hexdigest()

    return _batches(fold(), _ENDS)


def _common(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows part, first, last, before: the turns that the first key shares with the key before it and with the last."""
    for batch in batches:
        out = []
        for part, first, last, before in _rows([batch]):
            shared = -1 if before is None else len(os.path.commonprefix([first, before])) // WIDTH
            out.append((part, shared, len(os.path.commonprefix([first, last])) // WIDTH))
        yield from _batches(out, pa.schema([(c, pa.int64()) for c in ("part", "before", "span")]))


def shared_paths(parts: list[tuple[int, int, int]]) -> dict[int, tuple[list[tuple[int, int]], int]]:
    """For each part, given in order with the turns it shares (before, span): owners of its shared nodes, and what it shares behind."""

    def down_to(runs: list[tuple[int, int]], depth: int) -> list[tuple[int, int]]:
        whole = [r for r in runs if r[0] <= depth]
        more = runs[len(whole) : len(whole) + 1] if not whole or whole[-1][0] < depth else []
        return whole + [(depth, owner) for _, owner in more]

    found, path = {}, []
    for k, (part, before, span) in enumerate(parts):
        shared = down_to(path, before) if k else []
        found[part] = (shared, parts[k + 1][1] if k + 1 < len(parts) else -1)
        path = [*down_to(shared, span), (1 << 62, part)]
    return found


def _walk_parts(shared: dict) -> Callable:
    """The nodes of each part; rows come sorted by part and key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nodes() -> Iterator[tuple]:
            part, rows = None, []
            for key, sizes, n, least, ends, here in _rows(batches):
                if here != part and rows:
                    yield from nodes_of_part(rows, part, *shared[part])
                    rows = []
                part = here
                rows.append((key, sizes, n, least, ends))
            if rows:
                yield from nodes_of_part(rows, part, *shared[part])

        yield from _batches(nodes(), _NODE)

    return run


def conversation_turns(rows: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each as (turn, id, size)."""
    role, text = whole_text("role"), whole_text("text")
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        column("turn").cast("long").alias("turn"),
        F.substring(F.sha2(told, 256), 1, 2 * WIDTH).alias("id"),
        F.char_length(text).cast("long").alias("size"),
    )
    kept = rows.select(column("conv_id").cast("long").alias("conv_id"), turn.alias("t")).filter(F.col("conv_id").isNotNull())
    return kept.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(rows: DataFrame) -> DataFrame:
    """conv_id and turns, the first h of them those of the conversation that opens its hundred; h is 0 to 5 by the id's CRC-32."""
    own = cut_lineage(conversation_turns(rows), "own-turns")
    base = F.col("conv_id") - F.col("conv_id") % BASE
    heads = own.filter(F.col("conv_id") % BASE == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    both = own.withColumns({"base": base, "h": h}).join(heads, "base", "left")
    tail = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    return both.select("conv_id", F.concat(head, tail).alias("turns"))


def _key(turns: str) -> Column:
    return F.unhex(F.array_join(F.transform(turns, lambda t: t["id"]), ""))


def turn_trie(conversations: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """A row per node of the trie of all ``conversations`` (conv_id, turns)."""
    spark = conversations.sparkSession
    keyed = conversations.select(_key("turns").alias("key"), F.transform("turns", lambda t: t["size"]).alias("sizes"), "conv_id")
    ordered = keyed.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    blocks = ordered.mapInArrow(_blocks, "key binary, sizes array<long>, first long, n long, ids string")
    together = blocks.repartition("key").sortWithinPartitions("key", "first")
    distinct = cut_lineage(
        together.mapInArrow(_ends, "key binary, sizes array<long>, n long, least long, ends string"), "distinct-conversations"
    )
    size = distinct.agg(F.sum(F.octet_length("key") + WIDTH)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / part_bytes))
    cut = distinct.repartitionByRange(parts, "key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id().cast("long"))
    cut = cut_lineage(cut, "turn-keys")
    # A row per part from here to the driver, as three numbers.
    ends = cut.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    ends = ends.select("part", "first", "last", F.lag("last").over(Window.orderBy("part")).alias("before"))
    shared = shared_paths(sorted(tuple(r) for r in ends.mapInArrow(_common, "part long, before long, span long").collect()))
    dealt = cut.repartition("part").sortWithinPartitions("part", "key")
    nodes = cut_lineage(dealt.mapInArrow(_walk_parts(shared), _NODE_DDL), "trie-nodes")

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = nodes.filter(F.col("owner").isNotNull()).groupBy("owner", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent").alias("parent"), F.min("parent_owner").alias("parent_owner"),
        *sums, F.max("ends_sha256").alias("ends_sha256"),
    )
    merged = cut_lineage(merged, "shared-nodes")
    every = nodes.filter(F.col("owner").isNull()).unionByName(merged)
    tops = merged.select(F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("top"))
    below = every.filter(F.col("parent_owner").isNotNull()).join(tops, ["parent_owner", "depth"])
    known = every.filter(F.col("parent_owner").isNull()).withColumn("top", F.col("parent"))
    return known.unionByName(below).select(
        "conv_id", "depth", F.col("top").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def conversation_trie(rows: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The trie of the rebuilt conversations of ``rows`` (conv_id, turn, role, text)."""
    return turn_trie(rebuilt(rows), part_bytes)
