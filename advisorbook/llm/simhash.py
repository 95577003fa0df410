"""Near copies by SimHash: a self-join of binary tries over 64-bit fingerprints.

Documents of equal fingerprint are one leaf, however many they are. Two leaves link when at most
three bits differ. A pair of trie nodes is followed down together, bit by bit: children of equal
bit keep the errors, children of unequal bit add one, and a pair beyond the budget is left. Two
single leaves are settled at once by their differing bits.

Tries are dealt to tasks by a block of bits that must be equal: of four blocks at least one has no
error, so each leaf stands in four tries, below the value of each of its blocks, and no link is
lost. A trie of more than ``trie_leaves`` leaves is split the same way by four blocks of the bits
still free, until all are small (at 15 free bits the default always holds). A task walks all its
tries level by level together, and hands on a spanning forest of the links it found, not the links.

The fingerprints' components come from star rounds written to the shared folder. A fingerprint or
component that at least a thousandth of the rows share goes to all tasks (they are a thousand at
most), the others are shuffled, so no task gathers the rows of a hot one.

A text without words has fingerprint zero and is linked like any other; null is such a text. Each
row is a document of its own. A component's id is its least doc_id; null ids count only where a
component has no other (then it is null). Long texts are read in pieces. An empty table gives no
rows; further columns are left behind.
"""

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorbook.llm.common import column, utf8_texts, whole_text
from advisorbook.llm.encoding import batches_of_text
from advisorbook.llm.jaccard import components
from advisorbook.session import cut_lineage

WORDS, ERRORS = 3, 3
SEED = 42
TRIE_LEAVES = 50_000
_TOGETHER = 200_000
_PAIRS = 1 << 20
_SLICE, _PIECE = 16 << 20, 1 << 20
_HOT = 1000
_ALL = (1 << 64) - 1
_WHITE = re.compile(rb"[\x09-\x0D\x20]")


def _word_lists(body: bytes, words: int) -> Iterator[list[bytes]]:
    """The words of a text in lists, each beginning with the last words of the one before."""
    start, kept = 0, []
    while start < len(body):
        cut = _WHITE.search(body, start + _PIECE)
        stop = cut.start() if cut else len(body)
        found = kept + body[start:stop].split()
        # A short text is one list; of longer ones the last words - 1 begin the next.
        if len(found) >= words or stop == len(body):
            yield found
            kept = found[len(found) - words + 1 :]
        else:
            kept = found
        start = stop


def fingerprint(body: bytes, words: int = WORDS) -> int:
    """64 bits, each set where over half of the shingles' hashes have it."""
    from xxhash import xxh64_intdigest

    ones, n, short = np.zeros(64, np.int64), 0, []
    for found in _word_lists(body.lower(), words):
        if len(found) < words:
            short = found
            continue
        shingles = map(b" ".join, zip(*(found[k:] for k in range(words)), strict=False))
        hashes = np.array([xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        n += len(hashes)
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    if n == 0:
        return xxh64_intdigest(b" ".join(short), SEED) if short else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(words: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of_text(batches, at=1, chars=_SLICE):
            made = np.array([fingerprint(b, words) for b in utf8_texts(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], ["doc_id", "leaf"])

    return run


def near_leaves(trie: np.ndarray, leaf: np.ndarray, errors: int = ERRORS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as pairs of rows, of the leaves at most ``errors`` bits apart in each trie.

    Rows are sorted by trie, then leaf. A node is a range of rows; a pair of nodes is walked down
    as one, from each trie's root paired with itself.
    """
    n = len(leaf)
    bound = np.r_[0, np.flatnonzero(np.diff(trie)) + 1, n] if n else np.zeros(1, np.int64)
    first, last = bound[:-1], bound[1:]
    several = last - first > 1
    root = (first[several], last[several])
    walk = [(63, (*root, *root, np.zeros(several.sum(), np.int64)))]
    ones: dict[int, np.ndarray] = {}
    links_a, links_b, size = [], [], 0
    label = np.arange(n)

    def forest() -> None:
        """Fold the links so far into a label of each row: the least row linked with it."""
        nonlocal links_a, links_b, size
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (links_a, links_b))
        while True:
            x, y = label[a], label[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            apart = low < high
            if not apart.any():
                break
            a, b = a[apart], b[apart]
            np.minimum.at(label, high[apart], low[apart])
            while (label[label] != label).any():
                label[:] = label[label]
        links_a, links_b, size = [], [], 0

    while walk:
        bit, pairs = walk.pop()
        if len(pairs[0]) > _PAIRS:
            half = len(pairs[0]) // 2
            walk += [(bit, tuple(x[:half] for x in pairs)), (bit, tuple(x[half:] for x in pairs))]
            continue
        a0, a1, b0, b1, e = pairs
        single = (a1 - a0 == 1) & (b1 - b0 == 1) | (bit < 0) & (a0 != b0)  # below the last bit all rows are one leaf
        a, b = a0[single], b0[single]
        near = np.bitwise_count(leaf[a] ^ leaf[b]) <= errors
        links_a.append(a[near])
        links_b.append(b[near])
        size += int(near.sum())
        if size > _PAIRS:
            forest()
        if bit < 0 or single.all():
            continue
        a0, a1, b0, b1, e = (x[~single] for x in pairs)
        if bit not in ones:
            ones[bit] = np.r_[0, np.cumsum((leaf >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)]
        c = ones[bit]
        am, bm = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0])
        other = a0 != b0  # a node paired with itself has one pair of unequal children only
        children = [
            (a0, am, b0, bm, e, a0 < a1),
            (am, a1, bm, b1, e, a0 < a1),
            (a0, am, bm, b1, e + 1, e < errors),
            (am, a1, b0, bm, e + 1, (e < errors) & other),
        ]
        kept = []
        for p0, p1, q0, q1, err, some in children:
            fine = some & (p0 < p1) & (q0 < q1) & ((p0 != q0) | (p1 - p0 > 1))
            kept.append([x[fine] for x in (p0, p1, q0, q1, err)])
        walk.append((bit - 1, tuple(np.concatenate(x) for x in zip(*kept, strict=True))))
        if not len(walk[-1][1][0]):
            walk.pop()
    forest()
    linked = np.flatnonzero(label != np.arange(n))
    return linked, label[linked]


def _walk_tries(errors: int) -> Callable:
    """Links, as pairs of leaves, of all tries of a task; rows come sorted by trie and leaf."""

    def links(rows: list[np.ndarray]) -> pa.RecordBatch:
        free, fixed, leaf = rows
        trie = np.cumsum(np.r_[0, (np.diff(free) != 0) | (np.diff(fixed) != 0)]) if len(leaf) else leaf
        leaf = leaf.view(np.uint64)
        order = np.lexsort((leaf, trie))
        trie, leaf = trie[order], leaf[order]
        a, b = near_leaves(trie, leaf, errors)
        return pa.RecordBatch.from_arrays([pa.array(leaf[x].view(np.int64)) for x in (a, b)], ["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            kept = [np.concatenate([x, batch.column(k).to_numpy()]) for k, x in enumerate(kept)]
            if len(kept[0]) >= _TOGETHER:
                ends = np.flatnonzero((np.diff(kept[0]) != 0) | (np.diff(kept[1]) != 0)) + 1
                if len(ends):
                    yield links([x[: ends[-1]] for x in kept])
                    kept = [x[ends[-1] :] for x in kept]
        yield links(kept)

    return run


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _blocks(free: int, blocks: int) -> list[int]:
    """The masks left free when each of ``blocks`` blocks of the free bits must be equal."""
    bits = [k for k in range(64) if free >> k & 1]
    cuts = [len(bits) * k // blocks for k in range(blocks + 1)]
    return [free & ~sum(1 << k for k in bits[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b]


def _tries(leaves: DataFrame, errors: int, most: int) -> DataFrame:
    """free, fixed, leaf: each leaf below its value on the bits that are not free."""
    masks, small = [_ALL], None
    rows = leaves.select(F.lit(_signed(_ALL)).alias("free"), "leaf")
    while True:
        split = {m: _blocks(m, errors + 1) for m in masks}
        table = F.create_map(*[F.lit(x) for m, parts in split.items() for x in (_signed(m), [_signed(p) for p in parts])])
        rows = rows.select(F.explode(table[F.col("free")]).alias("free"), "leaf")
        rows = cut_lineage(rows.select("free", F.col("leaf").bitwiseAND(F.bitwise_not("free")).alias("fixed"), "leaf"), "tries")
        large = rows.groupBy("free", "fixed").agg(F.count(F.lit(1)).alias("leaves")).filter(F.col("leaves") > most)
        large = cut_lineage(large.select("free", "fixed"), "large-tries")
        if large.isEmpty():
            return rows if small is None else small.unionByName(rows)
        fitting = rows.join(large, ["free", "fixed"], "left_anti")
        small = fitting if small is None else small.unionByName(fitting)
        rows = rows.join(large, ["free", "fixed"], "left_semi")
        masks = [r["free"] & _ALL for r in large.select("free").distinct().collect()]  # at most 4 times as many as before


def _look_up(rows: DataFrame, table: DataFrame, key: str, rows_of: str, total: int) -> DataFrame:
    """``rows`` joined with ``table``, which holds each key once and the number of its rows."""
    hot = F.col(rows_of) * _HOT >= total
    few = table.filter(hot).drop(rows_of)  # at most _HOT keys
    found = rows.join(F.broadcast(few), key)
    others = rows.join(F.broadcast(few.select(key)), key, "left_anti")
    return found.unionByName(others.join(table.filter(~hot).drop(rows_of), key))


def near_components(
    docs: DataFrame,
    errors: int = ERRORS,
    words: int = WORDS,
    trie_leaves: int = TRIE_LEAVES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    texts = docs.select(column(key).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    marked = cut_lineage(texts.mapInArrow(_fingerprints(words), "doc_id long, leaf long"), "fingerprints")
    leaves = marked.groupBy("leaf").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"))
    leaves = cut_lineage(leaves, "leaves")
    tries = _tries(leaves.select("leaf"), errors, trie_leaves)
    dealt = tries.repartition("free", "fixed").sortWithinPartitions("free", "fixed")
    links = cut_lineage(dealt.mapInArrow(_walk_tries(errors), "a long, b long"), "trie-links")
    roots = components(links).withColumnRenamed("node", "leaf")
    rooted = cut_lineage(leaves.join(roots, "leaf", "left").withColumn("root", F.coalesce("root", "leaf")), "rooted-leaves")
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("leaves"))
    of_root = cut_lineage(of_root, "component-ids")
    total = leaves.agg(F.count(F.lit(1)), F.sum("n")).first()
    named = _look_up(rooted.select("leaf", "n", "root"), of_root, "root", "leaves", total[0])
    named = cut_lineage(named.select("leaf", "component_id", "n"), "component-of-leaf")
    told = F.lower(F.lpad(F.hex("leaf"), 16, "0")).alias("fingerprint")
    return _look_up(marked, named, "leaf", "n", total[1] or 0).select("doc_id", told, "component_id")
