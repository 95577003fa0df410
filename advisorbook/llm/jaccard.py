"""Similarity join on word shingles by grouped prefixes, and the components of its links.

Documents of equal shingle sets are one class. In a fixed order of all shingles, two sets of
Jaccard similarity t or more share a shingle among the first |A| - ceil(t |A|) + 1 of each.
Classes with identical prefixes and size make one group; groups meet on the shingles of
their prefixes, and a group pair is kept when its sizes fit and the shingles counted up to
the last common one still allow the overlap that t needs. What holds for a group's prefix and
size holds for all its members, so the kept pairs are expanded to members. A parity sketch of
about one bit per shingle, on which two sets differ in no more places than they have shingles
apart, drops members that differ too much; the others are verified on their full sets, read
again from the texts.

The order puts shingles that are frequent in the tasks' own counts last, then goes by hash;
any order gives the same links. Not all pairs of a large family of near copies are tried:
in a first round each member meets its group's first member, and each group the
most central group of similar size on each of its shingles, that with fewest rarer ones; copies
with edits of their own differ less from it than from one another. A second round tries every remaining candidate pair
that joins two different components of the first, so no link between components is lost. A
link inside a component adds nothing to it and is not looked for. In the second round a pair
makes one row and hardly more, that of its first common shingle: an entry knows the few
shingles before it, and two entries that share one of these meet earlier. On each shingle the
component of least root, mostly the largest, is only a partner of the others.

Components come from rounds of large-star and small-star steps, each written to the shared
folder. Nothing but counts of a sketch and a bitmap, both of fixed size, comes to the driver; the
bitmap only spares texts that no pair needs a shuffle. Skewed shingles are
split by Spark's joins; aggregations combine within map tasks.

A text without words has an empty set, is linked with nothing and is its own component; null
is such a text. Each row is a document of its own; rows that share a doc_id are told apart
by a hash of their texts. A component's id is its least doc_id; null ids count only where a
component has no other. Further columns are left behind; an empty table gives no rows.
"""

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorbook.llm.common import column, text_key, utf8_texts, whole_text
from advisorbook.llm.encoding import batches_of_text
from advisorbook.llm.hashing import MIX, NEXT, Stretches, mix
from advisorbook.session import cut_lineage

WORDS, SHARE = 3, 90
SKETCH_BITS = 20
MARK_WORDS = 1 << 17
BEFORE = 2
_SLICE = 1 << 20
_LEAST_TASKS, _TASK_EDGES = 32, 50_000
# The bytes between words.
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_sets(bodies: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Of each text the sorted 64-bit hashes of its distinct shingles."""
    text = _LOWER[np.frombuffer(b"".join(b + b" " for b in bodies), np.uint8)]
    ends = np.cumsum(np.fromiter((len(b) + 1 for b in bodies), np.int64, len(bodies)))
    hashes = Stretches(text)
    inside = ~_WHITE[text]
    start = np.flatnonzero(inside & np.r_[True, ~inside[:-1]]) if len(text) else np.zeros(0, np.int64)
    stop = np.flatnonzero(inside & np.r_[~inside[1:], True]) + 1 if len(text) else start
    word = mix(hashes.between(start, stop) + (stop - start).astype(np.uint64) * np.uint64(NEXT))
    made = np.zeros(max(0, len(word) - words + 1), np.uint64)
    for k in range(words):
        made = mix(made * np.uint64(NEXT) + word[k : len(word) - words + 1 + k])
    at = np.r_[0, np.searchsorted(start, ends)]
    sets = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= words:
            sets.append(np.unique(made[a : b - words + 1]))
        else:
            short = np.full(min(1, b - a), b - a, np.uint64)  # none without words
            for k in range(a, b):
                short = mix(short * np.uint64(MIX) + word[k : k + 1])
            sets.append(short)
    return sets


def _set_key(s: np.ndarray) -> bytes:
    """128 bits of a set, whatever the order of its members."""
    other = mix(s * np.uint64(NEXT) + np.uint64(len(s)))
    return np.array([s.sum(dtype=np.uint64), other.sum(dtype=np.uint64)], "<u8").tobytes()


def _list_key(s: np.ndarray) -> bytes:
    """128 bits of a list."""
    place = np.arange(1, len(s) + 1, dtype=np.uint64) * np.uint64(MIX)
    return _set_key(mix(s + place))


def _parity(s: np.ndarray) -> bytes:
    """Whether the shingles that fall on each bit are odd in number; about one bit per shingle."""
    size = max(64, 1 << (len(s) - 1).bit_length())
    times = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits(times.astype(np.uint8) & 1, bitorder="little").tobytes()


def _apart(x: bytes, y: bytes) -> int:
    """The bits in which two parity sketches differ; the longer is folded to the size of the other."""
    a, b = (np.frombuffer(z, np.uint64) for z in (x, y))
    while len(a) != len(b):
        if len(a) > len(b):
            a = a[: len(a) // 2] ^ a[len(a) // 2 :]
        else:
            b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _near(share: int) -> Callable:
    """The pairs whose sketches differ in no more bits than similar sets have shingles apart."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, na, nb = (batch.column(k).to_pylist() for k in range(2, 6))
            near = [
                _apart(p, q) <= i + j + 2 * (-share * (i + j) // (100 + share)) for p, q, i, j in zip(x, y, na, nb, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(near, pa.bool_()))

    return run


def _describe(words: int) -> Callable:
    """Rows of documents (their class and size) and of the task's frequent sketch cells."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, names = np.zeros(1 << SKETCH_BITS, np.int32), ["doc_id", "h", "n", "c", "cell", "times"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        for batch in batches_of_text(batches, at=2, chars=_SLICE):
            sets = shingle_sets(utf8_texts(batch), words)
            cells += np.bincount(
                (np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(cells)
            ).astype(np.int32)
            none = pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(map(len, sets)), kinds[2]),
                 pa.array(list(map(_set_key, sets)), kinds[3]), none, none], names,
            )
        often = np.flatnonzero(cells > max(8, 4 * cells.mean()))
        none = [pa.nulls(len(often), k) for k in kinds[:4]]
        yield pa.RecordBatch.from_arrays([*none, pa.array(often), pa.array(cells[often].astype(np.int64))], names)

    return run


def _prefixes(words: int, share: int, levels: bytes) -> Callable:
    """Of each class in a batch its prefix, and a key of the prefix."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(levels, np.uint8)
        for batch in batches_of_text(batches, at=0, chars=_SLICE):
            rows: dict[bytes, tuple] = {}
            for s in shingle_sets(utf8_texts(batch), words):
                if len(s) and (key := _set_key(s)) not in rows:
                    size = len(s) + (-share * len(s) // 100) + 1
                    rank = level[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    prefix = s[np.argsort(rank, kind="stable")[:size]]
                    rows[key] = (len(s), _list_key(prefix), prefix.view(np.int64), _parity(s))
            n, keys, prefixes, bits = zip(*rows.values(), strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows), pa.binary()), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(prefixes, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                ["c", "n", "px", "prefix", "bits"],
            )

    return run


def _marks(keep: DataFrame) -> bytes:
    """A bitmap of ``MARK_WORDS`` words in which each text key of ``k_h`` has its bit set."""
    word = F.expr(f"shiftrightunsigned(k_h, 6) & {MARK_WORDS - 1}")
    words = keep.groupBy(word.alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(k_h & 63 AS INT)))").alias("bits"))
    marks = np.zeros(MARK_WORDS, np.int64)
    for row in words.collect():  # at most the words of the bitmap
        marks[row["word"]] = row["bits"]
    return marks.tobytes()


def _pack(marks: bytes) -> Callable:
    """The texts whose key is marked, compressed."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        words = np.frombuffer(marks, np.uint64)
        pack = zstandard.ZstdCompressor(level=1).compress

        def marked() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                h = batch.column(1).to_numpy().view(np.uint64)
                bit = words[((h >> np.uint64(6)) & np.uint64(len(words) - 1)).astype(np.int64)] >> (h & np.uint64(63))
                yield batch.filter(pa.array(bit & np.uint64(1) > 0))

        for batch in batches_of_text(marked(), at=2, chars=_SLICE):
            z = pa.array([pack(b) for b in utf8_texts(batch)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), z], ["doc_id", "h", "z"])

    return run


def _verify(words: int, share: int) -> Callable:
    """The pairs whose full sets are similar enough."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        last, first = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b, za, zb = (batch.column(k).to_pylist() for k in range(4))
            linked = []
            for k in range(batch.num_rows):
                if a[k] != last:
                    last, first = a[k], shingle_sets([unpack(za[k])], words)[0]
                second = shingle_sets([unpack(zb[k])], words)[0]
                both = len(np.intersect1d(first, second, assume_unique=True))
                linked.append(100 * both >= share * (len(first) + len(second) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` (the least node of its component) for the nodes of links ``a``, ``b``.

    Ends at the first round whose edges are stars already. The tasks that write a round go by its edges, so
    that few edges do not cost a full set of shuffle partitions at each step.
    """
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges")
    while True:
        tasks = max(_LEAST_TASKS, edges.count() // _TASK_EDGES)
        # Large star: larger neighbours of a node go to the least of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(
            F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") < F.col("u")).alias("below")
        )
        least = cut_lineage(least.coalesce(tasks), "least")
        if least.filter("below > 0 AND n > 1").isEmpty():  # each node has its root as only neighbour
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        large = both.filter("v > u").join(least.select("u", "m"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut_lineage(large.coalesce(tasks), "large-star")
        # Small star: a node and its smaller neighbours go to the least of them.
        least = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks), "least")
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()
        edges = cut_lineage(small.coalesce(tasks), "edges")


class SimilarityJoin:
    """The join's steps over one table; ``components`` is what callers want."""

    def __init__(self, docs: DataFrame, share: int = SHARE, words: int = WORDS, key: str = "doc_id", text: str = "text") -> None:
        self.share, self.words = share, words
        self.rows = docs.select(
            column(key).cast("long").alias("doc_id"), text_key(text).alias("h"), whole_text(text).alias("text")
        )
        described = self.rows.mapInArrow(_describe(words), "doc_id long, h long, n long, c binary, cell long, times long")
        described = cut_lineage(described, "described")
        cells = described.filter(F.col("cell").isNotNull()).groupBy("cell").agg(F.sum("times").alias("times"))
        self.documents = described.filter(F.col("cell").isNull()).select("doc_id", "h", "n", "c")
        levels = np.zeros(1 << SKETCH_BITS, np.uint8)
        for row in cells.collect():  # at most the cells of the sketch
            levels[row["cell"]] = row["times"].bit_length()
        prefixes = self.rows.select("text").mapInArrow(
            _prefixes(words, share, levels.tobytes()), "c binary, n long, px binary, prefix array<long>, bits binary"
        )
        first = prefixes.groupBy("c").agg(*(F.first(x).alias(x) for x in ("n", "px", "prefix", "bits")))
        self.classes = cut_lineage(first.withColumn("cid", F.monotonically_increasing_id()), "classes")
        groups = cut_lineage(self.classes.groupBy("px", "n").agg(F.min("cid").alias("gid")), "groups")
        self.members = cut_lineage(
            self.classes.select("cid", "c", "px", "n").join(groups, ["px", "n"]).select("cid", "gid", "c", "n"), "members"
        )
        entries = self.classes.join(groups.select(F.col("gid").alias("cid")), "cid", "left_semi").select(
            F.col("cid").alias("gid"), "n", F.posexplode("prefix").alias("pos", "shingle")
        )
        shared = entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("shingle")
        self.entries = cut_lineage(entries.join(cut_lineage(shared, "shared"), "shingle", "left_semi"), "entries")

    def _sizes_fit(self, a: str, b: str):
        return (100 * F.col(a) >= self.share * F.col(b)) & (100 * F.col(b) >= self.share * F.col(a))

    def _possible(self, matches: DataFrame) -> DataFrame:
        """Group pairs ``a``, ``b`` whose common prefix shingles still allow the overlap needed."""
        counted = matches.groupBy("a", "b", "na", "nb").agg(
            F.count(F.lit(1)).alias("o"), F.max("pa").alias("pa"), F.max("pb").alias("pb")
        )
        most = F.col("o") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - 1
        return counted.filter((100 + self.share) * most >= self.share * (F.col("na") + F.col("nb"))).select("a", "b")

    def _side(self, frame: DataFrame, side: str) -> DataFrame:
        return frame.withColumnsRenamed({"gid": side, "n": f"n{side}", "pos": f"p{side}"})

    def _verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs of classes ``a``, ``b`` that are links."""
        sketch = self.classes.select("cid", "bits", "n")
        both = pairs.distinct().join(sketch.withColumnsRenamed({"cid": "a", "bits": "x", "n": "na"}), "a").join(
            sketch.withColumnsRenamed({"cid": "b", "bits": "y", "n": "nb"}), "b"
        )
        near = both.select("a", "b", "x", "y", "na", "nb").mapInArrow(_near(self.share), "a long, b long")
        pairs = cut_lineage(near, f"{name}-pairs")
        needed = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
        found = self.members.select("cid", "c").join(needed, "cid")
        keep = self.documents.groupBy("c").agg(F.min(F.struct("doc_id", "h")).alias("d")).join(found, "c")
        keep = cut_lineage(keep.select("cid", F.col("d.doc_id").alias("k_id"), F.col("d.h").alias("k_h")), f"{name}-keys")
        packed = self.rows.mapInArrow(_pack(_marks(keep)), "doc_id long, h long, z binary")
        same = (packed["h"] == keep["k_h"]) & packed["doc_id"].eqNullSafe(keep["k_id"])
        texts = packed.join(keep, same).select("cid", "z").dropDuplicates(["cid"])
        texts = cut_lineage(texts, f"{name}-texts")
        both = pairs.join(texts.withColumnsRenamed({"cid": "b", "z": "zb"}), "b").join(
            texts.withColumnsRenamed({"cid": "a", "z": "za"}), "a"
        )
        rows = both.select("a", "b", "za", "zb")
        return cut_lineage(rows.mapInArrow(_verify(self.words, self.share), "a long, b long"), f"{name}-links")

    def _first_round(self) -> DataFrame:
        inside = self.members.filter("cid > gid").select(F.col("gid").alias("a"), F.col("cid").alias("b"))
        band = F.floor(F.log("n") / math.log(100 / self.share)) if self.share < 100 else F.col("n")
        banded = self.entries.withColumn("band", band)
        pivots = cut_lineage(
            banded.groupBy("shingle", "band").agg(F.min(F.struct("pos", "gid", "n")).alias("p")).select("shingle", "band", "p.*"), "pivots"
        )
        met = self._side(banded, "b").join(self._side(pivots, "a"), ["shingle", "band"]).filter("a != b")
        pairs = self._possible(met).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return self._verified(inside.unionByName(pairs), "first")

    def _mixed_entries(self, spans: DataFrame) -> DataFrame:
        """Prefix shingles on which components of the first round meet.

        With ``before``, the shingles just before it in the group's prefix, and ``off``, whether the group
        lies outside the component of least root on the shingle, mostly the largest.
        """
        entries = self.entries.join(spans, "gid")
        mixed = entries.groupBy("shingle").agg(F.min("lo").alias("main"), F.max("hi").alias("most")).filter("main < most").drop("most")
        off = (F.col("lo") != F.col("main")) | (F.col("hi") != F.col("main"))
        entries = entries.join(cut_lineage(mixed, "mixed"), "shingle").withColumn("off", off).drop("main")
        prefixes = self.classes.select(F.col("cid").alias("gid"), "prefix")
        before = F.slice("prefix", F.greatest(F.col("pos") - BEFORE + 1, F.lit(1)), F.least(F.col("pos"), F.lit(BEFORE)))
        entries = cut_lineage(entries, "mixed-shingles").join(prefixes, "gid").withColumn("before", before)
        return cut_lineage(entries.drop("prefix"), "mixed-entries")

    def _second_round(self, roots: DataFrame) -> DataFrame:
        """Links between components of the first round."""
        rooted = cut_lineage(
            self.members.join(roots, self.members["cid"] == roots["node"], "left").select(
                "cid", "gid", F.coalesce("root", "cid").alias("root")
            ),
            "rooted",
        )
        spans = cut_lineage(rooted.groupBy("gid").agg(F.min("root").alias("lo"), F.max("root").alias("hi")), "group-roots")
        entries = self._mixed_entries(spans)
        x, y = (entries.select("shingle", *(F.col(c).alias(c + z) for c in ("gid", "n", "pos", "lo", "hi", "off", "before"))) for z in "xy")
        rest = F.least(F.col("nx") - F.col("posx"), F.col("ny") - F.col("posy"))
        meet = (
            (x["shingle"] == y["shingle"])
            & (F.col("gidx") != F.col("gidy"))
            & (~F.col("offy") | (F.col("gidx") < F.col("gidy")))
            & ((F.col("lox") != F.col("hiy")) | (F.col("hix") != F.col("loy")))
            & self._sizes_fit("nx", "ny")
            # On the first common shingle all that is common is still to come; later ones need no row.
            & ((100 + self.share) * rest >= self.share * (F.col("nx") + F.col("ny")))
            & ~F.arrays_overlap("beforex", "beforey")
        )
        met = x.filter("offx").join(y, meet)
        met = met.select(F.least("gidx", "gidy").alias("a"), F.greatest("gidx", "gidy").alias("b"))
        pairs = cut_lineage(met.distinct(), "group-pairs")
        left = rooted.select(F.col("gid").alias("a"), F.col("cid").alias("x"), F.col("root").alias("rx"))
        right = rooted.select(F.col("gid").alias("b"), F.col("cid").alias("y"), F.col("root").alias("ry"))
        within = spans.filter("lo < hi").select(F.col("gid").alias("a"), F.col("gid").alias("b"))
        expanded = pairs.unionByName(within).join(left, "a").join(right, "b").filter("rx != ry")
        return self._verified(expanded.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")), "second")

    def components(self) -> DataFrame:
        """A row per document: doc_id, h, n_shingles, component_id, and ``first``, whether it is one to keep of its component."""
        links = self._first_round()
        roots = components(links)
        more = self._second_round(roots)
        if not more.isEmpty():
            roots = components(links.unionByName(more))
        of_class = self.members.join(roots, self.members["cid"] == roots["node"], "left").select(
            "c", F.coalesce("root", "cid").alias("root")
        )
        rooted = cut_lineage(self.documents.filter("n > 0").join(cut_lineage(of_class, "roots"), "c"), "rooted-documents")
        least = cut_lineage(
            rooted.groupBy("root").agg(
                F.min("doc_id").alias("component_id"),
                F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "h")).alias("d"),
            ), "component-ids"
        )
        is_first = F.col("doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("h") == F.col("d.h"))
        linked = rooted.join(least, "root").select("doc_id", "h", "n", "component_id", is_first.alias("first"))
        alone = self.documents.filter("n = 0").select("doc_id", "h", "n", F.col("doc_id").alias("component_id"), F.lit(True).alias("first"))
        return linked.unionByName(alone).withColumnRenamed("n", "n_shingles")


def similar_components(docs: DataFrame, share: int = SHARE, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    return SimilarityJoin(docs, share, words).components().select("doc_id", "n_shingles", "component_id")


def keep_first(docs: DataFrame, share: int = SHARE, words: int = WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, that of least id, with all its columns; those without words all stay."""
    found = SimilarityJoin(docs, share, words, key, text).components()
    chosen = found.filter("first").select(F.col("doc_id").alias("k_id"), F.col("h").alias("k_h"), F.col("n_shingles").alias("k_n"))
    chosen = cut_lineage(chosen.groupBy("k_id", "k_h").agg(F.first("k_n").alias("k_n"), F.count(F.lit(1)).alias("times")), "chosen")
    rows = docs.select(F.struct("*").alias("row"), column(key).cast("long").alias("doc_id"), text_key(text).alias("h"))

    def matching(some: DataFrame) -> DataFrame:
        same = (rows["h"] == some["k_h"]) & rows["doc_id"].eqNullSafe(some["k_id"])
        return rows.join(some, same, "left_semi")

    single = matching(chosen.filter("times = 1 OR k_n = 0"))
    repeated = matching(chosen.filter("times > 1 AND k_n > 0")).dropDuplicates(["doc_id", "h"])
    return single.unionByName(repeated).select("row.*")
