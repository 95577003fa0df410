"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

A byte goes when it lies in a 100-byte string that also starts earlier: in a document of
smaller doc_id, or earlier in its own. Suffixes need to be ordered through their first 100
bytes only; suffixes equal that far are one group, and all but the first of a group repeat
it. The sort goes from the most significant digit on. Suffixes alone in their bin drop out
after each pass, so a pass moves only what the one before left.

* The leading digit of a suffix is the least hash among the 20-byte grams of its 100 bytes.
  Equal strings have equal digits, and neighbouring suffixes mostly share theirs, so a run of
  some forty suffixes travels as one row. A pass bins these rows and keeps the digits that
  come twice.
* Within a bin the runs are told apart by a fingerprint of all their bytes. Runs equal to
  one of an earlier document repeat it whole. Where a bin holds runs of several kinds, the
  first run of each kind stays open.
* The next passes do the same to the suffixes of open runs with longer grams, of 80 and of
  96 bytes, so fewer share a bin by chance and runs get shorter. The last has grams of 100
  bytes: every suffix is a run, and a bin is a group of equal strings.

Digit and fingerprint are 64 bits each and both decide. Repeats within a document are found
by the same digits in the task that reads it. Every pass is an aggregation that combines
within map tasks and a join whose skewed keys Spark splits, so a passage or copy in any share
of the documents is no hot group. Compressed texts move once, into a table bucketed by
document, which later passes join without moving them. A document is held by one task, at
some 60 times its length in memory.

A null text is empty. A null doc_id stands after all others. Documents with equal doc_id do
not precede one another, so repeated rows are judged alike and none removes from the other.
Further columns are left behind; an empty table gives no rows. Offsets are UTF-8 bytes, and
what is left may end inside a character.
"""

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorbook.llm.common import column, utf8_texts, whole_text
from advisorbook.llm.hashing import NEXT, Stretches, mix
from advisorbook.session import cut_lineage, work_path

DEPTH = 100
GRAMS = (20, 80, 96, 100)
_LAST = 2**63 - 1
_SLICE = 1 << 18


def _sliding(op: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """``op`` over each stretch of ``width`` values."""
    span, out = 1, values
    while 2 * span <= width:
        out = op(out[:-span], out[span:])
        span *= 2
    return out if span == width else op(out[: len(values) - width + 1], out[width - span :])


@dataclass
class Runs:
    """Neighbouring suffixes of equal digit: where a run starts, of how many, in which document."""

    start: np.ndarray
    count: np.ndarray
    doc: np.ndarray
    digit: np.ndarray
    print: np.ndarray

    def suffixes(self, chosen: np.ndarray) -> np.ndarray:
        """The starts of all suffixes of the chosen runs."""
        first, count = self.start[chosen], self.count[chosen]
        ends = np.cumsum(count)
        return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - count), count)

    def listed(self, lists: list[list[int] | None]) -> np.ndarray:
        """Which runs have their fingerprint in the list of their document."""
        found = np.zeros(len(self.doc), bool)
        for k, each in enumerate(lists):
            if each:
                a, b = np.searchsorted(self.doc, (k, k + 1))
                found[a:b] = np.isin(self.print[a:b], np.array(each, np.int64).view(np.uint64))
        return found


class Suffixes:
    """The suffixes of at least ``DEPTH`` bytes of some documents, or of stretches of them.

    ``owner`` and ``origin`` say of each stretch which document it is from and where it starts.
    """

    def __init__(self, data: np.ndarray, sizes: np.ndarray, owner: np.ndarray | None = None, origin: np.ndarray | None = None) -> None:
        self.bytes, self.sizes, self.ends = data, sizes, np.cumsum(sizes)
        self.owner = np.arange(len(sizes)) if owner is None else owner
        self.origin = self.ends - sizes if origin is None else origin
        self.hashes = Stretches(data)
        count = max(0, len(data) - DEPTH + 1)
        self.valid = np.repeat(self.ends, sizes)[:count] - np.arange(count) >= DEPTH

    @classmethod
    def of(cls, bodies: list[bytes]) -> "Suffixes":
        return cls(np.frombuffer(b"".join(bodies), np.uint8), np.fromiter(map(len, bodies), np.int64, len(bodies)))

    def stretch(self, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, starts, "right")

    def place(self, starts: np.ndarray) -> np.ndarray:
        """Where the suffixes at ``starts`` start in the documents."""
        at = self.stretch(starts)
        return starts - (self.ends - self.sizes)[at] + self.origin[at]

    def runs(self, gram: int) -> Runs:
        """The runs of one pass."""
        if not self.valid.any():
            none = np.zeros(0, np.int64)
            return Runs(none, none, none, none.view(np.uint64), none.view(np.uint64))
        least = _sliding(np.minimum, self.hashes.all_of(gram), DEPTH - gram + 1)
        joined = self.valid[1:] & self.valid[:-1] & (least[1:] == least[:-1])
        if gram == DEPTH:
            joined[:] = False
        start = np.flatnonzero(self.valid & np.r_[True, ~joined])
        last = np.flatnonzero(self.valid & np.r_[~joined, True])
        whole = self.hashes.between(start, last + DEPTH)
        count = last - start + 1
        # In the last pass the digit is of the same bytes, so the first half goes into the fingerprint.
        half = self.hashes.between(start, start + DEPTH // 2)
        fingerprint = mix(whole + (half if gram == DEPTH else count.astype(np.uint64)) * np.uint64(NEXT))
        return Runs(start, count, self.owner[self.stretch(start)], least[start], fingerprint)

    def within(self, starts: np.ndarray) -> "Suffixes":
        """The suffixes at ``starts`` alone, as stretches that hold just them."""
        chosen = np.zeros(len(self.valid) + 2, np.int8)
        chosen[starts + 1] = 1
        steps = np.diff(chosen)
        first, after = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
        own = self.stretch(first)
        # Neighbours that stand in different stretches are cut apart by their suffixes being invalid.
        sizes = after - first + DEPTH - 1
        ends = np.cumsum(sizes)
        flat = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)
        return Suffixes(self.bytes[flat], sizes, self.owner[own], self.place(first))

    def later_in_document(self) -> np.ndarray:
        """The starts of strings that also start earlier in their own document."""
        if not self.valid.any():
            return np.zeros(0, np.int64)
        gram, width = GRAMS[0], DEPTH - GRAMS[0] + 1
        grams, runs = self.hashes.all_of(gram), self.runs(gram)
        bars = np.where(self.valid, _sliding(np.minimum, grams, width), np.uint64(0))
        edge = np.zeros(width - 1, np.uint64)
        chosen = np.flatnonzero(_sliding(np.maximum, np.concatenate([edge, bars, edge]), width) == grams)
        # A repeated string has its least gram twice in the document.
        keys = _with_document(self.stretch(chosen), grams[chosen])
        keys.sort()
        starts = runs.suffixes(np.isin(_with_document(runs.doc, runs.digit), keys[1:][keys[1:] == keys[:-1]]))
        if not len(starts):
            return starts
        whole = self.hashes.between(starts, starts + DEPTH)
        half = self.hashes.between(starts, starts + DEPTH // 2)
        doc = self.stretch(starts)
        order = np.lexsort((starts, half, whole, doc))
        whole, half, doc = whole[order], half[order], doc[order]
        same = (whole[1:] == whole[:-1]) & (half[1:] == half[:-1]) & (doc[1:] == doc[:-1])
        return starts[order][1:][same]

    def cover(self, starts: list[np.ndarray]) -> np.ndarray:
        """Which bytes the strings at ``starts`` cover."""
        every = np.concatenate(starts)
        n = len(self.bytes) + 1
        if not len(every):
            return np.zeros(n - 1, bool)
        steps = np.bincount(every, minlength=n) - np.bincount(every + DEPTH, minlength=n)
        return np.cumsum(steps[:-1]) > 0


def _with_document(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mix(value + (doc.astype(np.uint64) + np.uint64(1)) * np.uint64(NEXT))


def open_runs(s: Suffixes, parts: list[list[list[int] | None]]) -> Runs:
    """The runs of the pass after those whose open runs are listed."""
    for gram, lists in zip(GRAMS, parts, strict=False):
        runs = s.runs(gram)
        s = s.within(runs.suffixes(runs.listed(lists)))
    return s.runs(GRAMS[len(parts)])


def repeated(s: Suffixes, wholes: list[list], parts: list[list]) -> list[np.ndarray]:
    """The starts of strings that repeat earlier documents, given each pass's lists per document."""
    starts = []
    for k, gram in enumerate(GRAMS):
        runs = s.runs(gram)
        starts.append(s.place(runs.suffixes(runs.listed(wholes[k]))))
        if not any(parts[k]):
            break
        s = s.within(runs.suffixes(runs.listed(parts[k])))
    return starts


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches of bounded size with their texts, from a ``text`` column or compressed from ``z``."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        names = batch.schema.names
        if "text" in names:
            sizes = pc.fill_null(pc.binary_length(batch.column(names.index("text"))), 0)
        else:
            sizes = batch.column(names.index("n_bytes"))
        share = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64) // _SLICE
        cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if "text" in names:
                yield part, utf8_texts(part)
            else:
                yield part, [unpack(z) if z is not None else b"" for z in part.column(names.index("z")).to_pylist()]


def _column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _emit(n_before: int) -> Callable:
    """The distinct runs of each document in the pass after ``n_before`` others."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bodies in _slices(batches):
            runs = open_runs(Suffixes.of(bodies), [_column(batch, f"parts_{k}") for k in range(n_before)])
            order = np.lexsort((runs.print, runs.digit, runs.doc))
            digit, fp, doc = runs.digit[order], runs.print[order], runs.doc[order]
            new = np.ones(len(doc), bool)
            new[1:] = (digit[1:] != digit[:-1]) | (fp[1:] != fp[:-1]) | (doc[1:] != doc[:-1])
            ids = batch.column(batch.schema.get_field_index("doc")).to_numpy()
            made = (digit[new].view(np.int64), fp[new].view(np.int64), ids[doc[new]])
            yield pa.RecordBatch.from_arrays(list(map(pa.array, made)), ["digit", "fp", "doc"])

    return run


_RUNS = "digit long, fp long, doc long"
_RESULT = [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
_ALONE = "doc long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, z binary"


def _left(s: Suffixes, bodies: list[bytes], starts: list[np.ndarray]) -> tuple[dict[str, list], list[bytes]]:
    """The counts of each document without the strings at ``starts``, and what is left of it."""
    covered = s.cover(starts)
    rows: dict[str, list] = {name: [] for name, _ in _RESULT}
    kept = []
    for body, end in zip(bodies, s.ends.tolist(), strict=True):
        gone = covered[end - len(body) : end]
        n = int(np.count_nonzero(gone))
        left = s.bytes[end - len(body) : end][~gone].tobytes() if n else body
        rows["n_bytes"].append(len(body))
        rows["n_removed"].append(n)
        rows["n_spans"].append(int(np.count_nonzero(gone[1:] > gone[:-1])) + int(n and gone[0]))
        rows["kept_sha256"].append(hashlib.sha256(left).hexdigest())
        kept.append(left)
    return rows, kept


def _alone(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's result were it the only one, and its text compressed."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    for batch, bodies in _slices(batches):
        s = Suffixes.of(bodies)
        rows, _ = _left(s, bodies, [s.later_in_document()])
        made = [pa.array(rows[name], kind) for name, kind in _RESULT]
        packed = pa.array([pack(b) for b in bodies], pa.binary())
        keys = [batch.column(batch.schema.get_field_index(n)) for n in ("doc", "doc_id")]
        yield pa.RecordBatch.from_arrays([*keys, *made, packed], ["doc", "doc_id", *rows, "z"])


def _result(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's result; documents that share nothing keep the one they had alone."""
    for batch, bodies in _slices(batches):
        names = batch.schema.names
        wholes, parts = ([_column(batch, f"{kind}_{k}") for k in range(len(GRAMS))] for kind in ("wholes", "parts"))
        rows = {name: _column(batch, name) for name, _ in _RESULT}
        kept: list[bytes | None] = [None] * batch.num_rows
        kinds: dict[tuple[bool, bool], list[int]] = {}
        for i in range(batch.num_rows):
            given, own = any(lists[i] for lists in wholes), rows["n_removed"][i] > 0
            if given or "kept" in names:
                kinds.setdefault((given, own), []).append(i)
        for (given, own), some in kinds.items():
            texts = [bodies[i] for i in some]
            s = Suffixes.of(texts)
            starts = [s.later_in_document()] if own else [np.zeros(0, np.int64)]
            if given:
                starts += repeated(s, [[w[i] for i in some] for w in wholes], [[p[i] for i in some] for p in parts])
            new, left = _left(s, texts, starts)
            for j, i in enumerate(some):
                kept[i] = left[j]
                for name in new:
                    rows[name][i] = new[name][j]
        made = [pa.array(rows[name], kind) for name, kind in _RESULT]
        out, columns = ["doc_id", *rows], [batch.column(names.index("doc_id")), *made]
        if "kept" in names:
            out, columns = [*out, "kept"], [*columns, pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, out)


def _pass(runs: DataFrame, last: bool) -> DataFrame:
    """Per document the fingerprints of runs that repeat an earlier one (wholes) and of open runs (parts)."""
    twice = runs.groupBy("digit").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digit")
    left = cut_lineage(runs.join(cut_lineage(twice, "digits"), "digit", "left_semi"), "runs")
    kinds = cut_lineage(left.groupBy("digit", "fp").agg(F.min("doc").alias("first")), "kinds")
    wholes = left.join(kinds, ["digit", "fp"]).filter(F.col("doc") > F.col("first"))
    verdicts = wholes.select("doc", "fp", F.lit(True).alias("whole"))
    if not last:
        several = kinds.groupBy("digit").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("digit")
        parts = kinds.join(cut_lineage(several, "open-digits"), "digit", "left_semi")
        verdicts = verdicts.unionByName(parts.select(F.col("first").alias("doc"), "fp", F.lit(False).alias("whole")))
    return verdicts.groupBy("doc").agg(
        F.collect_set(F.when(F.col("whole"), F.col("fp"))).alias("wholes"),
        F.collect_set(F.when(~F.col("whole"), F.col("fp"))).alias("parts"),
    )


def _bucketed(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table bucketed by document in the shared folder; the catalog forgets its name."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("path", work_path(spark, name)).bucketBy(n, "doc").saveAsTable(table)
    stored = spark.table(table)
    stored.schema  # noqa: B018  resolved before the name goes
    spark.sql(f"DROP TABLE {table}")
    return stored


def remove_repeats(docs: DataFrame, with_kept: bool = False, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if asked for."""
    ids = column(key).cast("long")
    rows = docs.select(F.coalesce(ids, F.lit(_LAST)).alias("doc"), ids.alias("doc_id"), whole_text(text).alias("text"))
    runs = rows.select("doc", "text").mapInArrow(_emit(0), _RUNS)
    lists = _pass(runs, last=False).withColumnsRenamed({"wholes": "wholes_0", "parts": "parts_0"})
    alone = rows.mapInArrow(_alone, _ALONE).join(lists, "doc", "left")
    if not with_kept:
        alone = alone.withColumn("z", F.when(F.col("wholes_0").isNotNull(), F.col("z")))
    found = texts = _bucketed(alone, "texts")
    for k in range(1, len(GRAMS)):
        open_ = texts.filter(F.size(f"parts_{k - 1}") > 0)
        needed = open_.select("doc", "n_bytes", "z", *(f"parts_{j}" for j in range(k)))
        runs = cut_lineage(needed.mapInArrow(_emit(k), _RUNS), "open-runs")
        lists = cut_lineage(_pass(runs, last=k + 1 == len(GRAMS)), "lists")
        named = lists.withColumnsRenamed({"wholes": f"wholes_{k}", "parts": f"parts_{k}"})
        texts = texts.join(named, "doc", "left")
        found = texts
    kept = [F.lit(None).cast("binary").alias("kept")] if with_kept else []
    schema = _ALONE.removeprefix("doc long, ").replace(", z binary", ", kept binary" if with_kept else "")
    return found.select("*", *kept).mapInArrow(_result, schema)
