"""Order-preserving packing of documents into training sequences by dynamic programming.

The ids of the documents follow one another in the order the rows are read in, and cuts are
chosen so that padding plus penalties for cutting inside a document is least. A sequence
holds at most ``length`` ids and is padded to ``length`` unless its size is a power of two.
Cuts at document ends are free, cuts at sentence or line ends cost ``SENTENCE_PENALTY`` ids;
only where neither comes for ``STRETCH`` ids, a cut elsewhere is offered at
``STRETCH_PENALTY``. With cost c and position p, the best last cut i before j has the least
c(i) + p(i) among those at most ``length`` behind, which a monotone queue gives in constant
time; the few cuts at a power of two behind are tried one by one.

Documents never leave the task that reads them, so nothing is shuffled; a task works through
blocks of ``BLOCK`` ids that end at document ends, and each block ends a sequence (at most
one padded sequence in two thousand). A document longer than a block makes a block of its own.

A null text is empty and has the end id alone. Documents with equal ids are told apart by
their pieces' sequence and offset only. Further columns are left behind; an empty table
gives no pieces.
"""

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from advisorbook.llm.common import column, whole_text
from advisorbook.llm.encoding import Encoder, batches_of_text

SENTENCE_PENALTY = 4
STRETCH, STRETCH_PENALTY = 256, 64
SHORTEST_POWER = 128
BLOCK = 1 << 21
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def best_cuts(places: list[int], penalties: list[int], length: int) -> list[int]:
    """The places to cut, the last one included, at least padding plus penalties.

    ``places`` ascend from above 0, neighbours at most ``length`` apart; the last must be cut.
    """
    powers, power = [], SHORTEST_POWER
    while power < length:
        powers.append(power)
        power *= 2
    places = [0, *places]
    penalties = [0, *penalties]
    where = {place: k for k, place in enumerate(places)}
    cost, last = [0] * len(places), [0] * len(places)
    queue, keys, head = [0], [0], 0
    for j in range(1, len(places)):
        place = places[j]
        while places[queue[head]] < place - length:
            head += 1
        least, choice = keys[head] + length - place, queue[head]
        for power in powers:
            i = where.get(place - power)
            if i is not None and cost[i] < least:
                least, choice = cost[i], i
        cost[j], last[j] = (c := least + penalties[j]), choice
        key = c + place
        while len(queue) > head and keys[-1] >= key:
            queue.pop()
            keys.pop()
        queue.append(j)
        keys.append(key)
    cuts, j = [], len(places) - 1
    while j > 0:
        cuts.append(places[j])
        j = last[j]
    return cuts[::-1]


class _Block:
    """Documents that are packed together."""

    def __init__(self) -> None:
        self.ids, self.docs, self.size, self.places, self.penalties = [], [], 0, [], []

    def add(self, doc: int | None, ids: np.ndarray, ends: np.ndarray) -> None:
        n = len(ids)
        ends = np.unique(ends[(ends > 0) & (ends < n)])
        marks = np.r_[0, ends, n]
        wide = np.flatnonzero(np.diff(marks) > STRETCH)
        extra = [np.arange(marks[k] + STRETCH, marks[k + 1], STRETCH) for k in wide]
        places = np.concatenate([ends, *extra, [n]])
        penalties = np.full(len(places), SENTENCE_PENALTY)
        penalties[len(ends) : -1] = STRETCH_PENALTY
        penalties[-1] = 0
        order = np.argsort(places)
        self.places += (places[order] + self.size).tolist()
        self.penalties += penalties[order].tolist()
        self.docs.append((doc, self.size, n))
        self.ids.append(ids)
        self.size += n

    def pieces(self, length: int, first_sequence: int) -> tuple[list[tuple], int]:
        """Rows, and how many sequences they make."""
        cuts = best_cuts(self.places, self.penalties, length)
        rows, k, began = [], 0, 0
        for (doc, at, n), ids in zip(self.docs, self.ids, strict=True):
            body, done = memoryview(ids).cast("B"), 0
            while done < n:
                if cuts[k] <= at + done:
                    began = cuts[k]
                    k += 1
                end = min(n, cuts[k] - at)
                crc = zlib.crc32(body[4 * done : 4 * end])
                rows.append((doc, done, end - done, crc, n, first_sequence + k, at + done - began))
                done = end
        return rows, len(cuts)


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, length: int = 1024, byte_level: bool = True) -> DataFrame:
    """A row per piece of a document: where it starts there, and its sequence and place in it."""
    if length < STRETCH or length & (length - 1):
        raise ValueError(f"length must be a power of two of at least {STRETCH}")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, block = Encoder.of(vocabulary, byte_level), _Block()
        sequence = TaskContext.get().partitionId() << 40

        def emit() -> pa.RecordBatch:
            nonlocal block, sequence
            rows, made = block.pieces(length, sequence)
            sequence += made
            block = _Block()
            names = [part.split()[0] for part in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

        for batch in batches_of_text(batches):
            found = encoder.documents(batch.column(1), end_id)
            for doc, (ids, ends) in zip(batch.column(0).to_pylist(), found, strict=True):
                block.add(doc, ids, ends)
                if block.size >= BLOCK:
                    yield emit()
        if block.docs:
            yield emit()

    rows = docs.select(column("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, SCHEMA)
