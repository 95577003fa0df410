"""Ranked lexical search: one Aho-Corasick scan of the texts counts the terms of all items.

All terms of the items are one automaton, each between two guards; in a text every character
that is part of no term becomes a guard, so only whole terms match. The automaton's outputs
are term numbers, and a table maps a term to its items. A first scan counts documents, terms
and the documents that hold each term; a second one scores each document as it passes and
keeps, for each item, the best of its task. No index of the documents is written.

An automaton goes to all tasks, so its size is bounded: items are dealt by hash into as many
parts as it takes to stay below ``automaton_bytes`` each (one item alone may be larger: its own
text is the bound), and each part has scans of its own. Any number of items gives whole results.
The best of the tasks are ranked in two steps, so an item is never gathered from all tasks at once.

Null text has no terms, an item without terms finds nothing. Rows that share an item_id are one
item with the terms of all its rows. Each row of the documents is a document of its own; rows
that share a doc_id are ranked one after the other. Null doc_ids come last among equal scores.
Empty tables give no rows. Long texts are scanned in pieces that end at a guard. Further
columns are left behind.
"""

import math
import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from advisorbook.llm.common import column, utf8_texts, whole_text, worker_cache
from advisorbook.llm.encoding import batches_of_text
from advisorbook.session import cut_lineage

BEST = 10
AUTOMATON_BYTES = 8 << 20
_ENTRY_BYTES = 24
_SLICE, _PIECE = 4 << 20, 1 << 20
_CELLS = _POOL = 1 << 20
_SALTS = 64
# The characters of terms, and the guard that stands for all others.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GUARD = 32
_GUARDED = np.full(256, _GUARD, np.uint8)
_GUARDED[48:58] = np.arange(48, 58)
_GUARDED[65:91] = np.arange(97, 123)
_GUARDED[97:123] = np.arange(97, 123)
_GUARDED[128:] = np.arange(128, 256)


def asked_terms(rows: list) -> dict:
    """The terms of some items in order, and of each term the places of its items and how often they ask."""
    terms = sorted({r["term"] for r in rows})
    items = list(dict.fromkeys(r["item_id"] for r in rows))
    number, place = {t: k for k, t in enumerate(terms)}, {i: k for k, i in enumerate(items)}
    term = np.array([number[r["term"]] for r in rows], np.int64)
    order = np.argsort(term, kind="stable")
    return {
        "token": uuid.uuid4().hex,
        "terms": terms,
        "items": items,
        "item": np.array([place[r["item_id"]] for r in rows], np.int64)[order],
        "times": np.array([r["times"] for r in rows], np.int64)[order],
        "at": np.searchsorted(term[order], np.arange(len(terms) + 1)),
    }


def guarded_automaton(terms: list[str]):
    """All terms, each between two guards; its output is the term's number."""
    import ahocorasick

    made = ahocorasick.Automaton()
    for k, term in enumerate(terms):
        made.add_word(f" {term.encode().decode('latin-1')} ", k)
    made.make_automaton()
    return made


def _automaton(asked: dict):
    """The worker's own automaton of these terms; only the last one is kept."""
    known = worker_cache("automata")
    if asked["token"] not in known:
        known.clear()
        known[asked["token"]] = guarded_automaton(asked["terms"])
    return known[asked["token"]]


def _pieces(text: str) -> Iterator[tuple[int, str]]:
    """Stretches of a guarded text that begin and end with a guard, and where they start."""
    start = 0
    while start < len(text) - 1:
        stop = text.find(" ", min(start + _PIECE, len(text) - 1))
        yield start, text[start : stop + 1]
        start = stop


def term_counts(bodies: list[bytes], automaton, n_terms: int) -> tuple[np.ndarray, ...]:
    """The number of terms of each text; and text, term and frequency of each asked term in it."""
    marked = _GUARDED[np.frombuffer(b" " + b" ".join(bodies) + b" ", np.uint8)]
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    ends = np.cumsum(sizes + 1)
    inside = marked != _GUARD
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    n = np.diff(np.r_[0, np.searchsorted(starts, ends)])
    counted = []
    for start, piece in _pieces(marked.tobytes().decode("latin-1")):
        found = np.fromiter(chain.from_iterable(automaton.iter(piece)), np.int64).reshape(-1, 2)
        # A match ends on the guard behind its term; that of a text's last term stands at its end.
        text = np.searchsorted(ends, found[:, 0] + start)
        counted.append(np.unique(text * n_terms + found[:, 1], return_counts=True))
    keys = np.concatenate([k for k, _ in counted]) if counted else np.zeros(0, np.int64)
    keys, back = np.unique(keys, return_inverse=True)
    times = np.zeros(len(keys), np.int64)
    np.add.at(times, back, np.concatenate([t for _, t in counted]) if counted else np.zeros(0, np.int64))
    return n, keys // n_terms, keys % n_terms, times


def _statistics(shared: Broadcast) -> Callable:
    """Of a task: documents with a term (-1), all terms (-2), and documents with each asked term."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, n_terms = _automaton(shared.value), len(shared.value["terms"])
        holding, documents, terms = np.zeros(n_terms, np.int64), 0, 0
        for batch in batches_of_text(batches, at=1, chars=_SLICE):
            n, _, term, _ = term_counts(utf8_texts(batch), automaton, n_terms)
            holding += np.bincount(term, minlength=n_terms)
            documents, terms = documents + int((n > 0).sum()), terms + int(n.sum())
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[-1, -2, some]), pa.array(np.r_[documents, terms, holding[some]])], ["term", "times"]
        )

    return run


class _Best:
    """The best documents of each item so far."""

    def __init__(self, items: int, best: int) -> None:
        self.best, self.least = best, np.ones(items, np.int64)
        self.kept = [np.zeros(0, np.int64)] * 4  # item, score, whether the id is null, id
        self.waiting, self.size = [], 0

    def offer(self, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.least)
        if len(row):
            self.waiting.append((item, scores[row, item], null[row], doc[row]))
            self.size += len(row)
            if self.size > _POOL or len(self.kept[0]) == 0:
                self.settle()

    def settle(self) -> list[np.ndarray]:
        item, score, null, doc = (np.concatenate(x) for x in zip(self.kept, *self.waiting, strict=True))
        order = np.lexsort((doc, null, -score, item))
        first = np.searchsorted(item[order], item[order])
        order = order[np.arange(len(order)) - first < self.best]
        self.kept, self.waiting, self.size = [x[order] for x in (item, score, null, doc)], [], 0
        items, at, times = np.unique(self.kept[0], return_index=True, return_counts=True)
        full = times == self.best
        self.least[items[full]] = self.kept[1][at[full] + self.best - 1]
        return self.kept


def _scores(asked: dict, text: np.ndarray, term: np.ndarray, worth: np.ndarray, texts: int) -> np.ndarray:
    """Scores of texts for all items, from what each term of a text is worth there."""
    at, items = asked["at"], len(asked["items"])
    wanted = at[term + 1] - at[term]
    entry = np.arange(wanted.sum()) + np.repeat(at[term] - (np.cumsum(wanted) - wanted), wanted)
    cells = np.zeros(texts * items, np.int64)
    np.add.at(cells, np.repeat(text * items, wanted) + asked["item"][entry], np.repeat(worth, wanted) * asked["times"][entry])
    return cells.reshape(texts, items)


def _rank(shared: Broadcast, weights: np.ndarray, documents: int, terms: int, best: int) -> Callable:
    """The best documents of a task for each item."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        automaton, items, at = _automaton(asked), len(asked["items"]), asked["at"]
        pool = _Best(items, best)
        for batch in batches_of_text(batches, at=1, chars=_SLICE):
            n, text, term, times = term_counts(utf8_texts(batch), automaton, len(asked["terms"]))
            m = np.array([25 + 75 * k * documents // terms for k in n.tolist()], np.int64)
            worth = weights[term] * (1_000_000_000 * times // (1000 * times + 8 * m[text]))
            ids = batch.column(0)
            null, doc = (np.asarray(x) for x in (ids.is_null(), ids.fill_null(0)))
            # Some texts at a time, so that neither scores nor what they are summed from grow.
            cost = items + np.bincount(text, at[term + 1] - at[term], minlength=len(n)).astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(cost) // _CELLS)) + 1).tolist(), len(n)]
            for first, last in zip(cuts[:-1], cuts[1:], strict=True):
                here = slice(*np.searchsorted(text, [first, last]))
                scores = _scores(asked, text[here] - first, term[here], worth[here], last - first)
                pool.offer(scores, doc[first:last], null[first:last])
        item, score, null, doc = pool.settle()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int64)), pa.array(doc.astype(np.int64), mask=null.astype(bool)), pa.array(score)],
            ["item", "doc_id", "score"],
        )

    return run


def _top(rows: DataFrame, by: list[str], best: int) -> DataFrame:
    ranked = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= best)


def _parts(items: DataFrame, most: int) -> int:
    """The number of parts to deal the items into, so that none is larger than ``most`` bytes."""
    sizes = items.groupBy("item_id").agg(F.sum(F.octet_length("term") + _ENTRY_BYTES).alias("bytes"))
    sizes = cut_lineage(sizes, "item-sizes")
    parts = max(1, math.ceil((sizes.agg(F.sum("bytes")).first()[0] or 0) / most))
    while True:
        dealt = sizes.groupBy(F.pmod(F.xxhash64("item_id"), F.lit(parts)).alias("part")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("items")
        )
        if dealt.filter((F.col("bytes") > most) & (F.col("items") > 1)).isEmpty():
            return parts
        parts *= 2


def search(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    automaton_bytes: int = AUTOMATON_BYTES,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id and score of the ``best`` documents of each item."""
    spark = docs.sparkSession
    texts = docs.select(column(key).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    found = F.regexp_extract_all(F.translate(whole_text(item_text), UPPER, LOWER), F.lit(TERM), F.lit(0))
    asked = items.select(column(item_key).alias("item_id"), F.explode(found).alias("term"))
    asked = cut_lineage(asked.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times")), "asked-terms")
    ranked = []
    parts = _parts(asked, automaton_bytes)
    for part in range(parts):
        # At most automaton_bytes, or one item.
        rows = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).collect()
        if not rows:
            continue
        terms = asked_terms(rows)
        shared = spark.sparkContext.broadcast(terms)
        seen = texts.mapInArrow(_statistics(shared), "term long, times long").groupBy("term").agg(F.sum("times").alias("times"))
        times = {r["term"]: r["times"] for r in seen.collect()}  # a row per asked term
        documents, total = times.get(-1, 0), times.get(-2, 0)
        if not documents:
            break
        weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * times.get(k, 0) + 1))) for k in range(len(terms["terms"]))]
        scan = _rank(shared, np.array(weights, np.int64), documents, total, best)
        kept = texts.mapInArrow(scan, "item long, doc_id long, score long")
        kept = _top(kept.withColumn("salt", F.spark_partition_id() % _SALTS), ["item", "salt"], best)
        names = spark.createDataFrame(list(enumerate(terms["items"])), f"item long, item_id {asked.schema['item_id'].dataType.simpleString()}")
        kept = _top(kept.drop("rank"), ["item"], best)
        ranked.append(kept.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not ranked:
        kind = asked.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    result = ranked[0]
    for more in ranked[1:]:
        result = result.unionByName(more)
    return result
