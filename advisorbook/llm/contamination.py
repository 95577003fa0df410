"""Benchmark passages in training documents, through a positional inverted index.

Test windows are ten consecutive words of an item (an item of fewer words is one window).
Of each distinct window the rarest word in the corpus is its seed; a window with a word the
corpus lacks cannot occur and is dropped. The index stores the postings of the seeds alone:
word, document, position, and the words around it, which are the postings of all other terms
at their offsets from the seed. A window is found where the list of its seed, shifted by the
seed's place in the window, meets the lists of its other words; that intersection is one join
on the window's words read off at the shifted place.

Proximity matches find reworded items. The marks of a window are its ``MARKS`` rarest words that
the corpus holds, whether or not it holds the others; where two different marks of an item stand
within ``NEAR`` words, the document comes near the item. So an exact copy of an item with two
different words always comes near it. Postings of marks that are no seeds carry no words around.

The corpus is read twice, to count the test words and to store postings; both times its
words meet a table that is broadcast where it fits ``BROADCAST_BYTES`` and is shuffled otherwise,
so nothing but counts, postings and matches is moved. The hits of a document are at most its
words; no group is larger.

Words are of whole texts, lower-cased in A-Z; a null text has none. Documents with equal
doc_id are told apart by a hash of their texts; repeated rows are judged alike; a null doc_id
is a document like others. Repeated items are counted once by their item_id; a null item_id
counts as the string "null". Further columns are left behind. With an empty benchmark no
document is hit; an empty table of documents gives no rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from advisorbook.llm.common import column, text_key, whole_text
from advisorbook.session import cut_lineage

WINDOW = 10
NEAR = 20
MARKS = 2
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64
# What is no word, after lower-casing A-Z.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), _GAP, -1), "")


def test_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """A row per item and distinct window of it: item, words, n."""
    items = benchmark.select(
        F.coalesce(column(item).cast("string"), F.lit("null")).alias("item"), words_of(whole_text(text)).alias("w")
    ).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - WINDOW + 1, F.lit(1)))
    windows = items.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, WINDOW))).alias("words"))
    return windows.distinct().withColumn("n", F.size("words"))


def _bounded(table: DataFrame) -> DataFrame:
    """The table, to be broadcast where its measured text and ``ROW_BYTES`` a row are within the bound."""
    told = F.concat_ws(",", *(F.col(c).cast("string") for c in table.columns))
    size = table.agg(F.sum(F.octet_length(told) + ROW_BYTES)).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def word_counts(docs: DataFrame, vocabulary: DataFrame, text: str = "text") -> DataFrame:
    """How often each word of ``vocabulary`` (column ``word``) stands in the corpus."""
    words = docs.select(F.explode(words_of(whole_text(text))).alias("word"))
    return words.join(_bounded(vocabulary), "word").groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def seeds(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each distinct window that can occur, with its rarest word and that word's first place in it."""
    distinct = windows.select("words", "n").distinct()
    places = distinct.select("words", "n", F.posexplode("words").alias("place", "word")).join(counts, "word", "left")
    best = places.groupBy("words", "n").agg(
        F.min(F.coalesce("count", F.lit(0))).alias("least"), F.min(F.struct("count", "word", "place")).alias("seed")
    )
    return best.filter(F.col("least") > 0).select("words", "n", F.col("seed.word").alias("word"), F.col("seed.place").alias("place"))


def marks(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """A row per item and mark of any of its windows: item, word."""
    words = windows.select("words").distinct().select("words", F.explode(F.array_distinct("words")).alias("word"))
    rarest = words.join(counts, "word").groupBy("words").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("count", "word"))), 1, MARKS).alias("rarest")  # of at most 10 words
    )
    of = rarest.select("words", F.explode("rarest.word").alias("word")).join(windows.select("words", "item"), "words")
    return of.select("item", "word").distinct()


def index_postings(
    docs: DataFrame, seeded: DataFrame, marked: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The postings of seeds and marks: word, document (``doc_id``, ``h``), position, and the words around seeds.

    ``before`` is how many of ``around`` stand before the seed; at most 9 on either side.
    """
    wanted = seeded.select("word", F.lit(True).alias("is_seed")).union(marked.select("word", F.lit(False)))
    wanted = wanted.groupBy("word").agg(F.max("is_seed").alias("is_seed"))
    rows = docs.select(column(key).alias("doc_id"), text_key(text).alias("h"), words_of(whole_text(text)).alias("w"))
    found = rows.select("doc_id", "h", "w", F.posexplode("w").alias("position", "word")).join(_bounded(wanted), "word")
    first = F.greatest(F.col("position") - (WINDOW - 1), F.lit(0))
    return found.select(
        "word", "doc_id", "h", "position",
        (F.col("position") - first).alias("before"),
        F.when(F.col("is_seed"), F.slice("w", first + 1, F.col("position") - first + WINDOW)).alias("around"),
    )


def phrase_matches(postings: DataFrame, seeded: DataFrame) -> DataFrame:
    """Where windows occur: doc_id, h, start, n, words."""
    shifts = seeded.groupBy("word").agg(F.collect_set(F.struct("place", "n")).alias("shifts"))  # at most 100 a word
    shifted = postings.filter(F.col("around").isNotNull()).join(_bounded(shifts), "word").select(
        "doc_id", "h", "position", "before", "around", F.explode("shifts").alias("shift")
    )
    place, n, before = F.col("shift.place"), F.col("shift.n"), F.col("before")
    fits = (before >= place) & (before - place + n <= F.size("around"))
    candidates = shifted.filter(fits).select(
        "doc_id", "h", (F.col("position") - place).alias("start"), n.alias("n"),
        F.slice("around", before - place + 1, n).alias("words"),
    )
    distinct = seeded.select("words")
    return candidates.join(_bounded(distinct), "words").distinct()


def near_items(postings: DataFrame, marked: DataFrame, near: int = NEAR) -> DataFrame:
    """Per document, the items of which two different marks stand within ``near`` words."""
    # Each item's marks meet in the document's own order of positions.
    by_item = postings.select("doc_id", "h", "position", "word").join(_bounded(marked), "word")
    order = Window.partitionBy("doc_id", "h", "item").orderBy("position")
    last = by_item.select(
        "doc_id", "h", "item", "position", "word", F.lag("position").over(order).alias("p"), F.lag("word").over(order).alias("v")
    )
    hit = last.filter((F.col("position") - F.col("p") <= near) & (F.col("word") != F.col("v")))
    return hit.select("doc_id", "h", "item").distinct()


def covered_words(matches: DataFrame) -> DataFrame:
    """Per document, how many words lie in any match."""
    spans = matches.groupBy("doc_id", "h", "start").agg(F.max(F.col("start") + F.col("n")).alias("end"))
    order = Window.partitionBy("doc_id", "h").orderBy("start")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = spans.select(
        "doc_id", "h", F.greatest(F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0))), F.lit(0)).alias("new")
    )
    return new.groupBy("doc_id", "h").agg(F.sum("new").cast("long").alias("n_hit"))


def matched_items(matches: DataFrame, windows: DataFrame) -> DataFrame:
    """Per document, the items with windows that occur, as sorted strings."""
    pairs = matches.select("doc_id", "h", "words").distinct().join(windows.select("item", "words"), "words")
    return pairs.groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("item")).alias("items"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per hit document: doc_id, h, n_hit, items, near_items (how many items come near)."""
    windows = cut_lineage(test_windows(benchmark), "test-windows")
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    counts = cut_lineage(word_counts(docs, vocabulary, text), "test-word-counts")
    seeded = cut_lineage(seeds(windows, counts), "test-seeds")
    marked = cut_lineage(marks(windows, counts), "test-marks")
    postings = cut_lineage(index_postings(docs, seeded, marked, key, text), "postings")
    matches = cut_lineage(phrase_matches(postings, seeded), "matches")
    near = near_items(postings, marked).groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("near_items"))
    hits = covered_words(matches)
    items = matched_items(matches, windows)
    return _same_document(_same_document(hits, items), near, "full").select(
        "doc_id", "h", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), "items",
        F.coalesce("near_items", F.lit(0).cast("long")).alias("near_items"),
    )


def _same_document(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on doc_id, null like a value, and h."""
    r = right.withColumnsRenamed({"doc_id": "r_id", "h": "r_h"})
    joined = left.join(r, left["doc_id"].eqNullSafe(r["r_id"]) & (left["h"] == r["r_h"]), how)
    if how == "full":
        joined = joined.withColumn("doc_id", F.when(F.col("h").isNull(), F.col("r_id")).otherwise(F.col("doc_id")))
        joined = joined.withColumn("h", F.coalesce("h", "r_h"))
    return joined.drop("r_id", "r_h")


def judge(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row per document with its words, hit words and items."""
    found = find_contamination(docs, benchmark)
    rows = docs.select(
        column("doc_id").alias("doc_id"), text_key().alias("h"), F.size(words_of(whole_text())).cast("long").alias("n_words")
    )
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return _same_document(rows, found, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.coalesce("near_items", F.lit(0).cast("long")).alias("n_near_items"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents no benchmark window occurs in, with all their columns."""
    hit = find_contamination(docs, benchmark).filter(F.col("n_hit") > 0).select("doc_id", "h")
    rows = docs.select(F.struct("*").alias("row"), column("doc_id").alias("doc_id"), text_key().alias("h"))
    same = rows["doc_id"].eqNullSafe(hit["doc_id"]) & (rows["h"] == hit["h"])
    return rows.join(hit, same, "left_anti").select("row.*")
