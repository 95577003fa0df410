"""Quality rules as a short-circuit cascade.

Each rule's cost and selectivity are estimated on a sample of documents; the rules are then
tried in order of rejections per second, and a document meets no further rule once one has
rejected it. Features are computed when a rule first asks for them, so a cheap rule that
rejects saves the dear ones. The order decides the cost only: a document is kept when no
rule rejects it, in whatever order they come.

Null and empty texts have no words and are rejected by ``few_words``. Rows are judged one by
one, so repeated rows, ties and further columns change nothing; an empty table gives no rows.
"""

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from advisorbook.llm.common import column, utf8_texts, whole_text

# The characters that count as symbols, and the white space between words.
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\x0b\x0c\r"
WINDOW = 5
SAMPLE_ROWS = 2000


class _Numbers(dict):
    """Numbers words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Document:
    """The features of one UTF-8 text, each computed at first use."""

    def __init__(self, text: bytes) -> None:
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        units = np.frombuffer(self.text, np.uint8)
        followers = int(((units & 0xC0) == 0x80).sum())
        return len(units) - followers - sum(self.text.count(c) for c in WHITE)

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.text.count(c) for c in SYMBOLS)

    @cached_property
    def lines(self) -> list[bytes]:
        """The lines that hold a word."""
        return [line for line in self.text.split(b"\n") if line.strip(WHITE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside windows of five that the text holds at least twice."""
        n = self.n_words
        if n <= WINDOW:
            return 0
        numbers = _Numbers()
        ids = np.fromiter(map(numbers.__getitem__, self.words), np.int64, n)
        if len(numbers) == n:
            return 0
        width, windows = len(numbers), ids
        for reach in range(1, WINDOW):
            windows = windows[:-1] * len(numbers) + ids[reach:]
            width *= len(numbers)
            if width > 2**62 // len(numbers) and reach < WINDOW - 1:
                found, windows = np.unique(windows, return_inverse=True)
                width = len(found)
        _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
        repeated = times[which] > 1
        covered = np.zeros(n, bool)
        for reach in range(WINDOW):
            covered[reach : reach + len(repeated)] |= repeated
        return int(covered.sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Document], bool]


FEW_WORDS = Rule("few_words", lambda d: d.n_words < 10)
REPEATED_WORDS = Rule("repeated_words", lambda d: 100 * d.n_repeat_words > 20 * d.n_words)
BASE_RULES = (FEW_WORDS, REPEATED_WORDS)
RULES = (
    *BASE_RULES,
    Rule("many_symbols", lambda d: 10 * d.n_symbols > 3 * d.n_words),
    Rule("repeated_lines", lambda d: 10 * d.n_dup_lines > 3 * len(d.lines)),
    Rule("short_words", lambda d: d.word_chars < 2 * d.n_words),
    Rule("long_words", lambda d: d.word_chars > 12 * d.n_words),
)


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS, text: str = "text") -> DataFrame:
    """Seconds, rejections and documents of each rule over about ``rows`` sampled documents."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, rejected, seen = [0.0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for body in utf8_texts(batch):
                seen += 1
                for k, rule in enumerate(rules):
                    began = time.perf_counter()
                    rejected[k] += rule.rejects(Document(body))
                    spent[k] += time.perf_counter() - began
        names = pa.array([r.name for r in rules])
        yield pa.RecordBatch.from_arrays(
            [names, pa.array(spent), pa.array(rejected), pa.array([seen] * len(rules))],
            ["rule", "seconds", "rejected", "documents"],
        )

    texts = docs.select(whole_text(text).alias("text"))
    share = min(1.0, rows / max(1, docs.select(F.count(F.lit(1))).first()[0]))
    sampled = texts.sample(share, seed=1) if share < 1 else texts
    each = sampled.mapInArrow(measure, "rule string, seconds double, rejected long, documents long")
    return each.groupBy("rule").agg(*(F.sum(c).alias(c) for c in ("seconds", "rejected", "documents")))


def cascade_order(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS, text: str = "text") -> list[Rule]:
    """The rules by rejections per second, most first; one row per rule comes to the driver."""
    found = {r["rule"]: r["rejected"] / max(r["seconds"], 1e-9) for r in estimate(docs, rules, rows, text).collect()}
    return sorted(rules, key=lambda rule: (-found.get(rule.name, 0.0), rule.name))


def rejected_by(document: Document, order: Sequence[Rule]) -> str | None:
    """The first rule of the cascade that rejects the document."""
    return next((rule.name for rule in order if rule.rejects(document)), None)


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows whose text no rule rejects, with all their columns."""
    order = cascade_order(docs, rules, text=text)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passed = [rejected_by(Document(body), order) is None for body in utf8_texts(batch, text)]
            yield batch.filter(pa.array(passed, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """A row per document: its base counts, whether a base rule fails it, and the verdict."""
    order = cascade_order(docs, rules)

    def row(body: bytes) -> dict:
        d = Document(body)
        first = rejected_by(d, order)
        failed = any(rule.rejects(d) for rule in BASE_RULES)
        return {
            "n_words": d.n_words, "word_chars": d.word_chars, "n_symbols": d.n_symbols,
            "n_dup_lines": d.n_dup_lines, "n_repeat_words": d.n_repeat_words,
            "base_failed": failed, "kept": first is None,
        }

    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kinds = [(c, pa.int64()) for c in counts] + [("base_failed", pa.bool_()), ("kept", pa.bool_())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(body) for body in utf8_texts(batch)]
            made = [pa.array([r[c] for r in rows], kind) for c, kind in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["doc_id", *(c for c, _ in kinds)])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in counts) + ", base_failed boolean, kept boolean"
    return docs.select(column("doc_id"), column("text")).mapInArrow(run, schema)
