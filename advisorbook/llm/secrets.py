"""Secret scans over every version of a text, each distinct text scanned once.

A version is a path with a text; its blob is the SHA-256 of the text, so the same content
under many paths or in many versions is one blob. The ledger is a table of (blob, rule, rule
version, spans): a row, also one without spans, says that this blob has been scanned by this
version of the rule. A scan reads only the pairs the ledger lacks, appends them, and joins
the ledger's spans back to all paths. Raising a rule's version rescans for that rule alone.

Spans are found by built-in functions: the text is split at the matches, each piece becomes a
row of two lengths, and a running sum over the blob's pieces gives code-point offsets (ends
exclusive); the work grows in proportion to the text, however many matches it has. Matches are leftmost and
do not overlap within a rule; a match that fails its rule's second condition is dropped and
not tried again.

A null text is the empty blob. Repeated rows are paths of their own with equal results; a
null path is kept as it is; further columns are left behind; an empty table scans nothing.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from advisorbook.llm.common import column, whole_text


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds; of what it finds, ``keep`` (a pattern for the whole match) passes.

    ``needs``: strings of which every text with a match holds one; they spare the pattern.
    """

    name: str
    pattern: str
    keep: str | None = None
    needs: tuple[str, ...] = ()
    version: int = 1
    base: bool = True


# The patterns that decide what a secret is.
_ASSIGN = "(?i:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
RULES = (
    Rule("assign", _ASSIGN + "[A-Za-z0-9+/_.=-]+", _ASSIGN + "[A-Za-z0-9+/_.=-]{12,}+", (":", "=")),
    Rule("access", "AKIA[A-Z0-9]{14,}", needs=("AKIA",)),
    Rule("hex", "[0-9a-f]{16,}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", needs=("PRIVATE KEY-----",), base=False),
)

LEDGER = "blob string, rule string, rule_version int, spans array<struct<start:long,end:long>>"


def blob_of(text: Column) -> Column:
    """The content address of a text."""
    return F.sha2(text.cast("binary"), 256)


def match_pieces(text: Column, rule: Rule) -> Column:
    """The text cut at the rule's matches: lengths of gap and match after it, and whether the match passes."""
    pattern, keep = rule.pattern, rule.keep
    matches = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    gaps = F.split(text, pattern, -1)
    pieces = F.transform(
        F.arrays_zip(gaps.alias("gap"), matches.alias("match")),
        lambda p: F.struct(
            F.length(p["gap"]).cast("long").alias("gap"),
            F.coalesce(F.length(p["match"]), F.lit(0)).cast("long").alias("length"),
            F.coalesce(p["match"].rlike(f"^(?:{keep})$") if keep else p["match"].isNotNull(), F.lit(False)).alias("passed"),
        ),
    )
    zero = F.lit(0).cast("long")
    none = F.array(F.struct(zero.alias("gap"), zero.alias("length"), F.lit(False).alias("passed")))
    possible = reduce(Column.__or__, [text.contains(n) for n in rule.needs]) if rule.needs else F.lit(True)
    return F.when(possible & text.rlike(keep or pattern), pieces).otherwise(none)


def spans_of(pieces: DataFrame) -> DataFrame:
    """Ledger rows from (blob, rule, rule_version, pieces): a running sum of the lengths gives the offsets."""
    rows = pieces.select("blob", "rule", "rule_version", F.posexplode("pieces").alias("k", "piece"))
    so_far = Window.partitionBy("blob", "rule").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("piece.gap") + F.col("piece.length")).over(so_far)
    placed = rows.select(
        "blob", "rule", "rule_version", "piece.passed", F.struct((end - F.col("piece.length")).alias("start"), end.alias("end")).alias("span")
    )
    spans = F.array_sort(F.collect_list(F.when(F.col("passed"), F.col("span"))))
    return placed.groupBy("blob", "rule", "rule_version").agg(spans.alias("spans"))


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(folder)


def scan_unseen(versions: DataFrame, ledger: DataFrame | None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """New ledger rows for the blobs of ``versions`` (blob, text) and the rules' versions."""
    current = F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("rule_version")) for r in rules))
    if ledger is None:
        todo = versions.withColumn("todo", current)
    else:
        done = ledger.groupBy("blob").agg(F.collect_set(F.struct("rule", "rule_version")).alias("done"))
        todo = (
            versions.join(done, "blob", "left")
            .withColumn("todo", F.array_except(current, F.coalesce("done", F.array().cast("array<struct<rule:string,rule_version:int>>"))))
            .filter(F.size("todo") > 0)
        )
    # Copies within a task collapse before they are moved; each blob is scanned once.
    once = todo.groupBy("blob").agg(F.first("text").alias("text"), F.first("todo").alias("todo"))
    found = F.array(
        *(
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.version).alias("rule_version"),
                F.when(
                    F.array_contains(F.col("todo.rule"), r.name), match_pieces(F.col("text"), r)
                ).alias("pieces"),
            )
            for r in rules
        )
    )
    return spans_of(once.select("blob", F.inline(found)).filter(F.col("pieces").isNotNull()))


def scan(versions: DataFrame, folder: str, rules: Sequence[Rule] = RULES, path: str = "path", text: str = "text") -> DataFrame:
    """Scan what the ledger in ``folder`` lacks, append it, and return the spans of every row.

    One row per row of ``versions``: its path column and ``found``, an array of rule name,
    start and end, by start, then in the order of ``rules``.
    """
    spark = versions.sparkSession
    body = whole_text(text)
    blobs = versions.select(blob_of(body).alias("blob"), body.alias("text"))
    known = read_ledger(spark, folder) if _exists(spark, folder) else None
    scan_unseen(blobs, known, rules).write.mode("append").parquet(folder)
    return findings(versions, read_ledger(spark, folder), rules, path, text)


def findings(versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES, path: str = "path", text: str = "text") -> DataFrame:
    """The ledger's spans of the rules' present versions, joined to all paths of their blobs."""
    order = F.lit(0)
    present = F.lit(False)
    for k, r in enumerate(rules):
        order = F.when(F.col("rule") == r.name, k).otherwise(order)
        present = present | ((F.col("rule") == r.name) & (F.col("rule_version") == r.version))
    spans = (
        ledger.filter(present & (F.size("spans") > 0))
        # Two scans at once may have appended the same pair.
        .groupBy("blob", "rule")
        .agg(F.first("spans").alias("spans"))
        .withColumn("k", order)
        .withColumn("found", F.expr("transform(spans, s -> struct(s.start AS start, k AS k, s.end AS end, rule AS rule))"))
        .groupBy("blob")
        .agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))
    )
    paths = versions.select(column(path).alias("path"), blob_of(whole_text(text)).alias("blob"))
    plain = F.expr("transform(found, s -> struct(s.rule AS rule, s.start AS start, s.end AS end))")
    none = F.array().cast("array<struct<rule:string,start:long,end:long>>")
    return paths.join(spans, "blob", "left").select("path", F.coalesce(plain, none).alias("found"))


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def digest(found: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Counts and digests of the base rules' spans, and all spans as text."""
    names = [r.name for r in rules if r.base]

    def of(*wanted: str) -> Column:
        return F.filter("found", lambda s: s["rule"].isin(*wanted))

    base = of(*names)
    counts = [F.size(of(n)).cast("long").alias(f"n_{n}") for n in names]
    return found.select(
        F.col("path").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans")
    )
