"""URL rules by a Bloom filter cascade over the corpus's complete key universe.

A rule is a host and a path prefix; it fits its host and all subdomains where the path starts
with the prefix, and the longest rule that fits decides. The keys of a URL are its host and
parent domains, each with the path's first characters at every length some rule has; a rule
fits when its key is among them, so a lookup is a set-membership test per key.

The set is a cascade of Bloom filters: level 1 holds the listed keys, level 2 the unlisted
keys of the corpus that level 1 lets through, level 3 the listed keys that level 2 lets
through, and so on until a level lets none through. A key's answer is the parity of the first
level that rejects it, exact for every key of the corpus and of the list, with no join. The
first level is sized for as many false positives as there are rules, so each level's size
follows the list and the logarithm of the corpus, not the corpus. Levels are short arrays of
64-bit words made by an aggregation on Spark and put into the expression as literals;
``MOST_BITS`` bounds them, and a list beyond it is matched by a shuffled join instead.

A null URL or one without ``://`` has an empty host and path, which no rule fits. Where no
rule fits, the verdict is ``default``. Equal lengths of rules that fit one URL are settled by
the longer host. Repeated rows are judged alike; further columns are left behind; an empty
table gives no rows.
"""

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from advisorbook.llm.common import column

HASHES = 4
MOST_BITS = 1 << 22
MOST_LEVELS = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between the first ``://`` and ``/``, ``?`` or ``#``, and what follows up to ``?`` or ``#``."""
    parts = "(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.regexp_extract(url, parts, 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(F.regexp_extract(url, parts, 2), F.lit(""))


def keys_of(host: Column, path: Column, lengths: Sequence[int]) -> Column:
    """The keys of a URL whose rule would fit it, longest first, then by longer host."""
    labels = F.split(host, "[.]", -1)
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )

    def cut(n: int) -> Column:
        reached = F.filter(hosts, lambda h: F.length(path) >= n)
        return F.transform(
            reached,
            lambda h: F.struct(
                (-F.length(h) - n).alias("order"), (-F.length(h)).alias("host"), F.concat(h, F.substring(path, 1, n)).alias("key")
            ),
        )

    ends = [cut(n) for n in lengths]
    return F.transform(F.array_sort(F.concat(*ends)), lambda k: k["key"])


@dataclass(frozen=True)
class Level:
    """One Bloom filter: 64-bit words, and the seed that its hashes start from."""

    words: tuple[int, ...]
    seed: int

    def passes(self, key: Column) -> Column:
        bits = F.array(*map(F.lit, self.words)) if len(self.words) < 512 else F.lit(list(self.words))
        places = [_place(key, self.seed, k, 64 * len(self.words)) for k in range(HASHES)]
        tests = [(F.shiftrightunsigned(F.get(bits, F.floor(p / 64).cast("int")), 0).bitwiseAND(_bit(p)) != 0) for p in places]
        return reduce(Column.__and__, tests)


def _place(key: Column, seed: int, k: int, n_bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed), F.lit(k)), F.lit(n_bits))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))


def build_level(keys: DataFrame, n_bits: int, seed: int) -> Level:
    """The filter of a ``key`` column; its words, at most ``MOST_BITS`` / 64 of them, come to the driver."""
    places = keys.select(F.explode(F.array(*(_place(F.col("key"), seed, k, n_bits) for k in range(HASHES)))).alias("p"))
    words = places.groupBy(F.floor(F.col("p") / 64).alias("w")).agg(F.bit_or(_bit(F.col("p"))).alias("bits")).collect()
    filled = [0] * (n_bits // 64)
    for row in words:
        filled[row["w"]] = row["bits"]
    return Level(tuple(filled), seed)


def bits_for(n: int, false_share: float) -> int:
    """Bits, whole words, for ``n`` keys at a share of false positives, with ``HASHES`` hashes."""
    share = min(0.9, max(false_share, 1e-9)) ** (1 / HASHES)
    return 64 * max(1, math.ceil(-HASHES * n / math.log(1 - share) / 64))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Exact for every key of the universe it was built over."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for k in range(len(self.levels) - 1, -1, -1):
            answer = F.when(~self.levels[k].passes(key), F.lit(k % 2 == 1)).otherwise(answer)
        return answer


def build_cascade(listed: Sequence[str], universe: DataFrame, most_bits: int = MOST_BITS) -> Cascade | None:
    """The cascade of ``listed`` over the ``key`` column of ``universe``; None where it would pass ``most_bits``."""
    spark = universe.sparkSession
    listed = sorted(set(listed))
    if not listed:
        return Cascade(())
    inside = spark.range(1).select(F.explode(F.lit(listed)).alias("key"))
    outside = universe.filter(~F.col("key").isin(listed)) if len(listed) <= 1000 else universe.join(inside, "key", "left_anti")
    n_outside = outside.count()
    levels: list[Level] = []
    share, keys, others = math.sqrt(0.5) * len(listed) / max(1, n_outside), inside, outside
    n = len(listed)
    while n:
        n_bits = bits_for(n, share)
        if n_bits > most_bits:
            return None
        if len(levels) == MOST_LEVELS:
            raise RuntimeError("the cascade does not end; two keys hash alike")
        level = build_level(keys, n_bits, 2 * len(levels) + 1)
        levels.append(level)
        # What this level lets through of the other side is what the next level holds.
        keys, others = others.filter(level.passes(F.col("key"))), keys
        n, share = keys.count(), 0.5
    return Cascade(tuple(levels))


def universe_of(urls: DataFrame, lengths: Sequence[int], url: str = "url") -> DataFrame:
    """All distinct keys of the URLs."""
    host, path = host_and_path(column(url))
    parts = urls.select(host.alias("h"), path.alias("p"))
    heads = parts.select("h", F.substring("p", 1, max(lengths)).alias("p")).distinct()
    return heads.select(F.explode(keys_of(F.col("h"), F.col("p"), lengths)).alias("key")).distinct()


def judge(pages: DataFrame, rules: Sequence[UrlRule] = RULES, page: str = "page_id", url: str = "url", default: str = "allow", most_bits: int = MOST_BITS) -> DataFrame:
    """A row per page: host, path, the rule that decides (null where none fits) and the verdict."""
    lengths = sorted({len(r.path) for r in rules}) or [0]
    by_verdict = {v: [r.key for r in rules if r.verdict == v] for v in sorted({r.verdict for r in rules})}
    universe = universe_of(pages, lengths, url)
    cascades = {v: build_cascade(keys, universe, most_bits) for v, keys in by_verdict.items()}
    host, path = host_and_path(column(url))
    rows = pages.select(column(page).alias("page_id"), host.alias("host"), path.alias("path"))
    keys = keys_of(F.col("host"), F.col("path"), lengths)
    if any(c is None for c in cascades.values()):
        return _judge_by_join(rows, keys, rules, default)
    member: Callable[[Column], Column] = lambda key: reduce(
        Column.__or__, [c.contains(key) for c in cascades.values()], F.lit(False)
    )
    ruled = rows.withColumn("rule", F.get(F.filter(keys, member), F.lit(0)))
    verdict = F.lit(default)
    for name, cascade in cascades.items():
        verdict = F.when(cascade.contains(F.col("rule")), F.lit(name)).otherwise(verdict)
    return ruled.withColumn("verdict", F.when(F.col("rule").isNull(), F.lit(default)).otherwise(verdict))


def _judge_by_join(rows: DataFrame, keys: Column, rules: Sequence[UrlRule], default: str) -> DataFrame:
    """The same for lists whose filters would be too large for literals: distinct URLs meet the rules in a join."""
    spark = rows.sparkSession
    pairs = F.arrays_zip(F.lit([r.key for r in rules]).alias("key"), F.lit([r.verdict for r in rules]).alias("verdict"))
    listed = spark.range(1).select(F.inline(pairs))
    urls = rows.select("host", "path").distinct()
    fits = urls.select("host", "path", F.posexplode(keys).alias("order", "key")).join(listed, "key")
    best = fits.groupBy("host", "path").agg(F.min(F.struct("order", "key", "verdict")).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
