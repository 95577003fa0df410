"""Ranked search, the turn trie and SimHash against brute force, on odd rows and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from advisorbook.llm import jaccard, ranked_search, simhash, turn_trie
from advisorbook.session import cut_lineage
from advisorbook.sources.tables import setting

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "one two three"), (4, "one two three"), (4, "other words here now"), (4, "one two three"), (None, None)]


def documents(spark, rows):
    """Documents with further columns whose names the operators use themselves."""
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return frame.withColumns({c: F.lit("x") for c in ("item", "term", "score", "salt", "rank", "leaf", "n", "root", "free", "a b")})


def sorted_tuples(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def some_text(rng, words, n):
    return "".join(rng.choice(words) + rng.choice([" ", "  ", ", ", "-", "\n", " ", "é "]) for _ in range(n))


def ranked_by_force(rows, items, best=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(d, Counter(pattern.findall((t or "").translate(LOWER)))) for d, t in rows]
    holding = [c for _, c in docs if c]
    n_docs, n_terms = len(holding), sum(sum(c.values()) for c in holding)
    df = Counter(t for c in holding for t in c)
    asked = defaultdict(Counter)
    for i, t in items:
        asked[i].update(pattern.findall((t or "").translate(LOWER)))
    out = []
    for item, terms in asked.items():
        scores = []
        for d, c in docs:
            if c:
                m = 25 + 75 * sum(c.values()) * n_docs // n_terms
                score = sum(
                    k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t, k in terms.items() if c[t]
                )
                if score > 0:
                    scores.append((-score, d is None, d or 0))
        out += [(item, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scores)[:best])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [1 << 20, 300])
def test_ranked_search_by_force(spark, most):
    rng = random.Random(2)
    words = ["Alpha", "beta", "GAMMA", "delta9", "x", "été", "Été", "naïve", "日本", "zz_top", "a1b2", "\x7fdel", "İstanbul", *[f"w{k}" for k in range(40)]]
    rows = [*ODD, *[(10 + k // 2, some_text(rng, words, rng.randint(0, 60))) for k in range(80)], (900, "x" * 5000), (901, "beta")]
    items = [(1, "Alpha beta BETA"), (2, None), (3, "..."), (4, "nowhere"), (5, "one Two x x x"), (None, "gamma 日本"), (6, "w1"), (6, "w2 w1"),
             *[(20 + k, some_text(rng, words, 12)) for k in range(8)]]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    got = ranked_search.search(documents(spark, rows), asked, automaton_bytes=most)
    assert sorted_tuples(got) == ranked_by_force(rows, items)


def test_ranked_search_of_long_texts(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(500)]
    rows = [(1, some_text(rng, words, 500_000)), (2, "w1 w2"), (3, "q" * 3_000_000 + " w1"), (4, "\n" * 2_500_000 + "w2")]
    items = [(1, "w1 w2 w3"), (2, "q")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert sorted_tuples(ranked_search.search(documents(spark, rows), asked)) == ranked_by_force(rows, items)


def test_ranked_search_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search.search(documents(spark, []), items).count() == 0
    assert ranked_search.search(documents(spark, ODD), items.limit(0)).count() == 0
    assert ranked_search.search(documents(spark, [(1, " "), (2, None)]), items).count() == 0


def trie_by_force(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            own[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    members = defaultdict(set)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, c in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(c) - 1) * len(p[-1][1]) if p else 0
    return sorted(
        [(min(c), len(p), min(members[p[:-1]]) if p else None, len(c), kids[p], leaves[p], saved[p],
          hashlib.sha256(",".join(map(str, sorted(x for x in c if len(built[x]) == len(p)))).encode()).hexdigest())
         for p, c in members.items()], key=repr,
    )


def chats(rng, n, ids):
    rows = []
    for conv in rng.sample(range(ids), n):
        for turn in range(rng.choice([1, 1, 2, 3, 4, 8])):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["hi", "hi", "é", "long text " * 9, f"t{rng.random()}"])))
    return rows


@pytest.mark.parametrize(("part_bytes", "seed"), [(1 << 20, 1), (64, 2), (64, 3), (300, 4)])
def test_trie_by_force(spark, part_bytes, seed):
    rng = random.Random(seed)
    rows = chats(rng, 150, 400)
    rows += [(1000, None, None, None), (1000, None, "user", "late"), (1000, 0, "user", None), (1001, 5, "user", "x"), (1001, 5, "user", "x"),
             (None, 0, "user", "gone"), (2003, 0, "user", "no base"), (-5, 0, "user", "hi"), (-100, 0, "user", "hi"), (1000, 0, "user", "\x00")]
    rows += [(3000 + k, t, "user", f"same {t}") for k in range(60) for t in range(7)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    frame = frame.withColumns({c: F.lit("x") for c in ("key", "part", "sizes", "h", "base", "depth")})
    assert sorted_tuples(turn_trie.conversation_trie(frame, part_bytes)) == trie_by_force(rows)


def test_trie_of_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert turn_trie.conversation_trie(spark.createDataFrame([], schema)).count() == 0
    assert turn_trie.conversation_trie(spark.createDataFrame([(None, 0, "user", "x")], schema)).count() == 0
    # Without the conversation that opens their hundred, short ones may have no turn left.
    rows = [(c, 0, "user", "x") for c in (101, 102, 205, 307, 409)]
    rows += [(7, t, "user", str(t)) for t in range(60)]
    assert sorted_tuples(turn_trie.conversation_trie(spark.createDataFrame(rows, schema))) == trie_by_force(rows)
    long = spark.range(20_000).selectExpr("cast(id % 2 as long) conv_id", "id turn", "'user' role", "if(id < 19000, 'x', cast(id as string)) text")
    nodes = turn_trie.conversation_trie(long, part_bytes=1000)
    assert nodes.groupBy().agg({"depth": "max", "n_convs": "sum", "n_leaves": "max"}).first()[0] == 10_000
    assert [tuple(r) for r in nodes.filter("depth in (0, 9500)").select("n_convs", "n_children", "n_leaves", "saved_tokens").collect()] == [
        (2, 1, 2, 9500), (2, 2, 2, 1)]


def test_trie_hashes_ids_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "BLOCK_BYTES", 20)
    rows = [(c, 0, "user", "same") for c in range(5000)]
    schema = "conv_id long, turn long, role string, text string"
    assert sorted_tuples(turn_trie.conversation_trie(spark.createDataFrame(rows, schema))) == trie_by_force(rows)


def test_radix_nodes_grow_and_keep_order():
    rng = random.Random(1)
    keys = sorted({bytes(rng.choice([0, 1, rng.randrange(256)]) for _ in range(16 * rng.randint(1, 3))) for _ in range(3000)})
    keys += [k + bytes(16) for k in keys[::7] if k + bytes(16) not in keys]
    tree = turn_trie.RadixTree()
    shuffled = list(range(len(keys)))
    rng.shuffle(shuffled)
    for k in shuffled:
        tree.insert(keys[k], k)
    assert [keys[k] for _, k in tree.walk() if k is not None] == sorted(keys)
    assert sum(k is None for _, k in tree.walk()) == len({k[:d] for k in keys for d in range(0, len(k) + 1, 16)})
    kinds, todo = set(), [tree.root]
    while todo:
        branch = todo.pop()
        if branch.layout:
            kinds.add(type(branch.layout).__name__)
            todo += [kid for _, kid in branch.layout.items()]
    assert kinds == {"Node4", "Node16", "Node48", "Node256"}


def fingerprint_by_force(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    made = [" ".join(w[k : k + n]) for k in range(len(w) - n + 1)] if len(w) >= n else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in made]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def simhash_by_force(rows):
    prints = [fingerprint_by_force(t) for _, t in rows]
    leaves = sorted(set(prints))
    root = {x: x for x in leaves}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, x in enumerate(leaves):
        for y in leaves[:k]:
            if (x ^ y).bit_count() <= 3:
                root[find(x)] = find(y)
    least = defaultdict(lambda: None)
    for (d, _), p in zip(rows, prints, strict=True):
        if d is not None:
            least[find(p)] = d if least[find(p)] is None else min(d, least[find(p)])
    return sorted([(d, f"{p:016x}", least[find(p)]) for (d, _), p in zip(rows, prints, strict=True)], key=repr)


@pytest.mark.parametrize("trie_leaves", [simhash.TRIE_LEAVES, 25])
def test_simhash_by_force(spark, trie_leaves):
    rng = random.Random(4)
    words = [f"Wort{k}" for k in range(200)] + [" ", "\x1c", "é"]
    rows = [*ODD, (50, "A b"), (51, "a  B"), (52, "a\tb\x0bc"), (None, "only null ids here " * 3)]
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(30, 400))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            base = copy if rng.random() < 0.3 else base
            rows.append((len(rows) + 60, " ".join(copy)))
    assert sorted_tuples(simhash.near_components(documents(spark, rows), trie_leaves=trie_leaves)) == simhash_by_force(rows)


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_components(documents(spark, [])).count() == 0


def test_fingerprint_of_texts_longer_than_a_piece(monkeypatch):
    monkeypatch.setattr(simhash, "_PIECE", 50)
    rng = random.Random(6)
    for text in ["a" * 200, " " * 200, "a " * 200, "  b" + " " * 120 + "c" + "\n" * 70, "".join(rng.choice("ab c\n") for _ in range(2000))]:
        assert simhash.fingerprint(text.encode()) == fingerprint_by_force(text)


def families(rng, n, size, flips):
    out = set()
    for _ in range(n):
        base = rng.getrandbits(64)
        for _ in range(size):
            out.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))))
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("pairs", [1 << 20, 64])
def test_tries_keep_every_link(monkeypatch, pairs):
    monkeypatch.setattr(simhash, "_PAIRS", pairs)
    rng = random.Random(7)
    leaf = families(rng, 40, 30, 6)
    trie = (np.arange(len(leaf)) >= len(leaf) // 2).astype(np.int64)
    a, b = simhash.near_leaves(trie, leaf)
    label = np.arange(len(leaf))
    for x, y in zip(a, b, strict=True):
        label[label == label[x]] = label[y]
    near = np.bitwise_count(leaf[:, None] ^ leaf[None, :]) <= 3
    near &= trie[:, None] == trie[None, :]
    x, y = np.nonzero(near)
    assert (label[x] == label[y]).all()
    reach = np.arange(len(leaf))
    while True:
        low = np.array([reach[near[k]].min() for k in range(len(leaf))])
        if (low == reach).all():
            break
        reach = low
    assert len(set(label)) == len(set(reach))


def test_components_end_at_stars_in_few_tasks(spark, monkeypatch):
    """A chain and a star: each step writes few files however many shuffle partitions, and no round follows the last change."""
    written = []

    def kept(df, name):
        found = cut_lineage(df, name)
        written.append((name, len(found.inputFiles())))
        return found

    monkeypatch.setattr(jaccard, "cut_lineage", kept)
    star = [(1000, k) for k in range(1001, 1400)]
    with setting(spark, "spark.sql.shuffle.partitions", "64"), setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        found = jaccard.components(spark.createDataFrame(star, "a long, b long"))
        assert sorted_tuples(found) == sorted(((b, a) for a, b in star), key=repr)
    assert [n for n, _ in written] == ["edges", "least"]
    chain = [(k, k + 1) for k in range(400)]
    with setting(spark, "spark.sql.shuffle.partitions", "64"), setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        found = jaccard.components(spark.createDataFrame(chain + star, "a long, b long"))
        assert sorted_tuples(found) == sorted([(k, 0) for k in range(1, 401)] + [(b, a) for a, b in star], key=repr)
    assert max(files for name, files in written[3:]) <= 32
