"""Ranked search, repeated lines and the prefix trie against plain Python, on small tables with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from compare import connect, difference, type_difference

from tallyworks.llm import catalogue, lexical, lines, tries

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_line_dedup", "op13_prefix_trie"])
def test_equal_to_sql(spark, name):
    frame, sql = catalogue.queries()[name](spark, SMALL), catalogue.oracle_sql()[name]
    connection = connect(SMALL)
    assert type_difference(frame, connection, sql) is None
    assert difference(frame, connection, sql) is None


# --- ranked search ------------------------------------------------------------------------------

def ranked(docs, items, k=10):
    pattern = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counted = [(doc, Counter(pattern.findall((text or "").translate(fold)))) for doc, text in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for (doc, counts), n in zip(counted, sizes):
            m = 25 + 75 * n * n_docs // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in pattern.findall((text or "").translate(fold)) if counts[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if none else doc, -s) for i, (s, none, doc) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def odd_texts(seed, count):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "été", "ß", "x1"] + [f"w{i}" for i in range(60)]
    weights = [40, 10, 30, 5, 5, 5] + [60 / (i + 1) for i in range(60)]
    texts = [rng.choice([" ", "\n", "-", ", "]).join(rng.choices(vocabulary, weights, k=rng.randint(1, 40))) for _ in range(count)]
    return texts + [None, "", "  \n", "...", texts[0], texts[0], "w1 " * 30_000, "� W1", "É é"]


@pytest.mark.parametrize("shard,item_bytes", [(1 << 20, 1 << 20), (200, 1500)])
def test_best_documents(spark, shard, item_bytes):
    texts = odd_texts(1, 150)
    docs = [(i * 3 % 200, t, "x", 5, 7) for i, t in enumerate(texts)] + [(None, texts[3], "y", 1, 1), (3, texts[3], "y", 1, 1)]
    items = [(i, t, 9) for i, t in enumerate(odd_texts(2, 12)[:20])] + [(None, "w1 w2", 9), (4, "w7 w7 the", 9)]
    found = lexical.search(
        spark.createDataFrame(docs, "doc_id long, text string, rank string, score long, _item long").repartition(3),
        spark.createDataFrame(items, "item_id long, text string, _text long"), item_bytes=item_bytes, shard=shard,
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted([tuple(r) for r in found.collect()], key=repr) == ranked([d[:2] for d in docs], [i[:2] for i in items])


def test_reading_stops_before_the_lists_end():
    import numpy as np

    n = 5_000
    rng = np.random.default_rng(0)
    term, impact = np.tile([0, 1], n), rng.zipf(1.3, 2 * n) % 1_000_000
    shard = lexical.Shard(np.full(n, 2), term, impact, 2)
    docs, scores = shard.best(np.array([0, 1]), np.array([1, 1]), np.array([1, 1]), 3, 0)
    sums = impact.reshape(-1, 2).sum(axis=1)
    assert sorted(scores, reverse=True)[:3] == sorted(sums, reverse=True)[:3] and len(docs) < 100


def test_search_in_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(none, some).count() == 0
    assert lexical.search(some.withColumnRenamed("item_id", "doc_id"), some.limit(0)).count() == 0


# --- repeated lines -----------------------------------------------------------------------------

def cleaned(docs, least_docs, least_chars=1, keep_first=False):
    def key(line):
        return "".join(c.lower() if c.isascii() else c for c in line.strip(" \t\n\x0b\x0c\r"))

    holders, first = defaultdict(set), {}
    for row, (doc, text) in enumerate(docs):
        for i, line in enumerate((text or "").split("\n")):
            holders[key(line)].add(row)
            place = (doc is None, doc or 0, row, i)
            first[key(line)] = min(first.get(key(line), place), place)
    out = []
    for row, (doc, text) in enumerate(docs):
        all_lines = (text or "").split("\n")
        kept = [
            line for i, line in enumerate(all_lines)
            if len(key(line)) < least_chars or len(holders[key(line)]) < least_docs
            or keep_first and first[key(line)][2:] == (row, i)
        ]
        out.append((doc, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [None, 1 << 20])
@pytest.mark.parametrize("keep_first,least_chars", [(False, 1), (True, 1), (False, 4)])
def test_lines_of_many_documents(spark, bits, keep_first, least_chars):
    rng = random.Random(5)
    pool = ["Menu", " menu\t", "MENU", "©2020", "é", "É", "", "   ", "x", "long line " * 3000]
    docs = [
        (i, "\n".join(rng.choice(pool) if rng.random() < 0.4 else f"own {i} {j}" for j in range(rng.randint(1, 12))), 1, "k")
        for i in range(80)
    ]
    docs += [(None, "menu\nx", 1, "k"), (None, None, 1, "k"), (5, "", 1, "k"), (5, "Menu\nMenu", 1, "k"), (90, "\n\n", 1, "k")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, _row long, key string").coalesce(1)
    found = lines.drop_repeated_lines(frame, 10, least_chars, keep_first, bits=bits)
    assert sorted([tuple(r) for r in found.collect()], key=repr) == cleaned([d[:2] for d in docs], 10, least_chars, keep_first)


def test_no_lines(spark):
    assert lines.drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_second_filter_holds_what_two_tasks_see_once(spark):
    rows = spark.createDataFrame([("a\nb",), ("c\nb",), ("d",), ("d",)], "text string").repartition(4)
    filled = lines.seen_twice(rows, 1 << 20, 1)

    def holds(key):
        import numpy as np

        at = lines._positions(np.frombuffer(lines._digest(key)[:8], dtype=np.uint64), 1 << 20)
        return bool(((filled[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all())

    assert holds(b"b") and holds(b"d") and not holds(b"a") and not holds(b"c")


# --- prefix trie --------------------------------------------------------------------------------

def trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            ref = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, ref, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    nodes, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            nodes[whole[:d]].append(c)
    out, children, leaves, saved = [], Counter(p[:-1] for p in nodes if p), Counter(), Counter()
    for path, members in nodes.items():
        worth = (len(members) - 1) * len(re.findall("[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += worth
    for path, members in nodes.items():
        out.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
            children[path], leaves[path], saved[path],
            hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def conversations(seed):
    rng = random.Random(seed)
    texts = ["hello there", "a  b\tc", "", "yes", "long " * 500]
    rows = [
        (c, t, rng.choice(["user", "assistant"]) if rng.random() < 0.2 else "user", rng.choice(texts))
        for c in range(70) if c not in (20, 33) for t in range(rng.choice([1, 1, 2, 3, 4, 6]))
    ]
    rows += [(100, t, "user", f"turn {t % 3}") for t in range(90)] + [(101, t, "user", f"turn {t % 3}") for t in range(0, 60, 2)]
    rows += [(None, 0, "user", "lost"), (140, None, None, None), (140, 2, "x", "b"), (140, 2, "x", "b"), (140, 2, "x", "a"), (-3, 1, "u", "n")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block,depths,part", [(16, 4096, 4096), (4, 3, 5)])
def test_trie_of_rebuilt_conversations(spark, monkeypatch, block, depths, part):
    monkeypatch.setattr(tries, "TURNS_A_BLOCK", block)
    monkeypatch.setattr(tries, "DEPTHS_A_BLOCK", depths)
    monkeypatch.setattr(tries, "IDS_A_PART", part)
    rows = [r + (1, "k") for r in conversations(3)]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, depth int, conv string").repartition(5)
    found = sorted([tuple(r) for r in tries.prefix_trie(frame).collect()], key=repr)
    assert found == trie([r[:4] for r in rows])


def test_trie_of_nothing(spark):
    assert tries.prefix_trie(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0


def test_colliding_fingerprints_are_noticed(spark, monkeypatch):
    """With bases of the first seed that cannot tell the order of turns, the nodes are found all the same."""
    honest = tries._bases
    monkeypatch.setattr(tries, "_bases", lambda seed: [1] * tries.LANES if seed == 0 else honest(seed))
    rows = [(c, t, "user", str((c % 3 + t) % 3)) for c in range(12) for t in range(4)]
    found = tries.prefix_trie(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert sorted([tuple(r) for r in found.collect()], key=repr) == trie(rows)
