"""The text operators against brute-force versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyworks.llm import ngrams, pii, repeats, suffixes

# extra columns with clashing names: none of them may be read or get in the way
SCHEMA = "doc_id long, text string, id long, start int, n int, key string, component string, base string"
EMPTY = "doc_id long, text string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, 1, 2, "k", "c", "b") for i, t in rows], SCHEMA).repartition(3)


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def passages(seed, alphabet, count, longest):
    """Texts that share passages of one base, with edits, copies and edge cases."""
    rng = random.Random(seed)
    base = [rng.choice(alphabet) for _ in range(8 * longest)]
    rows = []
    for i in range(count):
        at = rng.randrange(len(base))
        text = base[at:at + rng.randint(0, longest)] + [rng.choice(alphabet) for _ in range(rng.randint(0, longest // 2))]
        rows.append((i, " ".join(text)))
    rows += [(count, rows[1][1]), (count + 1, rows[1][1]), (count + 2, None), (count + 3, ""), (count + 4, " \n\t ")]
    return rows + [(count + 5, "a " * 3 * longest), (count + 6, "a b " * 2 * longest), (count + 7, "a " * 60 + "c")]


# --- personal data ------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text):
    out = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), number, m.end()))
    return sorted(out)


def test_base_spans_match_the_plain_patterns(spark):
    rng = random.Random(2)
    parts = [
        "a", "1", "@", ".", "-", " ", "+1", "(783)", "555-5762", "4777431686562174", "1.2.3.4", "é", "😀", "%", "256.1.1.1",
        "a@b.c", "@d.e", "%w@q.r", "+", "\n", "00012.3.4.5", "5555 5555 5555 4444", "x at y", "[at]",
    ]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))) for i in range(600)]
    rows += [(1000, None), (1001, ""), (1002, "1" * 2000), (1003, "a@" + "b." * 900 + "c"), (1004, "1.2.3.4 " * 700)]
    rows += [(1005, "+1" + " " * 900), (1006, "1-" * 900), (1007, "a" * 2000)]
    found = {r["doc_id"]: r for r in pii.detect(frame(spark, rows)).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        assert [tuple(s) for s in found[i]["base"]] == base_spans(text), text
        assert set(found[i]["base"]) <= set(found[i]["spans"])


def test_wider_spans_are_added_and_redacted(spark):
    good = [(i, f"mail bob{i}@x.example.com or +1 (783) 555-{i:04d} or 81.92.62.{i} end") for i in range(60)]
    rows = good + [(100, "call me (783) 555-5762 or bob [at] example [dot] com"), (101, None), (102, "nothing here")]
    found = {r["doc_id"]: r for r in pii.detect(frame(spark, rows)).collect()}
    assert [tuple(s) for s in found[100]["spans"]] == [(8, 3, 22), (26, 0, 52)]
    assert found[102]["spans"] == []
    clean = pii.redact(frame(spark, rows))
    assert clean.columns == frame(spark, rows).columns
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts[100] == "call me [phone] or [email]"
    assert texts[3] == "mail [email] or [phone] or [ip] end"
    assert texts[101] is None and texts[102] == "nothing here"


# --- repeats --------------------------------------------------------------------------------------

def without_repeated_words(rows, window):
    seen, out = set(), {}
    for i, text in sorted(rows):
        own = words(text)
        gone = [False] * len(own)
        for p in range(len(own) - window + 1):
            key = tuple(own[p:p + window])
            if key in seen:
                gone[p:p + window] = [True] * window
            seen.add(key)
        out[i] = (len(own), sum(gone), " ".join(w for w, g in zip(own, gone) if not g))
    return out


@pytest.mark.parametrize("seed, window", [(1, 20), (2, 6), (3, 4)])
def test_repeated_words(spark, seed, window):
    rows = passages(seed, list("abcdefgé"), 60, 90)
    found = {r[0]: tuple(r)[1:] for r in repeats.remove_repeats(frame(spark, rows), window).collect()}
    assert found == without_repeated_words(rows, window)
    assert sum(v[1] for v in found.values()) > 0


def test_equal_windows_take_equal_symbols():
    """A window's key does not depend on what stands around it."""
    rng = np.random.default_rng(3)
    window = rng.integers(0, 4, 20)
    keys = set()
    for _ in range(200):
        around = [rng.integers(0, 4, rng.integers(0, 9)) for _ in range(2)]
        text = np.concatenate([around[0], window, around[1]]).astype(np.uint64)
        n = len(text)
        key, _, start, size = repeats.pieces_of(text, np.zeros(n, int), np.full(n, n), 20, 2)
        at = np.searchsorted(start, len(around[0]), "right") - 1
        assert start[at] <= len(around[0]) < start[at] + size[at]
        keys.add(int(key[at]))
    assert len(keys) == 1


def without_repeated_bytes(rows, length):
    texts = {i: (t or "").encode() for i, t in rows}
    count = Counter(t[p:p + length] for t in texts.values() for p in range(len(t) - length + 1))
    out = {}
    for i, t in texts.items():
        gone = np.zeros(len(t), dtype=bool)
        for p in range(len(t) - length + 1):
            if count[t[p:p + length]] > 1:
                gone[p:p + length] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out[i] = (len(t), int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone]))
    return out


@pytest.mark.parametrize("seed, length, anchor", [(1, 60, 16), (2, 20, 8), (4, 200, 32)])
def test_repeated_bytes(spark, seed, length, anchor):
    rows = passages(seed, list("abcdé"), 50, 250)
    got = suffixes.remove_repeats(frame(spark, rows), length, anchor)
    found = {r[0]: (r[1], r[2], r[3], bytes(r[4])) for r in got.collect()}
    assert found == without_repeated_bytes(rows, length)
    assert sum(v[1] for v in found.values()) > 0


def test_a_common_line_is_dealt_out(spark, monkeypatch):
    """No group of one anchor exceeds a transform, and windows that repeat beside a common line are found."""
    rng = random.Random(6)
    line, dashes = "".join(rng.choice("abcdefgh") for _ in range(190)), "-" * 120
    around = lambda: "".join(rng.choice("klmnop") for _ in range(90))
    rows = [(i, around() + (line if i % 2 else dashes) + around()) for i in range(3000)]
    rows += [(3000 + i, "x" + rows[7 * i][1][20 + i % 60:380 - i % 50]) for i in range(60)]
    sizes, in_groups = [], suffixes.in_groups

    def spy(frame, keys, order):
        largest = frame.groupBy(*keys).agg(F.sum(F.length("piece")).alias("s")).agg(F.max("s")).first()[0]
        sizes.append(largest or 0)
        return in_groups(frame, keys, order)

    monkeypatch.setattr(suffixes, "in_groups", spy)
    got = suffixes.remove_repeats(frame(spark, rows)).collect()
    assert {r[0]: (r[1], r[2], r[3], bytes(r[4])) for r in got} == without_repeated_bytes(rows, 200)
    assert sizes and max(sizes) <= suffixes.AT_ONCE


def test_interval_expansion_finds_long_common_prefixes():
    rng = np.random.default_rng(1)
    parts = [np.append(rng.integers(0, 3, 40), 256 + i) for i in range(30)]
    text = np.concatenate(parts)
    seen = Counter(tuple(text[p:p + 5]) for p in range(len(text)))
    found = suffixes.repeated_places(text, 5)
    assert found.tolist() == [seen[tuple(text[p:p + 5])] > 1 for p in range(len(text))]


# --- n-gram join ------------------------------------------------------------------------------------

def similar(rows, width, percent):
    sets = {}
    for i, text in rows:
        own = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = {tuple(own[p:p + width]) for p in range(len(own) - width + 1)}
        sets[i] = grams or ({tuple(own)} if own else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("width, percent, frequent, paired, block", [(3, 90, 8, 240, 4096), (5, 80, 4, 50, 16)])
def test_similar_groups(spark, monkeypatch, width, percent, frequent, paired, block):
    monkeypatch.setattr(ngrams, "FREQUENT", frequent)
    monkeypatch.setattr(ngrams, "PAIRED", paired)
    monkeypatch.setattr(ngrams, "BLOCK", block)
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcDEf") for _ in range(4)) for _ in range(300)]
    rows = []
    for size in (1, 2, 3, 5, 30, 60, 100, 300):
        base = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(rng.choice([3, 20, 60])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, size // 25))):
                own[rng.randrange(size)] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(own)))
    rows += [(9000, None), (9001, ""), (9002, " \n"), (9003, "A b"), (9004, "a B"), (9005, "a b c"), (9006, "a b c a b c")]
    found = {r[0]: tuple(r)[1:] for r in ngrams.similar_groups(frame(spark, rows), width, percent).collect()}
    assert found == similar(rows, width, percent)


# --- empty tables -------------------------------------------------------------------------------------

@pytest.mark.parametrize("operator", [
    pii.detect, pii.redact, repeats.remove_repeats, suffixes.remove_repeats, ngrams.similar_groups,
])
def test_empty_tables(spark, operator):
    assert operator(spark.createDataFrame([], EMPTY)).count() == 0


@pytest.mark.parametrize("operator", [repeats.remove_repeats, suffixes.remove_repeats, ngrams.similar_groups])
def test_tables_of_nulls(spark, operator):
    rows = operator(spark.createDataFrame([(1, None), (2, None)], EMPTY)).collect()
    assert sorted(r[0] for r in rows) == [1, 2]
    assert all(r[1] == 0 for r in rows)


def test_a_very_long_text(spark):
    rng = random.Random(1)
    text = " ".join(rng.choice("abcdefghij") * rng.randint(1, 9) for _ in range(120_000))
    docs = spark.createDataFrame([(1, text), (2, text[5000:9000]), (3, "x" * 300_000)], EMPTY)
    found = {r["doc_id"]: r for r in suffixes.remove_repeats(docs).drop("kept").collect()}
    assert found[2]["n_removed"] == found[2]["n_bytes"] and found[3]["n_removed"] == 300_000
    kept = {r["doc_id"]: r for r in repeats.remove_repeats(docs).select("doc_id", "n_words", "n_removed").collect()}
    assert kept[1]["n_words"] == 120_000
    assert {r[0]: r[2] for r in ngrams.similar_groups(docs).collect()} == {1: 1, 2: 2, 3: 3}
    assert pii.detect(docs).where(F.size("spans") > 0).count() == 0


def test_repeats_with_null_and_repeated_ids(spark):
    """Null ids come last, rows of one id by text; of equal rows one keeps its words."""
    shared, other = (" ".join(f"{c}{i}" for i in range(25)) for c in "xy")
    rows = [(None, shared), (7, "b " + shared), (7, "a " + shared), (None, None), (9, other), (9, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = repeats.remove_repeats(docs).select("doc_id", "n_words", "n_removed").collect()
    expected = [(None, 25, 25), (7, 26, 25), (7, 26, 0), (None, 0, 0), (9, 25, 0), (9, 25, 25)]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_byte_repeats_with_null_and_repeated_ids(spark):
    shared = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(300))
    rows = [(None, shared), (7, "-" + shared), (7, "short"), (None, None), (9, "+" + shared[:150])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffixes.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans").collect()
    expected = [(None, 300, 300, 1), (7, 301, 300, 1), (7, 5, 0, 0), (None, 0, 0, 0), (9, 151, 0, 0)]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_short_pieces_make_one_state_each():
    """A piece that leaves the known states is read to its end without more of them, to the same ids."""
    import random

    from tallyworks.llm import bpe

    ranks = bpe.read_ranks(bpe.default_vocabulary()[0])
    own, draw = bpe.Transducer(ranks), random.Random(5)
    for length in (*range(1, 60), 200):
        for letters in (b"abcdeinorst", bytes(range(256))):
            piece = b" " + bytes(draw.choices(letters, k=length))
            before = len(own.states)
            by_definition = b"".join(own.code[part] for part in own.merge(piece))
            assert own.encode(piece) == by_definition
            assert length >= bpe.SHORT or len(own.states) <= before + 1
            assert own.encode(piece) == by_definition
