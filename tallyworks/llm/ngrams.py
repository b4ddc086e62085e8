"""Documents whose sets of word n-grams are alike, joined on combinations of tokens from extended prefixes.

All tokens (hashed n-grams) have one order. Two sets with the wanted overlap
share at least two of the tokens in their prefixes, if a prefix is one token
longer than a plain prefix filter needs. A token that few prefixes hold is an entry of
its own; of the tokens that many prefixes hold, every pair in a prefix is an
entry. A pair of similar sets therefore meets at a rare token or at two
frequent ones. Very long sets would have too many pairs; above a size their
frequent tokens are entries of their own, and sizes near it have both kinds.

Within an entry, sizes and parity bitmaps bound the difference of two sets from
below and leave few candidates. Sets of very different size cannot be similar,
so an entry is kept apart by classes of size. Only components are wanted, so the sets of an
entry are gathered around leaders first; after verification, only
sets of different components are compared any more, and a pair is named in the first
entry that both sets are known to share.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.shared import (
    components, discard, documents, mix, sliding_sums, small_batches, word_bounds, word_hashes, written,
)
from tallyworks.llm.vectors import in_groups, runs
from tallyworks.operators.filters import bloom_filter, may_hold

COMBINE = 2            # tokens that prefixes share, and that an entry for frequent tokens combines
FREQUENT = 64          # prefixes that hold a token for it to count as frequent
PAIRED = 240           # sets up to this size pair their frequent tokens
BLOCK = 4_096          # sets of an entry that one task compares with one another
AT_ONCE = 1 << 18
RECENT = 1 << 16       # pairs that a task remembers having named
FEW = 8                # entries of a set that go with it, so that other entries leave its pairs to them
FILTER_BITS, LEAST_BITS, MOST_BITS = 8, 1 << 14, 1 << 24    # an id, and of a filter; the largest is 2 MB

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _sets(texts: list[str], width: int) -> list[np.ndarray]:
    """The sorted hashes of the distinct n-grams of each text."""
    encoded = [t.encode("utf-8") for t in texts]
    data = _FOLD[np.frombuffer(b" ".join(encoded), dtype=np.uint8)]
    starts, ends = word_bounds(data)
    hashes = word_hashes(data, starts, ends)
    edges = np.searchsorted(starts, np.concatenate(([0], np.cumsum([len(t) + 1 for t in encoded]))))
    grams = sliding_sums(hashes, width, 5)
    out = []
    for a, b in zip(edges.tolist(), edges[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(grams[a:b - width + 1]))
        elif b > a:
            out.append(mix(sliding_sums(hashes[a:b], b - a, 5) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _groups(batch):
    texts = [t or "" for t in batch.column(1).to_pylist()]
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > AT_ONCE:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, texts[begin:]


def _bits(n: int, percent: int) -> int:
    """Three to six bits for each token by which two similar sets of ``n`` tokens may differ, within bounds."""
    most = 2 * n * (100 - percent) // (100 + percent)
    return 1 << min(max((3 * most).bit_length(), 8), 16)


def _parity(tokens: np.ndarray, percent: int) -> bytes:
    """For each bit, whether an odd number of tokens falls on it. Sets differ by at least as much as their bitmaps."""
    bits = _bits(len(tokens), percent)
    counts = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _describe(width: int, percent: int):
    def describe(batches):
        for batch in batches:
            for begin, texts in _groups(batch):
                sets = _sets(texts, width)
                prefixes = [mix(s) for s in sets]
                cut = []
                for tokens in prefixes:
                    n = len(tokens)
                    overlap = -(-percent * n // 100)
                    length = min(n, n - overlap + COMBINE)
                    cut.append(np.sort(np.partition(tokens, length - 1)[:length] if length else tokens).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, len(texts)), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                     pa.array(cut, pa.list_(pa.int64())),
                     pa.array([_parity(s, percent) for s in sets], pa.binary())],
                    names=["doc_id", "n", "whole", "prefix", "parity"],
                )

    return describe


def _hashes(width: int):
    def hashes(batches):
        for batch in batches:
            for begin, texts in _groups(batch):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, len(texts)),
                     pa.array([s.tobytes() for s in _sets(texts, width)], pa.binary())],
                    names=["id", "tokens"],
                )

    return hashes


def _folded(rows: list[bytes], bits: int) -> np.ndarray:
    """Bitmaps at a common number of bits, as rows of 64-bit numbers."""
    out = np.empty((len(rows), bits // 64), dtype=np.uint64)
    for i, row in enumerate(rows):
        own = np.frombuffer(row, dtype=np.uint64).reshape(-1, bits // 64)
        out[i] = np.bitwise_xor.reduce(own, axis=0)
    return out


class _Entry:
    """The sets of one entry, in order of size."""

    def __init__(self, ids, sizes, parities, percent):
        order = np.lexsort((ids, sizes))
        self.order = order
        self.ids, self.sizes, self.percent = ids[order], sizes[order], percent
        parities = [parities[i] for i in order.tolist()]
        self.own = np.array([len(p) * 8 for p in parities])
        self.maps = {}
        for bits in np.unique(self.own).tolist():
            # sets of similar size have this many bits or twice as many
            rows = np.flatnonzero((self.own == bits) | (self.own == 2 * bits))
            self.maps[bits] = (rows, _folded([parities[i] for i in rows.tolist()], bits))

    def near(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The sets at or after ``i`` that may be similar to it, and the least that each differs from it."""
        n = self.sizes[i]
        end = int(np.searchsorted(self.sizes, n * 100 // self.percent, "right"))
        rows, maps = self.maps[int(self.own[i])]
        lo, hi = np.searchsorted(rows, i), np.searchsorted(rows, end)
        rows, own = rows[lo:hi], maps[lo:hi]
        differ = np.bitwise_count(own ^ own[0]).sum(axis=1).astype(np.int64)
        differ = np.maximum(differ, self.sizes[rows] - n)
        # |A and B| <= (|A| + |B| - differ) / 2, |A or B| >= (|A| + |B| + differ) / 2
        both = self.sizes[rows] + n
        fits = 100 * (both - differ) >= self.percent * (both + differ)
        fits[0] = False
        return rows[fits], differ[fits]


def _new(pairs: set[tuple[int, int]], seen: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """The pairs that this task has not named lately; many entries hold the same sets."""
    found = pairs - seen
    if len(seen) > RECENT:
        seen.clear()
    seen |= found
    return sorted(found)


def _gather(percent: int):
    """Around leaders: each set goes to the first leader it may be similar to; a leader is also tied to earlier groups.

    Gives pairs ``(a, b)``, and ``open`` entries, in which other pairs may be similar too.
    """
    def gather(batches):
        seen: set[tuple[int, int]] = set()
        for table in runs(batches, ["entry", "part"]):
            count = table.num_rows
            is_open = table["blocks"][0].as_py() > 1
            named: set[tuple[int, int]] = set()
            if count > 1:
                entry = _Entry(table["doc_id"].to_numpy(), table["n"].to_numpy(), table["parity"].to_pylist(), percent)
                ids = entry.ids.tolist()
                group = np.full(count, -1)
                for i in range(count):
                    if group[i] >= 0:
                        continue
                    group[i] = i
                    rows, differ = entry.near(i)
                    if not len(rows):
                        continue
                    free = group[rows] < 0
                    group[rows[free]] = i
                    tied = {}
                    for j, d in zip(rows[~free].tolist(), differ[~free].tolist()):
                        if group[j] not in tied or d < tied[group[j]][0]:
                            tied[group[j]] = (d, j)
                    others = rows[free].tolist() + [j for _, j in tied.values()]
                    is_open |= free.sum() > 1 or len(others) < len(rows)
                    named |= {(min(ids[i], ids[j]), max(ids[i], ids[j])) for j in others}
                # a set that follows a leader is not held against those after it
                is_open |= count > 2 and bool((group != np.arange(count)).any())
            fresh, is_open = _new(named, seen), int(is_open)
            if fresh or is_open:
                rows = fresh + [(None, None)] * is_open
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([None] * len(fresh) + [table["entry"][0].as_py()] * is_open, pa.int64())],
                    names=["a", "b", "open"],
                )

    return gather


def _across(percent: int):
    """All pairs of different components that may be similar, in an entry of one block or in a block and a chunk of others.

    A pair that also meets in an earlier one of the ``few`` first entries of both sets is left to that entry.
    """
    def across(batches):
        seen: set[tuple[int, int]] = set()
        for table in runs(batches, ["entry", "left", "right"]):
            if table.num_rows < 2:
                continue
            ids, part = table["doc_id"].to_numpy(), table["component"].to_numpy()
            if (part == part[0]).all():
                continue
            first = table["is_left"].to_numpy(zero_copy_only=False).astype(bool)
            same = table["blocks"][0].as_py() == 1
            few = np.full((len(ids), FEW), np.iinfo(np.int64).max)
            for i, row in enumerate(table["few"].to_pylist()):
                few[i, :len(row)] = row
            entry = _Entry(ids, table["n"].to_numpy(), table["parity"].to_pylist(), percent)
            part, first, few, ids = part[entry.order], first[entry.order], few[entry.order], entry.ids.tolist()
            earlier = few < table["entry"][0].as_py()
            named: set[tuple[int, int]] = set()
            for i in range(len(ids)):
                rows, _ = entry.near(i)
                rows = rows[(part[rows] != part[i]) & (same | (first[rows] != first[i]))]
                if len(rows):
                    rows = rows[~(np.isin(few[rows], few[i]) & earlier[rows]).any(axis=1)]
                named |= {(min(ids[i], ids[j]), max(ids[i], ids[j])) for j in rows.tolist()}
            if fresh := _new(named, seen):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in fresh], pa.int64()), pa.array([r[1] for r in fresh], pa.int64())],
                    names=["a", "b"],
                )

    return across


def _verify(percent: int):
    def verify(batches):
        for batch in batches:
            good = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(left, dtype=np.uint64), np.frombuffer(right, dtype=np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(good, pa.bool_())), batch.column(1).filter(pa.array(good, pa.bool_()))],
                names=["a", "b"],
            )

    return verify


def _linked(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose whole sets are similar, as a written table."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("_id")).distinct()
    # texts are wide and few of them are in a pair; the filter's size decides how many others are shuffled for the join
    bits = min(max(1 << (2 * FILTER_BITS * pairs.count()).bit_length(), LEAST_BITS), MOST_BITS)
    likely = docs.where(may_hold(bloom_filter(needed, "_id", bits), F.col("doc_id"), bits))
    with small_batches(docs.sparkSession):
        tokens = written(
            likely.join(needed, F.col("doc_id") == F.col("_id")).select("doc_id", "text")
            .mapInArrow(_hashes(width), "id long, tokens binary"), "ngram-sets",
        )
        joined = (
            pairs.join(tokens.select(F.col("id").alias("a"), F.col("tokens").alias("x")), "a")
            .join(tokens.select(F.col("id").alias("b"), F.col("tokens").alias("y")), "b")
            .select("a", "b", "x", "y")
        )
        links = written(joined.mapInArrow(_verify(percent), "a long, b long"), "ngram-links")
    discard(tokens)
    return links


def _by_size(entries: DataFrame, percent: int) -> DataFrame:
    """Entries by classes of size: each set is in its own class and in the next, so that sets of similar size share one."""
    # a class is a little wider than the sizes of similar sets lie apart, so rounding cannot part them
    width = 1.001 * max(math.log(100 / percent), 0.01)
    own = F.floor(F.log("n") / width)
    return entries.withColumn("class", F.explode(F.array(own, own + 1))).select(
        "doc_id", "n", F.xxhash64("entry", "class").alias("entry")
    )


def _dealt(apart: DataFrame, block: Column) -> DataFrame:
    """Entries of several blocks: each block meets, chunk by chunk, the sets that are not of the entry's main component.

    The main component is known to be one, so its sets need not meet each other and are not repeated for each block.
    """
    chunks = F.when(F.col("blocks") > 1, F.ceil(F.col("apart") / BLOCK)).otherwise(1).cast("int")
    chunk = F.pmod(F.xxhash64("entry", "doc_id"), "chunks").cast("int")
    place = lambda left, right, is_left: F.struct(left.alias("left"), right.alias("right"), F.lit(is_left).alias("is_left"))
    stays = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda x: place(F.col("mine"), x, True))
    visits = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: place(x, F.col("chunk"), False))
    return (
        apart.withColumn("mine", block).withColumn("chunks", chunks).withColumn("chunk", chunk)
        .withColumn("places", F.when((F.col("blocks") > 1) & (F.col("component") != F.col("main")), F.concat(stays, visits)).otherwise(stays))
        .select("entry", "doc_id", "n", "blocks", "component", F.inline("places"))
    )


def similar_groups(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row.

    A document's set holds its distinct ``width``-word shingles, words being runs of
    bytes other than space and \\x09-\\x0D with A-Z in lower case; a text of fewer words is one
    shingle. Two documents are linked when 100 x intersection >= ``percent`` x union;
    ``component_id`` is the smallest id reachable by links. Texts without words
    and null texts have empty sets and stay alone. Equal sets are one class and are never compared.
    Ids must be distinct and not null; other columns are not read. An empty table gives
    an empty result.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with small_batches(docs.sparkSession):
        sets = written(own.mapInArrow(
            _describe(width, percent), "doc_id long, n long, whole binary, prefix array<long>, parity binary"
        ), "ngram-prefixes")
    classes = sets.where("n > 0").groupBy("whole").agg(F.min("doc_id").alias("first"))
    ones = sets.join(classes.select(F.col("first").alias("doc_id")), "doc_id", "left_semi")
    held = ones.select("doc_id", "n", F.explode("prefix").alias("token"))
    often = held.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = written(held.join(often, "token"), "ngram-tokens")
    frequent = shared.where(F.col("c") > FREQUENT)
    alone = shared.where((F.col("c") <= FREQUENT) | (100 * F.col("n") >= percent * PAIRED)).select(
        "doc_id", "n", F.col("token").alias("entry")
    )
    several = frequent.where(F.col("n") <= PAIRED).groupBy("doc_id", "n").agg(
        F.array_sort(F.collect_list("token")).alias("t")
    )
    paired = several.select("doc_id", "n", F.explode(F.flatten(F.transform(
        "t", lambda x, i: F.transform(F.slice("t", i + 2, F.size("t")), lambda y: F.xxhash64(x, y))
    ))).alias("entry"))
    entries = _by_size(alone.unionByName(paired), percent)
    # Similar sets share many entries: of the entries that hold the same sets, one is kept.
    members = entries.groupBy("entry").agg(
        F.count(F.lit(1)).alias("c"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
        F.sum(F.xxhash64("doc_id").cast("decimal(38,0)")).alias("sum"), F.min("n").alias("least"), F.max("n").alias("most"),
    ).where((F.col("c") > 2) | (F.col("c") > 1) & (100 * F.col("least") >= percent * F.col("most")))
    sizes = members.groupBy("c", "low", "high", "sum").agg(F.min("entry").alias("entry")).select("entry", "c")
    entries = written(
        entries.join(sizes, "entry").withColumn("blocks", F.ceil(F.col("c") / BLOCK).cast("int")).drop("c"),
        "ngram-entries",
    )
    discard(shared)
    # bitmaps are far wider than the rest of an entry's rows, so they join them last
    bitmaps = sets.select("doc_id", "parity")
    block = F.pmod(F.xxhash64("doc_id", "entry"), F.col("blocks")).cast("int")
    gathered = written(
        in_groups(entries.join(bitmaps, "doc_id").withColumn("part", block), ["entry", "part"], ["n"])
        .mapInArrow(_gather(percent), "a long, b long, open long"), "ngram-pairs",
    )
    pairs = gathered.where("open IS NULL").select("a", "b").distinct()
    links = _linked(pairs, own, width, percent)
    # what is still apart: open entries that hold more than one component
    parts = components(links, "ngram-components")
    still = entries.join(gathered.select(F.col("open").alias("entry")).distinct(), "entry", "left_semi")
    placed = (
        still.join(parts, F.col("doc_id") == F.col("node"), "left")
        .withColumn("component", F.coalesce("component", "doc_id")).drop("node")
    )
    mixed = (
        placed.groupBy("entry", "component").agg(F.count(F.lit(1)).alias("c"))
        .groupBy("entry").agg(
            F.max(F.struct("c", "component")).alias("most"), F.sum("c").alias("c"), F.count(F.lit(1)).alias("components")
        ).where("components > 1")
        .select("entry", F.col("most.component").alias("main"), (F.col("c") - F.col("most.c")).alias("apart"))
    )
    apart = written(placed.join(mixed, "entry"), "ngram-apart")
    few = apart.groupBy("doc_id").agg(F.slice(F.array_sort(F.collect_list("entry")), 1, FEW).alias("few"))
    dealt = _dealt(apart, block).join(few, "doc_id").join(bitmaps, "doc_id")
    more = written(
        in_groups(dealt, ["entry", "left", "right"], ["n"]).mapInArrow(_across(percent), "a long, b long")
        .distinct().join(pairs, ["a", "b"], "left_anti"), "ngram-more-pairs",
    )
    for table in (entries, gathered, apart):
        discard(table)
    others = _linked(more, own, width, percent)
    parts = components(links.unionByName(others), "ngram-components")
    for table in (more, links, others):
        discard(table)
    named = (
        classes.join(parts, F.col("first") == F.col("node"), "left")
        .select("whole", F.coalesce("component", "first").alias("component"))
    )
    return sets.join(named, "whole", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def op6_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_groups(documents(spark, folder))
