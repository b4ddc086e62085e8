"""Words that repeat an earlier passage, found by recompression.

Recompression shortens a sequence in rounds. A round first replaces each run of
one symbol by a symbol for the run, then, with all symbols divided into left and right
ones, each left symbol followed by a right one by a symbol for the pair. A symbol's
name is a hash of what it stands for, so names are global: equal passages get
equal symbols in their interior, whatever stands around them and wherever they
are. For each symbol we keep the words that decided it; it is interior to a window
that holds them all.

Every window of ``window`` words takes three interior symbols in a row (of the highest
level that has any, those with the smallest hash). Consecutive windows that
take the same one form a piece. Equal windows take equal symbols, so only pieces
whose symbol occurs more than once can repeat anything. Equal pieces are settled as a whole;
windows of pieces that share a symbol but differ are verified one by one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.shared import by_place, discard, documents, mix, powers, word_bounds, word_hashes, written

WINDOW = 20
LEVELS = 2
JOINED = 3             # symbols in a row that tell a window's passage from others
AT_ONCE = 1 << 18      # bytes of text that are handled together
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xA24BAED4963EE407
_BACK = pow(_BASE, -1, 1 << 64)


class Symbols:
    """A sequence of symbols: names, and the first and last words that decided each."""

    def __init__(self, name: np.ndarray, low: np.ndarray, high: np.ndarray, first: np.ndarray, last: np.ndarray):
        self.name, self.low, self.high = name, low, high
        self.first, self.last = first, last  # the words where a symbol's document begins and ends

    def _beside(self) -> tuple[np.ndarray, np.ndarray]:
        """What a symbol's left and right neighbours add to what decides it; beyond a document, more than any window has."""
        n = len(self.name)
        left, right = self.first - 1, self.last + 1
        inner = self.first[1:] == self.first[:-1]
        left[1:][inner] = self.low[:-1][inner]
        right[:-1][inner] = self.high[1:][inner]
        return (left, right) if n else (self.low, self.high)

    def shorter(self, level: int) -> Symbols:
        return self._runs()._pairs(level)

    def joined(self, count: int) -> Symbols:
        """Each ``count`` symbols in a row as one, where they are of one document."""
        n = max(len(self.name) - count + 1, 0)
        end = slice(count - 1, count - 1 + n)
        name = self.name[:n]
        for i in range(1, count):
            name = mix(name * _ODD + mix(self.name[i:i + n]))
        whole = self.first[:n] == self.first[end]
        return Symbols(name[whole], self.low[:n][whole], self.high[end][whole], self.first[:n][whole], self.last[:n][whole])

    def _runs(self) -> Symbols:
        name = self.name
        begins = np.ones(len(name), dtype=bool)
        begins[1:] = (name[1:] != name[:-1]) | (self.first[1:] != self.first[:-1])
        at = np.flatnonzero(begins)
        size = np.diff(np.append(at, len(name)))
        left, right = self._beside()
        named = np.where(size > 1, mix(name[at] * _ODD + size.astype(np.uint64)), name[at])
        return Symbols(named, left[at], right[at + size - 1], self.first[at], self.last[at])

    def _pairs(self, level: int) -> Symbols:
        name = self.name
        is_left = (mix(name + np.uint64((level + 1) * int(_ODD) % 2**64)) & np.uint64(1)).astype(bool)
        pair = np.zeros(len(name), dtype=bool)  # with the next one
        pair[:-1] = is_left[:-1] & ~is_left[1:] & (self.first[1:] == self.first[:-1])
        second = np.zeros(len(name), dtype=bool)
        second[1:] = pair[:-1]
        left, right = self._beside()
        low = np.where(is_left, self.low, np.minimum(left, self.low))
        high = np.where(is_left, np.maximum(right, self.high), self.high)
        follows = np.append(name[1:], np.uint64(0))
        ends = np.append(self.high[1:], 0)
        named = np.where(pair, mix(name * _ODD + mix(follows)), name)
        low, high = np.where(pair, self.low, low), np.where(pair, ends, high)
        keep = ~second
        return Symbols(named[keep], low[keep], high[keep], self.first[keep], self.last[keep])


def _least_in_ranges(value: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The place of the smallest value in each range, -1 for an empty one; the first of equals."""
    out = np.full(len(lo), -1, dtype=np.int64)
    size = hi - lo
    place, width = np.arange(len(value)), 1
    while width <= size.max(initial=0):
        some = (size >= width) & (size < 2 * width)
        a, b = place[lo[some]], place[hi[some] - width]
        out[some] = np.where(value[a] <= value[b], a, b)
        if len(place) <= width:
            break
        a, b = place[:-width], place[width:]
        place, width = np.where(value[a] <= value[b], a, b), 2 * width
    return out


def pieces_of(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, window: int, levels: int):
    """``(key, hash, start, n)`` of the pieces of documents that follow one another.

    ``first`` and ``last`` give for each word where its document begins and ends.
    A piece has ``n`` windows, the first one at the word ``start``.
    """
    n = len(hashes)
    starts = np.flatnonzero(np.arange(n) + window <= last)
    none = np.zeros(0, dtype=np.int64)
    if not len(starts):
        return none.view(np.uint64), none.view(np.uint64), none, none
    symbols = Symbols(hashes, np.arange(n), np.arange(n) + 1, first, last)
    key = np.zeros(len(starts), dtype=np.uint64)
    where = np.full(len(starts), -1, dtype=np.int64)
    # what is tried later, and tells more, replaces what came before; a single word is always there
    units = symbols
    for level in range(levels + 2):
        value = mix(units.name + np.uint64(level))
        lo = np.searchsorted(units.low, starts, "left")
        hi = np.searchsorted(units.high, starts + window, "right")
        found = _least_in_ranges(value, lo, np.maximum(lo, hi))
        some = found >= 0
        key[some] = value[found[some]]
        where[some] = found[some] * (levels + 2) + level
        if level:
            symbols = symbols.shorter(level)
        units = symbols.joined(JOINED)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (where[1:] != where[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(starts)))
    begin = starts[at]
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix(hashes) * powers(n, _BASE))))
    whole = mix((sums[begin + size + window - 1] - sums[begin]) * powers(n + 1, _BACK)[begin])
    return key[at], whole, begin, size


def _split(texts: list[str]):
    """Word hashes of several texts in a row, with each word's document bounds."""
    data = np.frombuffer(" ".join(texts).encode("utf-8"), dtype=np.uint8)
    starts, ends = word_bounds(data)
    sizes = np.array([len(t.encode("utf-8")) + 1 for t in texts])
    edges = np.searchsorted(starts, np.concatenate(([0], np.cumsum(sizes))))
    counts = np.diff(edges)
    return (
        word_hashes(data, starts, ends), np.repeat(edges[:-1], counts), np.repeat(edges[1:], counts), edges, starts, ends,
        data,
    )


def _groups(batches, text_at: int):
    """Rows of a batch in groups of texts of limited size; one longer text is a group of its own."""
    for batch in batches:
        texts = [t or "" for t in batch.column(text_at).to_pylist()]
        begin, size = 0, 0
        for i, text in enumerate(texts):
            if size and size + len(text) > AT_ONCE:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, size = i, 0
            size += len(text)
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]


def _cut(window: int, levels: int):
    def cut(batches):
        for rows, texts in _groups(batches, 1):
            hashes, first, last, edges, *_ = _split(texts)
            key, whole, begin, size = pieces_of(hashes, first, last, window, levels)
            row = np.searchsorted(edges, begin, "right") - 1
            ids = rows.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(ids[row]),
                 pa.array((begin - edges[row]).astype(np.int32)), pa.array(size.astype(np.int32))],
                names=["key", "whole", "doc_id", "start", "n"],
            )

    return cut


def _windows(window: int):
    """The windows of some pieces of each document: two 64-bit hashes of their words."""

    def windows(batches):
        for rows, texts in _groups(batches, 1):
            hashes, _, _, edges, *_ = _split(texts)
            sums = [
                np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(part * powers(len(hashes), base))))
                for part, base in ((mix(hashes), _BASE), (mix(hashes + _ODD), _BACK))
            ]
            back = [powers(len(hashes) + 1, base) for base in (_BACK, _BASE)]
            wanted = rows.column(2)
            counts = np.diff(wanted.offsets.to_numpy())
            flat = wanted.flatten()
            start, n = flat.field(0).to_numpy().astype(np.int64), flat.field(1).to_numpy().astype(np.int64)
            row = np.repeat(np.arange(len(texts)), counts)
            piece = np.repeat(np.arange(len(start)), n)
            within = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
            own = start[piece] + within
            at = own + edges[row[piece]]
            found = [mix((s[at + window] - s[at]) * b[at]) for s, b in zip(sums, back)]
            ids = rows.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[0].view(np.int64)), pa.array(found[1].view(np.int64)), pa.array(ids[row[piece]]),
                 pa.array(own.astype(np.int32))],
                names=["a", "b", "doc_id", "start"],
            )

    return windows


def repeated_ranges(docs: DataFrame, window: int = WINDOW, levels: int = LEVELS) -> DataFrame:
    """``(doc_id, ranges array<struct<start, n>>)``: starts of windows that also start earlier, as runs of ``n``.

    ``docs`` has ``doc_id long, text string``; ids are distinct. Earlier means in a
    document of smaller id, or before in the same one.
    """
    pieces = written(
        docs.select("doc_id", "text").mapInArrow(
            _cut(window, levels), "key long, whole long, doc_id long, start int, n int"
        ), "pieces",
    )
    often = pieces.groupBy("key").agg(
        F.count(F.lit(1)).alias("c"), (F.min("whole") != F.max("whole")).alias("varied")
    ).where("c > 1").drop("c")
    shared = written(pieces.join(often, "key"), "shared-pieces")
    discard(pieces)
    # equal pieces: all but the first repeat it as a whole
    place = F.struct("doc_id", "start")
    classes = shared.groupBy("key", "whole").agg(
        F.min(place).alias("at"), F.first("n").alias("n"), F.first("varied").alias("varied"),
        F.count(F.lit(1)).alias("c"),
    )
    later = (
        shared.join(classes.where("c > 1").select("key", "whole", "at"), ["key", "whole"])
        .where(place != F.col("at")).select("doc_id", "start", "n")
    )
    # pieces that share a symbol but differ: their windows, one by one
    doubtful = classes.where("varied").select(F.col("at.doc_id").alias("_id"), F.col("at.start").alias("start"), "n")
    wanted = doubtful.groupBy("_id").agg(F.collect_list(F.struct("start", "n")).alias("wanted"))
    windows = written(
        docs.join(wanted, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "wanted")
        .mapInArrow(_windows(window), "a long, b long, doc_id long, start int"), "windows",
    )
    firsts = windows.groupBy("a", "b").agg(F.min(place).alias("at"), F.count(F.lit(1)).alias("c")).where("c > 1")
    single = (
        windows.join(firsts, ["a", "b"]).where(place != F.col("at"))
        .select("doc_id", "start", F.lit(1).alias("n"))
    )
    return later.unionByName(single).groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))


def _covered(size: int, ranges, window: int) -> np.ndarray:
    change = np.zeros(size + 1, dtype=np.int64)
    if ranges is not None and len(ranges):
        start = ranges.field(0).to_numpy().astype(np.int64)
        n = ranges.field(1).to_numpy().astype(np.int64)
        np.add.at(change, start, 1)
        np.add.at(change, start + n + window - 1, -1)
    return np.cumsum(change)[:size] > 0


def _kept(window: int):
    """For each text: its words, which of them are removed, and the others joined by one space."""
    def kept(batches):
        for batch in batches:
            out = []
            ranges = batch.column(2)
            for i, text in enumerate(batch.column(1).to_pylist()):
                data = (text or "").encode("utf-8")
                starts, ends = word_bounds(np.frombuffer(data, dtype=np.uint8))
                gone = _covered(len(starts), ranges[i].values, window)
                rest = b" ".join([data[a:b] for a, b in zip(starts[~gone].tolist(), ends[~gone].tolist())])
                out.append((len(starts), int(gone.sum()), rest))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                 pa.array([o[2].decode("utf-8") for o in out], pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return kept


def remove_repeats(docs: DataFrame, window: int = WINDOW, levels: int = LEVELS) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)``: each text without the words that repeat an earlier passage.

    A window of ``window`` consecutive words whose words also stand in a row earlier
    (smaller ``doc_id``, or before in the same document) covers its words; covered
    words go. Windows are judged on the input. Words are runs of bytes other than
    space and \\x09-\\x0D, compared unchanged. A null text has no words; texts
    shorter than a window lose nothing; copies lose everything but the first.
    A null id counts as the largest; rows of one id come in the order of their texts,
    and of equal rows the first in that order keeps its words. Other columns are not read. An empty table
    gives an empty result.
    """
    own = by_place(docs)
    ranges = repeated_ranges(own.select(F.col("place").alias("doc_id"), "text"), window, levels)
    joined = own.join(ranges.withColumnRenamed("doc_id", "_id"), F.col("place") == F.col("_id"), "left").select(
        "doc_id", "text", "ranges"
    )
    return joined.mapInArrow(_kept(window), "doc_id long, n_words long, n_removed long, kept string")


def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(documents(spark, folder)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )
