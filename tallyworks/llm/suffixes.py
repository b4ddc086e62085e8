"""Bytes that repeat elsewhere: bounded interval expansion on Burrows-Wheeler transforms of anchored pieces.

Windows of ``length`` bytes are dealt out by content. Each takes one of the 32-byte
strings inside it as its anchor (the one of smallest hash); equal windows take
equal anchors, so the windows of one anchor are compared among themselves.
Consecutive windows with the same anchor form a piece of text. An anchor that
occurs once is done, and so are equal pieces. The pieces left, where texts
begin to differ, are concatenated, many anchors in one task, and their
Burrows-Wheeler transform is expanded: intervals of suffixes that begin alike
are extended backwards by one byte, breadth first, which yields the lengths of common
prefixes in increasing order. The expansion stops at ``length``: the places
not reached by then share that much.

An anchor with more pieces than a transform may hold (a common line, a row of
dashes) has them dealt out again by wider strings, twice as long each time and as long as
the windows in the end, when equal keys mean equal windows. Equal windows still meet,
because they take equal strings at every width.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.shared import by_place, discard, documents, mix, powers, table_of, written
from tallyworks.llm.vectors import in_groups, runs

LENGTH = 200
ANCHOR = 32
AT_ONCE = 1 << 18      # bytes of text that are handled together
_BASE = 0x9FB21C651E98DF25
_BACK = pow(_BASE, -1, 1 << 64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = table_of(29, 256)


def _least_at(value: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest of each ``width`` values in a row, the first of equals."""
    place, have = np.arange(len(value)), 1
    while have < width:
        step = min(have, width - have)
        a, b = place[:-step], place[step:]
        place, have = np.where(value[a] <= value[b], a, b), have + step
    return place


def pieces_of(data: np.ndarray, last: np.ndarray, length: int, anchor: int, apart: bool = False):
    """``(key, whole, start, n)``: pieces of ``n`` windows of texts that follow one another.

    ``last`` gives for each byte where its text ends. ``apart`` takes ``whole`` from another
    hash than ``key``, for anchors as long as the windows.
    """
    size = len(data)
    none = np.zeros(0, dtype=np.int64)
    if size < length:
        return none.view(np.uint64), none.view(np.uint64), none, none
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[data] * powers(size, _BASE))))
    back = powers(size + 1, _BACK)
    hashes = mix((sums[anchor:] - sums[:-anchor]) * back[:size - anchor + 1])
    chosen = _least_at(hashes, length - anchor + 1)
    windows = np.flatnonzero(np.arange(len(chosen)) + length <= last[:len(chosen)])
    if not len(windows):
        return none.view(np.uint64), none.view(np.uint64), none, none
    own = chosen[windows]
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (own[1:] != own[:-1]) | (windows[1:] != windows[:-1] + 1)
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(windows)))
    begin = windows[at]
    if apart:
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix(_BYTE)[data] * powers(size, _BACK))))
        back = powers(size + 1, _BASE)
    whole = mix((sums[begin + n + length - 1] - sums[begin]) * back[begin])
    return hashes[own[at]], whole, begin, n


def _groups(batches):
    for batch in batches:
        texts = [(t or "").encode("utf-8") for t in batch.column(1).to_pylist()]
        begin, size = 0, 0
        for i, text in enumerate(texts):
            if size and size + len(text) > AT_ONCE:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, size = i, 0
            size += len(text)
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]


def _cut(length: int, anchor: int):
    def cut(batches):
        for rows, texts in _groups(batches):
            sizes = np.array([len(t) for t in texts])
            edges = np.concatenate(([0], np.cumsum(sizes)))
            data = np.frombuffer(b"".join(texts), dtype=np.uint8)
            key, whole, begin, n = pieces_of(data, np.repeat(edges[1:], sizes), length, anchor)
            row = np.searchsorted(edges, begin, "right") - 1
            ids = rows.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(ids[row]),
                 pa.array((begin - edges[row]).astype(np.int32)), pa.array(n.astype(np.int32))],
                names=["key", "whole", "doc_id", "start", "n"],
            )

    return cut


def _texts_of_pieces(length: int):
    def extract(batches):
        for batch in batches:
            wanted = batch.column(2)
            out = []
            for i, text in enumerate(batch.column(1).to_pylist()):
                data = text.encode("utf-8")
                for piece in wanted[i].as_py():
                    at = piece["start"]
                    out.append((piece["key"], piece["c"], piece["whole"], data[at:at + piece["n"] + length - 1]))
                    if len(out) >= 20_000:
                        yield _piece_rows(out)
                        out = []
            yield _piece_rows(out)

    return extract


def _cut_again(length: int, width: int):
    """Pieces of crowded anchors, cut by strings of ``width`` bytes; the new keys hold the old ones."""
    def cut(batches):
        for batch in batches:
            wanted = batch.column(2)
            for i, text in enumerate(batch.column(1).to_pylist()):
                data = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
                own = wanted[i].as_py()
                for first in range(0, len(own), 500):
                    yield cut_some(batch.column(0)[i].as_py(), data, own[first:first + 500])

    def cut_some(doc_id, data, wanted):
        begin = np.array([p["start"] for p in wanted], dtype=np.int64)
        sizes = np.array([p["n"] for p in wanted], dtype=np.int64) + length - 1
        edges = np.concatenate(([0], np.cumsum(sizes)))
        joined = np.concatenate([data[a:a + size] for a, size in zip(begin.tolist(), sizes.tolist())])
        key, whole, start, n = pieces_of(joined, np.repeat(edges[1:], sizes), length, width, apart=True)
        of = np.searchsorted(edges, start, "right") - 1
        old = np.array([p["key"] for p in wanted], dtype=np.int64).view(np.uint64)
        key = mix(old[of] * _ODD + key)
        return pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(whole.view(np.int64)), pa.array([doc_id] * len(of), pa.int64()),
             pa.array((start - edges[of] + begin[of]).astype(np.int32)), pa.array(n.astype(np.int32))],
            names=["key", "whole", "doc_id", "start", "n"],
        )

    return cut


def _piece_rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = {"key": pa.int64(), "c": pa.int64(), "whole": pa.int64(), "piece": pa.binary()}
    return pa.RecordBatch.from_arrays(
        [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds.values())], names=list(kinds)
    )


def _sorted_places(value: np.ndarray, place: np.ndarray, values: int, places: int) -> tuple[np.ndarray, np.ndarray]:
    """``place`` and ``value`` in the order of ``value``, then ``place``; they are below ``places`` and ``values``.

    Numbers that hold both are sorted as they are, which is much faster than sorting places by values.
    """
    bits = int(places).bit_length()
    if int(values).bit_length() + bits > 63:
        order = np.lexsort((place, value))
        return place[order], value[order]
    both = np.sort((value << bits) | place)
    return both & ((1 << bits) - 1), both >> bits


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The places of a text in the order of what follows them.

    By doubling; a separator that occurs once ends each part, so the rounds
    follow the longest part, not the text.
    """
    rank = text.astype(np.int64)
    have, top = 1, max(len(text), int(text.max(initial=0))) + 2
    while True:
        after = np.full(len(rank), -1, dtype=np.int64)
        after[:-have] = rank[have:]
        both = rank * top + after + 1
        order, both = _sorted_places(both, np.arange(len(rank)), top * top, len(rank))
        new = np.ones(len(order), dtype=np.int64)
        new[1:] = both[1:] != both[:-1]
        new[0] = 0
        ranks = np.cumsum(new)
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = ranks
        have *= 2
        if ranks[-1] == len(order) - 1:
            return order


def repeated_places(text: np.ndarray, length: int) -> np.ndarray:
    """Which places of a text begin a string of ``length`` symbols that begins elsewhere in it too.

    Each part of the text must end in a symbol that occurs once.
    """
    n = len(text)
    order = suffix_order(text)
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    before = text[order - 1]                # the Burrows-Wheeler transform
    step = place[order - 1]                 # from a suffix to the one that is longer by a symbol
    # boundary[i]: whether suffixes i - 1 and i have been told apart
    boundary = np.zeros(n + 1, dtype=bool)
    low, high = np.zeros(1, dtype=np.int64), np.full(1, n, dtype=np.int64)
    boundary[0] = boundary[n] = True
    symbols = int(text.max()) + 1
    for _ in range(length):
        # extend every interval of this length backwards by each symbol that stands before it
        size = high - low
        member = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        both = np.repeat(np.arange(len(low)) * symbols, size) + before[member]
        member, both = _sorted_places(both, member, len(low) * symbols, n)
        begins = np.ones(len(member), dtype=bool)
        begins[1:] = both[1:] != both[:-1]
        at = np.flatnonzero(begins)
        ends = np.append(at[1:], len(member)) - 1
        low, high = step[member[at]], step[member[ends]] + 1
        # an interval that ends where another boundary was found earlier tells nothing new
        fresh = ~boundary[high]
        boundary[high] = True
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
    alike = ~boundary[1:n]                  # suffixes i and i + 1 agree on ``length`` symbols
    found = np.zeros(n, dtype=bool)
    found[order[:-1][alike]] = True
    found[order[1:][alike]] = True
    return found


def _settle(length: int):
    """The windows of single pieces that occur in another piece of their anchor."""

    def emit(pieces):
        sizes = np.array([len(p) for _, _, p in pieces])
        starts = np.concatenate(([0], np.cumsum(sizes + 1)))
        text = np.zeros(starts[-1], dtype=np.int64)
        for i, (_, _, piece) in enumerate(pieces):
            text[starts[i]:starts[i] + sizes[i]] = np.frombuffer(piece, dtype=np.uint8)
        text[starts[1:] - 1] = 256 + np.arange(len(pieces))
        found = repeated_places(text, length)
        keys, wholes, at, n = [], [], [], []
        for i, (key, whole, _) in enumerate(pieces):
            if whole is None:
                continue
            own = found[starts[i]:starts[i] + sizes[i] - length + 1].astype(np.int8)
            edge = np.flatnonzero(np.diff(np.concatenate(([0], own, [0]))))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                keys.append(key), wholes.append(whole), at.append(a), n.append(b - a)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(wholes, pa.int64()), pa.array(at, pa.int32()), pa.array(n, pa.int32())],
            names=["key", "whole", "at", "m"],
        )

    def settle(batches):
        # Windows of different anchors differ, so the anchors of a task may share a transform.
        waiting, size = [], 0
        for table in runs(batches, ["key"]):
            rows = zip(table["key"].to_pylist(), table["c"].to_pylist(), table["whole"].to_pylist(), table["piece"].to_pylist())
            own = [(key, whole if c == 1 else None, piece) for key, c, whole, piece in rows]
            more = sum(len(piece) for _, _, piece in own)
            if waiting and size + more > AT_ONCE:
                yield emit(waiting)
                waiting, size = [], 0
            waiting += own
            size += more
        if waiting:
            yield emit(waiting)

    return settle


def repeated_ranges(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``(doc_id, ranges array<struct<start, n>>)``: starts of byte strings of ``length`` that start elsewhere too.

    The first pass gathers keys only. Texts are sent for single pieces whose anchor
    has other pieces, and for one of each class of equal pieces beside them. Anchors
    with more pieces than ``AT_ONCE`` bytes may hold are cut again instead.
    """
    schema = "key long, whole long, doc_id long, start int, n int"
    pieces = written(docs.select("doc_id", "text").mapInArrow(_cut(length, anchor), schema), "byte-pieces")
    width, ranges = anchor, []
    while True:
        fitting = max(AT_ONCE // (2 * length - width), 1)  # a piece holds its anchor in all its windows
        often = pieces.groupBy("key").agg(
            F.count(F.lit(1)).alias("c"), (F.min("whole") != F.max("whole")).alias("varied")
        ).where("c > 1").select("key", "varied", (F.col("varied") & (F.col("c") > fitting)).alias("crowded"))
        shared = written(pieces.join(often, "key"), "shared-byte-pieces")
        discard(pieces)
        classes = shared.groupBy("key", "whole").agg(
            F.min(F.struct("doc_id", "start")).alias("at"), F.first("n").alias("n"), F.first("varied").alias("varied"),
            F.first("crowded").alias("crowded"), F.count(F.lit(1)).alias("c"),
        )
        ranges.append(
            shared.join(classes.where("c > 1").select("key", "whole"), ["key", "whole"]).select("doc_id", "start", "n")
        )
        if width >= length:  # a piece is a window: what is not equal is different
            break
        places = classes.where("varied").select(
            "key", "whole", "c", "n", "crowded", F.col("at.doc_id").alias("_id"), F.col("at.start").alias("start")
        )
        doubtful = places.where("NOT crowded").drop("crowded")
        wanted = doubtful.groupBy("_id").agg(F.collect_list(F.struct("key", "whole", "c", "start", "n")).alias("wanted"))
        texts = docs.join(wanted, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "wanted").mapInArrow(
            _texts_of_pieces(length), "key long, c long, whole long, piece binary"
        )
        settled = in_groups(texts, ["key"], ["whole"]).mapInArrow(_settle(length), "key long, whole long, at int, m int")
        ranges.append(
            settled.join(doubtful.select("key", "whole", "_id", "start"), ["key", "whole"])
            .select(F.col("_id").alias("doc_id"), (F.col("start") + F.col("at")).alias("start"), F.col("m").alias("n"))
        )
        if shared.where("crowded").isEmpty():
            break
        width = min(2 * width, length)
        again = places.where("crowded").groupBy("_id").agg(F.collect_list(F.struct("key", "start", "n")).alias("wanted"))
        pieces = written(
            docs.join(again, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "wanted")
            .mapInArrow(_cut_again(length, width), schema), "byte-pieces",
        )
    found = reduce(DataFrame.unionByName, ranges)
    return found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))


def _kept(length: int):
    def kept(batches):
        for batch in batches:
            out = []
            ranges = batch.column(2)
            for i, text in enumerate(batch.column(1).to_pylist()):
                data = np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8)
                change = np.zeros(len(data) + 1, dtype=np.int64)
                own = ranges[i].values
                if own is not None and len(own):
                    start = own.field(0).to_numpy().astype(np.int64)
                    np.add.at(change, start, 1)
                    np.add.at(change, start + own.field(1).to_numpy() + length - 1, -1)
                gone = np.cumsum(change)[:-1] > 0
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((len(data), int(gone.sum()), spans, data[~gone].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([o[i] for o in out], pa.int64()) for i in range(3)),
                 pa.array([o[3] for o in out], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return kept


def remove_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept binary)``: each text without the bytes that stand elsewhere too.

    A string of ``length`` bytes that also starts anywhere else, in the same
    document or another, covers its bytes; covered bytes go, ``n_spans`` counts the runs of
    them. Strings are judged on the input and never cross documents. A null text
    is empty; texts shorter than ``length`` lose nothing; copies that are long enough lose
    all. What is kept need not be valid UTF-8. Rows with null or repeated ids are documents
    of their own, each in the result. Other columns are not read. An empty table gives an empty result.
    """
    own = by_place(docs)
    ranges = repeated_ranges(own.select(F.col("place").alias("doc_id"), "text"), length, anchor)
    joined = own.join(ranges.withColumnRenamed("doc_id", "_id"), F.col("place") == F.col("_id"), "left").select(
        "doc_id", "text", "ranges"
    )
    return joined.mapInArrow(_kept(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(documents(spark, folder)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
