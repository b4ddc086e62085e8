"""Lines that many documents repeat: two Bloom filters find the suspects, an exact count confirms them.

A first pass over the lines fills two filters, one for keys seen at least once and
one for keys seen at least twice. Each task sends only the positions that its keys set; the filters
are merged slice by slice: a position set by two tasks goes into the second filter.
A second pass tests every line against the second filter. Only lines that pass, the
suspected repeats, are shuffled, as 128-bit digests of their keys, and counted exactly.

The filters get 16 bits a line up to ``MOST_BITS``. Beyond that they fill up, and more
lines than necessary are shuffled; the result is the same.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.shared import SPACES, documents, written

LEAST_DOCS = 10
BITS_A_LINE = 16
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 29   # the larger one is 64 MB in a task
SLICE = 1 << 20                            # bits that are merged and sent together
HELD = 1 << 20                             # hashes that a task holds before it makes them distinct


def _keys(text: bytes | None) -> list[bytes]:
    """The key of each line of a text."""
    return [line.strip(SPACES).lower() for line in (text or b"").split(b"\n")]


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Two filter positions for each hash, as two rows."""
    mask = np.uint64(bits - 1)
    return np.stack((hashes & mask, (hashes >> np.uint64(32)) & mask)).astype(np.int64)


def _text_bytes(column: pa.Array) -> list:
    return column.cast(pa.large_binary()).to_pylist()


def _mark(bits: int, least: int):
    """Task side of the first pass: rows ``(slice, once, twice)`` of positions within a slice, as unsigned 32-bit numbers."""

    def compact(hashes: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found, at, count = np.unique(hashes, return_inverse=True, return_counts=True)
        twice = count > 1
        twice[at[often]] = True
        return found, twice

    def run(batches):
        hashes, often = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
        fresh: list[bytes] = []
        for batch in batches:
            for text in _text_bytes(batch.column(0)):
                fresh.extend(_digest(key)[:8] for key in set(_keys(text)) if len(key.decode("utf-8", "replace")) >= least)
                if len(fresh) >= HELD:
                    new = np.frombuffer(b"".join(fresh), dtype=np.uint64)
                    hashes, often = compact(np.append(hashes, new), np.append(often, np.zeros(len(new), dtype=bool)))
                    fresh = []
        new = np.frombuffer(b"".join(fresh), dtype=np.uint64)
        hashes, often = compact(np.append(hashes, new), np.append(often, np.zeros(len(new), dtype=bool)))
        once = np.unique(_positions(hashes, bits))
        twice = np.unique(_positions(hashes[often], bits))
        slices = np.unique(once // SLICE)

        def parts(places: np.ndarray) -> list[bytes]:
            edges = np.append(np.searchsorted(places, slices * SLICE), len(places))
            ends = np.searchsorted(places, (slices + 1) * SLICE)
            return [(places[a:b] % SLICE).astype(np.uint32).tobytes() for a, b in zip(edges, ends)]

        yield pa.RecordBatch.from_pydict(
            {"slice": pa.array(slices, pa.int64()), "once": pa.array(parts(once), pa.binary()),
             "twice": pa.array(parts(twice), pa.binary())}
        )

    return run


def _merge(batches):
    """Rows ``(slice, bits)`` of the second filter. Rows come ordered by slice, so one slice is held at a time."""
    at, once, twice = None, None, None

    def done():
        return pa.RecordBatch.from_pydict(
            {"slice": pa.array([at], pa.int64()), "bits": pa.array([np.packbits(twice).tobytes()], pa.binary())}
        )

    for batch in batches:
        for row in batch.to_pylist():
            if row["slice"] != at:
                if at is not None and twice.any():
                    yield done()
                at, once, twice = row["slice"], np.zeros(SLICE, dtype=bool), np.zeros(SLICE, dtype=bool)
            mine = np.frombuffer(row["once"], dtype=np.uint32)
            twice[mine[once[mine]]] = True
            twice[np.frombuffer(row["twice"], dtype=np.uint32)] = True
            once[mine] = True
    if at is not None and twice.any():
        yield done()


def seen_twice(rows: DataFrame, bits: int, least_chars: int) -> np.ndarray:
    """The second filter over the lines of ``rows(text)``: ``bits`` bits, packed, at most ``MOST_BITS``."""
    marks = rows.mapInArrow(_mark(bits, least_chars), "slice long, once binary, twice binary")
    merged = marks.repartition("slice").sortWithinPartitions("slice").mapInArrow(_merge, "slice long, bits binary")
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in merged.toLocalIterator():
        out[row["slice"] * SLICE // 8:(row["slice"] + 1) * SLICE // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def _suspect(shared, bits: int, least: int):
    """Task side of the second pass: ``(_row, line_no, key, first)`` of each line that the second filter holds;
    ``first`` where the document has no earlier line of that key."""

    def run(batches):
        filled = shared.value
        for batch in batches:
            row, line, digest, first = [], [], [], []
            for number, text in zip(batch.column(0).to_pylist(), _text_bytes(batch.column(1))):
                known: dict[bytes, bytes] = {}
                for i, key in enumerate(_keys(text)):
                    if len(key.decode("utf-8", "replace")) >= least:
                        first.append(key not in known)
                        row.append(number)
                        line.append(i)
                        digest.append(known.setdefault(key, _digest(key)))
            hashes = np.frombuffer(b"".join(d[:8] for d in digest), dtype=np.uint64)
            places = _positions(hashes, bits)
            kept = np.flatnonzero(((filled[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1).all(axis=0))
            yield pa.RecordBatch.from_pydict({
                "_row": pa.array(row, pa.int64()).take(kept), "line_no": pa.array(line, pa.int32()).take(kept),
                "key": pa.array(digest, pa.binary()).take(kept), "first": pa.array(first, pa.bool_()).take(kept),
            })

    return run


def _without(batches):
    """``(_row, id, kept_text, n_lines, n_dropped)`` of ``(_row, id, text, dropped)``."""
    for batch in batches:
        texts, totals, gone = [], [], []
        for text, dropped in zip(_text_bytes(batch.column(2)), batch.column(3).to_pylist()):
            lines = (text or b"").split(b"\n")
            out = set(dropped or ())
            texts.append(b"\n".join(line for i, line in enumerate(lines) if i not in out) if out else text or b"")
            totals.append(len(lines))
            gone.append(len(out))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.binary()).cast(pa.string()),
             pa.array(totals, pa.int64()), pa.array(gone, pa.int64())],
            names=["_row", "_id", "kept_text", "n_lines", "n_dropped"],
        )


def drop_repeated_lines(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    least_chars: int = 1,
    keep_first: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
    bits: int | None = None,
) -> DataFrame:
    """``(id, kept_text, n_lines, n_dropped)``: each document without the lines that ``least_docs`` documents hold.

    Lines end at ``\\n``. A line's key is the line without white space at both ends, A-Z in lower
    case; keys under ``least_chars`` code points count for nothing. A key found in ``least_docs`` rows
    or more loses all its lines in every document; with ``keep_first`` all but the first, which is in the
    smallest id (a null id comes last, equal ids in the order of their rows).

    A null text counts as an empty one, which is one empty line. Every row is a document of its
    own, whether its id is null or repeated. Other columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = written(docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_column).alias("_id"), F.col(text_column).alias("_text")
    ), "line-rows")
    if bits is None:
        text = F.coalesce("_text", F.lit(""))
        count = rows.agg(F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)).first()[0] or 1
        bits = min(max(1 << (count * BITS_A_LINE - 1).bit_length(), LEAST_BITS), MOST_BITS)
    shared = spark.sparkContext.broadcast(seen_twice(rows.select("_text"), bits, least_chars))
    suspects = written(rows.select("_row", "_text").mapInArrow(
        _suspect(shared, bits, least_chars), "_row long, line_no int, key binary, first boolean"
    ), "line-suspects")
    named = suspects.join(rows.select("_row", "_id"), "_row") if keep_first else suspects
    choice = [F.min(F.struct(F.col("_id").isNull(), "_id", "_row", "line_no")).alias("_first")] if keep_first else []
    often = written(
        named.groupBy("key").agg(F.count_if("first").alias("n"), *choice).where(F.col("n") >= least_docs).drop("n"), "line-keys"
    )
    found = suspects.join(often, "key")
    if keep_first:
        found = found.where("NOT (_row = _first._row AND line_no = _first.line_no)")
    dropped = written(found.groupBy("_row").agg(F.collect_list("line_no").alias("dropped")), "line-drops")
    kind = docs.select(F.col(id_column).alias("_id")).schema["_id"].dataType.simpleString()
    # both sides grow with the documents, so they meet by a shuffle at every size
    return rows.join(dropped.hint("merge"), "_row", "left").select("_row", "_id", "_text", "dropped").mapInArrow(
        _without, f"_row long, _id {kind}, kept_text string, n_lines long, n_dropped long"
    ).select(F.col("_id").alias(id_column), "kept_text", "n_lines", "n_dropped")


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's lines without those whose key ten or more documents hold, as counts and a digest."""
    found = drop_repeated_lines(documents(spark, folder))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def lines_sql() -> str:
    return rf"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
    lines AS (SELECT r, doc_id, unnest(range(len(l))) AS i, unnest(l) AS line FROM docs),
    keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
    often AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= {LEAST_DOCS})
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (k IN (SELECT k FROM often)) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (k NOT IN (SELECT k FROM often)), '')) AS kept_sha256
    FROM keyed GROUP BY r, doc_id"""
