"""Byte-level BPE as a transducer: merges compiled into states that are made when first reached.

Encoding by ranks has a local characterisation: a token sequence is the encoding
of its bytes exactly if every two neighbours are the encoding of their own
bytes. Therefore each prefix of a text has one last token, which follows from
the bytes before it, and text can be read left to right. A state is the last
token emitted and the bytes read since; its transition on a byte emits the tokens
that every possible continuation shares. At most about one longest token of bytes
is pending, so the lookahead is bounded.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tallyworks.llm.shared import documents

MAX_STATES = 1 << 18
MAX_KNOWN = 3 << 18
PIECES_AT_ONCE = 1 << 16
# Bytes of a piece that may be read without states.
SHORT = 48

# Fixed value: the pattern of the public byte-level vocabulary, for which texts may be cut at single spaces.
SPACED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BESIDE = re.compile(r" \s|\s ")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Transducer:
    """Encodes one piece of text at a time, byte by byte, in linear time."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.max_states = max_states
        self.prefixes = {token[:i] for token in ranks for i in range(1, len(token))}
        self.code = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        # a single byte is made by no merge, but is there from the start
        self.halves: dict[bytes, tuple[bytes, bytes] | None] = {token: (b"", token) for token in ranks if len(token) == 1}
        self._reset()

    def _reset(self) -> None:
        """Forget all states, as when there are too many: they are made again on demand."""
        self.numbers: dict[tuple[bytes, bytes], int] = {}
        self.states: list[tuple[bytes, bytes, tuple[bytes, ...], tuple[int, ...]]] = []
        self.moves: dict[int, tuple[int, bytes]] = {}  # by 256 * state + byte
        self.neighbours: dict[tuple[bytes, bytes], bool] = {}
        self.start = self._state(b"", b"", (b"",), ())

    def _state(self, before: bytes, pending: bytes, last: tuple[bytes, ...], live: tuple[int, ...]) -> int:
        """``last[i]``: the last token of all text up to ``pending[:i]``; ``live``: where
        the rest of the pending bytes begins a longer token."""
        key = (before, pending)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append((before, pending, last, live))
        return number

    def merge(self, text: bytes, until: int = 1) -> list[bytes]:
        """The encoding by its definition: join the neighbours of least rank, leftmost first."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > until:
            ranked = [(self.ranks.get(a + b, len(self.ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranked)
            if rank == len(self.ranks):
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts that the last merge of a token joins; None if merging never makes the token."""
        if token not in self.halves:
            parts = self.merge(token, until=2)
            self.halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self.halves[token]

    def _may_follow(self, a: bytes, b: bytes) -> bool:
        """Whether encoding a + b leaves the two tokens apart.

        Undo the merges next to the boundary, latest first. If what then meets
        there has a merge earlier than the one undone, it would have been joined.
        """
        known = self.neighbours.get((a, b))
        if known is not None:
            return known
        left, right, ranks = a, b, self.ranks
        bound = len(ranks) + 1
        while True:
            if ranks.get(left + right, bound) < bound:
                known = False
                break
            of_left = ranks[left] if len(left) > 1 else -1
            of_right = ranks[right] if len(right) > 1 else -1
            if of_left < 0 and of_right < 0:
                known = True
                break
            if of_left > of_right:
                bound, left = of_left, self._halves(left)[1]
            else:  # of equal ranks the left one is merged first
                bound, right = of_right + 1, self._halves(right)[0]
        self.neighbours[a, b] = known
        return known

    def _last(
        self, before: bytes, read: bytes, last: Sequence[bytes], live: Iterable[int], end: int
    ) -> tuple[bytes, list[int]]:
        """The last token of ``read[:end + 1]``, and where a longer token begins that goes on."""
        ranks, halves, neighbours, prefixes = self.ranks, self.halves, self.neighbours, self.prefixes
        found, going = b"", []
        for start in (*live, end):  # exactly one of these tokens fits what comes before it
            token = read[start:end + 1]
            if not found and token in ranks and (halves.get(token) or self._halves(token)):
                previous = last[start] if start else before
                if not previous:
                    found = token
                else:
                    known = neighbours.get((previous, token))
                    if self._may_follow(previous, token) if known is None else known:
                        found = token
            if token in prefixes:
                going.append(start)
        return found, going

    def _step(self, number: int, byte: int) -> tuple[int, bytes]:
        before, pending, last, live = self.states[number]
        end = len(pending)
        pending += bytes((byte,))
        token, going = self._last(before, pending, last, live, end)
        last, live = (*last, token), tuple(going)
        end += 1
        ids = b""
        if not live:  # nothing goes on: all is settled
            ids = self._ids(last, end)
            before, pending, last = token, b"", (b"",)
        elif live[0]:
            # What every possible continuation shares: the tokens up to the last
            # boundary through which the encodings to all live places pass.
            boundaries, commit = {end}, end
            while commit:
                commit -= len(last[commit])
                boundaries.add(commit)
            commit = end
            for start in live:
                while start not in boundaries:
                    start -= len(last[start])
                commit = min(commit, start)
            if commit:
                ids = self._ids(last, commit)
                before, pending = last[commit], pending[commit:]
                last, live = (b"", *last[commit + 1:]), tuple([start - commit for start in live])
        move = (self._state(before, pending, last, live), ids)
        self.moves[256 * number + byte] = move
        return move

    def _rest(self, number: int, rest: bytes) -> bytes:
        """The ids from a state to the end of a piece, without states for what is read."""
        before, pending, last, live = self.states[number]
        read, last = pending + rest, list(last)
        for end in range(len(pending), len(read)):
            token, live = self._last(before, read, last, live, end)
            last.append(token)
        return self._ids(last, len(read))

    def _ids(self, last: Sequence[bytes], end: int) -> bytes:
        """The ids of the tokens up to ``end``."""
        ids = b""
        while end:
            ids = self.code[last[end]] + ids
            end -= len(last[end])
        return ids

    def encode(self, piece: bytes) -> bytes:
        """The ids of one piece as little-endian 32-bit numbers. A piece that is a token is that token.

        Most pieces not met before end in bytes that no other piece shares, so a short piece makes one state where it leaves
        those that are there, and is read to its end without any.
        """
        if piece in self.code:
            return self.code[piece]
        if len(self.states) > self.max_states:
            self._reset()
        number, out, moves = self.start, [], self.moves
        short = len(piece) <= SHORT
        for at, byte in enumerate(piece):
            move = moves.get(256 * number + byte)
            if move is None:
                number, ids = self._step(number, byte)
                if short:
                    return b"".join((*out, ids, self._rest(number, piece[at + 1:])))
            else:
                number, ids = move
            if ids:
                out.append(ids)
        _, pending, last, _ = self.states[number]
        out.append(self._ids(last, len(pending)))
        return b"".join(out)


class Utf8Stream:
    """Bytes in, text out: an incomplete last character waits for the bytes that follow."""

    def __init__(self) -> None:
        self.waiting = b""

    @staticmethod
    def _incomplete(data: bytes) -> int:
        """How many bytes at the end begin a character that is not complete."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                needs = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if needs > back else 0
            if byte < 0x80:
                return 0
        return 0

    def feed(self, data: bytes, last: bool = False) -> str:
        data = self.waiting + data
        keep = 0 if last else self._incomplete(data)
        self.waiting = data[len(data) - keep:]
        return data[:len(data) - keep].decode("utf-8", errors="replace")


class Codec:
    """Whole texts to ids and back, in blocks, so that a long text needs no long list."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer = Transducer(ranks)
        self.pattern = regex.compile(pattern)
        self.alone = pattern == SPACED
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token

    def _remember(self, known: dict[str, bytes], text: str, ids: bytes) -> bytes:
        if len(text) <= 48:
            if len(known) >= MAX_KNOWN:
                known.clear()
            known[text] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        return self.pieces.get(piece) or self._remember(
            self.pieces, piece, self.transducer.encode(piece.encode("utf-8"))
        )

    def _chunk(self, chunk: str) -> bytes:
        return self._remember(self.chunks, chunk, b"".join(map(self._piece, self.pattern.findall(chunk))))

    def encode(self, text: str) -> Iterator[bytes]:
        """Blocks of ids, as little-endian 32-bit numbers.

        No match of the pattern goes on past the place before a space that has
        no other white space beside it, so such a text is cut at its spaces and a
        chunk seen lately needs no matching.
        """
        if self.alone and not BESIDE.search(text):
            first, *rest = text.split(" ")
            get, chunk = self.chunks.get, self._chunk
            yield chunk(first)
            for at in range(0, len(rest), PIECES_AT_ONCE):
                block = [" " + part for part in rest[at:at + PIECES_AT_ONCE]]
                yield b"".join([get(part) or chunk(part) for part in block])
            return
        pieces = (match.group() for match in self.pattern.finditer(text))
        while block := list(islice(pieces, PIECES_AT_ONCE)):
            yield b"".join(map(self._piece, block))

    def decode(self, blocks: Iterator[bytes]) -> Iterator[str]:
        stream, table = Utf8Stream(), self.bytes_of
        for ids in blocks:
            yield stream.feed(b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]))
        yield stream.feed(b"", last=True)


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec a worker process; its states stay warm from batch to batch."""
    return Codec(read_ranks(path), pattern)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(id, *keep, tokens array<int>)`` for every row of ``docs``.

    A null or empty text has no tokens; rows are independent, so repeated rows,
    ties and clashing names of other columns (which are not read) change nothing.
    """
    columns = [id_column, *keep]
    schema = ", ".join([*(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns), "tokens array<int>"])

    def encode(batches):
        own = codec(path, pattern)
        for batch in batches:
            ids = [
                np.frombuffer(b"".join(own.encode(text)) if text else b"", dtype="<u4").astype(np.int32)
                for text in batch.column(len(columns)).to_pylist()
            ]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            values = np.concatenate(ids) if ids else np.zeros(0, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.ListArray.from_arrays(offsets, pa.array(values, type=pa.int32()))],
                names=[*columns, "tokens"],
            )

    return docs.select(*columns, text_column).mapInArrow(encode, schema)


def round_trip_digests(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)``: encode and decode every text, block by block.

    A null text counts as empty: no tokens, and the digests of nothing.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def digests(batches):
        own = codec(path, pattern)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1).to_pylist():
                seen, back, size = hashlib.sha256(), hashlib.sha256(), 0

                def watched(blocks):
                    nonlocal size
                    for ids in blocks:
                        seen.update(ids)
                        size += len(ids) // 4
                        yield ids

                for part in own.decode(watched(own.encode(text or ""))):
                    back.update(part.encode("utf-8"))
                counts.append(size)
                ids_sha.append(seen.hexdigest())
                text_sha.append(back.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()),
                 pa.array(text_sha, pa.string())],
                names=[id_column, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = f"`{id_column}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_column, text_column).mapInArrow(digests, schema)


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip_digests(documents(spark, folder), *default_vocabulary())
