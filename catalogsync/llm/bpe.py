"""Byte-level BPE by longest match and backtracking.

Bytes are mapped to Latin-1 characters, so that an Aho-Corasick automaton over
the vocabulary finds every token at every place of a piece in one pass. The
encoder then walks the piece with the longest match first. A token may follow
another only if the two are compatible: merging their joined bytes from scratch
gives the two back. A row of tokens is what the merges give exactly when all its
neighbours are compatible, and the check is remembered by pair. Where no match
fits, the place is marked as a dead end and the last token is shortened; no
place is a dead end twice, so the time is linear in the piece.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from catalogsync.llm.common import map_batches, once, pick

# Entries that a worker keeps in each of two generations of pieces, entries of pairs, characters of the longest piece kept.
KEPT_PIECES = 500_000
KEPT_PAIRS = 1_000_000
LONGEST_KEPT = 64


# The pattern that is known here in a second form for the standard library's faster engine, for texts of characters up to
# U+024F and of some punctuation and currency signs: which of them are letters, numbers or space is settled.
_KNOWN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LETTERS, _NUMBERS, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\x09-\x0d \x85\xa0"
_UNKNOWN = re.compile("[^\x00-ɏ‐-‧‰-⁞₠-₿]")
_QUICK = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACE}{_LETTERS}{_NUMBERS}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, lines)))}


def merge(data: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The defining merges: join the neighbours of lowest rank, leftmost first, until none is a token. For short data."""
    parts = [data[k : k + 1] for k in range(len(data))]
    while len(parts) > 1:
        best, at = None, -1
        for k in range(len(parts) - 1):
            rank = ranks.get(parts[k] + parts[k + 1])
            if rank is not None and (best is None or rank < best):
                best, at = rank, k
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Encoder:
    """Encodes pieces to token ids and decodes ids to bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = dict(zip(ranks.values(), ranks.keys()))
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        # All tokens' bytes in a row, where each begins, and its length.
        size = max(self.bytes_of, default=0) + 1
        self.lengths = np.array([len(self.bytes_of.get(k, b"")) for k in range(size)], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(self.bytes_of.get(k, b"") for k in range(size)), np.uint8)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.whole: dict[int, bool] = {}

    def reachable(self, token: int) -> bool:
        """Do the merges give this token for its own bytes? Others only stand for a whole piece."""
        known = self.whole.get(token)
        if known is None:
            known = self.whole[token] = len(merge(self.bytes_of[token], self.ranks)) == 1
        return known

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            a, b = self.bytes_of[left], self.bytes_of[right]
            known = self.pairs[left, right] = merge(a + b, self.ranks) == [a, b]
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(piece.decode("latin-1")):
            found[end + 1 - match[0]].append(match)  # shorter matches end earlier and come first
        pairs, reached = self.pairs, self.whole
        row: list[int] = []  # tokens chosen so far
        left: list[int] = []  # for each of them, how many shorter matches remain untried
        dead = bytearray(n + 1)
        at, tries = 0, len(found[0])
        while at < n:
            matches = found[at]
            placed = False
            while tries:
                tries -= 1
                length, token = matches[tries]
                if dead[at + length] or not (reached[token] if token in reached else self.reachable(token)):
                    continue
                fits = pairs.get((row[-1], token)) if row else True
                if fits or (fits is None and self.compatible(row[-1], token)):
                    row.append(token)
                    left.append(tries)
                    at += length
                    tries = len(found[at]) if at < n else 0
                    placed = True
                    break
            if not placed:
                if not row:
                    raise ValueError("a byte has no token")
                dead[at] = 1
                at -= len(self.bytes_of[row.pop()])
                tries = left.pop()
        return row

    def decode(self, ids: np.ndarray, at_once: int = 1_000_000) -> bytes:
        return b"".join(self._taken(ids[k : k + at_once]) for k in range(0, len(ids), at_once))

    def _taken(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        return self.flat[np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(ends[-1])].tobytes()


class Packed(dict):
    """Ids of pieces as little-endian unsigned 32-bit integers; misses are encoded and kept.

    When there are too many, they become the older generation; what is asked for
    again moves back, and what is not goes with the next change.
    """

    def __init__(self, encoder: Encoder):
        self.encoder = encoder
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.pop(piece, None)
        if ids is None:
            found = self.encoder.encode_piece(piece.encode("utf-8"))
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= KEPT_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """A worker's encoder with its caches."""

    def __init__(self, path: str, pattern: str):
        self.encoder = Encoder(read_ranks(path))
        self.packed = Packed(self.encoder)
        self.split = regex.compile(pattern)
        self.quick = _QUICK if pattern == _KNOWN else None

    def splitter(self, text: str):
        """What splits this text fastest; the pieces are the same."""
        return self.quick if self.quick and not _UNKNOWN.search(text) else self.split

    def encode(self, text: str) -> bytes:
        """The ids of a text, packed."""
        split = self.splitter(text)
        if len(text) <= 1_000_000:
            return b"".join(map(self.packed.__getitem__, split.findall(text)))
        return b"".join(self.packed[m.group()] for m in split.finditer(text))

    def decode(self, packed: bytes) -> bytes:
        return self.encoder.decode(np.frombuffer(packed, dtype="<u4"))


def _mapped(docs: DataFrame, path: str, pattern: str, doc_id: str, text: str, schema: str, row: Callable) -> DataFrame:
    rows = pick(docs, doc_id=doc_id, text=text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", *(part.split()[0] for part in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = once(("bpe", path, pattern), lambda: Codec(path, pattern))
        for batch in batches:
            made = [row(codec, value or "") for value in batch.column("text").to_pylist()]
            columns = list(zip(*made)) if made else [[] for _ in names[1:]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns, types)], names=names)

    types = [{"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}[part.split()[1]] for part in schema.split(", ")]
    return map_batches(rows, run, f"doc_id {kind}, {schema}")


def bpe_encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of every text: ``doc_id``, ``n_tokens`` and ``ids`` (binary, little-endian unsigned 32-bit).

    ``path``: a rank file on every machine; ``pattern``: what splits texts into
    pieces, each encoded by itself. Null texts count as empty and give no ids.
    Null ids, repeated rows and other columns as in ``bpe_round_trip``.
    """

    def row(codec: Codec, value: str) -> tuple:
        packed = codec.encode(value)
        return len(packed) // 4, packed

    return _mapped(docs, path, pattern, doc_id, text, "n_tokens long, ids binary", row)


def bpe_round_trip(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text, decode its ids, and return digests of both.

    A row per row of ``docs``: ``doc_id``, ``n_tokens``, ``ids_sha256`` (hex, of
    the ids as little-endian unsigned 32-bit integers) and ``decoded_sha256``
    (hex, of the decoded bytes). A null text counts as empty: no tokens and the
    digests of nothing. A null id stays null, repeated rows each get their row,
    an empty table gives an empty one, other columns are ignored. Texts of any
    length take memory in proportion to the longest of a batch.
    """

    def row(codec: Codec, value: str) -> tuple:
        packed = codec.encode(value)
        return len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(codec.decode(packed)).hexdigest()

    return _mapped(docs, path, pattern, doc_id, text, "n_tokens long, ids_sha256 string, decoded_sha256 string", row)


def bpe_decode(encoded: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Texts of packed ids: ``doc_id`` and ``text``; bytes that are no UTF-8 become replacement characters."""
    rows = pick(encoded, doc_id=doc_id, ids=ids)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = once(("bpe", path, pattern), lambda: Codec(path, pattern))
        for batch in batches:
            texts = [codec.decode(v or b"").decode("utf-8", "replace") for v in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return map_batches(rows, run, f"doc_id {kind}, text string")
