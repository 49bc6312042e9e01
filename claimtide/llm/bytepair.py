"""Byte-level BPE by backtracking over longest matches, in time linear in the text.

Merging pairs by rank splits a run of bytes in exactly one way, and a split is that way if each two adjacent tokens stay
apart when merged for themselves.  So the encoder walks from left to right: it takes the longest token that begins at its
place, and a shorter one, or a step back, if that token can't follow the one before.  Places from which no split leads on
are struck off and never visited again.  Whether two tokens can be neighbours is decided by undoing the merges that made
them, and remembered per pair.

The automaton works on text, so bytes go into it as the Latin-1 characters of the same numbers.  One pass of it gives the
longest token at every place.  A text is cut by the tokenizer's pattern first, and each match is encoded for itself.

Vocabularies are given, never trained.  Tasks build the tables from the file's rows, which the driver hands to them.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimtide.llm.common import replace_columns

VOCABULARY = "byte_bpe_50k.tiktoken"
# White space as the pattern's own engine has it; Python's also has the four separators 1C to 1F.
SPACE = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
# Matches that a task remembers, and the longest of them.
REMEMBERED, SHORT = 200_000, 48
# Pairs of tokens that a task remembers.
PAIRS = 200_000
# Rows that a task holds in both forms at a time.
ROWS = 500


def read_ranks(path: str) -> list[bytes]:
    """The tokens' bytes, by rank."""
    found = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                found[int(rank)] = base64.b64decode(token)
    if sorted(found) != list(range(len(found))):
        raise ValueError(f"ranks of {path} have gaps")
    return [found[r] for r in range(len(found))]


def exact_pattern(pattern: str) -> str:
    """The pattern with white space spelt out, inside classes and outside."""
    parts = regex.split(r"(\[\^?[^\]]*\])", pattern)
    return "".join(p.replace(r"\s", SPACE) if i % 2 else p.replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")
                   for i, p in enumerate(parts))


class Codec:
    """Encoder and decoder of one vocabulary, given as the tokens' bytes by rank."""

    def __init__(self, tokens: list[bytes], pattern: str = public_tokenizers.PATTERN):
        self.tokens, self.ranks = tokens, {t: r for r, t in enumerate(tokens)}
        self.lengths = [len(t) for t in tokens]
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.pattern = regex.compile(exact_pattern(pattern))
        self.halves: list[tuple[int, int] | None] = []
        self.merged: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton()
        for rank, token in enumerate(tokens):
            parts = self._merge(token, rank)
            # A token that no merges lead to is only ever a whole match.
            made = len(parts) == 2
            self.halves.append((parts[0], parts[1]) if made else None)
            if made:
                self.merged[parts[0], parts[1]] = rank
            if made or len(token) == 1:
                self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.shorter = [self._shorter(t) for t in tokens]
        self.together: dict[int, bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}

    def _merge(self, token: bytes, below: int) -> list[int]:
        """What merging by rank makes of a token's bytes with the ranks before its own."""
        parts = [bytes([b]) for b in token]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _shorter(self, token: bytes) -> int | None:
        """The longest token that begins this one and is shorter."""
        for n in range(len(token) - 1, 0, -1):
            rank = self.ranks.get(token[:n])
            if rank is not None and (n == 1 or self.halves[rank] is not None):
                return rank
        return None

    def neighbours(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens by rank ends with these two."""
        pair = left * len(self.tokens) + right
        known = self.together.get(pair)
        if known is None:
            if len(self.together) >= PAIRS:
                self.together.clear()
            known = self.together[pair] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        # Undo the later of the two tokens' last merges, again and again, down to single bytes.  In between the merges
        # stood two other tokens at the border; had their own merge come before the one undone, it would have been made.
        # Of merges alike, the one further left comes first.
        before = (len(self.tokens), 0)
        while True:
            across = self.merged.get((left, right))
            if across is not None and (across, 1) < before:
                return False
            a, b = self.halves[left], self.halves[right]
            if a is None and b is None:
                return True
            if b is None or (a is not None and left > right):
                before, left = (left, 0), a[1]
            else:
                before, right = (right, 2), b[0]

    def encode_match(self, match: str) -> tuple[int, ...]:
        """Ids of one match of the pattern."""
        known = self.known.get(match)
        if known is not None:
            return known
        data = match.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(data)
        found = (whole,) if whole is not None else tuple(self._walk(data))
        if len(match) <= SHORT:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[match] = found
        return found

    def _walk(self, data: bytes) -> list[int]:
        size = len(data)
        longest = [0] * size
        for last, (rank, length) in self.automaton.iter(data.decode("latin-1")):
            longest[last - length + 1] = rank  # ends come in order, so the longest is set last
        open_ = bytearray(b"\x01") * (size + 1)
        lengths, shorter, neighbours = self.lengths, self.shorter, self.neighbours
        taken: list[int] = []
        at, candidate = 0, longest[0]
        while at < size:
            if candidate is None:  # nothing leads on from here
                open_[at] = 0
                candidate = taken.pop()
                at -= lengths[candidate]
            elif open_[at + lengths[candidate]] and (not taken or neighbours(taken[-1], candidate)):
                taken.append(candidate)
                at += lengths[candidate]
                candidate = longest[at] if at < size else None
                continue
            candidate = shorter[candidate]
        return taken

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text, without special tokens; NULL and the empty text have none."""
        ids: list[int] = []
        known, encode_match = self.known.get, self.encode_match
        for match in self.pattern.findall(text or ""):
            ids.extend(known(match) or encode_match(match))
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


# The codec that a worker process made last, with its vocabulary: later tasks of the process find it made.
_made: list[tuple[list[bytes], Codec]] = []


def codec_of(tokens: list[bytes]) -> Codec:
    if not _made or _made[0][0] != tokens:
        _made[:] = [(tokens, Codec(tokens))]
    return _made[0][1]


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in order, few at a time: results of long texts leave the worker before the next ones are made."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def encode_documents(docs: DataFrame, vocabulary: str | None = None, text: str = "text", name: str = "ids",
                     packed: bool = False) -> DataFrame:
    """All columns but the text, with the ids of every whole text as array ``name``.

    ``packed`` gives them as binary instead: little-endian unsigned 32-bit integers.  A NULL text is empty and has no
    ids.  Every string has ids, as every byte is a token.  Repeated rows stay.  An input column called ``name`` gives
    way.  An empty table gives an empty result.
    """
    kept = replace_columns(docs, **{name: F.col(f"`{text}`")})
    kept = kept.select(*[F.col(f"`{c}`") for c in kept.columns if c == name or c.lower() != text.lower()])
    tokens = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary or public_tokenizers.path(VOCABULARY)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(tokens.value)
        for batch in in_slices(batches):
            found = [np.array(codec.encode(t.as_py()), dtype="<u4") for t in batch.column(batch.num_columns - 1)]
            ids = (pa.array([x.tobytes() for x in found], pa.binary()) if packed
                   else pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], names=batch.schema.names)

    return kept.mapInArrow(run, kept.drop(name).schema.add(name, T.BinaryType() if packed else T.ArrayType(T.IntegerType())))


def decode_documents(encoded: DataFrame, vocabulary: str | None = None, ids: str = "ids", name: str = "bytes") -> DataFrame:
    """All columns, with the bytes that the ids, an array or packed, stand for as column ``name``; NULL has no bytes.

    An id that the vocabulary doesn't have is an error.
    """
    packed = dict(encoded.dtypes)[ids] == "binary"
    kept = replace_columns(encoded, **{name: F.col(f"`{ids}`")})
    tokens = encoded.sparkSession.sparkContext.broadcast(read_ranks(vocabulary or public_tokenizers.path(VOCABULARY)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens.value.__getitem__
        for batch in in_slices(batches):
            found = []
            for row in batch.column(batch.num_columns - 1):
                own = row.as_py() or ()
                found.append(b"".join(map(known, np.frombuffer(own, dtype="<u4").tolist() if packed and own else own)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.binary())], names=batch.schema.names)

    return kept.mapInArrow(run, kept.drop(name).schema.add(name, "binary"))
