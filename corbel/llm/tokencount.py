"""Exact token counts at every prefix of a text, by dynamic programming.

A byte-pair encoding is right exactly if each two neighbouring tokens are what
the vocabulary makes of their joined bytes. So the last token of every prefix
of a piece follows from the last tokens of its shorter prefixes, and with it
the prefix's token count: no prefix is ever encoded. Texts are cut into units
(white space and what follows it) at places where a prefix that goes on cannot
change the count before; within a unit every prefix is counted as it stands,
so the count of a text's prefix is the full units before it plus one entry of
the table. The differences from one character to the next are stored, one byte
a character.
"""

from __future__ import annotations

import functools
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corbel.llm.common import column, map_batches
from corbel.llm.tokens import BYTE_PATTERN, CACHED_LENGTH, tokenizer

#: White space goes with what follows it; an apostrophe ending belongs to white
#: space only if that ends in something other than a space.
UNITS = (
    r" ?\p{L}+|(?:\s*[^\S ])?'(?:s|t|re|ve|m|ll|d)|\s*\p{L}+|\s*\p{N}+|\s*[^\s\p{L}\p{N}]+|\s+"
)
#: Unit tables, and answers about pairs of tokens, that a worker remembers; a bound on memory only.
CACHED_PIECES = 800_000
#: Texts whose units are made together.
TEXTS = 1000
#: No apostrophe ending is longer.
LONGEST_ENDING = 3


class PrefixCounter:
    """Token counts of all prefixes of texts under one byte-level vocabulary."""

    def __init__(self, path: str):
        self._library = tokenizer(path)
        self._units = regex.compile(UNITS).findall
        self._pieces = regex.compile(BYTE_PATTERN).findall
        self._letters = _byte_letters()
        self._ids = {
            bytes(self._letters.index(c) for c in token): i
            for token, i in self._library.get_vocab(with_added_tokens=False).items()
        }
        self._bytes = {i: x for x, i in self._ids.items()}
        self._longest = max(map(len, self._ids))
        self._specials = [
            x.content for x in self._library.get_added_tokens_decoder().values()
        ]
        # Where two begin, the library takes the longer one.
        longest_first = sorted(map(regex.escape, self._specials), key=len, reverse=True)
        self._special = regex.compile("|".join(longest_first))
        self._pairs: dict[tuple[int, int], bool] = {}
        self._tables: dict[str, bytes] = {}
        self._data, self._last, self._count = b"", [-1], [0]

    def _alone(self, data: bytes) -> list[int]:
        letters = "".join(self._letters[b] for b in data)
        return [token.id for token in self._library.model.tokenize(letters)]

    def _fits(self, before: int, token: int) -> bool:
        pair = (before, token)
        known = self._pairs.get(pair)
        if known is None:
            if len(self._pairs) >= CACHED_PIECES:
                self._pairs.clear()
            first = self._bytes[before] if before >= 0 else b""
            wanted = [before, token] if before >= 0 else [token]
            known = self._pairs[pair] = self._alone(first + self._bytes[token]) == wanted
        return known

    def piece(self, piece: str) -> list[int]:
        """Tokens of each prefix, character by character, of text that no cut divides."""
        data, before = piece.encode(), self._data
        alike, least = 0, min(len(data), len(before))
        while alike < least and data[alike] == before[alike]:
            alike += 1
        # What the piece begins with like the one before is known.
        last, count = self._last[: alike + 1], self._count[: alike + 1]
        for end in range(alike + 1, len(data) + 1):
            for start in range(max(0, end - self._longest), end):
                token = self._ids.get(data[start:end])
                if token is not None and self._fits(last[start], token):
                    last.append(token)
                    count.append(count[start] + 1)
                    break
        self._data, self._last, self._count = data, last, count
        if len(data) == len(piece):
            return count[1:]
        ends = accumulate(len(c.encode()) for c in piece)
        return [count[end] for end in ends]

    def unit(self, unit: str) -> list[int]:
        """Tokens of each prefix of a unit as a text of its own."""
        blank = len(unit) - len(unit.lstrip())
        if unit[:blank] in ("", " ") and unit[:1] != "'":
            return self.piece(unit)
        counts = self.piece(unit[:blank]) if blank else []
        near = min(len(unit), blank + LONGEST_ENDING)
        for end in range(blank + 1, near + 1):
            counts.append(sum(self.piece(x)[-1] for x in self._pieces(unit[:end])))
        if len(unit) > near:
            *head, rest = self._pieces(unit)
            before = sum(self.piece(x)[-1] for x in head)
            counts += [before + x for x in self.piece(rest)[near - len(unit) + len(rest) :]]
        return counts

    def _table(self, unit: str) -> bytes:
        table = self._tables.get(unit)
        if table is None:
            counts = self.unit(unit)
            # Two's complement: a step may be negative.
            table = bytes((x - y) & 255 for x, y in zip(counts, [0, *counts]))
            if len(unit) <= CACHED_LENGTH:
                if len(self._tables) >= CACHED_PIECES:
                    self._tables.clear()
                self._tables[unit] = table
        return table

    def all_steps(self, texts: list[str | None]) -> list[bytes]:
        """Steps of each text. New units are met in order, as neighbours share their beginnings."""
        units = [self._units(text or "") for text in texts]
        for unit in sorted(set(chain.from_iterable(units)) - self._tables.keys()):
            self._table(unit)
        special = [text is not None and any(x in text for x in self._specials) for text in texts]
        return [
            self.steps(text) if odd else self._joined(own)
            for text, own, odd in zip(texts, units, special)
        ]

    def _steps(self, text: str) -> bytes:
        return self._joined(self._units(text))

    def _joined(self, units: list[str]) -> bytes:
        try:
            return b"".join(map(self._tables.__getitem__, units))
        except KeyError:
            return b"".join(map(self._table, units))

    def steps(self, text: str | None) -> bytes:
        """Signed bytes: by how much each character changes the token count."""
        if not text:
            return b""
        parts, at = [], 0
        for found in self._special.finditer(text) if self._specials else ():
            # Until its last character a special string is text like any other.
            before = self._steps(text[at : found.start()])
            opened = self._steps(text[at : found.end() - 1])
            parts += [opened, np.int8(_total(before) + 1 - _total(opened)).tobytes()]
            at = found.end()
        return b"".join([*parts, self._steps(text[at:])])


def _total(steps: bytes) -> int:
    return int(np.frombuffer(steps, np.int8).sum(dtype=np.int64))


def _byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    bytes for themselves, the others in order from code point 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte) if byte in plain else chr(spare))
        spare += byte not in plain
    return "".join(letters)


@functools.lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_counts(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``token_steps`` to each row.

    ``token_steps`` has a signed byte per character; the sum of the first k is
    the token count of the first k characters, so :func:`tokens_at` and
    :func:`fitting` answer questions about truncation and budgets without the
    text. Null and empty texts have zero tokens and an empty table. Rows are
    independent: repeated rows get equal answers, and columns named like the
    new ones are replaced. A character adds four tokens at most and takes away
    fewer than the longest token has bytes, so a byte is enough.
    """

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        known, texts = counter(path), column(batch, text).to_pylist()
        tables = []
        for first in range(0, len(texts), TEXTS):
            tables += known.all_steps(texts[first : first + TEXTS])
        sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in column(batch, text)]
        totals = [_total(x) for x in tables]
        return [
            pa.array(sizes, pa.int64()),
            pa.array(totals, pa.int64()),
            pa.array(tables, pa.binary()),
        ]

    fields = [
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("token_steps", T.BinaryType()),
    ]
    return map_batches(df, fields, compute)


def _answers(ask, kind: T.DataType):
    @F.pandas_udf(kind)
    def answer(tables, numbers):
        import pandas as pd

        return pd.Series(
            [
                ask(np.cumsum(np.frombuffer(x or b"", np.int8), dtype=np.int64), int(n))
                for x, n in zip(tables, numbers)
            ]
        )

    return answer


def tokens_at(steps: Column, characters: Column) -> Column:
    """Token count of the first ``characters`` characters, from the stored table."""

    def ask(counts, n):
        n = min(n, len(counts))
        return int(counts[n - 1]) if n > 0 else 0

    return _answers(ask, T.LongType())(steps, characters)


def fitting(steps: Column, budget: Column) -> Column:
    """Length of the longest prefix of at most ``budget`` tokens, in characters."""

    def ask(counts, n):
        fits = np.flatnonzero(counts <= n)
        return int(fits[-1]) + 1 if len(fits) else 0

    return _answers(ask, T.LongType())(steps, budget)
