"""Token ids of whole texts by the ``tokenizers`` library, met piece by piece.

The vocabularies merge bytes only inside the pieces that their splitting
pattern cuts from a text. Where white space is kept, whole texts are encoded by
the vocabulary's ranks. Where it is dropped, a text is cut at white space into
chunks, a chunk not met before is cut into pieces, a piece not met before is
encoded, and a text's ids are its chunks' ids joined. ``tests/llm`` holds this
against the library's own ids of whole texts.
"""

from __future__ import annotations

import base64
import functools
import os
import re
import unicodedata
from collections.abc import Callable

import numpy as np
import regex

#: The splitting patterns of the two vocabularies. Letters are tried first, as
#: most pieces are letters and no other alternative begins like them.
BYTE_PATTERN = r" ?\p{L}+|'(?:s|t|re|ve|m|ll|d)| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"\p{L}+|'s|'t|'re|'ve|'m|'ll|'d|\p{N}|[^\s\p{L}\p{N}]+"

#: Pieces and chunks a worker remembers, and the longest it does; they bound memory only.
CACHED_PIECES, CACHED_CHUNKS = 100_000, 100_000
CACHED_LENGTH = 64


def vocabulary_path(name: str) -> str:
    """File of a public vocabulary; every machine has them."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _lowered(text: str) -> str:
    """NFC, then lower case letter by letter (a final sigma is no exception)."""
    if text.isascii():
        return text.lower()
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


#: A byte that prints stands for itself, the others are numbered from 256 on.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_HIDDEN = {x: 256 + i for i, x in enumerate(x for x in range(256) if x not in _SHOWN)}
_LETTERS = {chr(_HIDDEN.get(x, x)): x for x in range(256)}

#: A byte that no UTF-8 text has stands for the end of a word.
_END, _WORD_END = b"\xff", "</w>"


def _merger(library) -> Callable[[bytes], list[int]]:
    """Ids of a word's bytes and :data:`_END`, for a byte-level vocabulary with word ends.

    Its entries are numbered in the order of their merges, letters with a word end first, so
    merging by rank gives what the library's model does; ``tests/llm`` holds both
    against each other.
    """
    import tiktoken

    ranks, added = {}, library.get_added_tokens_decoder()
    for unit, rank in library.get_vocab().items():
        if rank not in added:
            body = unit.removesuffix(_WORD_END)
            end = _END if body != unit else b""
            ranks[bytes(_LETTERS[x] for x in body) + end] = rank
    coder = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    return coder._core_bpe.encode_single_piece


#: Characters that Python alone takes for white space.
_NO_SPACE = "\x1c\x1d\x1e\x1f"


def bare_chunks(text: str) -> list[str]:
    """A text's runs of anything but white space, where white space is dropped."""
    return [text] if any(x in text for x in _NO_SPACE) else text.split()


#: Characters before this one have had the same classes and cases in all versions of Unicode in use.
_SETTLED = "\u0250"


class Remembered(dict):
    """What ``make`` gives for a text, remembered for ``limit`` short ones at a time."""

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self._make, self._limit = make, limit

    def __missing__(self, text: str) -> bytes:
        made = self._make(text)
        if len(text) <= CACHED_LENGTH:
            if len(self) >= self._limit:
                self.clear()
            self[text] = made
        return made


def _special_strings(library):
    """Ids of the special strings as bytes, and a pattern that cuts a text around them."""
    added = library.get_added_tokens_decoder()
    specials = {x.content: np.uint16(i).tobytes() for i, x in added.items()}
    return specials, regex.compile("(" + "|".join(regex.escape(x) for x in sorted(specials)) + ")")


class PieceEncoder:
    """Ids of a text as bytes, little-endian unsigned 16-bit (both vocabularies are smaller).

    Pieces of Latin letters and ASCII are merged by the vocabulary's ranks at once, others go
    through all the library's steps.
    """

    def __init__(
        self,
        path: str,
        pattern: str,
        chunks: Callable[[str], list[str]],
        prepare: Callable[[str], str],
    ):
        self._library = tokenizer(path)
        self._merge = _merger(self._library)
        self._find = regex.compile(pattern).findall
        self._cut, self._prepare = chunks, prepare
        self._specials, self._split = _special_strings(self._library)
        self._units = [np.uint16(i).tobytes() for i in range(self._library.get_vocab_size())]
        self._piece = Remembered(self._of_piece, CACHED_PIECES).__getitem__
        self._chunk = Remembered(self._of_chunk, CACHED_CHUNKS).__getitem__

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" not in text:
            return self._segment(text)
        return b"".join(
            self._specials.get(x) or self._segment(x) for x in self._split.split(text) if x
        )

    def _segment(self, text: str) -> bytes:
        return b"".join(map(self._chunk, self._cut(text)))

    def forget(self) -> None:
        """Free what is remembered; a worker may have other work next."""
        for call in (self._piece, self._chunk):
            call.__self__.clear()

    def _of_chunk(self, chunk: str) -> bytes:
        return b"".join(map(self._piece, self._find(self._prepare(chunk))))

    def _of_piece(self, piece: str) -> bytes:
        if piece.isascii() or max(piece) < _SETTLED:
            return b"".join([self._units[i] for i in self._merge(piece.encode() + _END)])
        encoded = self._library.encode(piece, add_special_tokens=False)
        return np.array(encoded.ids, dtype="<u2").tobytes()


#: Two characters of white space, as the splitting patterns see it.
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2}")
#: The alternative of a splitting pattern that looks ahead, for white space before a last one.
_AHEAD = r"|\s+(?!\S)"


@functools.lru_cache(maxsize=4)
def byte_ranks(path: str, ahead: bool = True):
    """Coder of ordinary text for a byte-level vocabulary that keeps white space, and its units.

    It reads the ranks in the ``.tiktoken`` file beside the ``.json`` one. They and
    the splitting pattern give the library's ids, several times as fast; special strings
    are plain text to it. ``tests/llm`` holds both against each other.

    Without ``ahead`` the pattern never looks ahead, which is faster again, and right where no
    two characters of white space meet.
    """
    import public_tokenizers
    import tiktoken

    with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
        ranks = {base64.b64decode(unit): int(rank) for unit, rank in map(bytes.split, lines)}
    units = [b""] * (max(ranks.values()) + 1)
    for unit, rank in ranks.items():
        units[rank] = unit
    pattern = public_tokenizers.PATTERN
    if not ahead:
        pattern = pattern.replace(_AHEAD, "")
    coder = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return coder.encode_ordinary, units


class ByteEncoder:
    """Ids as :class:`PieceEncoder` gives them, of a byte-level vocabulary that keeps white space.

    What lies between special strings is encoded at once, by the vocabulary's ranks. The pattern
    looks ahead only where two characters of white space meet.
    """

    def __init__(self, path: str):
        self._ahead, _ = byte_ranks(path)
        self._ranks, _ = byte_ranks(path, ahead=False)
        self._specials, self._split = _special_strings(tokenizer(path))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" not in text:
            return self._segment(text)
        return b"".join(
            self._specials.get(x) or self._segment(x) for x in self._split.split(text) if x
        )

    def _segment(self, text: str) -> bytes:
        ranks = self._ahead if _BLANKS.search(text) else self._ranks
        return np.array(ranks(text), dtype="<u2").tobytes()


@functools.lru_cache(maxsize=2)
def byte_encoder(path: str) -> ByteEncoder:
    """For a byte-level vocabulary that keeps white space."""
    return ByteEncoder(path)


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> PieceEncoder:
    """For a lower-case vocabulary with word ends that drops white space."""
    return PieceEncoder(path, WORD_PATTERN, bare_chunks, _lowered)
