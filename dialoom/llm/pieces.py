"""Encoding of texts by their pieces, each of which the tokenizer sees once in a while.

A text is cut before every ASCII white space that follows a character of another kind, and between an ASCII letter
or digit and a mark after it. No token of the tokenizers used here spans such a place, and what follows it does not
depend on what came before, so the tokens of a text are those of its pieces. Marks that their special tokens
(`<|endoftext|>`) or contractions hold are no cuts. Cuts are found over the UTF-8 bytes of many texts at once, and Arrow numbers the distinct
pieces, so Python sees each of them once a slice. Pieces repeat far more than texts do: a worker keeps results, up
to a number of characters.

Half the time of encoding one word is spent around it. Where the model marks the last token of a word, pieces that
are one white space and letters are encoded many at a time, and parted after these marks. They are encoded one by
one unless there is a word for each piece, of as many bytes.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from typing import Generic, NamedTuple, TypeVar

import numpy as np
import pyarrow as pa

from dialoom.llm.common import text_bytes
from dialoom.llm.textbytes import WORD_SPACE

# Kinds of bytes: white space, letters and digits, marks before which a piece may start.
SPACE, WORD, MARK = 1, 2, 3
KIND = np.where(WORD_SPACE, SPACE, 0).astype(np.uint8)
KIND[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = WORD
KIND[[*b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~"]] = MARK

# The characters with the property White_Space beyond ASCII; fixed values.
WIDE_WHITE = (
    "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WIDE_WHITE_BYTES = {n: [int.from_bytes(c.encode()) for c in WIDE_WHITE if len(c.encode()) == n] for n in (2, 3)}
KEPT_CHARS = 8_000_000
TOGETHER = 64  # pieces encoded at a time
SPLIT_BYTES = 4 << 20

T = TypeVar("T")


def read_file(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


@lru_cache(maxsize=2)
def tokenizer(definition: str):
    """The tokenizer of a definition in JSON, made once for each worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
    from tokenizers import Tokenizer

    return Tokenizer.from_str(definition)


def _after_white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place, one of several bytes, is white space."""
    last = [data[np.maximum(at - n, 0)].astype(np.int64) for n in (1, 2, 3)]
    two = last[0] | last[1] << 8
    return np.isin(two, WIDE_WHITE_BYTES[2]) | np.isin(two | last[2] << 16, WIDE_WHITE_BYTES[3])


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pieces of rows of UTF-8 bytes start, in ascending order; every row that is not empty starts one."""
    kind = KIND[data]
    here, before = kind[1:], kind[:-1]
    start = np.zeros(len(data) + 1, bool)
    start[1:-1] = (here == SPACE) & (before != SPACE) | (here == MARK) & (before == WORD)
    at = np.flatnonzero(start[1:-1] & (data[:-1] >= 0x80)) + 1
    start[at] = ~_after_white(data, at)
    start[offsets] = True
    return np.flatnonzero(start[:-1])


class Split(NamedTuple):
    """Pieces of the rows of a column: row i has `pieces[numbers[j]]` for j from `rows[i]` to `rows[i + 1]`."""

    pieces: list[str]
    numbers: np.ndarray
    rows: np.ndarray


def split_column(column: pa.Array) -> Split:
    """The pieces of a column of texts, nulls being empty."""
    data, offsets = text_bytes(column)
    starts = piece_starts(data, offsets)
    bounds = np.append(starts, len(data))
    spans = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    numbered = spans.dictionary_encode()
    return Split(numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), np.asarray(numbered.indices), np.searchsorted(starts, offsets))


def pieces_of(text: str) -> list[str]:
    """The pieces of one text, in order."""
    split = split_column(pa.array([text], pa.string()))
    return [split.pieces[i] for i in split.numbers]


def word_ends(tokenizer) -> tuple[np.ndarray, np.ndarray] | None:
    """Whether the token of each id ends a word, and its bytes; None for a model that does not mark such tokens."""
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    if not suffix:
        return None
    vocabulary = tokenizer.get_vocab(with_added_tokens=False)
    ends = np.zeros(max([*vocabulary.values(), *tokenizer.get_added_tokens_decoder()]) + 1, bool)
    sizes = np.zeros(len(ends), np.int64)
    for token, i in vocabulary.items():
        ends[i] = token.endswith(suffix)
        sizes[i] = len(token) - len(suffix) * ends[i]  # a character for each byte
    return ends, sizes


def _is_word(piece: str) -> bool:
    return piece[:1] in " \n\r\t" and piece[1:].isalpha()


class Encoder(Generic[T]):
    """`reduce(ids)` for the pieces of texts. Results not asked for in the last KEPT_CHARS / 2 may be forgotten."""

    def __init__(self, definition: str, reduce: Callable[[Sequence[int]], T]):
        self.tokenizer = tokenizer(definition)
        self.ends = word_ends(self.tokenizer)
        self.reduce = reduce
        self.known: dict[str, T] = {}
        self.before: dict[str, T] = {}
        self.chars = 0

    def results(self, pieces: Iterable[str]) -> dict[str, T]:
        """Results by piece, for `pieces` and others."""
        if self.chars > KEPT_CHARS // 2:
            self.before, self.known, self.chars = self.known, {}, 0
        asked = set(pieces).difference(self.known)
        again = asked.intersection(self.before)
        self.known.update((piece, self.before[piece]) for piece in again)
        new = list(asked - again)
        if self.ends:
            words, new = [p for p in new if _is_word(p)], [p for p in new if not _is_word(p)]
            for group, ids in self._together(words):
                if ids:
                    self.known.update(zip(group, map(self.reduce, ids), strict=True))
                else:
                    new += group
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        self.known.update(zip(new, (self.reduce(e.ids) for e in found), strict=True))
        self.chars += sum(map(len, asked))
        return self.known

    def _together(self, words: list[str]) -> Iterator[tuple[list[str], list[Sequence[int]]]]:
        """Groups of pieces, and the ids of each piece, or none where the words found are not the pieces."""
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        found = self.tokenizer.encode_batch_fast(list(map("".join, groups)), add_special_tokens=False)
        ends, sizes = self.ends
        for group, encoding in zip(groups, found, strict=True):
            ids = array("I", encoding.ids)
            at = np.asarray(ids)
            bounds = np.append(0, np.flatnonzero(ends[at]) + 1)
            same = len(bounds) == len(group) + 1 and bounds[-1] == len(ids)
            same = same and np.add.reduceat(sizes[at], bounds[:-1]).tolist() == [len(p.encode()) - 1 for p in group]
            cuts = bounds.tolist()
            yield group, [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)] if same else []


@lru_cache(maxsize=2)
def encoder(definition: str, reduce: Callable[[Sequence[int]], T]) -> Encoder[T]:
    """The encoder of a worker process, which keeps its results from task to task."""
    return Encoder(definition, reduce)
