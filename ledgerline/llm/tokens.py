"""Token ids of many texts with the tokenizers library.

Both tokenizers used here cut a text at white space before they merge
anything, so the ids of a text are those of its chunks in order (a chunk is a
word, with the space before it where the tokenizer keeps that).  Chunks repeat
endlessly in a corpus, so each distinct one is encoded once per worker while a
bounded table has room.  Texts with rarer kinds of white space, where library
and Python could cut differently, are encoded whole.

New chunks are given to the library many in one text, as a call costs more than
a word.  The ids are cut apart by what the vocabulary marks: the first token of
a chunk that begins with its space, or the last one of each word.  Chunks whose
number of marks isn't plain beforehand, and texts whose marks don't add up, are
encoded one by one.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np

# Code points that some libraries, but not all, treat as white space or zero width.
_RARE = ((0x1C, 0x1F), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x180E, 0x180E), (0x2000, 0x200D),
         (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x2060), (0x3000, 0x3000), (0xFEFF, 0xFEFF))
RARE_SPACE = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _RARE) + "]")
_SPACED = re.compile(r" ?\S+|\s+(?!\S)|\s+")
CHUNKS = 1_000_000  # distinct chunks that a worker remembers
SLICE = 2_000_000  # characters handled at once

# Vocabulary sizes of the public tokenizer files.
BYTE_BPE, BYTE_BPE_IDS = "byte_bpe_50k.json", 50_257
WORD_BPE, WORD_BPE_IDS = "word_bpe_49k.json", 49_408


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def spaced_chunks(text: str) -> list[str]:
    """For tokenizers that keep white space."""
    return _SPACED.findall(text)


def words(text: str) -> list[str]:
    """For tokenizers that drop white space."""
    return text.split()


JOINED = 256  # chunks in one text
_MARKS = ".,;:!?"


def _plain_words(chunk: str) -> int:
    """How many words (1 or 2) a tokenizer sees in a chunk of letters, or of
    letters and one mark; 0: not known."""
    low = chunk.lower()
    if len(low) != len(chunk):
        return 0
    if low.isalpha():
        return 1
    return 2 if low[-1] in _MARKS and low[:-1].isalpha() else 0


def _spaced(chunk: str) -> int:
    return int(len(chunk) > 1 and chunk[0] == " " and chunk[1] != " ")


class _Joined:
    """Ids of chunks, encoded many in one text and cut at marked ids."""

    def __init__(self, ids: Callable[[list[str]], list[list[int]]], marked: np.ndarray, at_end: bool) -> None:
        self._ids, self._marked, self._at_end = ids, marked, at_end
        self._count, self._between = (_plain_words, " ") if at_end else (_spaced, "")

    def __call__(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids in a row, and where each chunk's begin and how many it has."""
        marks = np.fromiter(map(self._count, chunks), np.int64, len(chunks))
        easy, hard = np.flatnonzero(marks), [np.flatnonzero(marks == 0)]
        groups = [easy[i:i + JOINED] for i in range(0, len(easy), JOINED)]
        begin, sizes, flat, held = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64), [np.zeros(0, np.uint32)], 0
        for g, own in zip(groups, self._ids([self._between.join([chunks[i] for i in g.tolist()]) for g in groups])):
            ids = np.array(own, np.uint32)
            at, wanted = np.flatnonzero(self._marked[ids]), marks[g]
            if len(at) != wanted.sum():
                hard.append(g)
                continue
            ends = at[np.cumsum(wanted) - 1] + 1 if self._at_end else np.append(at[1:], len(ids))
            if ends[-1] != len(ids) or not (self._at_end or at[0] == 0):
                hard.append(g)
                continue
            begin[g] = held + np.append(0, ends[:-1])
            sizes[g] = np.diff(ends, prepend=0)
            flat.append(ids)
            held += len(ids)
        rest = np.concatenate(hard)
        alone = self._ids([chunks[i] for i in rest.tolist()])
        sizes[rest] = list(map(len, alone))
        begin[rest] = held + np.cumsum(sizes[rest]) - sizes[rest]
        flat.append(np.fromiter(chain.from_iterable(alone), np.uint32, int(sizes[rest].sum())))
        return np.concatenate(flat), begin, sizes


def lower_words(text: str) -> list[str]:
    """For tokenizers that drop white space and case."""
    return text.lower().split() if text.isascii() else text.split()


class _Table(dict):
    """Chunk to its number; a new chunk gets the next one."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = at = len(self)
        self.new.append(chunk)
        return at


def appended(room: np.ndarray, held: int, more: np.ndarray) -> np.ndarray:
    """``room`` with ``more`` after its first ``held`` entries; it doubles
    when it is full, so appending costs what is appended."""
    if held + len(more) > len(room):
        room = np.concatenate([room[:held], np.zeros(max(held, 2 * len(more), 1024), room.dtype)])
    room[held:held + len(more)] = more
    return room


class Encoder:
    """``ids`` encodes a list of strings; ``cut`` divides a text into chunks
    that can be encoded apart; texts that ``whole`` finds are not divided."""

    def __init__(self, ids: Callable[[list[str]], list[list[int]]], cut: Callable[[str], list[str]],
                 whole: re.Pattern | None = None, chunks: int = CHUNKS, joined: _Joined | None = None) -> None:
        self._ids, self._cut, self._whole, self._room, self._joined = ids, cut, whole, chunks, joined
        self._clear()

    def _clear(self) -> None:
        self._table = _Table()
        self._flat, self._start, self._size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._ids_held = self._held = 0  # the arrays have room beyond these

    def _learn(self) -> None:
        if self._joined:
            flat, begin, sizes = self._joined(self._table.new)
        else:
            ids = self._ids(self._table.new)
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat, begin = np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), np.cumsum(sizes) - sizes
        self._start = appended(self._start, self._held, self._ids_held + begin)
        self._size = appended(self._size, self._held, sizes)
        self._flat = appended(self._flat, self._ids_held, flat)
        self._held, self._ids_held = self._held + len(sizes), self._ids_held + len(flat)
        self._table.new = []

    def numbers(self, chunks: Iterable[str], n: int) -> np.ndarray:
        """The numbers of ``n`` chunks, valid until the next call."""
        if len(self._table) > self._room:
            self._clear()
        at = np.fromiter(map(self._table.__getitem__, chunks), np.int64, n)
        if self._table.new:
            self._learn()
        return at

    def ids_of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered chunks in a row, and how many each has."""
        sizes = self._size[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self._flat[np.repeat(self._start[at] - ends + sizes, sizes) + np.arange(total)], sizes

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row (uint32), and the number of ids of each text."""
        cut = [[] if self._whole and self._whole.search(t) else self._cut(t) for t in texts]
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        ids, sizes = self.ids_of(self.numbers(chain.from_iterable(cut), int(counts.sum())))
        edges = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        sizes = np.diff(edges)
        rare = [i for i, t in enumerate(texts) if not cut[i] and t]
        if rare:
            parts = np.split(ids, edges[1:-1])
            for i, own in zip(rare, self._ids([texts[i] for i in rare])):
                parts[i] = np.array(own, np.uint32)
            ids, sizes = np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))
        return ids, sizes

    def encode_with_end(self, texts: Sequence[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``, with ``end_id`` after each text."""
        ids, sizes = self.encode(texts)
        return np.insert(ids, np.cumsum(sizes), np.uint32(end_id)), sizes + 1


@cache
def library_encoder(path: str, cut: Callable[[str], list[str]]) -> Encoder:
    """One per worker process, so that what it learnt serves the next task."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

    def ids(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    vocabulary = tokenizer.get_vocab()
    marked, at_end = np.zeros(max(vocabulary.values()) + 1, bool), any(t.endswith("</w>") for t in vocabulary)
    for token, at in vocabulary.items():
        marked[at] = token.endswith("</w>") if at_end else token.startswith("\u0120")  # how byte-level files write a space
    fits = marked.any() and (cut is spaced_chunks) != at_end
    return Encoder(ids, cut, RARE_SPACE, joined=_Joined(ids, marked, at_end) if fits else None)


def slices(texts: Sequence[str], limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` characters, one text at least."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)
