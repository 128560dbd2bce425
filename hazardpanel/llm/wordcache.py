"""Whole texts encoded word by word, with the library's result.

A single space between two characters that are no white space is a place where
the tokenizers used here always cut: the byte-level one starts a pre-token at
such a space, the piece model has no piece with the space mark after another
character (checked when it is loaded).  So a text's ids are the ids of the parts
between those spaces.  The parts of a whole buffer of texts are told apart by
Arrow, each distinct one is looked up or encoded once, and the ids of all texts
are put together from them by array operations.  For the byte-level tokenizer,
which never joins a letter with the punctuation after it, the punctuation at the
end of a part is a part of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from hazardpanel.llm.common import text_buffers

#: Memory of the parts kept per worker; beyond it the cache starts anew.
CACHE_BYTES = 32 << 20
#: What a kept part takes beside its characters and ids.
ENTRY_BYTES = 12
LONGEST = 48
#: Punctuation split off at most.
LONGEST_TAIL = 16
HEAD, CORE, TAIL_PART = 0, 1, 2
#: Bytes of text that are put together at once.
WINDOW = 8 << 20
#: What a part must neither begin nor end with (an empty part does both).
EDGE = frozenset(["", *(chr(i) for i in range(0x3001) if chr(i).isspace())])
Ids = tuple[np.ndarray, np.ndarray]         # ids of several texts one after the other, and how many each has

SOLID = np.zeros(256, bool)             # bytes that may stand beside a cut
SOLID[[*range(0x21, 0x7F), *range(0x80, 0x100)]] = True
#: First and second bytes of the white space outside ASCII (and of other characters, where a text is then not cut).
OPENS, GOES_ON, TWO = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
#: ASCII letters, and punctuation that the byte-level tokenizer separates from a letter before it (an apostrophe may join).
LETTER, TAIL = np.zeros(256, bool), np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
TAIL[list(b".,;:!?%&$#*|()\"-")] = True
OPENS[[0xE1, 0xE2, 0xE3]] = GOES_ON[[0x80, 0x81, 0x9A]] = TWO[[0x85, 0xA0]] = True


def flat(lists: list[list[int]]) -> Ids:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes


def gather(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of ``values`` with these starts and sizes, one after the other."""
    done = np.cumsum(size)
    return values[np.arange(done[-1]) + np.repeat(start - (done - size), size)] if len(done) else values[:0]


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places of the spaces at which the texts of a buffer are cut, ascending."""
    at = np.flatnonzero(data == 0x20)
    if not len(at):
        return at
    padded = np.concatenate((np.zeros(3, np.uint8), data, np.zeros(2, np.uint8)))
    before3, before2, before, after, after2 = (padded[at + k] for k in (0, 1, 2, 4, 5))
    wide_before = (OPENS[before3] & GOES_ON[before2]) | ((before2 == 0xC2) & TWO[before])
    wide_after = (OPENS[after] & GOES_ON[after2]) | ((after == 0xC2) & TWO[after2])
    text = np.searchsorted(offsets, at, side="right")
    inner = (at > offsets[text - 1]) & (at + 1 < offsets[text])
    return at[inner & SOLID[before] & SOLID[after] & ~wide_before & ~wide_after]


def tails(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Where the punctuation after a letter begins that ends each part [begin, end);
    ``end`` where there is none."""
    at = end.copy()
    for _ in range(LONGEST_TAIL):
        back = (at > begin) & TAIL[data[np.maximum(at - 1, 0)]]
        if not back.any():
            break
        at -= back
    before, before2 = data[np.maximum(at - 1, 0)], data[np.maximum(at - 2, 0)]
    # a letter of the Latin-1 block is 0xC3 and a byte that is not that of the times or division sign
    letter = LETTER[before] | ((before2 == 0xC3) & (before >= 0x80) & (before != 0x97) & (before != 0xB7) & (at - begin > 1))
    return np.where((at > begin) & (at < end) & letter, at, end)


class WordCache:
    def __init__(self, whole_texts: Callable[[list[str]], Ids], after_space: Callable[[list[str]], Ids], never_cut: str = "",
                 split_tails: bool = False, limit: int = CACHE_BYTES):
        """``whole_texts`` encodes texts, ``after_space`` parts as they are encoded
        after a space.  ``never_cut``: a character whose texts are never cut.
        ``split_tails``: punctuation at the end of a part is encoded like a text."""
        self.whole_texts, self.after_space, self.never_cut, self.split_tails, self.limit = whole_texts, after_space, never_cut.encode(), split_tails, limit
        self._empty()

    def _empty(self) -> None:
        self.parts, self.ids, self.start, self.size = pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    @property
    def held(self) -> int:
        return self.parts.nbytes + self.ids.nbytes + self.start.nbytes + self.size.nbytes

    def lookup(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct parts that follow a space: all ids, and each part's first and number of them."""
        at = pc.index_in(parts, value_set=self.parts)
        known = at.is_valid().to_numpy(zero_copy_only=False)
        missing = parts.filter(pa.array(~known))
        fresh, sizes = self.after_space(missing.to_pylist())
        ids = np.concatenate((self.ids, fresh))
        start, size = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        place = at.drop_null().to_numpy()
        start[known], size[known] = self.start[place], self.size[place]
        start[~known], size[~known] = len(self.ids) + np.cumsum(sizes) - sizes, sizes
        short = pc.less_equal(pc.binary_length(missing), LONGEST).to_numpy(zero_copy_only=False)
        kept = missing.filter(pa.array(short))
        kept_ids = gather(fresh, np.cumsum(sizes)[short] - sizes[short], sizes[short])
        if self.held + kept.nbytes + kept_ids.nbytes + ENTRY_BYTES * len(kept) > self.limit:
            self._empty()
        if kept.nbytes + kept_ids.nbytes + ENTRY_BYTES * len(kept) <= self.limit:
            own = sizes[short]
            self.start = np.concatenate((self.start, len(self.ids) + np.cumsum(own) - own)).astype(np.int32)
            self.size = np.concatenate((self.size, own)).astype(np.int32)
            self.parts, self.ids = pa.concat_arrays([self.parts, kept]), np.concatenate((self.ids, kept_ids))
        return ids, start, size

    def encode_buffer(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a buffer, one after the other, and where each text's
        end.  A text longer than a window is encoded in pieces that begin at cuts."""
        if len(data) <= WINDOW:
            return self._encode(data, offsets)
        row, rows, out, ends, done = 0, len(offsets) - 1, [], [], 0
        while row < rows:
            stop = max(int(np.searchsorted(offsets, offsets[row] + WINDOW, side="right")) - 1, row + 1)
            if stop > row + 1 or offsets[stop] - offsets[row] <= WINDOW:
                ids, own = self._encode(data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row])
                out.append(ids)
                ends.append(own + done)
                done += len(ids)
            else:
                for goes_on, piece in self._pieces(data[offsets[row]:offsets[stop]]):
                    out.append(self._encode(piece, np.array([0, len(piece)]), goes_on)[0])
                    done += len(out[-1])
                ends.append(np.array([done]))
            row = stop
        return np.concatenate(out), np.concatenate(ends)

    def _pieces(self, text: np.ndarray) -> Iterator[tuple[bool, np.ndarray]]:
        if self.never_cut and self.never_cut in text.tobytes():
            yield False, text
            return
        at = 0
        while at < len(text):
            stop, size = len(text), WINDOW
            while at + size < len(text):
                found = cuts(text[at:at + size], np.array([0, size]))
                if len(found):
                    stop = at + int(found[-1])
                    break
                size *= 2
            yield at > 0, text[at:stop]
            at = stop + 1

    def _encode(self, data: np.ndarray, offsets: np.ndarray, goes_on: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """``goes_on``: the first text begins after a cut."""
        n = len(offsets) - 1
        if not n:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        cut = cuts(data, offsets)
        if self.never_cut and self.never_cut in (raw := data.tobytes()):
            whole = np.array([self.never_cut in raw[a:b] for a, b in zip(offsets.tolist(), offsets[1:].tolist())])
            cut = cut[~whole[np.searchsorted(offsets, cut, side="right") - 1]]
        # parts in order: a text's first begins where it does, the others after a cut
        heads = np.searchsorted(cut, offsets[:-1]) + np.arange(n)
        last = np.append(heads[1:], n + len(cut)) - 1
        opens, closes = np.zeros(n + len(cut), bool), np.zeros(n + len(cut), bool)
        opens[heads] = closes[last] = True
        begin, end = np.empty(len(opens), np.int64), np.empty(len(opens), np.int64)
        begin[opens], begin[~opens], end[closes], end[~closes] = offsets[:-1], cut + 1, offsets[1:], cut
        if goes_on:
            opens[0] = False
        kind = np.where(opens, HEAD, CORE).astype(np.uint8)
        if self.split_tails and len(data):
            tail = np.where(opens, end, tails(data, begin, end))
            split = tail < end
            place = np.repeat(np.arange(len(begin)), 1 + split)
            second = np.concatenate(([False], place[1:] == place[:-1]))
            last = np.cumsum(1 + split)[last] - 1
            begin, end, kind = np.where(second, tail[place], begin[place]), np.where(second, end[place], tail[place]), np.where(second, TAIL_PART, kind[place])
        solid = np.ones(len(data), bool)
        solid[cut] = False
        edge = np.concatenate(([0], np.cumsum(end - begin))).astype(np.int32)
        parts = pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(edge), pa.py_buffer(data[solid])])
        del solid, edge
        start, size = np.empty(len(begin), np.int64), np.empty(len(begin), np.int64)
        coded = parts.filter(pa.array(kind == CORE)).dictionary_encode()
        ids, first, count = self.lookup(coded.dictionary)
        code = coded.indices.to_numpy()
        start[kind == CORE], size[kind == CORE] = first[code], count[code]
        own, count = self.whole_texts(parts.filter(pa.array(kind == HEAD)).to_pylist())
        start[kind == HEAD], size[kind == HEAD] = len(ids) + np.cumsum(count) - count, count
        ids = np.concatenate((ids, own))
        if self.split_tails:
            coded = parts.filter(pa.array(kind == TAIL_PART)).dictionary_encode()
            own, count = self.whole_texts(coded.dictionary.to_pylist())
            code = coded.indices.to_numpy()
            start[kind == TAIL_PART], size[kind == TAIL_PART] = (len(ids) + np.cumsum(count) - count)[code], count[code]
            ids = np.concatenate((ids, own))
        return gather(ids, start, size), np.cumsum(size)[last]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        ids, ends = self.encode_buffer(*text_buffers(pa.array(texts, pa.string())))
        return np.split(ids, ends[:-1])
