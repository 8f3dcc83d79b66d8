"""Token ids of whole texts, as the ``tokenizers`` library gives them, through a table of words.

A byte-level BPE first cuts a text into words. No word reaches over the border between a character that is not white space
and a following blank or newline, nor from a letter to an ASCII sign (but the apostrophe). Texts are cut there, in whole
batches; each different word is encoded once by the library and kept in a table of bounded size. A word is found by a hash and told
by its bytes: it is compared with the word that the hash stands for, in the batch and in the table, and texts that hold another
word of the same hash are encoded by themselves. So are texts with words of more than ``LONG`` bytes, and those in which
borders aren't sure (runs of white space, other white space, special strings). A text of more than ``BIG`` bytes is encoded in
blocks of about ``BLOCK`` bytes, cut where white space follows another character.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from leadflow.llm import common as C

#: A run of blanks and newlines with what follows it, or such a run at the end.
_PIECE = re.compile(r"[ \n]*[^ \n]+|[ \n]+\Z")
#: White space other than blank and newline: then only borders after printable ASCII are sure.
_ODD = re.compile("[^\\S \n]|\u180e")
_SURE = re.compile(r"(?<=[!-~])(?=[ \n])")
#: Most words that a worker keeps (some 40 bytes each), and most bytes of them.
TABLE_WORDS = 2_500_000
TABLE_BYTES = 64 << 20
#: Longer words aren't kept.
LONG = 256
BIG, BLOCK = 1 << 20, 1 << 18

_GAP = np.zeros(256, bool)
_GAP[[10, 32]] = True
#: Bytes that make a text odd: other ASCII white space and control signs. First bytes of wider white space are looked at closer.
_CONTROL = np.zeros(256, bool)
_CONTROL[[*range(0, 10), *range(11, 32), 127]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[x for x in range(33, 127) if not chr(x).isalnum() and x != 39]] = True
# Unicode's white space beyond ASCII (and U+180E, which once was) in UTF-8.
_WIDE = [chr(x).encode() for x in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def pieces(text: str) -> list[str]:
    """The text cut at borders that no word of the tokenizer crosses; joined, they are the text."""
    return _SURE.split(text) if _ODD.search(text) else _PIECE.findall(text)


def unsure(body: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True for rows in which white space isn't single blanks and newlines between words, or a special string may stand."""
    n = len(body)
    gap = _GAP[body]
    bad = _CONTROL[body]
    bad[1:] |= gap[1:] & gap[:-1]
    bad[:-1] |= (body[:-1] == 60) & (body[1:] == 124)  # "<|"
    lead = np.flatnonzero((body == 0xC2) | ((body >= 0xE1) & (body <= 0xE3)))
    if len(lead):
        wide = np.zeros(len(lead), bool)
        for w in _WIDE:
            at = lead + len(w) <= n
            for k, x in enumerate(w):
                at[at] = body[lead[at] + k] == x
            wide |= at
        bad[lead[wide]] = True
    filled = offsets[1:] > offsets[:-1]
    bad[offsets[:-1][filled]] |= gap[offsets[:-1][filled]]
    bad[offsets[1:][filled] - 1] |= gap[offsets[1:][filled] - 1]
    seen = np.concatenate([[0], np.cumsum(bad)])
    return seen[offsets[1:]] > seen[offsets[:-1]]


_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def eights(body: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros behind the end."""
    padded = np.zeros(len(body) + 8, np.uint8)
    padded[: len(body)] = body
    return np.ndarray((len(body) + 1,), "<u8", padded, 0, (1,))


def equal_spans(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether spans of ``size`` bytes hold the same bytes; ``a`` and ``b`` as ``eights`` gives them."""
    same = np.ones(len(size), bool)
    at, done = np.arange(len(size)), 0
    while len(at):
        left = size[at] - done
        same[at] &= ((a[a_at[at] + done] ^ b[b_at[at] + done]) & _MASK[np.clip(left, 0, 8)]) == 0
        at, done = at[left > 8], done + 8
    return same


class Table:
    """Ids of words by hash, and the words' bytes: a sorted part, and a small recent one that is merged into it now and then."""

    def __init__(self) -> None:
        self.parts = [self._empty(), self._empty()]
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.words = np.zeros(1 << 16, np.uint8)
        self.filled = 0

    @staticmethod
    def _empty() -> list[np.ndarray]:
        """Hashes; starts and numbers of ids; starts, sizes and leading gaps of words."""
        return [np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint8)]

    def find(self, keys: np.ndarray, body: np.ndarray, at: np.ndarray, sizes: np.ndarray, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start in ``flat``, number of ids) of words of ``sizes`` bytes at ``at`` of ``body`` (as ``eights``); start is -1 for
        a word that isn't there, -2 where another word has its hash."""
        start, size = np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        # a copy of the bytes and eight zeros: reading behind the end is safe
        words = np.ndarray((len(self.words) - 7,), "<u8", self.words, 0, (1,))
        for have, begin, length, place, width, gap in self.parts:
            if len(have):
                k = np.minimum(np.searchsorted(have, keys), len(have) - 1)
                hit = np.flatnonzero(have[k] == keys)
                k = k[hit]
                same = (width[k] == sizes[hit]) & (gap[k] == lead[hit])
                same[same] = equal_spans(words, place[k[same]], body, at[hit[same]], sizes[hit[same]])
                start[hit], size[hit] = np.where(same, begin[k], -2), np.where(same, length[k], 0)
        return start, size

    def add(self, keys: np.ndarray, words: list[bytes], lead: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Starts of new words, given in the order of their hashes, whose ids follow each other in ``ids``."""
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(len(self.flat), len(ids)), np.uint32)])
        begin = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        joined = np.frombuffer(b"".join(words), np.uint8)
        if self.filled + len(joined) + 8 > len(self.words):
            self.words = np.concatenate([self.words[: self.filled], np.zeros(max(len(self.words), len(joined) + 8), np.uint8)])
        width = np.array([len(w) for w in words], np.int64)
        place = self.filled + np.cumsum(width) - width
        self.words[self.filled : self.filled + len(joined)] = joined
        self.filled += len(joined)
        self.parts[1] = self._merge(self.parts[1], [keys, begin, lengths.astype(np.int32), place, width.astype(np.int32), lead.astype(np.uint8)])
        if len(self.parts[1][0]) > 100_000:
            self.parts = [self._merge(*self.parts), self._empty()]
        return begin

    @staticmethod
    def _merge(one: list[np.ndarray], two: list[np.ndarray]) -> list[np.ndarray]:
        at = np.searchsorted(one[0], two[0])
        return [np.insert(a, at, b) for a, b in zip(one, two, strict=True)]

    def __len__(self) -> int:
        return len(self.parts[0][0]) + len(self.parts[1][0])


class Encoder:
    """Ids of the texts of Arrow columns."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.table = Tokenizer.from_file(path), Table()
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.newline = self._ids("\n")
        if len(self.newline) != 1 or any(self._ids(f"a\n{x}").tolist() != [*self._ids("a").tolist(), *self.newline.tolist(), *self._ids(x).tolist()] for x in ("b", " b")):
            raise ValueError("not a byte-level vocabulary in which a newline between words is an id of its own")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def alone(self, text: str) -> np.ndarray:
        """Ids of a text cut at sure borders only."""
        got = self.tokenizer.encode_batch_fast(pieces(text), add_special_tokens=False)
        return np.array([x for e in got for x in e.ids], "<u4")

    def words(self, words: list[str], most: int = 4096) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number by word) of words without newlines and white space at their end: lines of one text."""
        ids, lengths = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for low in range(0, len(words), most):
            got = self._ids("\n".join(words[low : low + most]))
            part = got == self.newline[0]
            cut = np.flatnonzero(part)
            if len(cut) != len(words[low : low + most]) - 1:
                raise ValueError("a newline did not part two words")
            ids.append(got[~part])
            lengths.append(np.diff(np.concatenate([[-1], cut, [len(got)]])) - 1)
        return np.concatenate(ids), np.concatenate(lengths)

    def _found(self, body: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start in the table's ids, length, n+1 row offsets) of each word of the rows that aren't odd.

        Rows with words that are too long, or that share a hash with other words, become odd.
        """
        n = len(body)
        gap = _GAP[body]
        begin = np.zeros(n, bool)
        begin[1:] = gap[:-1]
        letter = _LETTER[body]
        if n > 1:  # accented Latin letters, but the times and division signs
            letter[1:] |= (body[:-1] == 0xC3) & (body[1:] >= 0x80) & (body[1:] != 0x97) & (body[1:] != 0xB7)
        begin[1:] |= letter[:-1] & _SIGN[body[1:]]
        begin[offsets[:-1][offsets[:-1] < n]] = True
        if odd.any():
            begin &= ~np.repeat(odd, np.diff(offsets))
        starts = np.flatnonzero(begin)
        rows = np.searchsorted(starts, offsets)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), rows
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(rows))
        ends = np.minimum(np.append(starts[1:], n), offsets[1:][row])
        ends -= gap[ends - 1]  # a word ends before the gap
        # 0: no gap before it, 10 or 32: that one
        before = np.where((starts > offsets[:-1][row]) & gap[np.maximum(starts - 1, 0)], body[np.maximum(starts - 1, 0)], 0)
        keys = C.span_hashes(body, starts, ends) + before.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        sizes = ends - starts
        keys, first, place = np.unique(keys, return_index=True, return_inverse=True)
        loads = eights(body)
        # a hash stands for its first word here: all others must be that word
        one = first[place]
        other = (sizes != sizes[one]) | (before != before[one]) | (sizes > LONG)
        same = np.flatnonzero(~other)
        other[same] = ~equal_spans(loads, starts[same], loads, starts[one[same]], sizes[same])
        start, size = self.table.find(keys, loads, starts[first], sizes[first], before[first])
        other |= (start == -2)[place]
        if other.any():
            odd[row[other]] = True
            return self._found(body, offsets, odd)
        new = np.flatnonzero(start < 0)
        if len(new):
            if len(self.table) + len(new) > TABLE_WORDS or self.table.filled + int(sizes[first[new]].sum()) > TABLE_BYTES:
                self.table = Table()
                new = np.arange(len(keys))
            at = first[new]
            raw = body.tobytes()
            words = [raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]
            lead = before[at]
            ids, lengths = self.words([f" {w.decode()}" if x == 32 else w.decode() for w, x in zip(words, lead.tolist(), strict=True)])
            if (lead == 10).any():  # the newline is a word of its own before them
                where = (np.cumsum(lengths) - lengths)[lead == 10]
                ids = np.insert(ids, where, self.newline[0])
                lengths = lengths + (lead == 10)
            start[new], size[new] = self.table.add(keys[new], words, lead, ids, lengths), lengths
        return start[place], size[place], rows

    def counts(self, column: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        body, offsets = C.text_bytes(column)
        sizes = np.diff(offsets)
        if (sizes > BIG).any():
            out = np.zeros(len(sizes), np.int64)
            small = np.flatnonzero(sizes <= BIG)
            out[small] = self.counts(column.take(pa.array(small)))
            for k in np.flatnonzero(sizes > BIG):
                out[k] = sum(len(self.alone(t)) for t in blocks(body[offsets[k] : offsets[k + 1]]))
            return out
        odd = unsure(body, offsets)
        _, size, rows = self._found(body, offsets, odd)
        sums = np.concatenate([[0], np.cumsum(size)])
        out = sums[rows[1:]] - sums[rows[:-1]]
        for k in np.flatnonzero(odd):
            out[k] = len(self.alone(column[int(k)].as_py()))
        return out

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, n+1 offsets of the texts)."""
        body, offsets = C.text_bytes(column)
        sizes = np.diff(offsets)
        if (sizes > BIG).any():
            small = np.flatnonzero(sizes <= BIG)
            some, cut = self.ids(column.take(pa.array(small)))
            each: list[np.ndarray] = [np.zeros(0, "<u4")] * len(sizes)
            for k, a, b in zip(small.tolist(), cut[:-1], cut[1:], strict=True):
                each[k] = some[a:b]
            for k in np.flatnonzero(sizes > BIG):
                each[k] = np.concatenate([self.alone(t) for t in blocks(body[offsets[k] : offsets[k + 1]])])
            return np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])
        odd = unsure(body, offsets)
        start, size, rows = self._found(body, offsets, odd)
        total = int(size.sum())
        ids = self.table.flat[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(total)]
        sums = np.concatenate([[0], np.cumsum(size)])
        at = sums[rows]
        if not odd.any():
            return ids, at
        each = [self.alone(column[k].as_py()) if odd[k] else ids[at[k] : at[k + 1]] for k in range(len(odd))]
        return np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])


def blocks(body: np.ndarray, size: int | None = None) -> Iterator[str]:
    """A text's bytes in blocks of about ``size``, each but the first begun by a blank or newline behind another character.

    Where there is no such place in sight a block is longer.
    """
    size, low, n = size or BLOCK, 0, len(body)
    while low < n:
        high, look = min(n, low + size), min(n, low + size)
        while look < n:
            # the first gap from here on that follows a character which isn't white space
            part = body[look : look + size]
            here = np.flatnonzero(_GAP[part])
            here = next((int(look + k) for k in here if _word_ends(body, int(look + k))), None)
            if here is not None:
                high = here
                break
            look = high = min(n, look + size)
        yield body[low:high].tobytes().decode()
        low = high


def _word_ends(body: np.ndarray, at: int) -> bool:
    """Whether the character before ``at`` is no white space."""
    if body[at - 1] < 128:
        return 32 < body[at - 1] < 127
    return not body[max(0, at - 4) : at].tobytes().endswith(tuple(_WIDE))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_vocabulary() -> str:
    """Path of the vocabulary file that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
