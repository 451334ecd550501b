"""Cutting texts where a byte-level BPE tokenizer cuts them anyway.

Such a tokenizer never merges across its pattern's matches, and a space between two
characters that are not white space always starts a new match.  Cutting there gives
pieces whose words can be encoded one by one, and equal words once; a column of texts
is cut and its distinct words found without a Python object per place.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: White space as any engine in use may understand it; a space next to it is no cut.
_WHITE = r"\t-\r\x1c-\x1f \x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff"
_CUT = re.compile(f"(?<=[^{_WHITE}]) (?=[^{_WHITE}])")
_RE2_WHITE = re.sub(r"\\u([0-9a-f]{4})", r"\\x{\1}", _WHITE)
_BESIDE = f"[{_RE2_WHITE}] | [{_RE2_WHITE}]"
#: Pieces that are plainly one word, or one and a mark; the pattern is matched on the others.
_LATIN = r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{17F}]+"
_ONE, _TWO = rf"\A ?{_LATIN}\z", rf"\A ?{_LATIN}[.,]\z"

# The pattern of byte-level BPE (fixed value), with its white space spelled out.
_S = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORDS = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


def cut(text: str) -> list[str]:
    """Pieces of a text without the space they are cut at: all but the first begin with one."""
    return _CUT.split(text)


def cut_column(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct pieces of a column, the piece at each place, and the number of pieces of each text.

    A null text counts as empty; every text has a piece at least.
    """
    texts = pc.fill_null(texts, "")
    parts = pc.split_pattern(texts, " ")
    beside = np.flatnonzero(pc.match_substring_regex(texts, _BESIDE).to_numpy(zero_copy_only=False))
    if len(beside):  # texts with spaces that are no cuts
        rest = np.ones(len(texts), bool)
        rest[beside] = False
        slow = pa.array([cut(texts[int(i)].as_py()) for i in beside], parts.type)
        back = np.empty(len(texts), np.int64)
        back[np.concatenate([np.flatnonzero(rest), beside])] = np.arange(len(texts))
        parts = pa.concat_arrays([parts.filter(pa.array(rest)), slow]).take(pa.array(back))
    coded = parts.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), parts.value_lengths().to_numpy().astype(np.int64)


def words_column(pieces: pa.Array, special: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of pieces, the words of all pieces in order (as places), and each piece's number of words.

    A string in ``special`` is a word of its own wherever it occurs.
    """
    one = pc.match_substring_regex(pieces, _ONE).to_numpy(zero_copy_only=False)
    two = pc.match_substring_regex(pieces, _TWO).to_numpy(zero_copy_only=False)
    rest = np.flatnonzero(~one & ~two)
    others = pieces.take(pa.array(rest)).to_pylist()
    found = [WORDS.findall(p) for p in others]
    if special:
        breaks = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
        for i in [i for i, p in enumerate(others) if any(x in p for x in special)]:
            found[i] = [w for k, run in enumerate(breaks.split(others[i])) for w in ([run] if k % 2 else WORDS.findall(run))]
    marked = pieces.filter(pa.array(two))
    count = np.where(two, 2, 1)
    count[rest] = [len(w) for w in found]
    start = np.cumsum(count) - count
    coded = pa.concat_arrays([
        pieces.filter(pa.array(one)), pc.utf8_slice_codeunits(marked, 0, -1), pc.utf8_slice_codeunits(marked, -1),
        pa.array([w for ws in found for w in ws], pieces.type)]).dictionary_encode()
    begins, n = start[rest], count[rest]
    place = np.concatenate([start[one], start[two], start[two] + 1,
                            np.repeat(begins - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))])
    words = np.empty(int(count.sum()), np.int64)
    words[place] = coded.indices.to_numpy()
    return coded.dictionary.to_pylist(), words, count


def gather(values: np.ndarray, length: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``values`` (one of each ``length`` after another) picked by ``rows``, and their lengths."""
    n = length[rows]
    stop = np.cumsum(n)
    start = (np.cumsum(length) - length)[rows]
    return values[np.repeat(start - (stop - n), n) + np.arange(int(stop[-1]) if len(stop) else 0)], n


class Memo:
    """Encoded words a worker keeps.  Past ``most`` (words, and 64 characters each) it forgets those
    that were asked for once."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int):
        self.encode, self.most = encode, most
        self.known: dict[str, bytes] = {}
        self.again: set[str] = set()
        self.weight = 0.0

    def of(self, words: list[str]) -> list[bytes]:
        if self.weight > self.most:
            self.known = {w: self.known[w] for w in self.again} if 2 * len(self.again) < self.most else {}
            self.again = set()
            self.weight = len(self.known) + sum(map(len, self.known)) / 64
        known = self.known
        new = [w for w in words if w not in known]
        self.again.update(known.keys() & words)
        known.update(zip(new, self.encode(new)))
        self.weight += len(new) + sum(map(len, new)) / 64
        return [known[w] for w in words]


class ColumnEncoder:
    """Ids of columns of texts from a function that encodes words to little-endian numbers."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], kind: str, special: list[str], most: int):
        self.kind, self.special, self.memo = np.dtype(kind), special, Memo(encode, most)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        if not len(texts):
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        gc.disable()  # the many small lists made here hold no cycles to look for
        try:
            return self._ids(texts)
        finally:
            gc.enable()

    def _ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces, codes, size = cut_column(texts)
        begins = np.cumsum(size) - size
        first = np.zeros(len(codes), bool)
        first[begins] = True
        used = [np.unique(codes[first]), np.unique(codes[~first])]
        row = np.zeros((2, len(pieces)), np.int64)
        row[0, used[0]] = np.arange(len(used[0]))
        row[1, used[1]] = np.arange(len(used[1])) + len(used[0])
        whole = pa.concat_arrays([pieces.take(pa.array(used[0])),
                                  pc.binary_join_element_wise("", pieces.take(pa.array(used[1])), " ")])
        names, words, count = words_column(whole, self.special)
        raw = self.memo.of(names)
        length = np.array([len(x) for x in raw], np.int64) // self.kind.itemsize
        ids, n = gather(np.frombuffer(b"".join(raw), self.kind), length, words)
        total = np.concatenate([[0], np.cumsum(n)])
        stop = np.cumsum(count)
        ids, n = gather(ids, total[stop] - total[stop - count], row[np.where(first, 0, 1), codes])
        return ids, np.add.reduceat(n, begins)
