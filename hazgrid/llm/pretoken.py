"""Cutting texts into the pieces that byte-level BPE merges inside of."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: The white space of Unicode, and the pieces in the order they are tried.
BLANK = r"\t-\r \x85\xa0  -     　"
_PIECES = r"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{digit}]+| ?[^{blank}{letter}{digit}]+|[{blank}]+(?![^{blank}])|[{blank}]+"

#: Texts of ASCII and accented Latin letters only need no character properties, and so the faster module.
_LATIN = "A-Za-zÀ-ÖØ-öø-ſ"
_PLAIN = re.compile(r"[\t-\r -~À-ÖØ-öø-ſ]*")
_plain_pieces = re.compile(_PIECES.format(letter=_LATIN, digit="0-9", blank=r"\t-\r ")).findall
_all_pieces = regex.compile(_PIECES.format(letter=r"\p{L}", digit=r"\p{N}", blank=BLANK)).findall


def pieces(text: str) -> list[str]:
    """The text in pieces; joined they are the text again."""
    return _plain_pieces(text) if _PLAIN.fullmatch(text) else _all_pieces(text)


#: Units whose ids a worker remembers, units that are put in at a time, and characters encoded at a time.
#: When the memory is full the longer half is forgotten: this bounds a worker's memory and changes no result.
REMEMBERED, FRESH, AT_ONCE = 1_000_000, 50_000, 1_000_000

#: Blanks besides space and line end, and a dot or comma without a letter, digit or line end before it.
_odd_blank = re.compile("[\\0\\t\x0b-\\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search
_joined_mark = re.compile(rf"[.,](?<![{_LATIN}0-9\n][.,])").search


def _tangled(text: str) -> bool:
    blanks = "  " in text or "\n\n" in text or " \n" in text or "\n " in text
    return blanks or bool(_odd_blank(text) or _joined_mark(text))


#: Bytes of a unit that its marks tell; the first 0 to 8 bytes of eight, the first in the lowest place; an odd number.
SHORT, _FIRST, _SPREAD = 15, np.array([(1 << 8 * n) - 1 for n in range(9)], "u8"), np.uint64(0x9E3779B97F4A7C15)


def marks(units: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers of 64 bits for each unit, which differ for all units of up to ``SHORT`` bytes; of longer ones two hashes.

    The second holds the size and the bytes from the ninth on, the first those before, moved by
    the second, so that beginnings that units share do not make it equal.
    """
    if not len(units):
        return np.zeros(0, "u8"), np.zeros(0, "u8")
    ends = np.frombuffer(units.buffers()[1], "i4")[units.offset : units.offset + len(units) + 1]
    data = b"".join([units.buffers()[2] or b"", bytes(16)])
    # eight bytes from any place on
    words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    first, size = ends[:-1], np.diff(ends)
    key = words[first] & _FIRST[np.minimum(size, 8)]
    check = words[np.where(size > 8, first + 8, first)] & _FIRST[np.clip(size - 8, 0, SHORT - 8)]
    check |= np.minimum(size, 255).astype("u8") << np.uint64(56)
    key += check * _SPREAD
    long = np.flatnonzero(size > SHORT)
    if len(long):
        texts = units.take(pa.array(long)).to_pylist()
        key[long] = np.fromiter(map(hash, texts), "i8", len(long)).view("u8")
        other = np.fromiter((hash(text[::-1] + "\0") for text in texts), "i8", len(long)).view("u8")
        check[long] = other | np.uint64(1 << 63)  # which no number of a short unit has
    return key, check


class Known:
    """Ids of units in sorted arrays, some 35 bytes each; a unit is known by its ``marks``."""

    def __init__(self):
        self.key, self.check = np.zeros(0, "u8"), np.zeros(0, "u8")
        self.first, self.size = np.zeros(0, "i8"), np.zeros(0, "u4")
        self.pool = np.zeros(0, "<u4")

    def find(self, key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the units, and which of them are there."""
        if not len(self.key):
            return np.zeros(len(key), "i8"), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return at, (self.key[at] == key) & (self.check[at] == check)

    def add(self, key: np.ndarray, check: np.ndarray, size: np.ndarray, pool: np.ndarray) -> None:
        """Units that are not there; ``pool`` has their ids one after the other."""
        first = np.concatenate([self.first, len(self.pool) + np.cumsum(size) - size])
        keys = np.concatenate([self.key, key])
        order = np.argsort(keys, kind="stable")  # two sorted runs: merged in one pass
        self.key, self.first = keys[order], first[order]
        self.check = np.concatenate([self.check, check])[order]
        self.size = np.concatenate([self.size, size.astype("u4")])[order]
        self.pool = np.concatenate([self.pool, pool])

    def forget(self) -> None:
        """The half with more ids goes: short units are the common ones."""
        stay = self.size <= np.median(self.size)
        if stay.all():
            self.__init__()
            return
        pool = _gather(self.pool, self.first[stay], self.size[stay].astype("i8"))
        self.key, self.check, self.size = self.key[stay], self.check[stay], self.size[stay]
        self.pool, self.first = pool, np.cumsum(self.size, dtype="i8") - self.size


def _gather(pool: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Stretches of ``pool``, one after the other."""
    at = np.repeat(first - np.cumsum(size) + size, size)
    at += np.arange(len(at))
    return pool[at]


class Memory:
    """Ids of text units, so that each distinct unit is encoded once while it is remembered.

    A unit is one piece or a few that stand together: a single blank starts a new piece, and so
    do a dot or comma behind a letter and what follows a line end, so most texts are cut at
    marks put in there, and their units numbered, by Arrow; others are cut piece by piece.
    ``encode_units`` takes the units not yet known and returns their packed ids; ``added``
    maps the strings that are tokens wherever they stand to their ids.
    """

    def __init__(self, encode_units: Callable[[list[str]], Iterable[bytes]], added: dict[str, int]):
        self.encode_units, self.added = encode_units, added
        longest_first = sorted(added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")").split if added else None
        self.old, self.fresh = Known(), Known()

    def _units(self, units: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct units, one after the other, and how many each has."""
        key, check = marks(units)
        places = []
        missing = np.ones(len(units), bool)
        for known in (self.old, self.fresh):
            at, there = known.find(key, check)
            places.append((known, at, there))
            missing &= ~there
        new = np.flatnonzero(missing)
        packed = list(self.encode_units(units.take(pa.array(new)).to_pylist()))
        pool, size = np.frombuffer(b"".join(packed), "<u4"), np.fromiter(map(len, packed), "i8", len(packed)) // 4
        sizes, firsts = np.zeros(len(units), "i8"), np.zeros(len(units), "i8")
        sizes[new], firsts[new] = size, np.cumsum(size) - size
        pools = [pool]
        for known, at, there in places:
            sizes[there], firsts[there] = known.size[at[there]], known.first[at[there]] + sum(map(len, pools))
            pools.append(known.pool)
        # stretches of three pools, without copying the pools together
        ids = np.empty(int(sizes.sum()), "<u4")
        into, ends = np.cumsum(sizes) - sizes, np.cumsum([0, *map(len, pools)])
        for which, chosen in enumerate([missing, *(there for _, _, there in places)]):
            own, start = sizes[chosen], firsts[chosen] - ends[which]
            to = np.repeat(into[chosen] - np.cumsum(own) + own, own)
            to += np.arange(len(to))
            ids[to] = _gather(pools[which], start, own)
        self._keep(key[new], check[new], size, pool)
        return ids, sizes

    def _keep(self, key: np.ndarray, check: np.ndarray, size: np.ndarray, pool: np.ndarray) -> None:
        order = np.argsort(key)
        ids = _gather(pool, (np.cumsum(size) - size)[order], size[order])
        self.fresh.add(key[order], check[order], size[order], ids)
        if len(self.fresh.key) > FRESH:
            fresh, self.fresh = self.fresh, Known()
            size = fresh.size.astype("i8")
            self.old.add(fresh.key, fresh.check, size, _gather(fresh.pool, fresh.first, size))
            if len(self.old.key) > REMEMBERED:
                self.old.forget()

    def _piecewise(self, text: str) -> np.ndarray:
        found: list[str | int] = []
        for i, part in enumerate(self.cut(text) if self.cut else [text]):
            found.extend([self.added[part]] if i % 2 else pieces(part))
        distinct = list(dict.fromkeys(unit for unit in found if isinstance(unit, str)))
        ids, sizes = self._units(pa.array(distinct, pa.string()))
        number = {unit: i for i, unit in enumerate(distinct)}
        tokens = sorted({unit for unit in found if isinstance(unit, int)})
        number |= {token: len(distinct) + i for i, token in enumerate(tokens)}
        return self._numbered(
            np.array([number[unit] for unit in found], "i8"),
            np.concatenate([ids, np.array(tokens, "<u4")]),
            np.concatenate([sizes, np.ones(len(tokens), "i8")]),
        )[0]

    @staticmethod
    def _numbered(codes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units given by number, and where each ends."""
        each = sizes[codes]
        return _gather(ids, (np.cumsum(sizes) - sizes)[codes], each), np.cumsum(each)

    def _marked(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        marked = pa.array(texts, pa.string())
        for mark, to in ((" ", "\0 "), (".", "\0."), (",", "\0,"), ("\n", "\0\n\0")):
            marked = pc.replace_substring(marked, mark, to)
        cut = pc.split_pattern(marked, "\0")
        numbered = cut.values.dictionary_encode()
        ids, ends = self._numbered(numbered.indices.to_numpy(), *self._units(numbered.dictionary))
        return ids, np.diff(np.concatenate([[0], ends])[cut.offsets.to_numpy()])

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = [not _tangled(text) and not any(token in text for token in self.added) for text in texts]
        ids, sizes = self._marked([text for text, is_plain in zip(texts, plain) if is_plain])
        if all(plain):
            return ids, sizes
        cut = iter(np.split(ids, np.cumsum(sizes)[:-1]))
        parts = [next(cut) if is_plain else self._piecewise(text) for text, is_plain in zip(texts, plain)]
        return np.concatenate(parts), np.array([len(part) for part in parts])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts, one after the other, and how many each text has."""
        done, some, size = [], [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size > AT_ONCE:
                done.append(self._encode(some))
                some, size = [], 0
        if some:
            done.append(self._encode(some))
        pa.default_memory_pool().release_unused()  # or a worker keeps what cutting took at most
        if not done:
            return np.zeros(0, "<u4"), np.zeros(0, "i8")
        return np.concatenate([ids for ids, _ in done]), np.concatenate([sizes for _, sizes in done])
