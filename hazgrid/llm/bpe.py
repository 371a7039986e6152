"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of the tree are the pairs of neighbouring symbols of one piece of text, each
with its merge rank and place; every inner node is the smaller of its two children. The root
is then the leftmost pair of lowest rank. A merge changes three leaves, each of which is
carried to the root in logarithmic time, until the root says that no pair merges. A piece of
a hundred thousand bytes thus takes n log n steps and not n squared.

Encoded ids travel as binary columns of little-endian unsigned 32-bit integers, which
``sha2``, ``crc32`` and ``numpy.frombuffer`` read as they are.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_text, with_text_result
from .pretoken import Memory, pieces

#: Up to this many bytes, the trees of many pieces are kept and changed side by side in arrays.
SMALL = 64
NO_PAIR = 1 << 62
PLACE = (1 << 32) - 1


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where visible, else from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, after = [""] * 256, 256
    for byte in range(256):
        if byte in shown:
            letters[byte] = chr(byte)
        else:
            letters[byte] = chr(after)
            after += 1
    return letters


def _bytes(whole: dict) -> list[bytes]:
    """The bytes of each id of a tokenizer file."""
    byte_of, vocab = {letter: byte for byte, letter in enumerate(byte_letters())}, whole["model"]["vocab"]
    found = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in whole["added_tokens"])]))
    for token, i in vocab.items():
        found[i] = bytes(byte_of[letter] for letter in token)
    for token in whole["added_tokens"]:
        found[token["id"]] = token["content"].encode()
    return found


class Vocabulary:
    """A byte-level BPE read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model, added = whole["model"], whole["added_tokens"]
        kind = (model["type"], (whole["pre_tokenizer"] or {}).get("type"), whole["normalizer"])
        marks = ("continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "dropout")
        plain = not any(model.get(mark) for mark in marks)
        if kind != ("BPE", "ByteLevel", None) or whole["pre_tokenizer"]["add_prefix_space"] or not plain:
            raise ValueError(f"{path} is not a plain byte-level BPE")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError(f"{path} has added tokens that take in their neighbours")
        letters, vocab = byte_letters(), model["vocab"]
        self.first = [vocab[letter] for letter in letters]
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(vocab[a] << 32 | vocab[b], rank)
            self.merged.append(vocab[a + b])
        self.bytes = _bytes(whole)
        self.added = {t["content"]: t["id"] for t in added}
        pairs = sorted(self.ranks.items())
        self.pairs = np.array([pair for pair, _ in pairs] + [NO_PAIR])
        self.pair_ranks = np.array([rank for _, rank in pairs] + [0])
        self.memory = Memory(self.encode_units, self.added)

    def merge(self, symbols: list[int]) -> list[int]:
        """The symbols after all merges, lowest rank first and leftmost among equals."""
        count = len(symbols)
        if count < 2:
            return symbols
        rank_of, merged = self.ranks.get, self.merged
        size = 1 << (count - 2).bit_length()
        tree = [NO_PAIR] * (2 * size)
        for i in range(count - 1):
            rank = rank_of(symbols[i] << 32 | symbols[i + 1])
            if rank is not None:
                tree[size + i] = rank << 32 | i
        for node in range(size - 1, 0, -1):
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left < right else right
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        while (top := tree[1]) != NO_PAIR:
            i = top & PLACE
            gone = after[i]
            follows = after[gone]
            symbols[i], after[i] = merged[top >> 32], follows
            changed = [(gone, NO_PAIR)]
            if follows < count:
                before[follows] = i
                rank = rank_of(symbols[i] << 32 | symbols[follows])
                changed.append((i, NO_PAIR if rank is None else rank << 32 | i))
            else:
                changed.append((i, NO_PAIR))
            if (ahead := before[i]) >= 0:
                rank = rank_of(symbols[ahead] << 32 | symbols[i])
                changed.append((ahead, NO_PAIR if rank is None else rank << 32 | ahead))
            for place, value in changed:
                node = size + place
                if node >= 2 * size or tree[node] == value:  # the last symbol starts no pair
                    continue
                tree[node] = value
                while node > 1:
                    other = tree[node ^ 1]
                    value = value if value < other else other
                    node >>= 1
                    if tree[node] == value:
                        break
                    tree[node] = value
        ids, i = [], 0
        while i < count:
            ids.append(symbols[i])
            i = after[i]
        return ids

    def _leaves(self, a: np.ndarray, b: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The leaves of pairs (a, b) at places below ``SMALL``; a negative symbol is none."""
        pair = (a << 32) | b
        at = np.searchsorted(self.pairs, pair)
        found = (self.pairs[at] == pair) & (b >= 0) & (a >= 0)
        return np.where(found, (self.pair_ranks[at] << 6) | place, NO_PAIR)

    def merge_many(self, words: list[bytes], size: int) -> list[bytes]:
        """``merge`` for many pieces of up to ``size`` bytes (a power of two): one row of arrays for each tree."""
        count = np.array([len(word) for word in words])
        symbols = np.full((len(words), size + 1), -1, "i8")
        held = np.arange(size + 1) < count[:, None]
        symbols[held] = np.array(self.first)[np.frombuffer(b"".join(words), "u1")]
        after = np.tile(np.arange(1, size + 2), (len(words), 1))
        before = np.tile(np.arange(-1, size + 1), (len(words), 1))
        tree = np.full((len(words), 2 * size), NO_PAIR, "i8")
        tree[:, size:] = self._leaves(symbols[:, :-1], symbols[:, 1:], np.arange(size))
        node = size
        while node > 1:
            node >>= 1
            tree[:, node : 2 * node] = np.minimum(tree[:, 2 * node : 4 * node : 2], tree[:, 2 * node + 1 : 4 * node : 2])
        merged = np.array(self.merged)
        rows = np.flatnonzero(tree[:, 1] != NO_PAIR)
        while len(rows):
            top = tree[rows, 1]
            i = top & (SMALL - 1)
            gone = after[rows, i]
            follows = after[rows, gone]
            new = merged[top >> 6]
            symbols[rows, i], symbols[rows, gone] = new, -1
            after[rows, i], before[rows, follows] = follows, i
            ahead = before[rows, i]
            first = ahead < 0  # then its own leaf once more
            ahead = np.where(first, i, ahead)
            own = self._leaves(new, symbols[rows, follows], i)
            tree[rows, size + gone] = NO_PAIR
            tree[rows, size + ahead] = np.where(first, own, self._leaves(symbols[rows, ahead], new, ahead))
            tree[rows, size + i] = own
            changed = [size + gone, size + ahead, size + i]
            for _ in range(size.bit_length() - 1):
                changed = [node >> 1 for node in changed]
                for node in changed:
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            rows = rows[tree[rows, 1] != NO_PAIR]
        left = symbols >= 0
        ends = (4 * np.cumsum(left.sum(axis=1))).tolist()
        ids = symbols[left].astype("<u4").tobytes()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def encode_units(self, units: list[str]) -> list[bytes]:
        cut = list(map(pieces, units))
        data = {piece: piece.encode("utf-8") for unit in cut for piece in unit}
        ids: dict[str, bytes] = {}
        by_size: dict[int, list[str]] = {}
        for piece, word in data.items():
            by_size.setdefault(max(2, 1 << (len(word) - 1).bit_length()), []).append(piece)
        for size, some in by_size.items():
            if size <= SMALL:
                for at in range(0, len(some), 1 << 14):
                    part = some[at : at + (1 << 14)]
                    ids.update(zip(part, self.merge_many([data[piece] for piece in part], size)))
            else:
                for piece in some:
                    ids[piece] = np.array(self.merge([self.first[byte] for byte in data[piece]]), "<u4").tobytes()
        return [ids[unit[0]] if len(unit) == 1 else b"".join([ids[piece] for piece in unit]) for unit in cut]

    def encode(self, text: str) -> bytes:
        """The ids of a whole text. Strings of added tokens in it become those tokens."""
        return self.memory.encode([text])[0].tobytes()

    def decode(self, packed: bytes) -> str:
        return text_of(packed, self.bytes)


def text_of(packed: bytes, token: list[bytes]) -> str:
    """The text of packed ids; bytes that are no UTF-8 become replacement characters."""
    return b"".join([token[i] for i in np.frombuffer(packed, "<u4").tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    """Read once in each worker process."""
    return Vocabulary(path)


@lru_cache(maxsize=1)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id, which is all that decoding needs."""
    with open(path, encoding="utf-8") as file:
        return _bytes(json.load(file))


def encoded(docs: DataFrame, path: str, text: str = "text", to: str = "ids") -> DataFrame:
    """All rows and columns of ``docs`` with the packed ids of the whole text in column ``to``.

    ``path`` is the tokenizer file as every worker sees it. A missing text is encoded as
    empty, and empty texts have no ids. A column named ``to`` is replaced.
    """

    def encode(texts: pa.Array) -> pa.Array:
        ids, sizes = vocabulary(path).memory.encode(texts.to_pylist())
        ends = np.concatenate([[0], np.cumsum(4 * sizes)]).astype("i4")
        return pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(ids)])

    return with_text_result(docs, to, whole_text(text), "binary", lambda: encode)


def decoded(rows: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """All rows and columns with the text of the packed ids in column ``to``; null ids are no ids."""

    def decode(packed: pa.Array) -> pa.Array:
        return pa.array([text_of(p, token_bytes(path)) for p in packed.to_pylist()], pa.string())

    return with_text_result(rows, to, F.coalesce(F.col(ids), F.lit(b"")), "string", lambda: decode)


def n_tokens(ids: str = "ids"):
    return F.expr(f"CAST(octet_length(`{ids}`) DIV 4 AS BIGINT)")
