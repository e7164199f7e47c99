"""Language model scoring with an n-gram trie of three Elias-Fano levels.

The first level holds the words, by a 64-bit hash, with their counts; the second the
successors of each word; the third those of each pair of words, below the pair. Pointers
from a node to its successors and the successors themselves are monotone sequences.
Levels are cut into shards that Spark builds and that scoring tasks map into memory.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from urllib.parse import unquote, urlparse

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscore.llm.common import bounded_batches, crc_of_id, mixed, utf8
from subscore.session import shared_folder

FOLDS = 10
ADDED = 0.1  # to each count, in the distribution of single words
DISCOUNT = 0.75  # of the count of a pair or of three words
LOWEST = -12.0  # log10 that the least probability code stands for
CODES = 65535  # steps of a probability code
HELD = 2_000_000  # distinct entries that a task holds before it passes them on
SHARD_TOKENS = 4_000_000  # that a shard of the second and third level stands for
ROWS = 2000  # of a batch: the more, the fewer searches for the same words
MOST_WORDS = (1 << 32) - 1
UNKNOWN = np.uint64(0xFFFFFFFF)  # in the place of a word's number; nothing follows the end
LOW32 = np.uint64(0xFFFFFFFF)
END = np.uint64(xxhash.xxh3_64_intdigest(b" "))  # no word has a space


# --- Elias-Fano sequences ----------------------------------------------------

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_PLACE = np.zeros(256 * 8, np.uint8)  # of the k-th one of a byte
for _b in range(256):
    _PLACE[_b * 8 : _b * 8 + _BITS[_b].sum()] = np.flatnonzero(_BITS[_b])
_EACH_BYTE = np.uint64(0x0101010101010101)
_TOP_BITS = np.uint64(0x8080808080808080)
_TWOS, _FOURS, _EIGHTS = np.uint64(0x5555555555555555), np.uint64(0x3333333333333333), np.uint64(0x0F0F0F0F0F0F0F0F)


def _place_in_word(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the one with the given rank in each 64-bit word, which has more ones than that."""
    one, two, three, four, seven, eight = (np.uint64(k) for k in (1, 2, 3, 4, 7, 8))
    rank = rank.astype(np.uint64)
    upto = words - ((words >> one) & _TWOS)
    upto = (upto & _FOURS) + ((upto >> two) & _FOURS)
    upto = ((upto + (upto >> four)) & _EIGHTS) * _EACH_BYTE  # in each byte the ones up to it
    # Bytes that end before the one sought: those whose count is not above the rank.
    passed = (((rank * _EACH_BYTE) | _TOP_BITS) - upto) & _TOP_BITS
    shift = ((passed >> seven) * _EACH_BYTE >> np.uint64(56)) << three
    rank -= ((upto << eight) >> shift) & np.uint64(0xFF)
    return (shift + _PLACE[(((words >> shift) & np.uint64(0xFF)) << three) + rank]).astype(np.int64)


@dataclass
class EliasFano:
    """A non-decreasing sequence: low bits as they are, high parts in unary.

    ``ones``, ``zeros``: how many there are before each 64-bit word of ``high``.
    """

    width: int
    size: int
    low: np.ndarray
    high: np.ndarray
    ones: np.ndarray
    zeros: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n, most = len(values), int(values[-1]) if len(values) else 0
        width = max(0, (most // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        high = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-(int(high[-1]) + 1 if n else 1) // 64) * 64, np.uint8)
        bits[high] = 1
        packed = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.r_[0, np.cumsum(bits.reshape(-1, 64).sum(1, dtype=np.int64))[:-1]].astype(np.int64)
        low = np.zeros((n * width >> 6) + 2, np.uint64)
        if n and width:
            values &= np.uint64((1 << width) - 1)
            at = np.arange(n) * width
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low[word[first]] = np.add.reduceat(values << shift, first)  # fields don't overlap
            over = np.flatnonzero((at & 63) + width > 64)
            low[word[over] + 1] += values[over] >> (np.uint64(64) - shift[over])
        return cls(width, n, low, packed, ones, np.arange(len(packed)) * 64 - ones)

    def lows(self, index: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(index), np.uint64)
        at = index * self.width
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        beyond = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift) | beyond) & np.uint64((1 << self.width) - 1)

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        """The values at the given places (select on the high bits)."""
        word = np.searchsorted(self.ones, index, side="right") - 1
        place = word * 64 + _place_in_word(self.high[word], index - self.ones[word])
        return ((place - index).astype(np.uint64) << np.uint64(self.width)) | self.lows(index)

    def _upto(self, high: np.ndarray) -> np.ndarray:
        """How many values have a high part of at most ``high``, which may be -1."""
        last = len(self.high) * 64 - self.size - 1  # of the zeros
        wanted = np.clip(high, 0, last)
        word = np.searchsorted(self.zeros, wanted, side="right") - 1
        place = word * 64 + _place_in_word(~self.high[word], wanted - self.zeros[word])
        return np.where(high < 0, 0, np.where(high > last, self.size, place - wanted))

    def _run(self, place: np.ndarray) -> np.ndarray:
        """Ones in a row from each place on, -1 if it isn't seen where they end."""
        word, shift = place >> 6, (place & 63).astype(np.uint64)
        after = np.where(word + 1 < len(self.high), self.high[np.minimum(word + 1, len(self.high) - 1)], np.uint64(0))
        here = np.where(word < len(self.high), self.high[np.minimum(word, len(self.high) - 1)], np.uint64(0))
        beyond = np.where(shift > 0, after << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        zeros = ~((here >> shift) | beyond)
        ones = np.bitwise_count((zeros & (~zeros + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        return np.where(zeros == 0, -1, ones)

    def find(self, wanted: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places of the values between ``begin`` and ``end``, -1 if they aren't there (successor search).

        The values with the wanted high part stand together, one or two on average; of
        these, the low bits are compared.
        """
        high = (wanted >> np.uint64(self.width)).astype(np.int64)
        sought = wanted & np.uint64((1 << self.width) - 1)
        low = self._upto(high - 1)
        length = self._run(low + high)
        long = np.flatnonzero(length < 0)
        length[long] = self._upto(high[long]) - low[long]
        low, top = np.maximum(low, begin), np.minimum(low + length, end)
        last = top.copy()
        open_ = np.flatnonzero(low < top)
        while len(open_):
            mid = (low[open_] + top[open_]) >> 1
            less = self.lows(mid) < sought[open_]
            low[open_] = np.where(less, mid + 1, low[open_])
            top[open_] = np.where(less, top[open_], mid)
            open_ = open_[low[open_] < top[open_]]
        inside = np.flatnonzero(low < last)
        hit = inside[self.lows(low[inside]) == sought[inside]]
        out = np.full(len(wanted), -1)
        out[hit] = low[hit]
        return out


# --- files in the shared folder ----------------------------------------------


def mounted(path: str) -> str:
    """The folder as tasks see it; levels can be mapped from a mounted file system only."""
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"{path}: the levels need a shared folder that is mounted, to map files into memory")
    return unquote(parts.path)


def _write(folder: str, name: str, array: np.ndarray) -> None:
    """Whole or not at all, also if two attempts of a task write it."""
    os.makedirs(folder, exist_ok=True)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}.npy"
    np.save(draft, array)
    os.replace(draft, f"{folder}/{name}.npy")


@lru_cache(maxsize=4096)
def _level(folder: str, name: str) -> np.ndarray:
    return np.load(f"{folder}/{name}.npy", mmap_mode="r").view(np.ndarray)


_PARTS = ("low", "high", "ones", "zeros")


def _write_sequence(folder: str, name: str, sequence: EliasFano) -> None:
    for part in _PARTS:
        _write(folder, f"{name}-{part}", getattr(sequence, part))
    _write(folder, f"{name}-shape", np.array([sequence.width, sequence.size]))


@lru_cache(maxsize=4096)
def _sequence(folder: str, name: str) -> EliasFano:
    width, size = _level(folder, f"{name}-shape").tolist()
    return EliasFano(width, size, *(_level(folder, f"{name}-{part}") for part in _PARTS))


# --- successors of a level's nodes -------------------------------------------


def _coded(shares: np.ndarray) -> np.ndarray:
    """Codes of probabilities, rounded down, so that what is left to the words in general never is."""
    return np.clip(np.floor((1 - np.log10(shares) / LOWEST) * CODES), 0, CODES).astype(np.uint16)


def _decoded(codes: np.ndarray) -> np.ndarray:
    return 10 ** (LOWEST * (1 - codes.astype(np.float64) / CODES))


def _left(shares: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One less the sum of each node's shares."""
    out, starts = np.ones(len(ends)), np.r_[0, ends[:-1]]
    with_any = np.flatnonzero(ends > starts)
    if len(with_any):
        out[with_any] -= np.add.reduceat(shares, starts[with_any])
    return out


def _write_successors(folder: str, level: str, ends: np.ndarray, words: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """A level: for each node the numbers of the words that follow it, in order, with their shares.

    ``ends``: where each node's words end. Returns what the coded shares leave at each node.
    """
    words = words.astype(np.uint64) + np.uint64(1)
    # A node's words go on from the last value before it, so that all of them rise.
    with_any = ends > np.r_[0, ends[:-1]]
    lasts = words[ends[with_any] - 1]
    before = np.cumsum(np.r_[np.uint64(0), lasts], dtype=np.uint64)[:-1]
    words = words + np.repeat(before, np.diff(np.r_[0, ends[with_any]]))
    codes = _coded(shares)
    _write_sequence(folder, f"{level}-pointers", EliasFano.of(np.r_[0, ends]))
    _write_sequence(folder, f"{level}-words", EliasFano.of(words))
    _write(folder, f"{level}-codes", codes)
    return _left(_decoded(codes), ends)


def _find_successors(folder: str, level: str, nodes: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the level of ``words`` below ``nodes`` (-1: none), and their shares; nodes are in order."""
    pointers, values = _sequence(folder, f"{level}-pointers"), _sequence(folder, f"{level}-words")
    first = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]]) if len(nodes) else np.zeros(0, np.int64)
    begin, end = pointers[nodes[first]].astype(np.int64), pointers[nodes[first] + 1].astype(np.int64)
    base = np.zeros(len(first), np.uint64)
    later = np.flatnonzero((begin > 0) & (begin < end))
    base[later] = values[begin[later] - 1]
    times = np.diff(np.r_[first, len(nodes)])
    begin, end, base = (np.repeat(x, times) for x in (begin, end, base))
    at = values.find(base + words + np.uint64(1), begin, end)
    shares = np.zeros(len(nodes))
    hit = np.flatnonzero(at >= 0)
    shares[hit] = _decoded(_level(folder, f"{level}-codes")[at[hit]])
    return at, shares


# --- counting ------------------------------------------------------------------


# White space between words is the space and 0x09 to 0x0D.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_MIXED_BYTES = 64  # longer words are hashed one by one


def _word_hashes(whole: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words between the given places; at least eight bytes follow the last."""
    eight = np.ndarray(len(whole) - 7, "<u8", whole, strides=(1,))
    length = end - begin
    out = mixed(length.astype(np.uint64))
    some, at = np.arange(len(begin)), 0
    while len(some) and at < _MIXED_BYTES:
        out[some] = mixed(out[some] ^ (eight[begin[some] + at] & _FIRST_BYTES[np.minimum(length[some] - at, 8)]))
        at += 8
        some = some[length[some] > at]
    for k in np.flatnonzero(length > _MIXED_BYTES).tolist():
        out[k] = xxhash.xxh3_64_intdigest(whole[begin[k] : end[k]])
    return out


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end behind each text's words; and where each text's tokens begin."""
    raw = [utf8(t) for t in texts]
    begins = 1 + np.cumsum([0, *(len(t) + 1 for t in raw)])
    whole = b"".join((b" ", b" ".join(raw).lower(), b" ", bytes(8)))
    space = _IS_SPACE[np.frombuffer(whole, np.uint8, len(whole) - 8)]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1  # it begins and ends with a space
    words = edges[::2]
    before = np.searchsorted(words, begins)  # words before each text
    out = np.full(len(words) + len(raw), END)
    out[np.arange(len(words)) + np.repeat(np.arange(len(raw)), np.diff(before))] = _word_hashes(whole, words, edges[1::2])
    return out, before + np.arange(len(raw) + 1)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sum of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def _dealt(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> pd.DataFrame:
    """Sorted keys by shard, as differences, which compress well."""
    order = np.argsort(shard, kind="stable")
    shard, keys, counts = shard[order], keys[order], counts[order]
    edges = np.r_[0, np.flatnonzero(shard[1:] != shard[:-1]) + 1, len(shard)] if len(shard) else [0]
    rows = [
        (int(shard[a]), np.diff(keys[a:b], prepend=np.uint64(0)).tobytes(), counts[a:b].astype(np.uint32).tobytes())
        for a, b in zip(edges, edges[1:])
    ]
    return pd.DataFrame(rows, columns=["shard", "keys", "counts"])


def _gathered(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    keys = [np.cumsum(np.frombuffer(k, np.uint64), dtype=np.uint64) for k in rows["keys"]]
    counts = [np.frombuffer(c, np.uint32).astype(np.int64) for c in rows["counts"]]
    return summed(np.concatenate(keys), np.concatenate(counts))


_DEALT = "shard int, keys binary, counts binary"


def _counted(texts: DataFrame, keys_of, shard_of) -> DataFrame:
    """Counts of keys, combined within tasks and dealt to shards."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, more, waiting = (np.zeros(0, np.uint64), np.zeros(0, np.int64)), [], 0
        for batch in batches:
            new, n = np.unique(keys_of(batch["text"].tolist()), return_counts=True)
            more.append((new, n))
            waiting += len(new)
            if waiting > HELD // 4:
                held = summed(np.concatenate([held[0], *(k for k, _ in more)]), np.concatenate([held[1], *(c for _, c in more)]))
                more, waiting = [], 0
                if len(held[0]) > HELD:
                    yield _dealt(*held, shard_of(held[0]))
                    held = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        held = summed(np.concatenate([held[0], *(k for k, _ in more)]), np.concatenate([held[1], *(c for _, c in more)]))
        if len(held[0]):
            yield _dealt(*held, shard_of(held[0]))

    return texts.mapInPandas(count, _DEALT)


def summed_triples(pairs: np.ndarray, words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (pair, word) in order, with the sum of their counts."""
    if not len(pairs):
        return pairs, words, counts
    order = np.lexsort((words, pairs))
    pairs, words, counts = pairs[order], words[order], counts[order]
    first = np.flatnonzero(np.r_[True, (pairs[1:] != pairs[:-1]) | (words[1:] != words[:-1])])
    return pairs[first], words[first], np.add.reduceat(counts, first)


def _inside(begins: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of neighbours in a text, and for each token the place of the pair that it begins (-1: none).

    A pair is two numbers of 32 bits; ``UNKNOWN`` may be the second, never the first.
    """
    within = np.ones(len(ids), bool)
    within[begins[1:-1]] = False
    at = np.flatnonzero(within[1:] & (ids[:-1] != UNKNOWN))
    pairs, back = np.unique((ids[at] << np.uint64(32)) | ids[at + 1], return_inverse=True)
    of_token = np.full(len(ids), -1)
    of_token[at] = back
    return pairs, of_token


_TRIPLES = "shard int, keys binary, words binary, counts binary"


def _counted_triples(texts: DataFrame, model) -> DataFrame:
    """Counts of three words in a row, as (pair, word), combined within tasks and dealt to the pairs' shards.

    Behind a pair that ends a text stands ``UNKNOWN``, so that pairs are counted here too.
    """

    def counted(some: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, begins = _tokens(some)
        distinct, inverse = np.unique(hashes, return_inverse=True)
        ids = model.value.known(distinct)[0][inverse].astype(np.uint64)
        pairs, of_token = _inside(begins, ids)
        at = np.flatnonzero(of_token >= 0)
        follows = np.full(len(at), UNKNOWN)
        more = np.flatnonzero(of_token[at + 1] >= 0)
        follows[more] = ids[at[more] + 2]
        keys, n = np.unique((of_token[at].astype(np.uint64) << np.uint64(32)) | follows, return_counts=True)
        return pairs[(keys >> np.uint64(32)).astype(np.int64)], (keys & LOW32).astype(np.uint32), n

    def dealt(pairs: np.ndarray, words: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        shard = model.value.shard_of_pairs(pairs)
        order = np.argsort(shard, kind="stable")
        shard, pairs, words, counts = (x[order] for x in (shard, pairs, words, counts))
        edges = np.r_[np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]), len(shard)]
        rows = [
            (int(shard[a]), np.diff(pairs[a:b], prepend=np.uint64(0)).tobytes(), words[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes())
            for a, b in zip(edges, edges[1:])
        ]
        return pd.DataFrame(rows, columns=["shard", "keys", "words", "counts"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, size, held = [], 0, 0
        for batch in batches:
            waiting.append(counted(batch["text"].tolist()))
            size += len(waiting[-1][0])
            if size > HELD + held:  # as much again as is held already
                waiting = [summed_triples(*map(np.concatenate, zip(*waiting)))]
                size = held = len(waiting[0][0])
                if held > HELD:
                    yield dealt(*waiting[0])
                    waiting, size, held = [], 0, 0
        if size:
            yield dealt(*summed_triples(*map(np.concatenate, zip(*waiting))))

    return texts.mapInPandas(count, _TRIPLES)


@dataclass(frozen=True)
class NgramModel:
    """Where the levels are, and the sums that scores need.

    ``offsets``: words before each shard of the first level. ``shards``: those of
    the other levels. ``frequent``: words that make up so large a part of all tokens
    that the pairs they begin are dealt over all shards, in order, and ``left``: the
    probability they leave to single words; fewer than two per shard.
    """

    folder: str
    bits: int
    shards: int
    offsets: tuple[int, ...]
    tokens: int
    words: int
    frequent: np.ndarray
    left: np.ndarray

    def single(self, counts: np.ndarray) -> np.ndarray:
        """Probability of words by their count."""
        return (counts + ADDED) / (self.tokens + ADDED * (self.words + 1))

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: unknown) and counts of words, given in the order of their hashes."""
        ids, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        if not self.tokens:
            return ids, counts
        shard = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        edges = np.searchsorted(shard, np.arange((1 << self.bits) + 1))
        for s, (a, b) in enumerate(zip(edges, edges[1:])):
            size = self.offsets[s + 1] - self.offsets[s]
            if a == b or not size:
                continue
            words = _level(f"{self.folder}/words-{s}", "hashes")
            at = np.minimum(np.searchsorted(words, hashes[a:b]), size - 1)
            found = words[at] == hashes[a:b]
            ids[a:b] = np.where(found, at + self.offsets[s], -1)
            counts[a:b] = np.where(found, _level(f"{self.folder}/words-{s}", "counts")[at], 0)
        return ids, counts

    def place_of_frequent(self, words: np.ndarray) -> np.ndarray:
        """Places among the frequent words, -1 for others."""
        if not len(self.frequent):
            return np.full(len(words), -1)
        at = np.minimum(np.searchsorted(self.frequent, words), len(self.frequent) - 1)
        return np.where(self.frequent[at] == words, at, -1)

    def shard_of_pairs(self, pairs: np.ndarray) -> np.ndarray:
        before = pairs >> np.uint64(32)
        shard = mixed(before)
        if len(self.frequent):
            shard = np.where(self.place_of_frequent(before) >= 0, mixed(pairs ^ shard), shard)
        return (shard % np.uint64(self.shards)).astype(np.int32)

    def look_up(self, pairs: np.ndarray, triples: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What the trie has on distinct pairs and on triples, both in order.

        A triple is the place of its pair among ``pairs``, and a word, 32 bits each. Returns each
        pair's own share, what its first word leaves to single words, what it leaves itself to
        pairs, and each triple's own share; 0 or 1 where the trie has nothing.
        """
        own2, left2, left3 = np.zeros(len(pairs)), np.ones(len(pairs)), np.ones(len(pairs))
        own3 = np.zeros(len(triples))
        pair_of = (triples >> np.uint64(32)).astype(np.int64)
        edges_of = np.searchsorted(pair_of, np.arange(len(pairs) + 1))
        shard = self.shard_of_pairs(pairs)
        by_shard = np.argsort(shard, kind="stable")
        places, edges = np.unique(shard[by_shard], return_index=True)
        for s, some in zip(places.tolist(), np.split(by_shard, edges[1:])):
            folder = f"{self.folder}/pairs-{s}"
            if not os.path.exists(f"{folder}/done.npy"):
                continue
            contexts = _level(folder, "contexts")
            before = (pairs[some] >> np.uint64(32)).astype(np.uint32)
            at = np.minimum(np.searchsorted(contexts, before), len(contexts) - 1)
            there = np.flatnonzero(contexts[at] == before)
            some, at = some[there], at[there]
            left2[some] = _level(folder, "left2")[at]
            at, own2[some] = _find_successors(folder, "2", at, pairs[some] & LOW32)
            there = np.flatnonzero(at >= 0)
            some, at = some[there], at[there]
            left3[some] = _level(folder, "left3")[at]
            times = edges_of[some + 1] - edges_of[some]
            which = np.repeat(edges_of[some] - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
            own3[which] = _find_successors(folder, "3", np.repeat(at, times), triples[which] & LOW32)[1]
        place = self.place_of_frequent(pairs >> np.uint64(32))
        left2[place >= 0] = self.left[place[place >= 0]]
        return own2, left2, left3, own3


def _write_words(folder: str):
    def write(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        hashes, counts = _gathered(rows)
        _write(f"{folder}/words-{key[0]}", "hashes", hashes)
        _write(f"{folder}/words-{key[0]}", "counts", counts)
        top = np.argsort(-counts, kind="stable")[:64]
        sums = (key[0], len(hashes), int(counts.sum()), top.tolist(), counts[top].tolist())
        return pd.DataFrame([sums], columns=["shard", "words", "tokens", "top", "top_counts"])

    return write


def _write_pairs(model: NgramModel, totals_of_frequent: np.ndarray):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks, shard = [], None
        for batch in batches:
            for row in batch.itertuples(index=False):
                shard = row.shard
                keys = np.cumsum(np.frombuffer(row.keys, np.uint64), dtype=np.uint64)
                blocks.append((keys, np.frombuffer(row.words, np.uint32), np.frombuffer(row.counts, np.uint32)))
        if not blocks:
            return
        pairs, words, counts = (np.concatenate(x) for x in zip(*blocks))
        blocks.clear()
        pairs, words, counts = summed_triples(pairs, words, counts.astype(np.int64))
        folder = f"{model.folder}/pairs-{shard}"
        # Third level: the pairs are its nodes, one without successors if it ends a text.
        first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
        of_pairs = np.add.reduceat(counts, first)
        follows = words != UNKNOWN
        ends = np.cumsum(np.add.reduceat(follows.astype(np.int64), first))
        shares = ((counts - DISCOUNT) / np.repeat(of_pairs, np.diff(np.r_[first, len(pairs)])))[follows]
        left = _write_successors(folder, "3", ends, words[follows], shares)
        _write(folder, "left3", left.astype(np.float32))
        # Second level: the pairs' first words are its nodes.
        pairs, counts = pairs[first], of_pairs
        contexts, first = np.unique(pairs >> np.uint64(32), return_index=True)
        totals = np.add.reduceat(counts, first)
        place = model.place_of_frequent(contexts)  # those have pairs in other shards as well
        totals[place >= 0] = totals_of_frequent[place[place >= 0]]
        ends = np.r_[first[1:], len(pairs)]
        shares = (counts - DISCOUNT) / np.repeat(totals, np.diff(np.r_[0, ends]))
        left = _write_successors(folder, "2", ends, pairs & LOW32, shares)
        _write(folder, "contexts", contexts.astype(np.uint32))
        _write(folder, "left2", left.astype(np.float32))
        _write(folder, "done", np.ones(1))
        heavy = [(int(place[k]), float(1 - left[k])) for k in np.flatnonzero(place >= 0)]
        yield pd.DataFrame([(-1, 0.0), *heavy], columns=["place", "mass"])

    return write


def fit_ngrams(texts: DataFrame, shards: int | None = None) -> NgramModel:
    """Count all ``texts`` (column ``text``) and write the levels below the shared folder.

    Two passes: words with their counts, then three words in a row, which pairs
    follow from. Both are combined within tasks, dealt to shards as sorted blocks,
    and summed there; only sums per shard come to the driver. Every pair and every
    three words counted are kept. ``shards`` of the second and third level default to
    one for each ``SHARD_TOKENS`` tokens, so that a shard stays as large as it is
    when the texts grow. The pairs of words that make up more than a 2 * shards-th
    of all tokens are dealt over all shards. Up to 2**32 - 1 distinct words.

    Null counts as empty: an end only. Without rows, every word is unknown.
    """
    spark = texts.sparkSession
    bounded_batches(spark, ROWS)
    texts = texts.select("text")
    of_words = shards or max(8, texts.rdd.getNumPartitions())
    bits = max(1, (of_words - 1).bit_length())
    folder = mounted(shared_folder(spark, "ngrams"))
    counted = _counted(texts, lambda t: _tokens(t)[0], lambda k: (k >> np.uint64(64 - bits)).astype(np.int32))
    shape = "shard int, words bigint, tokens bigint, top array<bigint>, top_counts array<bigint>"
    sums = {r["shard"]: r for r in counted.groupBy("shard").applyInPandas(_write_words(folder), shape).collect()}
    sizes = [sums[s]["words"] if s in sums else 0 for s in range(1 << bits)]
    offsets = np.r_[0, np.cumsum(sizes)].tolist()
    tokens = sum(r["tokens"] for r in sums.values())
    if offsets[-1] >= MOST_WORDS:
        raise ValueError("too many distinct words")
    shards = shards or max(8, -(-tokens // SHARD_TOKENS))
    top = sorted(
        (offsets[s] + at, n) for s, r in sums.items() for at, n in zip(r["top"], r["top_counts"]) if n * 2 * shards > tokens
    )
    frequent = np.array([word for word, _ in top], np.uint64)
    model = NgramModel(folder, bits, shards, tuple(offsets), tokens, offsets[-1], frequent, np.ones(len(top)))
    shared = spark.sparkContext.broadcast(model)
    triples = _counted_triples(texts, shared).repartitionById(shards, "shard")  # a task for each shard
    write = _write_pairs(model, np.array([n for _, n in top], np.float64))
    masses = triples.mapInPandas(write, "place int, mass double").groupBy("place").agg(F.sum("mass").alias("mass"))
    left = np.ones(len(top))
    for r in masses.filter("place >= 0").collect():
        left[r["place"]] -= r["mass"]
    return replace(model, left=np.maximum(left, 1e-12))


def token_probabilities(model: NgramModel, hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token's probability by the model and by single words, and 1 if it is known, else 0."""
    distinct, inverse = np.unique(hashes, return_inverse=True)
    numbers, met = model.known(distinct)
    single = (model.single(met) if model.tokens else np.ones(len(distinct)))[inverse]
    ids = np.where(numbers < 0, UNKNOWN, numbers.astype(np.uint64))[inverse]
    pairs, of_token = _inside(begins, ids)
    # Tokens behind a pair, by the place of that pair and their own number.
    new_text = np.zeros(len(ids) + 1, bool)
    new_text[begins] = True
    third = np.flatnonzero((of_token[:-1] >= 0) & ~new_text[2:]) + 2
    triples, back = np.unique((of_token[third - 2].astype(np.uint64) << np.uint64(32)) | ids[third], return_inverse=True)
    own2, left2, left3, own3 = model.look_up(pairs, triples)
    p = single.copy()
    second = np.flatnonzero(of_token >= 0)
    p[second + 1] = own2[of_token[second]] + left2[of_token[second]] * single[second + 1]
    p[third] = own3[back] + left3[of_token[third - 2]] * p[third]
    return p, single, (met > 0).astype(np.int64)[inverse]


def score_ngrams(documents: DataFrame, model: NgramModel) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` of every row.

    ``base_score`` is the log10 probability by single words. ``score`` is that of
    the model: for a word w behind u, (c(u, w) - ``DISCOUNT``) / c(u) if the pair was
    met, plus what u leaves times w's own probability; and for w behind t and u the
    same of the three, plus what the pair leaves times the former. What is left is
    one less the coded shares, so that the probabilities of all words add up to one.
    The end is a token; null counts as empty.
    """
    bounded_batches(documents.sparkSession, ROWS)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            if batch.empty:
                continue
            hashes, begins = _tokens(batch["text"].tolist())
            p, single, known = token_probabilities(model, hashes, begins)
            at = begins[:-1]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].to_numpy(),
                    "n_tokens": np.diff(begins),
                    "n_known": np.add.reduceat(known, at),
                    "base_score": np.add.reduceat(np.log10(single), at),
                    "score": np.add.reduceat(np.log10(p), at),
                }
            )

    shape = f"doc_id {kind}, n_tokens bigint, n_known bigint, base_score double, score double"
    return documents.select("doc_id", "text").mapInPandas(score, shape)


def training_rows(documents: DataFrame) -> DataFrame:
    return documents.filter(crc_of_id() % FOLDS != 0).select("text")


def held_out():
    return (F.lit(0) == crc_of_id() % FOLDS).alias("held_out")
