"""Secret scans: patterns, and a linear-chain conditional random field that adds to them."""

from __future__ import annotations

import math
import random
import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subscore.llm.common import bounded_batches

# The three kinds of base spans, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_VALUE, LEAST_ACCESS = 8, 16

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """Matches of the three patterns, leftmost and without overlaps per kind."""
    spans: list[Span] = []
    if ":" in text or "=" in text:
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def secret_parts(text: str) -> list[tuple[int, int]]:
    """Where the base spans hold the secret itself: the value of an assignment, else the whole."""
    parts = [m.span(2) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    parts += [m.span() for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    return parts + [m.span() for m in _HEX.finditer(text)]


# --- tokens and features ---------------------------------------------------

_EDGE = r"\s=:@\"'`(),;\[\]{}<>"  # what ends a token wherever it stands; full stops and the like only at its end
_TOKEN = re.compile(rf"[^{_EDGE}.!?]+(?:[.!?]+[^{_EDGE}.!?]+)*|[=:@\"'`]|[(),;\[\]{{}}<>]+|[.!?]+")
_PIECE = re.compile(rf"\s+|{_TOKEN.pattern}")  # tokens and what is between them
_SHAPED = re.compile(r"[A-Za-z0-9+/_.-]{8,}")
_VALUE = re.compile(r"[=:]\x20?[\"'`]?[^\s=:]{6,}")  # something given after = or :
_DIGIT = re.compile(r"[0-9]")
_NUMERIC = re.compile(r"[0-9.+/_-]+\Z")
_HEX_ONLY = re.compile(r"[0-9a-f]+\Z")
_WORDS = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential", "access", "private")
_WORD = re.compile(r"[A-Za-z]?[a-z]+\Z")
REACH = 60  # characters of context that a taught stretch has on either side
OUT, BEGIN, INSIDE = range(3)


def is_shaped(token: str) -> bool:
    """Eight characters, a digit among them: a feature, no condition."""
    return len(token) >= 8 and bool(_DIGIT.search(token)) and bool(_SHAPED.fullmatch(token))


@dataclass
class Sequence:
    """Neighbouring tokens: where they are, what they are like."""

    spans: list[tuple[int, int]]
    features: np.ndarray  # a row of zeros and ones per token


def _entropy(token: str) -> float:
    counts = [token.count(c) for c in set(token)]
    return -sum(n / len(token) * math.log2(n / len(token)) for n in counts)


def _own(token: str) -> list[bool]:
    """What a token is like by itself."""
    n, h = len(token), _entropy(token)
    upper, lower = any(c.isupper() for c in token), any(c.islower() for c in token)
    digits = sum(c.isdigit() for c in token)
    return [
        n < 4, 4 <= n < 8, 8 <= n < 12, 12 <= n < 16, 16 <= n < 20, 20 <= n < 32, n >= 32,
        h < 2, 2 <= h < 3, 3 <= h < 3.6, h >= 3.6,
        upper, lower, upper and lower, digits > 0, digits * 4 >= n, digits == n,
        bool(_NUMERIC.match(token)), bool(_HEX_ONLY.match(token)),
        "." in token, "_" in token or "-" in token, "/" in token or "+" in token,
        is_shaped(token), is_shaped(token) and not _NUMERIC.match(token) and digits * 8 >= n,
        bool(_WORD.match(token)), upper and lower and sum(c.isupper() for c in token[1:]) > 1,
        any(not c.isalnum() and c not in "+/_.-" for c in token),
    ]


def _trigger(token: str) -> bool:
    lower = token.lower()
    return any(w in lower for w in _WORDS)


def _beside(token: str | None) -> list[bool]:
    """What a neighbour is like."""
    if token is None:
        return [True, False, False, False, False, False]
    return [False, token == "=", token == ":", token == "@", token in "\"'`", _trigger(token)]


def _file(text: str) -> list[bool]:
    """What the whole text is like."""
    lines = text.count("\n") + 1
    assigned = text.count("=") + text.count(": ")
    return [assigned > 0, assigned >= lines, "{" in text and "}" in text, "BEGIN" in text, len(text) < 2000]


# What a character is like, a bit each.
_CHARACTERS = (
    str.isupper, str.islower, str.isdigit, lambda c: not c.isalnum() and c not in "+/_.-",
    lambda c: c in "0123456789", lambda c: bool(_NUMERIC.match(c)), lambda c: bool(_HEX_ONLY.match(c)),
    lambda c: bool(re.match(r"[A-Za-z0-9+/_.-]\Z", c)), lambda c: bool(re.match(r"[a-z]\Z", c)), lambda c: bool(re.match(r"[A-Za-z]\Z", c)),
    lambda c: c == ".", lambda c: c in "_-", lambda c: c in "/+",
)
UNKNOWN = 1 << 15
_BITS = np.full(sys.maxunicode + 1, UNKNOWN, np.uint16)


def _bits(codes: np.ndarray) -> np.ndarray:
    """The bits of ``_CHARACTERS`` of each code point."""
    bits = _BITS[codes]
    if (bits == UNKNOWN).any():
        for code in np.unique(codes[bits == UNKNOWN]).tolist():
            _BITS[code] = sum(test(chr(code)) << k for k, test in enumerate(_CHARACTERS))
        bits = _BITS[codes]
    return bits


def described_tokens(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``_own`` and ``_beside`` of many tokens at once, a row each."""
    n = np.fromiter(map(len, tokens), np.int64, len(tokens))
    starts = np.cumsum(n) - n
    codes = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    bits = _bits(codes)

    def counts(k: int, skip_first: bool = False) -> np.ndarray:
        is_so = (bits >> k & 1).astype(np.int64)
        return np.add.reduceat(is_so, starts) - (is_so[starts] if skip_first else 0)

    # Of each token, how often each of its characters occurs.
    pairs = np.sort(np.repeat(np.arange(len(tokens)), n) << 21 | codes)
    heads = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    of = pairs[heads] >> 21
    share = np.diff(np.r_[heads, len(pairs)]) / n[of]
    h = -np.bincount(of, share * np.log2(share), len(tokens))
    upper, lower, digits, plain = counts(0) > 0, counts(1) > 0, counts(2), counts(4)
    numeric = counts(5) == n
    shaped = (n >= 8) & (plain > 0) & (counts(7) == n)
    letter_first = (bits[starts] >> np.where(n > 1, 9, 8) & 1) == 1
    own = [
        n < 4, (4 <= n) & (n < 8), (8 <= n) & (n < 12), (12 <= n) & (n < 16), (16 <= n) & (n < 20), (20 <= n) & (n < 32), n >= 32,
        h < 2, (2 <= h) & (h < 3), (3 <= h) & (h < 3.6), h >= 3.6,
        upper, lower, upper & lower, digits > 0, digits * 4 >= n, digits == n,
        numeric, counts(6) == n,
        counts(10) > 0, counts(11) > 0, counts(12) > 0,
        shaped, shaped & ~numeric & (digits * 8 >= n),
        letter_first & (counts(8, True) == n - 1), upper & lower & (counts(0, True) > 1),
        counts(3) > 0,
    ]
    one = np.where(n == 1, codes[starts], 0)
    trigger = np.zeros(len(tokens), bool)
    joined = "\n".join(tokens)
    low = joined.lower()
    if len(low) == len(joined):
        ends = np.cumsum(n + 1)
        for w in _WORDS:
            at = low.find(w)
            while at >= 0:
                trigger[np.searchsorted(ends, at, "right")] = True
                at = low.find(w, at + len(w))
    else:  # a few letters grow when lower-cased
        trigger[:] = [_trigger(t) for t in tokens]
    quote = np.isin(one, [ord(c) for c in "\"'`"])
    beside = [np.zeros(len(tokens), bool), one == ord("="), one == ord(":"), one == ord("@"), quote, trigger]
    return np.column_stack(own), np.column_stack(beside)


OWN, BESIDE = 27, 6
WIDTH = 2 + OWN + BESIDE * 4 + 5
TRIGGERS = [2 + OWN + BESIDE * k - 1 for k in range(1, 5)]  # the columns that tell of a word like password nearby


def _anchors(text: str) -> list[tuple[int, int]]:
    """Where a secret may be or stand beside: shaped tokens, trigger words, what is given after = or :."""
    found = [m.span() for m in _SHAPED.finditer(text) if _DIGIT.search(m[0])] if _DIGIT.search(text) else []
    if "=" in text or ":" in text:
        found += [m.span() for m in _VALUE.finditer(text)]
    lower = text.lower()
    if len(lower) != len(text):  # a few letters grow when lower-cased; places must stay
        lower = "".join(c.lower() if c.isascii() else c for c in text)
    for w in _WORDS:
        at = lower.find(w)
        while at >= 0:
            found.append((at, at + len(w)))
            at = lower.find(w, at + len(w))
    return sorted(found)


def _described(text: str, spans: list[tuple[int, int]], of_file: list[bool]) -> Sequence:
    tokens = [text[a:b] for a, b in spans]
    beside = [_beside(t) for t in (None, None, *tokens, None, None)]
    rows = [
        [True, k > 0 and spans[k - 1][1] == spans[k][0], *_own(t), *beside[k], *beside[k + 1], *beside[k + 3], *beside[k + 4], *of_file]
        for k, t in enumerate(tokens)
    ]
    return Sequence(spans, np.array(rows, np.float64))


def token_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text)]


def sequences(text: str) -> list[Sequence]:
    """All tokens of a text as one sequence, any of which can be a secret; none of a text without tokens."""
    spans = token_spans(text)
    return [_described(text, spans, _file(text))] if spans else []


def taught_stretches(text: str) -> list[Sequence]:
    """Stretches of a text to teach with: what stands near what may be a secret, and one taken from anywhere.

    The field decodes whole texts; this only chooses what a bounded sample is made of.
    """
    windows: list[list[int]] = []
    for a, b in _anchors(text):
        if windows and a - REACH <= windows[-1][1]:
            windows[-1][1] = max(windows[-1][1], b + REACH)
        else:
            windows.append([max(0, a - REACH), b + REACH])
    of_file = _file(text)
    found: list[Sequence] = []
    last = 0
    for begin, end in windows:
        # Cut words at the window's ends belong to no stretch before.
        begin = max(begin, last)
        while begin > last and not text[begin - 1].isspace():
            begin -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        last = end
        spans = [m.span() for m in _TOKEN.finditer(text, begin, end)]
        if spans:
            found.append(_described(text, spans, of_file))
    crc = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    if crc % 4 == 0 and text:
        begin = crc // 4 % len(text)
        while begin and not text[begin - 1].isspace():
            begin -= 1
        spans = [m.span() for m in _TOKEN.finditer(text, begin, begin + 6 * REACH)][:LONGEST]
        if spans:
            found.append(_described(text, spans, of_file))
    return found


# --- the random field ------------------------------------------------------


@dataclass(frozen=True)
class RandomField:
    """``weights`` (feature x tag) and ``steps`` (tag before x tag)."""

    weights: np.ndarray
    steps: np.ndarray

    def scores(self, s: Sequence) -> np.ndarray:
        return s.features @ self.weights

    def decode(self, s: Sequence) -> list[int]:
        """The likeliest tags (Viterbi)."""
        scores = self.scores(s)
        best, back = scores[0].copy(), []
        best[INSIDE] = -1e9
        for row in scores[1:]:
            ways = best[:, None] + self.steps
            back.append(ways.argmax(0))
            best = ways.max(0) + row
        tags = [int(best.argmax())]
        for arrows in reversed(back):
            tags.append(int(arrows[tags[-1]]))
        return tags[::-1]


class Decoder:
    """Decodes whole texts: what a token adds to the scores is reckoned once for all places where it stands."""

    LIMIT = 200_000  # tokens that are remembered

    def __init__(self, field: RandomField) -> None:
        w = field.weights
        besides = 2 + OWN
        self.constant, self.glued, self.own = w[0], w[1], w[2:besides]
        self.beside = np.hstack([w[besides + BESIDE * k : besides + BESIDE * (k + 1)] for k in range(4)])
        self.file = w[besides + 4 * BESIDE :]
        self.steps = field.steps.tolist()
        (oo, ob, _), (bo, bb, bi), (io, ib, ii) = self.steps
        # What a tag that isn't out gains at most, against out, by the steps from the token before and to the next one.
        self.before = max(0.0, ob - oo, bb - bo, bi - bo, ib - io, ii - io)
        self.after = max(0.0, bo - oo, io - oo, bb - ob, ib - ob)
        # An inside after it would have to begin instead.
        self.inside = max(bi, ii) - ob + max(io - bo, ib - bb, ii - bi, 0.0)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.zeros((1024, 15))
        self.table[0, 3:] = np.array(_beside(None), float) @ self.beside  # beyond a text's ends
        self.size = 1

    def _learn(self, tokens: list[str]) -> None:
        begin, self.size = self.size, self.size + len(tokens)
        while self.size > len(self.table):
            self.table = np.vstack([self.table, np.zeros_like(self.table)])
        own, beside = described_tokens(tokens)
        self.table[begin : self.size, :3] = own.astype(float) @ self.own
        self.table[begin : self.size, 3:] = beside.astype(float) @ self.beside
        self.known.update(zip(tokens, range(begin, self.size)))

    def _places(self, pieces: list[str]) -> list[int]:
        """The row of the table for each piece; -1 for white space."""
        places = list(map(self.known.get, pieces))
        if None in places:
            if len(self.known) > self.LIMIT:
                self.forget()
            new = {t for t in pieces if t not in self.known}
            spaces = [t for t in new if t.isspace()]
            self.known.update(dict.fromkeys(spaces, -1))
            if new := sorted(new.difference(spaces)):
                self._learn(new)
            places = list(map(self.known.__getitem__, pieces))
        return places

    def scores(self, text: str, spans: list[tuple[int, int]]) -> np.ndarray:
        """As ``RandomField.scores`` of the text's sequence."""
        return self._scores(text, *self._tokens(_PIECE.findall(text)))

    def _tokens(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of all tokens the row of the table, and which piece of the text they are."""
        at = np.array(self._places(pieces), np.int64)
        tokens = np.flatnonzero(at >= 0)
        return at[tokens], tokens

    def _scores(self, text: str, at: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        n = len(at)
        around = np.zeros(n + 4, np.int64)
        around[2:-2] = at
        read = self.table.take(around, 0)
        out = read[2:-2, :3] + (self.constant + np.array(_file(text), float) @ self.file)
        # Pieces leave nothing out: tokens are glued where no white space is a piece between them.
        out[1:] += (np.diff(tokens) == 1)[:, None] * self.glued
        for k, shift in enumerate((0, 1, 3, 4)):
            out += read[shift : shift + n, 3 + 3 * k : 6 + 3 * k]
        return out

    def open_places(self, rows: np.ndarray) -> np.ndarray:
        """The tokens that may have a tag other than out; for the others, out surely scores higher.

        Were such a token not out, making it out (and beginning anew behind it, should
        the next be inside) would gain: by its own scores it loses more than steps can give.
        """
        next_inside = np.r_[rows[1:, INSIDE] - rows[1:, BEGIN], -np.inf] + self.inside
        most = rows[:, 1:].max(1) - rows[:, 0] + self.before + np.maximum(self.after, next_inside)
        return np.flatnonzero(most >= -1e-6)

    def decode(self, text: str, spans: list[tuple[int, int]]) -> list[int]:
        """The likeliest tags of a whole text, as ``RandomField.decode``."""
        rows = self.scores(text, spans)
        tags = [OUT] * len(rows)
        for k, tag in self._tagged(rows):
            tags[k] = tag
        return tags

    def found(self, text: str) -> list[tuple[int, int]]:
        """Where the likeliest tags of a whole text have a secret."""
        pieces = _PIECE.findall(text)
        at, tokens = self._tokens(pieces)
        tagged = self._tagged(self._scores(text, at, tokens)) if len(at) else []
        spans: list[tuple[int, int]] = []
        if tagged:
            ends = list(accumulate(map(len, pieces)))
            for k, tag in tagged:
                piece = int(tokens[k])
                if tag == BEGIN:
                    spans.append((ends[piece] - len(pieces[piece]), ends[piece]))
                elif spans:
                    spans[-1] = (spans[-1][0], ends[piece])
        return spans

    def _tagged(self, rows: np.ndarray) -> list[tuple[int, int]]:
        """The tokens that aren't out, with their tags.

        Tokens that are surely out part the text into stretches, which are decoded by themselves.
        """
        open_ = self.open_places(rows)
        if not len(open_):
            return []
        found = []
        for stretch in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
            first, last = int(stretch[0]), int(stretch[-1])
            tags = self._best(rows[first : last + 1].tolist(), first > 0, last + 1 < len(rows))
            found += [(first + k, tag) for k, tag in enumerate(tags) if tag != OUT]
        return found

    def _best(self, rows: list[list[float]], after_out: bool, before_out: bool) -> list[int]:
        """The likeliest tags of a stretch (Viterbi), between tokens that are out or a text's ends."""
        (oo, ob, _), (bo, bb, bi), (io, ib, ii) = self.steps
        o, b, i = rows[0][0], rows[0][1], -1e9
        if after_out:
            o, b = o + oo, b + ob
        back = []
        for so, sb, si in rows[1:]:
            to_o, to_b, to_i = (o + oo, OUT), (o + ob, OUT), (b + bi, BEGIN)
            if b + bo > to_o[0]:
                to_o = (b + bo, BEGIN)
            if i + io > to_o[0]:
                to_o = (i + io, INSIDE)
            if b + bb > to_b[0]:
                to_b = (b + bb, BEGIN)
            if i + ib > to_b[0]:
                to_b = (i + ib, INSIDE)
            if i + ii > to_i[0]:
                to_i = (i + ii, INSIDE)
            back.append((to_o[1], to_b[1], to_i[1]))
            o, b, i = to_o[0] + so, to_b[0] + sb, to_i[0] + si
        if before_out:
            o, b, i = o + oo, b + bo, i + io
        tags = [max((o, -OUT), (b, -BEGIN), (i, -INSIDE))[1] * -1]
        for arrows in reversed(back):
            tags.append(arrows[tags[-1]])
        return tags[::-1]


@lru_cache(1)
def _decoder(weights: bytes, steps: bytes) -> Decoder:
    """One for all tasks of a worker with the same field, so that they share what is known of tokens."""
    return Decoder(RandomField(np.frombuffer(weights).reshape(-1, 3), np.frombuffer(steps).reshape(3, 3)))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def fit_random_field(
    examples: list[tuple[Sequence, list[int]]], rounds: int = 150, rate: float = 0.1, decay: float = 1e-3
) -> RandomField:
    """Maximum conditional likelihood: forward-backward over all sequences at once, with Adam."""
    steps = np.zeros((3, 3))
    steps[OUT, INSIDE] = -1e9  # inside follows begin or inside
    weights = np.zeros((WIDTH, 3))
    if not examples:
        return RandomField(weights + np.array([0, -50.0, -50.0]), steps)
    longest, n = max(len(t) for _, t in examples), len(examples)
    x, y = np.zeros((n, longest, WIDTH)), np.zeros((n, longest), int)
    there = np.zeros((n, longest), bool)
    for k, (s, tags) in enumerate(examples):
        x[k, : len(tags)], y[k, : len(tags)], there[k, : len(tags)] = s.features, tags, True
    tags = np.eye(3)[y] * there[..., None]
    observed = np.einsum("nlf,nlt->ft", x, tags)
    pairs = np.einsum("nla,nlb->ab", tags[:, :-1], tags[:, 1:])
    size = weights.size + 9
    m, v = np.zeros(size), np.zeros(size)
    for r in range(1, rounds + 1):
        scores = x @ weights
        scores[:, 0, INSIDE] = -1e9
        forward, backward = scores.copy(), np.zeros_like(scores)
        for t in range(1, longest):
            now = _log_sum(forward[:, t - 1, :, None] + steps, 1) + scores[:, t]
            forward[:, t] = np.where(there[:, t, None], now, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            now = _log_sum(steps + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(there[:, t + 1, None], now, 0)
        whole = _log_sum(forward[:, -1], 1)
        single = np.exp(np.clip(forward + backward - whole[:, None, None], -700, 0)) * there[..., None]
        joint = forward[:, :-1, :, None] + steps + (scores + backward)[:, 1:, None, :] - whole[:, None, None, None]
        joint = np.exp(np.clip(joint, -700, 0)) * there[:, 1:, None, None]
        gradient = np.concatenate(
            [
                ((np.einsum("nlf,nlt->ft", x, single) - observed) / n + decay * weights).ravel(),
                ((joint.sum((0, 1)) - pairs) / n + decay * np.maximum(steps, -50)).ravel(),
            ]
        )
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        change = rate * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.999**r)) + 1e-8)
        weights = weights - change[: weights.size].reshape(weights.shape)
        steps = steps - change[weights.size :].reshape(3, 3)
        steps[OUT, INSIDE] = -1e9
    return RandomField(weights, steps)


def taught_tags(s: Sequence, parts: list[tuple[int, int]]) -> list[int]:
    """Tags by the base spans: the first token of a secret begins it, the next are inside."""
    tags, before = [], None
    for a, b in s.spans:
        part = next((p for p in parts if p[0] < b and a < p[1]), None)
        tags.append(OUT if part is None else INSIDE if part == before else BEGIN)
        before = part
    return tags


def masked(s: Sequence) -> Sequence:
    """As if no word nearby told of a secret, so that the field learns what else does."""
    features = s.features.copy()
    features[:, TRIGGERS] = 0
    return Sequence(s.spans, features)


# What secrets are drawn from to teach more shapes than the patterns have.
_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = ("0123456789abcdef", _LETTERS, _LETTERS + "0123456789", _LETTERS + "0123456789!#$%&*+/_-")


def redrawn(text: str, parts: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text with each secret drawn anew from one of the alphabets, and where they are.

    One is as long as before or shorter, with spaces behind it; all else keeps its place.
    """
    draw = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    out, drawn, at = [], [], 0
    for a, b in sorted(parts):
        if a >= at:
            size = draw.randint(min(10, b - a), b - a)
            out += [text[at:a], "".join(draw.choices(draw.choice(ALPHABETS), k=size)), " " * (b - a - size)]
            drawn.append((a, a + size))
            at = b
    return "".join(out) + text[at:], drawn


SAMPLE_DOCUMENTS = 40_000  # the bound of what is fitted
SAMPLE_SEQUENCES = 3_000
LONGEST = 80  # tokens of a sequence that is fitted


def fit_secrets(documents: DataFrame) -> RandomField:
    """Fit the field on the base spans of at most ``SAMPLE_DOCUMENTS`` documents.

    The documents whose id hashes lowest are taken; of the stretches found in
    them, at most ``SAMPLE_SEQUENCES`` of at most ``LONGEST`` tokens, those with
    secrets and others alike. Every other one is masked: the patterns teach mostly
    what stands behind their own keywords, and the field is to know secrets that
    have none. Texts with secrets are taken a second time with others drawn in their
    places, of more shapes than the patterns have. Without any secrets, the field
    tags nothing.
    """
    bounded_batches(documents.sparkSession)
    ids = documents.select("doc_id").filter("doc_id is not null").distinct()
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS)

    def stretches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"].fillna("")):
                bodies = [(text, secret_parts(text))]
                if bodies[0][1]:
                    bodies.append(redrawn(*bodies[0]))
                for body, parts in bodies:
                    for s in taught_stretches(body):
                        if len(s.spans) <= LONGEST:
                            bits = np.packbits(s.features.astype(bool)).tobytes()
                            rows.append((str(doc), s.spans[0][0], bits, taught_tags(s, parts)))
            yield pd.DataFrame(rows, columns=["doc", "at", "bits", "tags"])

    taken = (
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")  # SAMPLE_DOCUMENTS ids at most
        .mapInPandas(stretches, "doc string, at long, bits binary, tags array<int>")
        .orderBy(F.xxhash64("doc", "at"), "doc", "at", "bits")
        .limit(SAMPLE_SEQUENCES)
        .toPandas()
    )
    examples = []
    for k, (bits, tags) in enumerate(zip(taken["bits"], taken["tags"])):
        table = np.unpackbits(np.frombuffer(bits, np.uint8))[: len(tags) * WIDTH].reshape(len(tags), WIDTH)
        s = Sequence([], table.astype(float))
        examples.append((masked(s) if k % 2 else s, [int(t) for t in tags]))
    return fit_random_field(examples if any(BEGIN in t for _, t in examples) else [])


def added_spans(field: RandomField | Decoder, text: str, base: list[Span]) -> list[Span]:
    """Secrets that the field finds outside all base spans, anywhere in the text."""
    decoder = field if isinstance(field, Decoder) else Decoder(field)
    spans = [(a, 3, b) for a, b in decoder.found(text)]
    return [x for x in spans if not any(x[0] < b and a < x[2] for a, _, b in base)]


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in sorted(spans))


def find_secrets(documents: DataFrame, field: RandomField) -> DataFrame:
    """Secrets of every whole text: a row per document row.

    Returns ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base`` and
    ``spans``: kind:start:end in code points, the end exclusive, by start and
    kind, comma-joined. Base spans stay as they are; the field adds spans of kind
    ``crf`` that overlap none. Null counts as empty, and an empty text has none.
    """
    bounded_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(field)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = _decoder(shared.value.weights.tobytes(), shared.value.steps.tobytes())
        for batch in batches:
            rows = []
            for text in batch["text"].fillna(""):
                base = base_spans(text)
                every = base + added_spans(decoder, text, base)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                rows.append((*counts, spans_text(base), spans_text(every)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base", "spans"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    shape = f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base string, spans string"
    return documents.select("doc_id", "text").mapInPandas(scan, shape)
