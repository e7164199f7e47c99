"""Token counts of whole texts by overlapping chunks that are spliced again."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from tokenizers import Encoding, Tokenizer

from subscore.llm.common import bounded_batches

CHUNK = 4_000  # characters
OVERLAP = 64  # at first; doubled until both chunks have a boundary in it
CACHED_UNITS = 500_000


@cache
def _tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@cache
def _units(path: str) -> UnitCounts:
    return UnitCounts(_tokenizer(path))


def _margin(tokenizer: Tokenizer) -> int:
    """Characters at a chunk's end whose splitting may depend on what follows.

    A contraction reaches two characters beyond an apostrophe, an added token as
    far as it is long.
    """
    return 4 + max([0, *(len(t.content) for t in tokenizer.get_added_tokens_decoder().values())])


def word_starts(encoding: Encoding, begin: int = 0, end: int | None = None) -> dict[int, int]:
    """Character offset at which a pre-tokenised word begins, to the tokens before it.

    Of those from ``begin`` to ``end``: only where chunks overlap are they needed.
    """

    def offset(k: int) -> int:
        return encoding.token_to_chars(k)[0]

    tokens = range(len(encoding))
    low = bisect_left(tokens, begin, key=offset)
    high = len(tokens) if end is None else bisect_right(tokens, end, key=offset)
    words = [encoding.token_to_word(k) for k in range(max(low - 1, 0), high)]
    first = low - max(low - 1, 0)  # whether there is a token before
    return {offset(k): k for k in range(low, high) if not k or words[k - low + first] != words[k - low + first - 1]}


def spliced_count(tokenizer: Tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text``, encoded piece by piece.

    The pre-tokeniser goes from left to right and remembers nothing: from a word
    boundary on, its words depend on what follows only. Merges stay within words.
    A boundary of the left chunk that is at least ``_margin`` before its end is
    one of the whole text; if the next chunk has it too, both agree from there
    on, and the counts are spliced. Without such a boundary in the overlap, the
    overlap is doubled, in the end as far as the left chunk reaches back; then
    the left chunk itself is made longer. So the count is the whole text's.
    """
    margin = _margin(tokenizer)
    begin, size, skip, total = 0, chunk, 0, 0  # the left chunk; its tokens that are counted already
    left = tokenizer.encode(text[:size], add_special_tokens=False)
    while begin + size < len(text):
        end = begin + size
        wide, cut = overlap, None
        while cut is None:
            at = max(end - wide, begin + 1)
            length = chunk + end - at
            right = tokenizer.encode(text[at : at + length], add_special_tokens=False)
            starts = word_starts(left, at - begin, size - margin)
            shared = word_starts(right, 0, end - margin - at)
            # Where the right chunk begins is a boundary to it only.
            both = (p for p, k in starts.items() if k >= skip and begin + p > at and begin + p - at in shared)
            cut = next(both, None)
            if at == begin + 1:
                break
            wide *= 2
        if cut is None:  # a word as long as the chunk
            size *= 2
            left = tokenizer.encode(text[begin : begin + size], add_special_tokens=False)
            continue
        total += starts[cut] - skip
        begin, size, skip, left = at, length, shared[begin + cut - at], right
    return total + len(left) - skip


class UnitCounts:
    """Token counts of texts, by units that are encoded once.

    A space behind a character that is surely no white space begins a word of
    the pre-tokeniser: no word goes from other characters on to white space. So a
    text's count is the sum over its units between such spaces. Units not met
    before are encoded together, with offsets; ``limit`` bounds what is kept.
    """

    # White space by any of the definitions in use, and what once was.
    unsure = re.compile(r"[\s\u180e\u200b\ufeff] ")
    sure_space = re.compile(r"(?<=[^\s\u180e\u200b\ufeff]) ")

    def __init__(self, tokenizer: Tokenizer, limit: int = CACHED_UNITS):
        self.tokenizer, self.limit = tokenizer, limit
        self.known: dict[str, int] = {}

    def learn(self, units: list[str]) -> None:
        if len(self.known) > self.limit:
            self.known.clear()
        groups = [units[k : k + 400] for k in range(0, len(units), 400)]
        for at in range(0, len(groups), 32):
            some = groups[at : at + 32]
            texts = ["".join(" " + u for u in g) for g in some]
            for group, encoding in zip(some, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
                begins = np.cumsum([0, *(1 + len(u) for u in group)])
                tokens = np.fromiter((o[0] for o in encoding.offsets), np.int64, len(encoding))
                counts = np.diff(np.searchsorted(tokens, begins)).tolist()
                self.known.update(zip(group, counts))

    def count(self, texts: list[str]) -> list[int]:
        pieces = [t.split(" ") if not self.unsure.search(t) else self.sure_space.split(t) for t in texts]
        # The first unit has no space before it, and the last may end in white space.
        edges = [e for p in pieces for e in (p[0], " " + p[-1] if len(p) > 1 else "")]
        at_edges = [len(e) for e in self.tokenizer.encode_batch_fast(edges, add_special_tokens=False)]
        inner = [p[1:-1] for p in pieces]
        new = set().union(*inner).difference(self.known)
        if new:
            size = len(self.known)
            self.learn(sorted(new))
            if len(self.known) < size:  # the old ones are gone
                self.learn(sorted(set().union(*inner).difference(self.known)))
        of = self.known.__getitem__
        return [at_edges[2 * k] + at_edges[2 * k + 1] + sum(map(of, p)) for k, p in enumerate(inner)]


def count_tokens(documents: DataFrame, tokenizer_path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, ``n_bytes`` and ``n_tokens`` of every row; null counts as empty.

    Texts beyond ``chunk`` characters are encoded in overlapping chunks (on the given
    tables half of all text), so that
    memory doesn't grow with a text's length; shorter ones by ``UnitCounts``.
    Counts are those of the library for the whole text, without begin, end or
    added special tokens. The file is opened by each task: ``tokenizer_path``
    must exist on every machine.
    """
    bounded_batches(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = _tokenizer(tokenizer_path)
        units = _units(tokenizer_path)
        for batch in batches:
            texts = batch["text"].fillna("").tolist()
            short = [k for k, t in enumerate(texts) if len(t) <= chunk]
            counts = [0] * len(texts)
            for k, n in zip(short, units.count([texts[k] for k in short])):
                counts[k] = n
            for k, text in enumerate(texts):
                if len(text) > chunk:
                    counts[k] = spliced_count(tokenizer, text, chunk, overlap)
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": sizes, "n_tokens": counts})

    return documents.select("doc_id", "text").mapInPandas(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
