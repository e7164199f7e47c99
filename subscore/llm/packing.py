"""Documents packed into fixed windows by sum-of-squares online packing."""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer, pre_tokenizers

from subscore.llm.common import bounded_batches

WINDOW = 4096  # tokens
END = 2  # id behind each document
OPEN = 1024  # windows that a task keeps partially filled; each holds one window of ids at most
CACHED_UNITS = 400_000
TASK_BITS = 33  # a window's id: the task above, its number there below
ID = np.dtype("<u4")


# Letters, digits and white space among the first 256 characters, whatever the version of Unicode.
LETTERS, DIGITS, SPACES = r"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"


class UnitIds:
    """Token ids of texts, by the units between ASCII white space.

    The file's pre-tokeniser must drop white space, so that no token reaches over it
    and a text's ids are those of its units in a row; ``probe`` texts show that. Each
    unit of a batch is looked up once. New units go to the library as a whole, unless
    they have characters below 256 only and the file splits words as ``_splitter``
    knows: then the model is asked for each word, which skips the rest of the
    library's steps. ``limit`` bounds the units, and the words, that are kept.
    """

    probe = ["a b", "a\nb c", " a  b "]
    long = 64  # characters; what is longer isn't kept

    def __init__(self, path: str, limit: int = CACHED_UNITS):
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        for text in self.probe:
            if self.whole([text])[0] != b"".join(self.whole(text.split())):
                raise ValueError(f"{path} doesn't drop white space")
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = _splitter(json.loads(Path(path).read_text(encoding="utf-8")))
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.units: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, ID).tobytes() for e in found]

    def word(self, word: str) -> bytes:
        if word in self.words:
            return self.words[word]
        shown = word if word.isascii() and word.isprintable() else "".join(w for w, _ in self.bytes.pre_tokenize_str(word))
        ids = np.array([t.id for t in self.tokenizer.model.tokenize(shown)], ID).tobytes()
        if len(word) <= self.long and len(self.words) < self.limit:
            self.words[word] = ids
        return ids

    def unit(self, unit: str) -> bytes:
        """Ids of one unit."""
        if self.split is None or max(unit) > "\xff" or any(t in unit for t in self.added):
            return self.whole([unit])[0]
        lower = unit.lower()
        if lower.isalpha():
            return self.word(lower)
        return b"".join(map(self.word, self.split(lower)))

    def ids(self, units: list[str]) -> list[bytes]:
        known, out = self.units, []
        for unit in units:
            found = known.get(unit)
            if found is None:
                found = self.unit(unit) if unit else b""
                if len(unit) <= self.long and len(known) < self.limit:
                    known[unit] = found
            out.append(found)
        return out

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        distinct = self.ids(coded.dictionary.to_pylist())
        which = coded.indices.to_numpy(zero_copy_only=False)
        flat = np.frombuffer(b"".join(distinct), ID)
        sizes = np.fromiter(map(len, distinct), np.int64, len(distinct)) // ID.itemsize
        begins = np.cumsum(sizes) - sizes
        # Where each occurrence's ids lie in ``flat``, one after the other.
        held = sizes[which]
        ends = np.cumsum(held)
        place = np.repeat((begins[which] - ends + held).astype(np.int32), held)
        place += np.arange(len(place), dtype=np.int32)
        ids = flat[place]
        of_text = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
        bounds = np.concatenate(([0], ends))[np.concatenate(([0], of_text)).astype(np.int64)]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _splitter(described: dict) -> Callable[[str], list[str]] | None:
    """What splits a lower-cased unit of characters below 256 as the file does; None if its steps are others."""
    steps = (described.get("normalizer") or {}).get("normalizers", [])
    cut, *coded = (described.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    known = (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": r"\s+"}, " ")
        and (cut.get("type"), cut.get("behavior"), cut.get("invert")) == ("Split", "Removed", True)
        and [(c["type"], c["add_prefix_space"], c["use_regex"]) for c in coded] == [("ByteLevel", False, False)]
    )
    if not known:
        return None
    pattern = cut["pattern"]["Regex"]
    for name, members in ((r"\p{L}", LETTERS), (r"\p{N}", DIGITS), (r"\s", SPACES)):
        pattern = pattern.replace(name, members)
    return re.compile(pattern).findall


@cache
def _units(path: str) -> UnitIds:
    return UnitIds(path)


class Levels:
    """The windows that are partially filled, by how full they are.

    ``count[h]`` is the number of windows with h ids in them; an item of r ids goes
    where the sum of the squared counts of levels 1 to ``window`` - 1 grows least:
    into a window of level h that goes up to h + r, or into a new one (h = 0). Moving
    a window from h to h + r changes the sum by 2 count[h + r] - 2 count[h] + 2, less
    the first part if it is full then; a new one by 2 count[r] + 1. Among equals the
    fullest window is taken.
    """

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.windows: dict[int, deque] = {}
        self.open = 0

    def best(self, r: int) -> int:
        reach = self.window - r
        cost = 2 * self.count[r : self.window + 1] - 2 * self.count[: reach + 1] + 2
        cost[reach] -= 1  # a full window isn't counted: only what leaves is
        cost[0] = 2 * self.count[r] + 1
        cost[1:][self.count[1 : reach + 1] == 0] = np.iinfo(np.int64).max
        return reach - int(np.argmin(cost[::-1]))

    def take(self, h: int):
        """The oldest window of level h."""
        found = self.windows[h].popleft()
        if not self.windows[h]:
            del self.windows[h]
        self.count[h] -= 1
        self.open -= 1
        return found

    def put(self, h: int, held) -> None:
        self.windows.setdefault(h, deque()).append(held)
        self.count[h] += 1
        self.open += 1

    def emptiest(self):
        return self.take(min(self.windows))


def powers_of_two(n: int) -> list[int]:
    """Whole numbers that add up to n, each a power of two, the largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Packs one task's documents; what is full is handed out.

    A document beyond a window is cut: whole windows at first, the rest is placed
    like a document. In the end the windows still partially filled are emptied into
    one run, which is cut into whole windows, and its last part into powers of two,
    which aren't padded: so no padding is left. The same is done to the emptier half
    whenever more than ``most`` windows are open, so that memory is bounded.
    A piece is (document, begin in it, ids).
    """

    def __init__(self, window: int = WINDOW, most: int = OPEN):
        self.window, self.most = window, most
        self.levels = Levels(window)
        self.rows: list[tuple] = []
        self.sequences = 0

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, begin, ids in pieces:
            self.rows.append((*doc, begin, ids.tobytes(), self.sequences, offset))
            offset += len(ids)
        self.sequences += 1

    def add(self, doc: tuple, ids: np.ndarray) -> None:
        for at in range(0, len(ids), self.window):
            piece = (doc, at, ids[at : at + self.window])
            size = len(piece[2])
            if size == self.window:
                self.close([piece])
                continue
            if at:  # no view that keeps a long document's ids
                piece = (doc, at, piece[2].copy())
            h = self.levels.best(size)
            held = [*(self.levels.take(h) if h else ()), piece]
            if h + size == self.window:
                self.close(held)
            else:
                self.levels.put(h + size, held)
        if self.levels.open > self.most:
            self.empty(self.most // 2, last=False)

    def empty(self, keep: int, last: bool) -> None:
        run: list[tuple] = []
        while self.levels.open > keep:
            run += self.levels.emptiest()
        left = sum(len(ids) for _, _, ids in run)
        run.reverse()
        while left >= self.window:
            self.cut(run, self.window)
            left -= self.window
        if left and not last:
            self.levels.put(left, run[::-1])
        elif left:
            for size in powers_of_two(left):
                self.cut(run, size)

    def cut(self, run: list[tuple], size: int) -> None:
        """A sequence of the next ``size`` ids of a run, which is held in reverse."""
        held = []
        while size:
            doc, begin, ids = run.pop()
            held.append((doc, begin, ids[:size]))
            if len(ids) > size:
                run.append((doc, begin + size, ids[size:]))
            size -= len(held[-1][2])
        self.close(held)

    def handed_out(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack_documents(documents: DataFrame, tokenizer_path: str, window: int = WINDOW, end: int = END, most: int = OPEN) -> DataFrame:
    """A row for each piece: ``doc_id``, ``doc_tokens``, ``start``, ``ids``, ``sequence_id``, ``offset``.

    ``ids`` are the piece's token ids, little-endian unsigned 32-bit numbers; ``start``
    counts the document's ids before it, ``offset`` those before it in its sequence.
    Every id of every row lies in one piece: the library's ids of the whole text,
    without special tokens added, and ``end``. Each task packs what it reads, by
    itself and in one pass; nothing is shuffled, and a task that runs again gives the
    same sequences. No sequence is longer than ``window``, and each is either full or a
    power of two long, so that nothing is padded.

    A null or empty text is ``end`` alone. Rows that repeat, and null ids, are documents
    like others; an empty table gives no rows. Columns besides ``doc_id`` and ``text``
    are never looked at. The tokenizer's file must exist on every machine.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    bounded_batches(documents.sparkSession, 2000)
    kind = documents.schema["doc_id"].dataType
    names = ["doc_tokens", "start", "ids", "sequence_id", "offset"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << TASK_BITS
        units, packer = _units(tokenizer_path), Packer(window, most)
        tail = np.array([end], ID)
        id_type = pa.int64()

        def table() -> pa.RecordBatch:
            docs, *columns = zip(*packer.handed_out())
            columns[3] = [first + k for k in columns[3]]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            return pa.RecordBatch.from_arrays([pa.array(docs, id_type), *arrays], ["doc_id", *names])

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc, ids in zip(batch["doc_id"].to_pylist(), units.batch(batch["text"])):
                packer.add((doc, len(ids) + 1), np.concatenate((ids, tail)))
            if packer.rows:
                yield table()
        packer.empty(0, last=True)
        if packer.rows:
            yield table()

    schema = f"doc_id {kind.simpleString()}, doc_tokens bigint, start bigint, ids binary, sequence_id bigint, offset bigint"
    return documents.select("doc_id", "text").mapInArrow(packed, schema)
