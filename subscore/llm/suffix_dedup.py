"""Repeated passages by sorted suffixes: anchors, multikey quicksort and blind tries."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subscore.llm.common import ROW, bitmap, bounded_batches, in_bitmap, mixed, numbered, stored, stored_in, utf8
from subscore.session import remove_folders, shared_folder

LENGTH = 400  # bytes of a passage
GRAM = 32  # bytes that make an anchor
HALF = LENGTH // 2
BLOCK = 1 << 20  # starts handled at once
STEP = 1 << 15  # of them, those whose grams are hashed at once, in a processor's cache
SHALLOW = 64  # bytes sorted by multikey quicksort
BITMAP_BITS = 26  # 8 MB
BATCH = 20_000  # stretches sorted together
MANY = 1_000  # stretches of a key that are sorted; of more, the passages are counted
MANY_BITS = 20
SALTS = 16


# --- anchors ---------------------------------------------------------------


def _anchors(text: np.ndarray) -> np.ndarray:
    """For each start of a passage, where the least of its grams is, the first of equal ones."""
    h = text.astype(np.uint64) + np.uint64(1)
    size = 1
    with np.errstate(over="ignore"):
        while size < GRAM:
            h = h[:-size] * np.uint64(0x9E3779B97F4A7C15) + h[size:]
            h ^= h >> np.uint64(29)
            size *= 2
    least = (mixed(h) & ~np.uint64(0xFFFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    width, window = 1, LENGTH - GRAM + 1
    while width * 2 <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = window - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


@dataclass
class Stretches:
    """Runs of starts that have one anchor, cut where the anchor is ``HALF`` ahead.

    Equal passages have their anchor at the same distance, and share ``HALF``
    bytes on the one or the other side of it. The hash of those is the key: equal
    passages are in stretches of one key.

    ``whole``: bytes of many texts. ``anchors``, ``firsts``, ``lasts``: places in it; ``of``: which
    text a stretch is in; ``behind``: what to add for places in that text.
    """

    whole: bytes
    keys: np.ndarray
    anchors: np.ndarray
    firsts: np.ndarray
    lasts: np.ndarray
    of: np.ndarray
    behind: np.ndarray

    def digests(self, some: np.ndarray) -> np.ndarray:
        """128-bit hashes of stretches' bytes with their anchors' places, as pairs of 64 bits."""
        w, firsts = self.whole, self.firsts[some]
        parts = zip(firsts.tolist(), (self.lasts[some] + LENGTH).tolist(), (self.anchors[some] - firsts).tolist())
        return np.frombuffer(b"".join([xxhash.xxh3_128_digest(w[f:e], d) for f, e, d in parts]), np.int64).reshape(-1, 2)


def _of_pieces(pieces: list[tuple[int, int, bytes]]) -> Stretches:
    whole = b"".join([p for _, _, p in pieces])
    sizes = np.array([len(p) for _, _, p in pieces])
    ends = np.cumsum(sizes)
    n = len(whole) - LENGTH + 1
    piece = np.repeat(np.arange(len(pieces)), sizes)[:n]
    starts = np.flatnonzero(np.arange(n) + LENGTH <= ends[piece])  # a passage is within one text
    anchors = np.concatenate(
        [
            begin + _anchors(np.frombuffer(whole, np.uint8)[begin : begin + STEP + LENGTH - 1])
            for begin in range(0, n, STEP)
        ]
    )[starts]
    change = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
    firsts, lasts, a = starts[change], starts[np.r_[change[1:], len(starts)] - 1], anchors[change]
    left, right = np.flatnonzero(firsts <= a - HALF), np.flatnonzero(lasts > a - HALF)
    of_left = [xxhash.xxh3_64_intdigest(whole[k - HALF : k + GRAM], 1) for k in a[left].tolist()]
    of_right = [xxhash.xxh3_64_intdigest(whole[k : k + HALF], 2) for k in a[right].tolist()]
    firsts, lasts, a = (
        np.r_[firsts[left], np.maximum(firsts[right], a[right] - HALF + 1)],
        np.r_[np.minimum(lasts[left], a[left] - HALF), lasts[right]],
        np.r_[a[left], a[right]],
    )
    piece = piece[firsts]
    behind = np.array([b for _, b, _ in pieces]) - (ends - sizes)
    of = np.array([k for k, _, _ in pieces])
    return Stretches(whole, np.array(of_left + of_right, np.uint64), a, firsts, lasts, of[piece], behind[piece])


def stretches(texts: list[bytes]) -> Iterator[Stretches]:
    """The stretches of all texts, those of many short ones at once, of a long one by ``BLOCK`` starts."""
    pieces: list[tuple[int, int, bytes]] = []
    held = 0
    for k, text in enumerate(texts):
        for begin in range(0, len(text) - LENGTH + 1, BLOCK):
            part = text[begin : begin + BLOCK + LENGTH - 1]
            if pieces and held + len(part) > BLOCK:
                yield _of_pieces(pieces)
                pieces, held = [], 0
            pieces.append((k, begin, part))
            held += len(part)
    if pieces:
        yield _of_pieces(pieces)


# --- deep-shallow sorting --------------------------------------------------


def common_length(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return n - ((int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")).bit_length() + 7) // 8


class _Node:
    """A branching: how many bytes all below share, and what follows, by the next byte (-1: the end)."""

    __slots__ = ("depth", "ways")

    def __init__(self, depth: int, ways: dict):
        self.depth, self.ways = depth, ways


def _byte(s: bytes, at: int) -> int:
    return s[at] if at < len(s) else -1


def blind_trie_order(strings: list[bytes], items: list[int]) -> list[int]:
    """``items`` by string, through a trie that keeps branching bytes and depths only.

    A new string goes down blindly, by the branching bytes alone, to some leaf (a
    list of equal strings); one comparison with it tells where they part, and
    there the new one is put in.
    """
    top = _Node(-1, {0: [items[0]]})  # above the root
    for item in items[1:]:
        s = strings[item]
        below = top.ways[0]
        while isinstance(below, _Node):
            below = below.ways.get(_byte(s, below.depth)) or next(iter(below.ways.values()))
        met = strings[below[0]]
        same = common_length(s, met)
        above, way, below = top, 0, top.ways[0]
        while isinstance(below, _Node) and below.depth < same:
            above, way = below, _byte(s, below.depth)
            below = above.ways[way]
        if isinstance(below, _Node) and below.depth == same:
            below.ways.setdefault(_byte(s, same), []).append(item)
        elif same == len(s) == len(met):
            below.append(item)
        else:
            above.ways[way] = _Node(same, {_byte(met, same): below, _byte(s, same): [item]})
    out: list[int] = []
    stack = [top.ways[0]]
    while stack:
        node = stack.pop()
        if isinstance(node, _Node):
            stack.extend(node.ways[way] for way in sorted(node.ways, reverse=True))
        else:
            out += node
    return out


def deep_shallow_order(strings: list[bytes], items: list[int]) -> list[int]:
    """``items`` by string: multikey quicksort by eight bytes at a time, then blind tries."""
    out: list[int] = []
    stack = [(items, 0)]
    while stack:
        some, depth = stack.pop()
        if len(some) < 2:
            out += some
        elif depth >= SHALLOW:
            out += blind_trie_order(strings, some)
        else:
            pivot = strings[some[len(some) // 2]][depth : depth + 8]
            less, same, more = [], [], []
            for k in some:
                word = strings[k][depth : depth + 8]
                (less if word < pivot else more if word > pivot else same).append(k)
            # Strings that end within the pivot's eight bytes are equal as a whole.
            below = (same, depth + 8) if len(pivot) == 8 else (same, SHALLOW)
            stack += [(more, depth), below, (less, depth)]
    return out


def repeated_starts(groups: np.ndarray, texts: list[bytes], ahead: np.ndarray) -> np.ndarray:
    """Which starts of each stretch begin a passage that another stretch of its group has too.

    ``texts``: each stretch's bytes; ``ahead``: the anchor's distance from their
    begin. Returns a row per stretch and a column per start. Stretches are sorted
    by what follows the anchor; neighbours that agree long enough, and whose bytes
    before the anchor hash alike, share a passage.
    """
    n = len(texts)
    starts = np.array([len(t) for t in texts]) - LENGTH + 1
    out = np.zeros((n, max(starts)), bool)
    right = [t[a:] for t, a in zip(texts, ahead.tolist())]
    order: list[int] = []
    cuts = np.r_[0, np.flatnonzero(groups[1:] != groups[:-1]) + 1, n].tolist()
    for begin, end in zip(cuts, cuts[1:]):
        order += deep_shallow_order(right, list(range(begin, end)))
    agree = np.array(
        [0] + [common_length(right[a], right[b]) if groups[a] == groups[b] else -1 for a, b in zip(order, order[1:])]
    )
    at = np.array(order)
    far, last = ahead[at], ahead[at] - starts[at] + 1  # distances of the first and the last start
    widest = int(far.max()) + 1
    before = np.zeros((n, widest), np.uint8)  # column d - 1: the byte d before the anchor
    for row, k in enumerate(order):
        part = texts[k][: ahead[k]][::-1]
        before[row, : len(part)] = np.frombuffer(part, np.uint8)
    h = np.zeros(n, np.uint64)
    for d in range(widest):
        if d:
            h = mixed(h ^ before[:, d - 1].astype(np.uint64))
        alive = np.flatnonzero((last <= d) & (d <= far))
        if len(alive) < 2:
            continue
        run = np.cumsum(agree < LENGTH - d).astype(np.uint64)
        kind = (mixed(h) ^ run)[alive]  # not both hashed alike: a byte and a run are small numbers, and may be the same
        sorted_ = np.argsort(kind, kind="stable")
        same = kind[sorted_][1:] == kind[sorted_][:-1]
        twice = alive[sorted_[np.r_[same, False] | np.r_[False, same]]]
        out[at[twice], far[twice] - d] = True
    return out


# --- on documents ----------------------------------------------------------


def _scan(documents: DataFrame) -> DataFrame:
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch[ROW].to_numpy()
            for found in stretches([utf8(t) for t in batch["text"]]):
                d = found.digests(np.arange(len(found.keys)))
                first, last = found.firsts + found.behind, found.lasts + found.behind
                columns = {"key": found.keys.view(np.int64), "d1": d[:, 0], "d2": d[:, 1], "first": first, "last": last}
                yield pd.DataFrame({ROW: rows[found.of]} | columns)

    shape = f"{ROW} bigint, key bigint, d1 bigint, d2 bigint, first bigint, last bigint"
    return numbered(documents).select(ROW, "text").mapInPandas(scan, shape)


def _texts_of(documents: DataFrame, wanted: np.ndarray, many: np.ndarray) -> DataFrame:
    """Bytes of the stretches whose key's bit is set, once for each content and task at least; whether it is in ``many``."""
    shared = documents.sparkSession.sparkContext.broadcast((wanted, many))
    columns = ["key", "d1", "d2", "many", "ahead", "bytes"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: set[tuple] = set()
            rows, size = [], 0
            for found in stretches([utf8(t) for t in batch["text"]]):
                wanted, many = (in_bitmap(x, found.keys) for x in shared.value)
                some = np.flatnonzero(wanted)
                contents = zip(some.tolist(), found.keys[some].view(np.int64).tolist(), *found.digests(some).T.tolist())
                for k, *content in contents:
                    if tuple(content) in seen:
                        continue
                    seen.add(tuple(content))
                    first, end = int(found.firsts[k]), int(found.lasts[k]) + LENGTH
                    rows.append((*content, bool(many[k]), int(found.anchors[k]) - first, found.whole[first:end]))
                    size += end - first
                    if size > 16 << 20:
                        yield pd.DataFrame(rows, columns=columns)
                        rows, size = [], 0
            yield pd.DataFrame(rows, columns=columns)

    return documents.select("text").mapInPandas(scan, "key bigint, d1 bigint, d2 bigint, many boolean, ahead int, bytes binary")


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted stretches to the starts that are repeated, whole groups at a time."""
    columns = ["key", "d1", "d2", "spans"]
    held: list[pd.DataFrame] = []

    def done(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows.groupby("key")["key"].transform("size")
        rows = rows[sizes > 1]
        if rows.empty:
            return pd.DataFrame(columns=columns)
        found = repeated_starts(rows["key"].to_numpy(), rows["bytes"].tolist(), rows["ahead"].to_numpy().astype(np.int64))
        keep = np.flatnonzero(found.any(1))
        spans = []
        for k in keep:
            edges = np.flatnonzero(np.diff(np.r_[False, found[k], False].astype(np.int8)))
            spans.append([{"a": int(a), "b": int(b)} for a, b in edges.reshape(-1, 2)])
        return rows.iloc[keep][["key", "d1", "d2"]].assign(spans=spans)

    for batch in batches:
        if batch.empty:
            continue
        held.append(batch)
        if sum(map(len, held)) < BATCH:
            continue
        rows = pd.concat(held)
        open_ = rows["key"] == rows["key"].iloc[-1]  # its group may go on
        if not open_.all():
            yield done(rows[~open_])
            rows = rows[open_]
        held = [rows]
    if held:
        yield done(pd.concat(held))


def _passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hash of the passage at each start of each stretch."""
    for batch in batches:
        n = batch["bytes"].map(len).to_numpy(np.int64) - LENGTH + 1
        starts = [k for m in n.tolist() for k in range(m)]
        texts = (t[k : k + LENGTH] for t, m in zip(batch["bytes"], n.tolist()) for k in range(m))
        p = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, texts)), np.int64).reshape(-1, 2)
        content = {c: np.repeat(batch[c].to_numpy(np.int64), n) for c in ("key", "d1", "d2")}
        yield pd.DataFrame(content | {"at": np.array(starts, np.int32), "p1": p[:, 0], "p2": p[:, 1]})


def _compare_many(texts: DataFrame, work: str) -> DataFrame:
    """As ``_compare``, for keys with so many stretches that no task can have them all.

    A passage is in a stretch once at most, as its anchor is the stretch's. So
    passages (128-bit hash) are counted, with combination on the map side. Which
    ones are repeated is told to the starts by a join over salts, so that a
    passage that very many stretches have is spread.
    """
    content = ["key", "d1", "d2"]
    starts = texts.select(*content, "bytes").mapInPandas(_passages, "key bigint, d1 bigint, d2 bigint, at int, p1 bigint, p2 bigint")
    starts = stored_in(work, starts.withColumn("salt", F.pmod("d1", F.lit(SALTS))), "starts")
    twice = starts.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("p1", "p2")
    twice = twice.withColumn("salt", F.explode(F.array(*[F.lit(k).cast("bigint") for k in range(SALTS)])))
    place = F.row_number().over(Window.partitionBy(*content).orderBy("at"))
    runs = (
        starts.join(twice, ["p1", "p2", "salt"])
        .withColumn("run", F.col("at") - place)
        .groupBy(*content, "run")
        .agg(F.min("at").alias("a"), (F.max("at") + 1).alias("b"))
    )
    return runs.groupBy(*content).agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def repeated_passages(documents: DataFrame) -> DataFrame:
    """Bytes covered by a ``LENGTH``-byte string that also starts anywhere else.

    Returns a row per document row: ``doc_id``, ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs), ``spans`` (begin and end of each) and
    ``kept`` (the remaining bytes). The strings are judged on the input.

    1. Each start of a string belongs to an anchor, the least gram within the
       string, so equal strings have theirs at the same distance. The starts of
       one anchor are a stretch: some 1.5 rows per 190 bytes.
    2. Stretches whose contents (128-bit hash) occur more than once are repeated
       as a whole; they are counted with combination on the map side, so that
       copies of a text cost little however many there are.
    3. Stretches that are alone, but share their key with others, lie at the ends
       of repeated passages. Only their bytes are moved, sorted (deep-shallow) and
       compared. If a key has more than ``MANY``, the passages in them are counted
       instead, wherever they are.

    Null counts as empty; texts below ``LENGTH`` bytes hold no string. A repeated
    row is a document like any other, so both copies go.
    """
    spark = documents.sparkSession
    bounded_batches(spark, 200)
    documents = stored(numbered(documents.select("doc_id", "text")), "rows")
    rows = stored(_scan(documents), "stretches")
    work = shared_folder(spark, "passages")
    content = ["key", "d1", "d2"]
    classes = stored_in(work, rows.groupBy(*content).agg(F.count(F.lit(1)).alias("n")), "contents")
    open_keys = (
        classes.groupBy("key")
        .agg(F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("n") == 1).alias("single"))
        .filter("kinds > 1 and single > 0")
        .select("key", "kinds")
    )
    open_keys = stored_in(work, open_keys, "open")
    known = bitmap(open_keys, "key", BITMAP_BITS)
    # Either way of comparing is right for any key, so that it doesn't matter what else has a hot key's bit.
    many = bitmap(open_keys.filter(F.col("kinds") > MANY), "key", MANY_BITS)
    texts = stored_in(work, _texts_of(documents, known, many).dropDuplicates(content), "texts")
    few = texts.filter("not many").join(open_keys, "key", "left_semi").select(*content, "ahead", "bytes")
    compared = few.repartition("key").sortWithinPartitions("key").mapInPandas(
        _compare, "key bigint, d1 bigint, d2 bigint, spans array<struct<a:int,b:int>>"
    )
    if many.any():
        compared = compared.unionByName(_compare_many(texts.filter("many"), work))
    some = compared.join(classes.filter("n = 1").select(*content), content, "left_semi")
    whole = classes.filter("n > 1").select(*content).withColumn("spans", F.lit(None).cast("array<struct<a:int,b:int>>"))
    verdicts = stored(some.select(*content, "spans").unionByName(whole), "verdicts")
    remove_folders(spark, [work])  # the verdicts are made; they are joined with rows and stretches below
    every = F.array(F.struct(F.lit(0).alias("a"), (F.col("last") - F.col("first") + 1).cast("int").alias("b")))
    hit = (
        rows.join(verdicts, content)
        .select(ROW, "first", F.explode(F.coalesce("spans", every)).alias("s"))
        .select(ROW, (F.col("first") + F.col("s.a")).alias("a"), (F.col("first") + F.col("s.b") - 1 + LENGTH).alias("b"))
        .groupBy(ROW)
        .agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("spans"))
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, spans in zip(batch["text"], batch["spans"]):
                text = utf8(text)
                runs: list[list[int]] = []
                for s in () if spans is None else spans:
                    if runs and s["a"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s["b"])
                    else:
                        runs.append([s["a"], s["b"]])
                edges = [0, *(x for r in runs for x in r), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(text), len(text) - len(kept), len(runs), [{"a": a, "b": b} for a, b in runs], kept))
            frame = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "spans", "kept"])
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    kind = documents.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<a:bigint,b:bigint>>, kept binary"
    return documents.join(hit, ROW, "left").mapInPandas(cut, shape)

