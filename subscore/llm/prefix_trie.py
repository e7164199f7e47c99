"""Prefix trie of conversations rebuilt from others' heads, by composable fingerprints.

The fingerprint of a sequence of turns is an element of a monoid: its length n and
h = t0 + t1 x + ... + t(n-1) x^(n-1) modulo a prime, t being a number for each turn.
Two sequences in a row have n1 + n2 and h1 + x^n1 h2. As x has an inverse, what a
prefix leaves of a sequence follows from the two fingerprints alone; so a rebuilt
conversation's prefixes are composed of the base's head and the own suffix, and no
rebuilt text is ever made. Three primes make a fingerprint of 93 bits.

Prefixes with equal fingerprints are verified: each carries the stored reference of
its last turn, a SHA-256 digest of role and text. Where all of a group have the same
one, subtracting it leaves equal fingerprints of the prefixes one turn shorter; if
that holds for every group, equal fingerprints are equal sequences, all the way up. If
it fails for one, everything is done again with another x.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subscore.functions.positions import with_positions
from subscore.llm.common import bounded_batches, stored
from subscore.session import shared_folder

# The three largest primes below 2^31, so that products fit 64 bits.
PRIMES = (2147483647, 2147483629, 2147483587)
LANES = ["f0", "f1", "f2"]
REFERENCE = ["r0", "r1", "r2", "r3"]
FAMILY = 5  # a conversation's base is its id less the remainder by this
HEADS = 9  # a head has 0 to 8 turns
BLOCK = 4096  # turns of a conversation, or nodes of a chain, in one group
HOT = 20_000
NODE = ["depth", *LANES]
EMPTY = hashlib.sha256(b"").hexdigest()


def bases(attempt: int) -> list[int]:
    """The x of each prime."""
    digest = hashlib.sha256(f"x{attempt}".encode()).digest()
    return [2 + int.from_bytes(digest[4 * k : 4 * k + 4]) % (p - 3) for k, p in enumerate(PRIMES)]


def powers(x: int, prime: int, exponents: np.ndarray) -> np.ndarray:
    """x to each exponent, modulo the prime."""
    out, square, left = np.ones(len(exponents), np.int64), x, exponents.astype(np.int64)
    while left.any():
        out = np.where(left & 1, out * square % prime, out)
        square, left = square * square % prime, left >> 1
    return out


def running(df: DataFrame, key: str, position: str, sums: Sequence[str], backwards: bool = False) -> DataFrame:
    """``df`` with each of ``sums`` replaced by its sum up to the row's position in its key, or from there on.

    Rows are summed up within blocks of positions, and the blocks' sums within keys: a
    key's rows never meet in one task, however many there are.
    """
    order = F.desc if backwards else F.asc
    blocks = df.withColumn("_block", F.floor(F.col(position) / BLOCK))
    inside = Window.partitionBy(key, "_block").orderBy(order(position)).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy(order("_block")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.groupBy(key, "_block").agg(*[F.sum(c).alias(f"_all_{c}") for c in sums])
    offsets = offsets.select(key, "_block", *[F.sum(f"_all_{c}").over(before).alias(f"_before_{c}") for c in sums])
    within = blocks.withColumns({c: F.sum(c).over(inside) for c in sums})
    # Most keys have one block, with nothing before it.
    found = within.join(offsets.filter(F.col(f"_before_{sums[0]}").isNotNull()), [key, "_block"], "left")
    total = {c: F.col(c) + F.coalesce(F.col(f"_before_{c}"), F.lit(0)) for c in sums}
    return found.withColumns(total).select(*df.columns)


def _head_turns() -> Column:
    return F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS


def referenced_turns(conversations: DataFrame) -> DataFrame:
    """Each turn's place in its conversation (``pos``, ``n``), its reference, and the bytes of its text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat_ws(" ", F.length(role).cast("string"), role, text).cast("binary"), 256)
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").alias("_turn"),
        role.alias("_role"),
        *[F.conv(F.substring(digest, 16 * k + 1, 16), 16, -10).cast("bigint").alias(r) for k, r in enumerate(REFERENCE)],
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    order = [F.col("_turn").asc_nulls_first(), F.col("_role"), *map(F.col, REFERENCE)]
    path = f"{shared_folder(conversations.sparkSession, 'turns')}/ranked"
    placed = with_positions(stored(turns, "turns"), ["conv_id"], order, path, "pos", "n")
    return stored(placed.drop("_turn", "_role"), "placed")


def fingerprinted(turns: DataFrame, xs: list[int]) -> DataFrame:
    """``turns`` with the fingerprint of their conversation up to and with them."""
    lanes = list(zip(LANES, PRIMES, xs))

    def scaled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lane, prime, x in lanes:
                batch[lane] = batch[lane].to_numpy() * powers(x, prime, batch["pos"].to_numpy()) % prime
            yield batch

    numbers = {lane: F.pmod(F.xxhash64(*REFERENCE, F.lit(lane)), F.lit(p)) for lane, p, _ in lanes}
    terms = turns.withColumns(numbers)
    schema = ", ".join(f"{c} {t}" for c, t in terms.dtypes)
    summed = running(terms.mapInPandas(scaled, schema), "conv_id", "pos", LANES)
    return summed.withColumns({lane: F.col(lane) % p for lane, p, _ in lanes})


def rebuilt_shapes(turns: DataFrame, xs: list[int]) -> DataFrame:
    """How each conversation is rebuilt: ``head`` turns of the base, ``size``, and what composes its prefixes.

    An own turn behind the head has, as prefix of the rebuilt conversation, the
    fingerprint ``a + s (f - g)``: a the head's, g that of the own turns left out, s
    the power of x by which the suffix moves. A base serves a few conversations and
    at most eight of its turns are read.
    """
    taken = F.col("pos") < _head_turns()
    own = turns.groupBy("conv_id").agg(
        F.max("n").alias("n"), *[F.coalesce(F.max_by(F.when(taken, F.col(f)), F.when(taken, F.col("pos"))), F.lit(0)).alias(f"g{k}") for k, f in enumerate(LANES)]
    )
    heads = (
        turns.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEADS - 1))
        .groupBy(F.col("conv_id").alias("_base"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", *LANES, *REFERENCE, "bytes"))).alias("_turns"))
    )
    shapes = own.withColumns({"_base": F.col("conv_id") - F.col("conv_id") % FAMILY, "h": _head_turns()}).join(heads, "_base", "left")
    shapes = shapes.withColumn("head", F.coalesce(F.slice("_turns", 1, F.col("h").cast("int")), F.expr("slice(_turns, 1, 0)"), F.expr("array()")))
    k = F.size("head").cast("bigint")
    last = F.try_element_at("head", F.lit(-1))
    moves = {}
    for lane, (p, x) in enumerate(zip(PRIMES, xs)):
        back = pow(x, -1, p)
        moves[f"a{lane}"] = F.coalesce(last[f"f{lane}"], F.lit(0))
        moves[f"s{lane}"] = F.array(*[F.lit(pow(back, d, p)).cast("bigint") for d in range(HEADS)])[(F.col("h") - k).cast("int")]
    return shapes.withColumns({"k": k, "size": k + F.greatest(F.col("n") - F.col("h"), F.lit(0)), **moves}).drop("_turns", "_base")


def _by_block(df: DataFrame, last: Column) -> DataFrame:
    """A row of ``df`` for each block of positions up to ``last``: a key's rows then join it in many tasks."""
    return df.withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor(last / BLOCK))))


def prefixes(turns: DataFrame, shapes: DataFrame) -> DataFrame:
    """A row for each prefix of each rebuilt conversation, the empty one too."""
    columns = ["conv_id", "size", *NODE, *REFERENCE, "bytes"]
    zero = F.lit(0).cast("bigint")
    root = shapes.select("conv_id", "size", *[zero.alias(c) for c in columns[2:]])
    heads = shapes.select("conv_id", "size", F.inline("head")).withColumn("depth", F.col("pos") + 1).select(*columns)
    moved = _by_block(shapes.drop("head"), F.col("n") - 1).drop("n")
    own = turns.filter(F.col("pos") >= _head_turns()).withColumn("_block", F.floor(F.col("pos") / BLOCK))
    own = own.join(moved, ["conv_id", "_block"])
    composed = {
        f: (F.col(f"a{k}") + F.col(f"s{k}") * F.pmod(F.col(f) - F.col(f"g{k}"), F.lit(p))) % p for k, (f, p) in enumerate(zip(LANES, PRIMES))
    }
    own = own.withColumns({**composed, "depth": F.col("k") + F.col("pos") - F.col("h") + 1})
    return root.unionByName(heads).unionByName(own.select(*columns))


def grouped(rows: DataFrame) -> DataFrame:
    """The nodes: members, the smallest of them (``owner``), how many end here, and whether references differ."""
    differs = [F.min(r) != F.max(r) for r in REFERENCE]
    nodes = rows.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("owner"),
        F.count_if(F.col("size") == F.col("depth")).alias("n_ends"),
        F.max("bytes").alias("bytes"),
        (differs[0] | differs[1] | differs[2] | differs[3]).alias("differs"),
    )
    return nodes.withColumn("saved", (F.col("n") - 1) * F.col("bytes"))


def end_digests(rows: DataFrame) -> DataFrame:
    """Per node the SHA-256 digest of the ids that end there, in order and comma-joined.

    Ranges of (node, id) are joined to texts in as many tasks as there are ranges; the
    texts of a node then pass through one digest, piece by piece: memory is bounded by
    a batch, and no list of ids is ever held.
    """
    ends = rows.filter(F.col("size") == F.col("depth")).select(*NODE, "conv_id")
    ranged = ends.repartitionByRange(*LANES, "depth", "conv_id").sortWithinPartitions(*NODE, "conv_id")

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                ids = batch["conv_id"].astype(str).groupby([batch[c] for c in NODE], sort=False)
                firsts = batch.drop_duplicates(NODE).rename(columns={"conv_id": "first"})
                yield firsts.assign(ids=ids.agg(",".join).to_numpy())

    pieces = ranged.mapInPandas(joined, ", ".join(f"{c} bigint" for c in [*NODE, "first"]) + ", ids string")
    dealt = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")

    def digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, digest = None, None
        for batch in batches:
            out = []
            for *node, text in batch[[*NODE, "ids"]].itertuples(index=False, name=None):
                if node == current:
                    digest.update(b"," + text.encode())
                    continue
                if current:
                    out.append((*current, digest.hexdigest()))
                current, digest = node, hashlib.sha256(text.encode())
            yield pd.DataFrame(out, columns=[*NODE, "ends_sha256"])
        if current:
            yield pd.DataFrame([(*current, digest.hexdigest())], columns=[*NODE, "ends_sha256"])

    return dealt.mapInPandas(digested, ", ".join(f"{c} bigint" for c in NODE) + ", ends_sha256 string")


def owners(rows: DataFrame, nodes: DataFrame, total: int) -> DataFrame:
    """``rows`` (with ``NODE``) and the smallest member of their node as ``parent``.

    Nodes with more than a ten-thousandth of all prefixes, fewer than ten thousand
    since each prefix is in one node, are broadcast; no key of the join with the
    others is hot.
    """
    most = max(HOT, total // 10_000)
    hot = nodes.filter(F.col("n") > most).select(*NODE, F.col("owner").alias("parent"))
    other = nodes.filter(F.col("n") <= most).select(*NODE, F.col("owner").alias("parent"))
    marked = rows.join(F.broadcast(hot), NODE, "left")
    found = marked.filter("parent is not null")
    return found.unionByName(marked.filter("parent is null").drop("parent").join(other, NODE).select(*found.columns))


def prefix_trie(conversations: DataFrame, attempts: int = 8) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations; the columns are those of ``op13``'s contract.

    The smallest member of a node owns it; what a conversation owns is one chain, from
    some depth to its end, since the smallest member of a prefix is also that of all
    its longer ones. So children, leaves and savings below a node add up from numbers
    of whole chains (where each begins, what it saves, whether its end has children)
    at the prefixes of their owners, and from running sums along the node's own chain.
    All of this grows as the turns do: nothing is paired, and no path is walked.

    Rows without a ``conv_id`` belong to no conversation. Turns are ordered by
    ``turn``, null first; equal ones by role, then by their reference. A null role or
    text is empty; rows that repeat are turns like others. The remainder by five has the
    sign of the id, as in SQL. Without conversations there are no rows, not even a
    root. Other columns are never looked at.
    """
    bounded_batches(conversations.sparkSession, 10_000)
    placed = referenced_turns(conversations)
    for attempt in range(attempts):
        xs = bases(attempt)
        turns = stored(fingerprinted(placed, xs), "fingerprints")
        rows = stored(prefixes(turns, stored(rebuilt_shapes(turns, xs), "shapes")), "prefixes")
        nodes = stored(grouped(rows), "nodes")
        if not nodes.filter("differs").take(1):
            return assembled(rows, nodes)
    raise RuntimeError("fingerprints of different sequences were equal in every attempt")


def assembled(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The trie's rows from its prefixes and nodes."""
    chains = nodes.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min("depth").alias("begin"),
        F.max("depth").alias("_end"),
        F.sum("saved").alias("chain_saved"),
        F.max((F.col("n") == F.col("n_ends")).cast("bigint")).alias("leaf"),
    )
    blocks = rows.select("conv_id", "size", *NODE).withColumn("_block", F.floor(F.col("depth") / BLOCK))
    passing = blocks.join(_by_block(chains, F.col("_end")), ["conv_id", "_block"])
    depth, begin = F.col("depth"), F.col("begin")
    below = passing.groupBy(*NODE).agg(
        F.count_if((depth >= begin - 1) & (depth < F.col("size"))).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.when(depth < begin, F.col("chain_saved")).otherwise(0)).alias("_below"),
    )
    attached = passing.filter(depth == begin - 1).select("conv_id", *NODE)
    parents = owners(attached, nodes, rows.count()).select(
        F.col("conv_id").alias("owner"), (depth + 1).alias("depth"), "parent"
    )
    along = running(nodes.select(*NODE, "owner", "n", "saved"), "owner", "depth", ["saved"], backwards=True)
    whole = along.join(below, NODE).join(end_digests(rows), NODE, "left").join(parents, ["owner", "depth"], "left")
    return whole.select(
        F.col("owner").alias("conv_id"),
        "depth",
        F.when(depth > 0, F.coalesce("parent", "owner")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        "n_leaves",
        (F.col("saved") + F.col("_below")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )
