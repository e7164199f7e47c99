"""What each filter of a chain removes, in every order, from the coalition removals.

A document has a set of filters that it fails. A coalition of filters removes the
documents that fail at least one of them; all that can be asked of any order of the
filters follows from one number for each coalition, and no order is run.

Nulls: a null text is empty (it fails A, and E behind another empty one); a null
source and an empty one are one part; a row without an id has no labels and no
smaller id, so it never fails E, nor does it make others fail. Of repeated rows
with the smallest id of their text none fails E. Labels that repeat count once, as 1
if one of them is 1. An empty table has no parts, hence no rows. Columns besides
those named are never looked at.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction
from functools import reduce
from itertools import permutations
from math import comb, factorial
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD_GAPS = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#$%&*|]"
COPIES = "E"
COUNTED = ["n", "good", "toxic"]


def text_failures() -> dict[str, Column]:
    """Failure conditions that follow from a text alone, over the columns of ``measured``."""
    return {
        "A": F.col("_words") < 200,
        "B": 100 * F.col("_distinct") < 50 * F.col("_words"),
        "C": 100 * F.col("_capitals") > 2 * F.col("_points"),
        "D": F.col("_symbols"),
    }


def measured(documents: DataFrame) -> DataFrame:
    """What the conditions look at, and a digest that stands for the whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = documents.select(
        F.col("doc_id").alias("_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text.alias("_text"),
        F.array_remove(F.split(text, WORD_GAPS), "").alias("_tokens"),
    )
    return split.select(
        "_id",
        "part",
        F.sha2(F.col("_text").cast("binary"), 256).alias("_digest"),
        F.size("_tokens").cast("bigint").alias("_words"),
        F.size(F.array_distinct("_tokens")).cast("bigint").alias("_distinct"),
        F.regexp_count("_text", F.lit("[A-Z]")).cast("bigint").alias("_capitals"),
        F.length("_text").cast("bigint").alias("_points"),
        F.col("_text").rlike(SYMBOLS).alias("_symbols"),
    )


def _mask(conditions: Mapping[str, Column]) -> Column:
    bits = [F.when(c, F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(conditions.values())]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with ``_good`` and ``_toxic``; rows without an id stay out of the join, where they would meet in one task."""
    marks = (
        labels.filter("doc_id is not null")
        .groupBy(F.col("doc_id").alias("_label_id"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic"))
    )
    found = rows.filter("_id is not null").join(marks, F.col("_id") == F.col("_label_id"), "left").drop("_label_id")
    return found.unionByName(rows.filter("_id is null"), allowMissingColumns=True).fillna(0, ["_good", "_toxic"])


def failure_counts(documents: DataFrame, labels: DataFrame, conditions: Mapping[str, Column] | None = None) -> DataFrame:
    """Documents (``n``), good and toxic ones per ``part`` and set of failed filters (``_mask``).

    The filters are ``conditions`` in their order, then E, which a row fails if its
    text has a smaller id anywhere in the table. Repeated rows are counted on the map
    side. Equal texts are then counted per part and labels, again on the map side, and
    only these counts meet by digest: of a text that a third of all rows share, a row
    for each part arrives.
    """
    conditions = conditions or text_failures()
    key = ["_digest", "part", "_mask"]
    rows = measured(documents).withColumn("_mask", _mask(conditions))
    distinct = rows.groupBy("_id", *key).agg(F.count(F.lit(1)).alias("_rows"))
    by_text = _labelled(distinct, labels).groupBy(*key, "_good", "_toxic").agg(
        F.sum("_rows").alias("_rows"),
        F.coalesce(F.sum(F.when(F.col("_id").isNull(), F.col("_rows"))), F.lit(0)).alias("_without"),
        F.min("_id").alias("_first"),
        F.min_by("_rows", "_id").alias("_first_rows"),
    )
    least = F.min("_first").over(Window.partitionBy("_digest"))
    first = F.when(F.col("_first") == least, F.col("_first_rows")).otherwise(0)
    passing = by_text.withColumn("_passing", F.col("_without") + first)
    copies = 1 << len(conditions)
    both = F.array(
        F.struct(F.col("_mask").alias("_failed"), F.col("_passing").alias("n")),
        F.struct(F.col("_mask").bitwiseOR(F.lit(copies)).alias("_failed"), (F.col("_rows") - F.col("_passing")).alias("n")),
    )
    return (
        passing.select("part", "_good", "_toxic", F.inline(both))
        .groupBy("part", F.col("_failed").alias("_mask"))
        .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("_good")).alias("good"), F.sum(F.col("n") * F.col("_toxic")).alias("toxic"))
    )


def coalition_removals(counts: DataFrame, filters: int) -> DataFrame:
    """Per part its documents (``total``), and for each of ``COUNTED`` an array of what every coalition removes.

    Coalition S is the number whose bits are its filters; element S (from 0) is what it removes.
    """

    def removed(column: str) -> Column:
        failing = [F.sum(F.when(F.col("_mask").bitwiseAND(F.lit(s)) != 0, F.col(column)).otherwise(0)) for s in range(1 << filters)]
        return F.array(*failing).alias(f"_{column}")

    return counts.groupBy("part").agg(F.sum("n").alias("total"), *[removed(c) for c in COUNTED])


def solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """The X of matrix X = right, by elimination in rationals."""
    rows = [[*a, *b] for a, b in zip(matrix, right, strict=True)]
    for k in range(len(rows)):
        pivot = next(i for i in range(k, len(rows)) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i, row in enumerate(rows):
            if i != k and row[k]:
                rows[i] = [x - row[k] * y for x, y in zip(row, rows[k])]
    return [row[len(matrix) :] for row in rows]


def shapley_weights(filters: int) -> list[list[Fraction]]:
    """What each coalition's removal adds to each filter's Shapley value.

    The values are the least squares fit of an additive game: minimise the sum over
    coalitions S, neither empty nor whole, of k(S) (v(S) - sum of x over S)^2 with the
    Shapley kernel k(S) = (f - 1) / (C(f, s) s (f - s)), under the constraint that x
    sums up to v(all). Its normal equations, with a multiplier for the constraint,
    have the same matrix for every part; so they are solved once, with a right side
    for each coalition, and a part's values are weighted sums of its removals.
    """
    if filters == 1:
        return [[Fraction(0), Fraction(1)]]
    subsets, whole = range(1 << filters), (1 << filters) - 1

    def kernel(s: int) -> Fraction:
        size = s.bit_count()
        return Fraction(filters - 1, comb(filters, size) * size * (filters - size)) if 0 < size < filters else Fraction(0)

    def has(s: int, k: int) -> int:
        return s >> k & 1

    matrix = [
        [*(2 * sum(kernel(s) * has(s, i) * has(s, j) for s in subsets) for j in range(filters)), Fraction(1)] for i in range(filters)
    ]
    matrix.append([*[Fraction(1)] * filters, Fraction(0)])
    right = [[2 * kernel(s) * has(s, i) for s in subsets] for i in range(filters)]
    right.append([Fraction(int(s == whole)) for s in subsets])
    return solved(matrix, right)[:filters]


def audited(removals: DataFrame, letters: Sequence[str]) -> DataFrame:
    """A row for each part, order of the filters and step, from the coalitions' removals.

    A step removes what the filters up to it remove beyond those before it. The
    Shapley value is over all orders, hence multiplied by their number.
    """
    f, whole = len(letters), (1 << len(letters)) - 1
    steps = []
    for order in permutations(range(f)):
        before = 0
        for step, k in enumerate(order, 1):
            steps.append(("".join(letters[i] for i in order), step, before, k))
            before |= 1 << k
    listed = F.from_json(
        F.lit("[" + ",".join(f'{{"o":"{o}","s":{s},"b":{b},"k":{k}}}' for o, s, b, k in steps) + "]"),
        "array<struct<o:string,s:int,b:int,k:int>>",
    )
    # Over all orders the weights are whole numbers.
    weights = [[w * factorial(f) for w in row] for row in shapley_weights(f)]
    values = [reduce(add, (F.col("_n")[s] * int(w) for s, w in enumerate(row) if w)) for row in weights]
    per_filter = removals.withColumn("_shapley", F.array(*values))
    rows = per_filter.withColumn("_step", F.explode(listed))
    before, k = F.col("_step.b"), F.col("_step.k")
    own = F.call_function("shiftleft", F.lit(1), k)
    upto = before.bitwiseOR(own)

    def lost(column: str) -> Column:
        return F.col(f"_{column}")[upto] - F.col(f"_{column}")[before]

    return rows.select(
        "part",
        F.col("_step.o").alias("filter_order"),
        F.col("_step.s").alias("step"),
        (F.col("total") - F.col("_n")[upto]).alias("kept"),
        lost("n").alias("removed"),
        (F.col("_n")[own] - lost("n")).alias("redundant"),
        (F.col("_n")[whole] - F.col("_n")[F.lit(whole).bitwiseXOR(own)]).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.col("_shapley")[k].alias("shapley"),
    )


def audit_filters(documents: DataFrame, labels: DataFrame, conditions: Mapping[str, Column] | None = None) -> DataFrame:
    """For every part, order and step: documents kept, removed, redundant, failing this filter alone, labels lost, Shapley value.

    ``conditions`` name the filters by a letter each, over the columns of ``measured``;
    E, the copies, is the last one. The driver holds nothing but the weights of the
    2^f coalitions; parts, however many, stay with Spark.
    """
    conditions = conditions or text_failures()
    counts = failure_counts(documents, labels, conditions)
    return audited(coalition_removals(counts, len(conditions) + 1), [*conditions, COPIES])
