"""Second-order boosted trees: gradients and Hessians of the log loss, summed up per leaf, feature and bin.

Rows are binned once and kept as blocks of arrays, in as many partitions as there are
cores. Each level of a tree is one job of one stage: tasks sum up their blocks into bins,
and what reaches the driver are those sums, at most 2^depth leaves times features times
bins a partition, added up in tasks first if there are many partitions. Gradients are whole
multiples of 2^-30, so sums are exact: the same trees grow however rows are dealt out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subscore.functions.hashing import key_text
from subscore.functions.positions import with_running_sums
from subscore.schemas import CATEGORICAL, SUBSCRIPTION_KEY, feature_columns
from subscore.session import shared_folder, ship_package

LABEL = "bad_flag"
UNIT = 1 << 30
BLOCK = ["_hash", "_label", "_bins"]
BLOCK_ROWS = 1 << 16
# Below so many rows a further task costs more than it saves; of more partitions than that, sums are added in tasks.
TASK_ROWS = 4096
SUMMED_BY_DRIVER = 64


@dataclass(frozen=True)
class BoostSettings:
    """Training parameters; trees, rate, depth, shares and seed are the fixed values of production.

    ``column_sample`` is the share of columns drawn anew for each level. ``ridge``,
    ``least_gain`` and ``least_cover`` are the regularisation of the gain: added to
    each Hessian sum, the least gain of a split, the least Hessian sum of a side.
    """

    sample_fraction: float = 0.1
    train_ratio: float = 0.75
    trees: int = 400
    rate: float = 0.02
    depth: int = 6
    row_sample: float = 0.56
    column_sample: float = 0.34
    seed: int = 567
    bins: int = 64
    ridge: float = 1.0
    least_gain: float = 0.0
    least_cover: float = 1.0
    refresh: int = 20  # trees after which rows are stored with their margins
    features: list[str] = field(default_factory=feature_columns)


@dataclass(frozen=True)
class Predictor:
    """A column, or one category of it (1 or 0); ``cuts`` are the values at which it may be split."""

    column: str
    category: str | None
    cuts: list[float]

    @property
    def name(self) -> str:
        return self.column if self.category is None else f"{self.column}={self.category}"


@dataclass(frozen=True)
class Tree:
    """Nodes in heap order: ``feature`` is -1 at a leaf; bins up to ``cut`` go left, missing ones if ``missing_left``."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    gain: np.ndarray
    cover: np.ndarray
    value: np.ndarray

    def leaves(self, bins: np.ndarray, depth: int, rows: np.ndarray | None = None) -> np.ndarray:
        """The node that each of the rows (all of them, if none are given) reaches in ``depth`` steps."""
        rows = np.arange(len(bins)) if rows is None else rows
        at = np.zeros(len(rows), np.int64)
        for _ in range(depth):
            f = self.feature[at]
            b = bins[rows, np.maximum(f, 0)]
            left = np.where(b == 0, self.missing_left[at], b <= self.cut[at])
            at = np.where(f >= 0, 2 * at + 2 - left, at)
        return at


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model: predictors, trees, and the settings that made them."""

    predictors: list[Predictor]
    trees: list[Tree]
    settings: BoostSettings

    def prefix(self, trees: int) -> BoostedTrees:
        return replace(self, trees=self.trees[:trees])


# --- Columns to bins ---------------------------------------------------------


def fit_predictors(df: DataFrame, settings: BoostSettings) -> list[Predictor]:
    """Quantile cuts of number columns, the categories of the others, each by one aggregation.

    Before the first tree all rows have the same Hessian, so plain quantiles are the
    weighted ones. Where a column has few values, all but the least are cuts.
    """
    numbers = [c for c in settings.features if c not in CATEGORICAL]
    shares = [k / settings.bins for k in range(1, settings.bins)]
    finite = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in numbers}
    found = df.agg(
        *[F.percentile_approx(v, shares, 10_000).alias(f"q{i}") for i, v in enumerate(finite.values())],
        *[F.min(v).alias(f"least{i}") for i, v in enumerate(finite.values())],
    ).first()
    cuts = {c: sorted({x for x in found[f"q{i}"] or [] if x > found[f"least{i}"]}) for i, c in enumerate(numbers)}
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in settings.features if c in CATEGORICAL]
    listed: dict[str, list[str]] = {}
    if pairs:
        levels = df.select(F.inline(F.array(*pairs))).filter("value is not null").distinct()
        for row in sorted(levels.collect()):
            listed.setdefault(row["column"], []).append(row["value"])
    out = []
    for c in settings.features:
        out += [Predictor(c, v, [1.0]) for v in listed.get(c, [])] if c in CATEGORICAL else [Predictor(c, None, cuts[c])]
    return out


def binned(columns: dict[str, pa.Array], predictors: Sequence[Predictor]) -> np.ndarray:
    """A row's bins: 0 for a missing value, else 1 and the number of cuts not above it."""
    out = np.empty((len(next(iter(columns.values()))), len(predictors)), np.uint8)
    for k, p in enumerate(predictors):
        values = columns[p.column]
        if p.category is None:
            numbers = values.cast(pa.float64()).to_numpy(zero_copy_only=False)
            out[:, k] = np.where(np.isnan(numbers), 0, 1 + np.searchsorted(p.cuts, numbers, side="right"))
        else:
            same = pc.equal(values, p.category).cast(pa.uint8())
            out[:, k] = pc.add(same, pa.scalar(1, pa.uint8())).fill_null(0).to_numpy(zero_copy_only=False)
    return out


def _needed(predictors: Sequence[Predictor]) -> list[str]:
    return list(dict.fromkeys(p.column for p in predictors))


def _prepared(df: DataFrame, columns: Sequence[str]) -> list:
    """Predictor columns, numbers as doubles and categories as text."""
    return [F.col(c).cast("string" if c in CATEGORICAL else "double").alias(c) for c in columns]


def binned_blocks(df: DataFrame, predictors: Sequence[Predictor], key: Sequence[str] = SUBSCRIPTION_KEY) -> RDD:
    """The labelled rows as the trees see them, in blocks: hashes of the key, labels, bins by predictor, margins of zero."""
    spark = df.sparkSession
    ship_package(spark)
    needed, width, most = _needed(predictors), len(predictors), BLOCK_ROWS

    def block(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        hashes, labels, bins = (np.concatenate(x, axis=-1) for x in zip(*parts))
        return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (hashes, labels, bins)], BLOCK)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for part in (batch.slice(k, most) for k in range(0, batch.num_rows, most)):
                bins = binned({c: part[c] for c in needed}, predictors).T
                held.append((part["_hash"].to_numpy(), part["_label"].to_numpy(), bins))
                rows += part.num_rows
                if rows >= most:
                    yield block(held)
                    held, rows = [], 0
        if held:
            yield block(held)

    def arrays(row) -> tuple[np.ndarray, ...]:
        hashes, labels = np.frombuffer(row["_hash"], np.int64), np.frombuffer(row["_label"])
        return hashes, labels, np.frombuffer(row["_bins"], np.uint8).reshape(width, -1), np.zeros(len(hashes))

    labelled = df.filter(F.col(LABEL).isNotNull())
    tasks = max(1, min(spark.sparkContext.defaultParallelism, -(-labelled.count() // TASK_ROWS)))
    rows = labelled.select(F.xxhash64(key_text(key)).alias("_hash"), F.col(LABEL).cast("double").alias("_label"), *_prepared(df, needed))
    return rows.repartition(tasks).mapInArrow(encode, ", ".join(f"{c} binary" for c in BLOCK)).rdd.map(arrays)


# --- Growing -----------------------------------------------------------------


def _spread(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def sampled_rows(hashes: np.ndarray, tree: int, settings: BoostSettings) -> np.ndarray:
    """Which rows a tree is grown on: by the key's hash, hence whatever the partitions."""
    salt = _spread(np.array([settings.seed * 1_000_003 + tree], np.uint64))
    return (_spread(hashes.view(np.uint64) ^ salt) >> np.uint64(32)).astype(np.float64) < settings.row_sample * 2**32


def sampled_columns(columns: int, tree: int, level: int, settings: BoostSettings) -> np.ndarray:
    """The columns that a level of a tree may split on."""
    if settings.column_sample >= 1:
        return np.arange(columns)
    drawn = np.random.default_rng([settings.seed, tree, level]).permutation(columns)
    return np.sort(drawn[: max(1, round(settings.column_sample * columns))])


def _whole(x: np.ndarray) -> np.ndarray:
    return np.rint(x * UNIT)


def _added(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Two sparse sums as one."""
    place, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    out = np.zeros((2, len(place)), np.int64)
    for kind in (0, 1):
        np.add.at(out[kind], at, np.concatenate([a[kind + 1], b[kind + 1]]))
    return place, *out


def histograms(blocks: RDD, predictors: int, grown: Tree, tree: int, level: int, settings: BoostSettings) -> np.ndarray:
    """Sums of gradients and Hessians: an array by leaf of the level, drawn column, bin and kind."""
    columns, leaves, bins = sampled_columns(predictors, tree, level, settings), 1 << level, settings.bins + 1

    def summed(part: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
        sums = np.zeros((2, len(columns), leaves * bins), np.int64)
        for hashes, labels, matrix, margins in part:
            use = np.flatnonzero(sampled_rows(hashes, tree, settings))
            leaf = grown.leaves(matrix.T, level, use) - (leaves - 1)
            use, leaf = use[leaf >= 0], leaf[leaf >= 0] * bins
            chance = 1 / (1 + np.exp(-margins[use]))
            weights = _whole(chance - labels[use]), _whole(chance * (1 - chance))
            for k, c in enumerate(columns):
                place = leaf + matrix[c][use]
                for kind in (0, 1):
                    # Whole numbers below 2^53: exact in doubles too.
                    sums[kind, k] += np.bincount(place, weights[kind], leaves * bins).astype(np.int64)
        place = np.flatnonzero(sums[1].ravel())
        yield place, sums[0].ravel()[place], sums[1].ravel()[place]

    partial = blocks.mapPartitions(summed)
    found = [partial.treeReduce(_added)] if partial.getNumPartitions() > SUMMED_BY_DRIVER else partial.collect()
    out = np.zeros((2, len(columns) * leaves * bins), np.int64)
    for place, *kinds in found:
        out[:, place] += kinds
    return (out / UNIT).reshape(2, len(columns), leaves, bins).transpose(2, 1, 3, 0)


def best_split(sums: np.ndarray, settings: BoostSettings) -> tuple[float, int, int, bool, np.ndarray, np.ndarray] | None:
    """The split of one leaf with the largest gain: gain, column, cut, whether missing go left, both sides' sums.

    Missing values are tried on both sides. Among equals the first column, then the
    lowest cut, then missing values to the right.
    """
    total = sums[0].sum(axis=0)
    known = sums[:, 1:].cumsum(axis=1)[:, :-1]  # up to each cut
    left = np.stack([known, known + sums[:, :1]], axis=2)  # column, cut, missing right or left, kind
    right = total - left
    score = left[..., 0] ** 2 / (left[..., 1] + settings.ridge) + right[..., 0] ** 2 / (right[..., 1] + settings.ridge)
    gain = (score - total[0] ** 2 / (total[1] + settings.ridge)) / 2
    gain[np.minimum(left[..., 1], right[..., 1]) < settings.least_cover] = -np.inf
    at = np.unravel_index(np.argmax(gain), gain.shape)
    if not gain[at] > max(settings.least_gain, 1e-9):
        return None
    return float(gain[at]), int(at[0]), int(at[1]) + 1, bool(at[2]), left[at], right[at]


def grow_tree(blocks: RDD, predictors: int, tree: int, settings: BoostSettings) -> Tree:
    """One tree, level by level: a job each."""
    size = (2 << settings.depth) - 1
    grown = Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, bool), np.zeros(size), np.zeros(size), np.zeros(size))

    def weigh(node: int, sums: np.ndarray) -> None:
        grown.cover[node] = sums[1]
        grown.value[node] = -settings.rate * sums[0] / (sums[1] + settings.ridge)

    for level in range(settings.depth):
        first = (1 << level) - 1
        if level and not (grown.feature[(first - 1) // 2 : first] >= 0).any():
            break
        columns = sampled_columns(predictors, tree, level, settings)
        sums = histograms(blocks, predictors, grown, tree, level, settings)
        if not level:
            weigh(0, sums[0][0].sum(axis=0))
        for leaf in range(1 << level):
            found = best_split(sums[leaf], settings) if sums[leaf][..., 1].any() else None
            if found:
                node = first + leaf
                grown.gain[node], column, grown.cut[node], grown.missing_left[node], left, right = found
                grown.feature[node] = columns[column]
                weigh(2 * node + 1, left)
                weigh(2 * node + 2, right)
    return grown


def _with_tree(blocks: RDD, tree: Tree, depth: int) -> RDD:
    """The blocks with one more tree in their margins."""
    return blocks.map(lambda b: (*b[:3], b[3] + tree.value[tree.leaves(b[2].T, depth)]))


def _remove(spark: SparkSession, path: str) -> None:
    stored = spark._jvm.org.apache.hadoop.fs.Path(path)
    stored.getFileSystem(spark._jsc.hadoopConfiguration()).delete(stored, True)


def train_boosted(train: DataFrame, settings: BoostSettings = BoostSettings(), key: Sequence[str] = SUBSCRIPTION_KEY) -> BoostedTrees:
    """Fit predictors and trees on the labelled rows.

    Rows are binned once. After each tree their margins are kept anew, in memory or on the
    executors' disks, so that a level's pass applies no tree but its own. Every ``refresh``
    trees they are checkpointed (``spark.checkpoint.dir``; a session without one gets a folder
    below its warehouse), which cuts the lineage; the checkpoint before goes then.
    Nulls and NaN are missing values, to which each split assigns a side.
    Without labelled rows, or with those of one class only, trees are single leaves.
    """
    if not 2 <= settings.bins <= 254:
        raise ValueError("bins must be between 2 and 254")
    spark = train.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(spark, "checkpoints"))
    predictors = fit_predictors(train.filter(F.col(LABEL).isNotNull()), settings)
    blocks = binned_blocks(train, predictors, key).persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[Tree] = []
    checkpoints: list[RDD] = []
    before = None
    for k in range(settings.trees):
        if k:
            before, blocks = blocks, _with_tree(blocks, trees[-1], settings.depth).persist(StorageLevel.MEMORY_AND_DISK)
        if k % settings.refresh == 0:
            blocks.checkpoint()  # written when the first level has gone through it
            checkpoints.append(blocks)
        trees.append(grow_tree(blocks, len(predictors), k, settings))
        if before:
            before.unpersist()
        if len(checkpoints) > 1:
            _remove(spark, checkpoints.pop(0).getCheckpointFile())
    blocks.unpersist()
    for rows in checkpoints:
        _remove(spark, rows.getCheckpointFile())
    return BoostedTrees(predictors, trees, settings)


# --- Applying ----------------------------------------------------------------


def predict_boosted(model: BoostedTrees, df: DataFrame) -> DataFrame:
    """Add ``p0``, the chance of paying back, and ``p1`` = 1 - ``p0``. Categories not met in training are none of the known ones."""
    ship_package(df.sparkSession)
    needed, depth = _needed(model.predictors), model.settings.depth
    shadow = [f"_x{k}" for k in range(len(needed))]
    kept = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField("p0", T.DoubleType()), T.StructField("p1", T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = binned({c: batch[s] for c, s in zip(needed, shadow)}, model.predictors)
            margin = np.zeros(len(bins))
            for tree in model.trees:
                margin += tree.value[tree.leaves(bins, depth)]
            p1 = 1 / (1 + np.exp(-margin))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(1 - p1), pa.array(p1)], [*kept, "p0", "p1"])

    prepared = [c.alias(s) for c, s in zip(_prepared(df, needed), shadow)]
    return df.select("*", *prepared).mapInArrow(scored, schema)


def staged_measures(model: BoostedTrees, validation: DataFrame, every: int = 1, label: str = LABEL) -> DataFrame:
    """Log loss and AUC after each ``every``-th tree and the last, over the labelled rows of ``validation``.

    One pass applies the trees in their order and counts, per number of trees, the rows
    of each class by distinct score, first within a batch. AUC takes them by ranges of
    (trees, score), as ``metrics.auc`` does for one score; ties count one half. Columns:
    ``trees``, ``n_events``, ``n_nonevents``, ``log_loss``, ``auc``.
    """
    ship_package(validation.sparkSession)
    needed, depth, last = _needed(model.predictors), model.settings.depth, len(model.trees)
    stages = [k for k in range(1, last + 1) if k % every == 0 or k == last]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, event = binned({c: batch[c] for c in needed}, model.predictors), batch["_label"].to_numpy() == 1
            margin = np.zeros(len(bins))
            for k, tree in enumerate(model.trees, 1):
                margin += tree.value[tree.leaves(bins, depth)]
                if k in wanted:
                    score, which = np.unique(1 / (1 + np.exp(-margin)), return_inverse=True)
                    events = np.bincount(which[event], minlength=len(score))
                    others = np.bincount(which[~event], minlength=len(score))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(score), k)), pa.array(score), pa.array(events), pa.array(others)], ["trees", "score", "events", "nonevents"]
                    )

    wanted = set(stages)
    rows = validation.filter(F.col(label).isin(0, 1)).select(F.col(label).cast("double").alias("_label"), *_prepared(validation, needed))
    counts = rows.mapInArrow(counted, "trees bigint, score double, events bigint, nonevents bigint")
    counts = counts.groupBy("trees", "score").agg(F.sum("events").alias("events"), F.sum("nonevents").alias("nonevents"))
    path = f"{shared_folder(validation.sparkSession, 'staged')}/counts"
    summed = with_running_sums(counts, [F.asc("trees"), F.asc("score")], ["nonevents"], path)
    chance = F.greatest(F.least(F.col("score"), F.lit(1 - 1e-15)), F.lit(1e-15))
    loss = -(F.col("events") * F.log(chance) + F.col("nonevents") * F.log1p(-chance))
    per_stage = summed.groupBy("trees").agg(
        F.sum("events").alias("n_events"),
        F.sum("nonevents").alias("n_nonevents"),
        F.sum(loss).alias("_loss"),
        # Non-events of all stages before; each stage has the same ones.
        F.min("before_nonevents").alias("_earlier"),
        F.sum(F.col("events") * (F.col("before_nonevents") + F.col("nonevents") / 2)).alias("_wins"),
    )
    events, others = F.col("n_events"), F.col("n_nonevents")
    return per_stage.select(
        "trees",
        "n_events",
        "n_nonevents",
        (F.col("_loss") / (events + others)).alias("log_loss"),
        F.try_divide(F.col("_wins") - F.col("_earlier") * events, events.cast("double") * others).alias("auc"),
    )


def stopping_point(measures: DataFrame, patience: int = 3, tolerance: float = 1e-3) -> int | None:
    """The number of trees at which ``patience`` measured stages have not lowered the log loss by the share ``tolerance``.

    Each stage is compared with the least loss before the last ``patience`` stages;
    None if the loss has kept falling. There is a row per stage, so no window is large.
    """
    stages = Window.orderBy("trees")
    before = F.min("log_loss").over(stages.rowsBetween(Window.unboundedPreceding, -patience))
    recent = F.min("log_loss").over(stages.rowsBetween(1 - patience, 0))
    stalled = measures.withColumns({"_before": before, "_recent": recent}).filter(F.col("_recent") > F.col("_before") * (1 - tolerance))
    return stalled.agg(F.min("trees")).first()[0]


def boosted_importance(model: BoostedTrees) -> DataFrame:
    """Importance of each column: the gain of its splits, relative to the largest, and as a share."""
    gains = dict.fromkeys(_needed(model.predictors), 0.0)
    for tree in model.trees:
        for f, gain in zip(tree.feature.tolist(), tree.gain.tolist()):
            if f >= 0:
                gains[model.predictors[f].column] += gain
    largest, total = max(gains.values(), default=0) or 1.0, sum(gains.values()) or 1.0
    rows = [(n, v, v / largest, v / total) for n, v in gains.items()]
    schema = "variable string, relative_importance double, scaled_importance double, percentage double"
    return SparkSession.active().createDataFrame(rows, schema).orderBy(F.desc("relative_importance"), "variable")


def tree_table(model: BoostedTrees) -> DataFrame:
    """A row for each node: tree, node, predictor, cut value, side of missing values, gain, cover and leaf value."""
    rows = []
    for k, t in enumerate(model.trees):
        for node in range(len(t.feature)):
            f = int(t.feature[node])
            reached = node == 0 or t.feature[(node - 1) // 2] >= 0
            if reached:
                p = model.predictors[f] if f >= 0 else None
                rows.append((k, node, p and p.name, p and float(p.cuts[t.cut[node] - 1]), bool(t.missing_left[node]) if p else None,
                             float(t.gain[node]) if p else None, float(t.cover[node]), float(t.value[node])))
    schema = "tree int, node int, predictor string, cut double, missing_left boolean, gain double, cover double, value double"
    return SparkSession.active().createDataFrame(rows, schema)


# --- Storing -----------------------------------------------------------------


def save_boosted(model: BoostedTrees, spark: SparkSession, path: str) -> None:
    """Replace the model's folder: a line for settings and predictors, and one for each tree."""
    head = {"settings": asdict(model.settings), "predictors": [asdict(p) for p in model.predictors]}
    lines = [json.dumps(head), *(json.dumps({n: v.tolist() for n, v in vars(t).items()}) for t in model.trees)]
    table = spark.createDataFrame(list(enumerate(lines)), "line int, content string")
    table.coalesce(1).write.mode("overwrite").parquet(path)


def load_boosted(spark: SparkSession, path: str) -> BoostedTrees:
    lines = [json.loads(r["content"]) for r in spark.read.parquet(path).orderBy("line").collect()]
    trees = [Tree(**{n: np.array(v) for n, v in line.items()}) for line in lines[1:]]
    return BoostedTrees([Predictor(**p) for p in lines[0]["predictors"]], trees, BoostSettings(**lines[0]["settings"]))
