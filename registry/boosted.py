"""Queries of the second-order trees, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registry import oracle as o
from registry import views as v
from subscore.functions.hashing import train_test_split
from subscore.operators import boosting, metrics, model
from subscore.plans import jobs
from subscore.schemas import CATEGORICAL, SUBSCRIPTION_KEY, feature_columns
from subscore.session import shared_folder
from subscore.sources import tables

FIRST = boosting.BoostSettings(trees=1, depth=2, row_sample=1.0, column_sample=1.0, bins=16)
STAGED = boosting.BoostSettings(trees=8, rate=0.3, depth=3, row_sample=1.0, sample_fraction=1.0)


def _training_table(spark: SparkSession, folder: str) -> DataFrame:
    """The training set in the digits in which its SQL states it, so that both have the same cuts."""
    t = v.monthly_tables(spark, folder, v.TRAINING_MONTH)
    built = jobs.build_training_set(v.loans(spark, folder), t, v.AS_OF)
    rounded = [F.round(c, o.DIGITS).alias(c) if kind == "double" else F.col(c) for c, kind in built.dtypes]
    return tables.write_feature_set(built.select(*rounded), f"{shared_folder(spark, 'boosted')}/training_set")


def boosted_first_splits(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of the first tree, two levels deep, over all training rows and predictors."""
    fitted = boosting.train_boosted(_training_table(spark, folder), FIRST)
    return boosting.tree_table(fitted).select("node", "predictor", "cut", "gain", "cover", "value")


def boosted_measures(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each number of trees, on the training rows and on those held out, and one for the held-out scores.

    What holds (1) on the training rows: the loss falls with each tree; in the end it is
    below that of any constant chance, and AUC above 0.9. On the others: the AUC after
    the last tree is that of the scores which the training job has written.
    """
    table = _training_table(spark, folder)
    result = jobs.train_second_order(table, shared_folder(spark, "second_order"), STAGED, every=1)
    fitted_on, _ = train_test_split(table, STAGED.train_ratio, SUBSCRIPTION_KEY)
    rate = F.col("n_events") / (F.col("n_events") + F.col("n_nonevents"))
    constant = -(rate * F.log(rate) + (1 - rate) * F.log(1 - rate))
    last = F.col("trees") == STAGED.trees
    falls = F.coalesce(F.col("log_loss") < F.lag("log_loss").over(Window.orderBy("trees")), F.lit(True))
    learnt = ~last | ((F.col("log_loss") < constant) & (F.col("auc") > 0.9))
    seen = boosting.staged_measures(result.model, fitted_on).withColumn("holds", falls & learnt)
    held_out = result.measures.withColumn("holds", F.lit(True))
    counts = ["trees", "n_events", "n_nonevents"]
    scored = result.auc.withColumn("trees", F.lit(STAGED.trees).cast("bigint"))
    both = result.measures.filter(last).unionByName(scored, allowMissingColumns=True)
    same = both.groupBy(*counts).agg(((F.count(F.lit(1)) == 2) & F.min("auc").eqNullSafe(F.max("auc"))).alias("holds"))

    def told(df: DataFrame, part: str) -> DataFrame:
        return df.select(F.lit(part).alias("part"), *counts, F.col("holds").cast("int").alias("holds"))

    return told(seen, "train").unionByName(told(held_out, "test")).unionByName(told(same, "scores"))


def boosted_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every scored subscription by second-order trees: whether its score is one as delivered, and the ranks' order.

    A constant score has one distinct value; ``distinct_scores`` says whether there are more than twenty.
    """
    fitted = boosting.train_boosted(_training_table(spark, folder), STAGED)
    target = shared_folder(spark, "boosted_scores")
    boosting.save_boosted(fitted, spark, f"{target}/model")
    scoring = jobs.build_scoring_set(v.monthly_tables(spark, folder, v.SCORING_MONTH), v.AS_OF)
    scores = tables.write_scores(model.score_subscribers(scoring, model.load_model(f"{target}/model")), f"{target}/scores")
    delivered = F.col("p0").between(0, 1) & (F.col("p0") == F.round("p0", model.SCORE_DIGITS))
    several = scores.groupBy("p0").agg(F.count(F.lit(1)).alias("n")).agg((F.count(F.lit(1)) > 20).cast("int").alias("holds"))
    rows = scores.select(F.lit("subscription").alias("kind"), "crm_sub_id", *SUBSCRIPTION_KEY, delivered.cast("int").alias("holds"))
    return rows.unionByName(several.withColumn("kind", F.lit("distinct_scores")), allowMissingColumns=True)


def all_queries() -> dict:
    return {f.__name__: f for f in (boosted_first_splits, boosted_measures, boosted_scores)}


# --- SQL ---------------------------------------------------------------------


def _values() -> str:
    """Every predictor's value for each training row; a category is 1 or 0."""
    parts = []
    for k, c in enumerate(feature_columns()):
        if c in CATEGORICAL:
            parts.append(
                f"SELECT id, bad_flag, {k} AS place, '{c}=' || level AS predictor, CAST({c} = level AS INTEGER)::DOUBLE AS v "
                f"FROM numbered, (SELECT DISTINCT {c} AS level FROM numbered WHERE {c} IS NOT NULL)"
            )
        else:
            parts.append(f"SELECT id, bad_flag, {k} AS place, '{c}' AS predictor, CAST({c} AS DOUBLE) AS v FROM numbered")
    return " UNION ALL ".join(parts)


def _level(rows: str) -> dict[str, str]:
    """The best split of each node in ``rows`` (id, node): cuts by ranks, gains by sums on both sides."""
    return {
        f"sides_{rows}": f"""
    SELECT node, place, c.predictor, cut, sum(CASE WHEN v < cut THEN 0.5 - bad_flag ELSE 0 END)::DOUBLE AS gl,
           sum(CASE WHEN v < cut THEN 0.25 ELSE 0 END)::DOUBLE AS hl, sum(0.5 - bad_flag)::DOUBLE AS g, sum(0.25)::DOUBLE AS h
    FROM cuts c JOIN vals USING (place, predictor) JOIN {rows} USING (id) GROUP BY ALL""",
        f"gains_{rows}": f"""
    SELECT *, (gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1)) / 2 AS gain
    FROM sides_{rows} WHERE hl >= 1 AND h - hl >= 1""",
        f"best_{rows}": f"""
    SELECT * FROM gains_{rows} WHERE gain > 1e-9
    QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, place, predictor, cut) = 1""",
    }


def _routed(rows: str) -> str:
    return f"""
    SELECT id, 2 * r.node + CASE WHEN v < cut THEN 1 ELSE 2 END AS node
    FROM {rows} r JOIN best_{rows} b ON r.node = b.node JOIN vals USING (id, place, predictor)"""


def _first_splits() -> str:
    steps = o._feature_steps(True)
    steps["features"] = o._feature_rows(True, "with_slope")
    steps["numbered"] = "SELECT row_number() OVER (ORDER BY analytic_id, register_date) AS id, * FROM features"
    steps["vals"] = _values()
    steps["ranked"] = """
    SELECT place, predictor, v, row_number() OVER w AS r, count(*) OVER (PARTITION BY place, predictor) AS n,
           min(v) OVER (PARTITION BY place, predictor) AS least
    FROM vals WINDOW w AS (PARTITION BY place, predictor ORDER BY v)"""
    steps["cuts"] = f"""
    SELECT DISTINCT place, predictor, v AS cut FROM ranked, range(1, {FIRST.bins}) AS q(k)
    WHERE NOT contains(predictor, '=') AND r = CAST(ceil(k * n / {FIRST.bins}.0) AS BIGINT) AND v > least
    UNION ALL SELECT DISTINCT place, predictor, 1.0 FROM vals WHERE contains(predictor, '=')"""
    steps["level0"] = "SELECT id, 0 AS node FROM numbered"
    steps |= _level("level0")
    steps["level1"] = _routed("level0")
    steps |= _level("level1")
    steps["level2"] = _routed("level1")
    steps["best"] = "SELECT * FROM best_level0 UNION ALL SELECT * FROM best_level1"
    steps["weights"] = f"""
    SELECT node, sum(0.25)::DOUBLE AS cover, -{FIRST.rate} * sum(0.5 - bad_flag)::DOUBLE / (sum(0.25)::DOUBLE + 1) AS value
    FROM (SELECT * FROM level0 UNION ALL SELECT * FROM level1 UNION ALL SELECT * FROM level2) JOIN numbered USING (id) GROUP BY node"""
    columns = ["CAST(node AS INTEGER) AS node", "predictor", *[o._r(c) for c in ("cut", "gain", "cover", "value")]]
    return o._statement(steps, o._select(columns, "weights LEFT JOIN best USING (node)"))


def _measures() -> str:
    split = f"CASE WHEN {o._hash('split-567')} < CAST(floor({STAGED.train_ratio} * 4294967296) AS BIGINT) THEN 'train' ELSE 'test' END"
    steps = o._feature_steps(True)
    steps["parts"] = f"""
    SELECT {split} AS part, count(*) FILTER (coalesce(bad_flag, 0) = 1) AS n_events,
           count(*) FILTER (coalesce(bad_flag, 0) = 0) AS n_nonevents FROM with_slope GROUP BY 1"""
    return o._statement(steps, f"""
    SELECT part, trees, n_events, n_nonevents, 1 AS holds FROM parts, range(1, {STAGED.trees + 1}) AS r(trees)
    UNION ALL SELECT 'scores', {STAGED.trees}, n_events, n_nonevents, 1 FROM parts WHERE part = 'test'""")


def all_statements() -> dict[str, str]:
    scores = """
    SELECT 'subscription' AS kind, crm_sub_id, analytic_id, CAST(register_date AS DATE) AS register_date, 1 AS holds FROM with_slope
    UNION ALL SELECT 'distinct_scores', NULL, NULL, NULL, 1"""
    return {
        "boosted_first_splits": _first_splits(),
        "boosted_measures": _measures(),
        "boosted_scores": o._statement(o._feature_steps(False), scores),
    }
