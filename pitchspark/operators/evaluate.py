"""Splits, classification metrics and the run leaderboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchspark.functions.draws import uniform
from pitchspark.operators.numbering import running_total

# Fixed values of the evaluation.
TEST_SHARE = 0.2
SPLIT_SEED = 42
N_FOLDS = 5
ERROR_CHARS = 60
#: A board of at most so many narrow rows is ordered by one task, a longer one by parts.
BOARD_ROWS = 100_000


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = TEST_SHARE,
                     seed: int = SPLIT_SEED, folds: int = N_FOLDS) -> DataFrame:
    """Add ``is_test`` and ``fold``.

    Inside each class, rows are ordered by ``u = hash(seed|key)`` (then the
    key) and the first ``round(share * n_class)`` are the test rows;
    training rows get ``fold = position mod folds``. scikit-learn's
    permutation cannot be reproduced, so this is the engine's own,
    documented definition.

    A class can hold a third of all rows, so the position is not a window
    over the class: rows get their place in the order (class, u, key) of the
    whole table (``numbering.running_total``, which writes ``df`` once) less
    the rows of the classes before.
    """
    placed = running_total(df.withColumn("_u", uniform(seed, F.col(key))), [F.col(label), F.col("_u"), F.col(key)], "_place")
    # One row per class, counted from the written rows; nulls are a class of their own and sort first, as in the order above.
    classes = placed.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_nc"))
    before = Window.orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.withColumn("_off", F.coalesce(F.sum("_nc").over(before), F.lit(0)))
    out = (placed.join(classes, F.col(label).eqNullSafe(F.col("_class")))
                 .withColumn("_pos", F.col("_place") - F.col("_off"))
                 .withColumn("_ntest", F.round(F.col("_nc") * test_share).cast("long")))
    return (out.withColumn("is_test", F.col("_pos") <= F.col("_ntest"))
               .withColumn("fold", F.when(F.col("_pos") <= F.col("_ntest"), F.lit(None).cast("int"))
                           .otherwise(F.pmod(F.col("_pos") - F.col("_ntest") - 1, F.lit(folds)).cast("int")))
               .drop("_u", "_class", "_place", "_pos", "_ntest", "_nc", "_off"))


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Share of rows with label == prediction, unweighted, among those with a label.

    A missing prediction is wrong; ``rows`` counts the rows with a label.
    """
    known = df.where(F.col(label).isNotNull())
    right = F.coalesce(F.col(label) == F.col(prediction), F.lit(False))
    return known.agg(F.avg(right.cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("rows"))


def _pair_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (label, prediction); every later step works on these few rows."""
    return df.groupBy(F.col(label).cast("int").alias("_y"), F.col(prediction).cast("int").alias("_p")).count()


def _classes(pairs: DataFrame) -> DataFrame:
    """The classes that occur as a label or a prediction."""
    return pairs.select(F.explode(F.array("_y", "_p")).alias("cls")).where("cls is not null").distinct()


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class precision, recall, F1 and support, plus macro and weighted rows.

    The classes are those in the data, as labels or predictions; division by
    zero gives 0. All work is one grouped count of (label, prediction) pairs.
    """
    pairs = _pair_counts(df, label, prediction)
    y, p, n = F.col("_y"), F.col("_p"), F.col("count")
    # Each pair counts for its label's class and, if another one, for its prediction's.
    sides = pairs.select(F.explode(F.array(
        F.struct(y.alias("cls"), F.when(y == p, n).otherwise(0).alias("tp"), F.lit(0).cast("long").alias("pred_n"), n.alias("support")),
        F.struct(p.alias("cls"), F.lit(0).cast("long").alias("tp"), n.alias("pred_n"), F.lit(0).cast("long").alias("support")))).alias("s"))
    per = (sides.select("s.*").where("cls is not null").groupBy("cls")
           .agg(F.sum("tp").alias("tp"), F.sum("pred_n").alias("pred_n"), F.sum("support").alias("support")))
    per = (per.withColumn("precision", F.when(F.col("pred_n") > 0, F.col("tp") / F.col("pred_n")).otherwise(0.0))
              .withColumn("recall", F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0))
              .withColumn("f1", F.when((F.col("precision") + F.col("recall")) > 0,
                                       2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                          .otherwise(0.0)))
    rows = per.select(F.col("cls").cast("string").alias("class"), "precision", "recall", "f1",
                      F.col("support").cast("long").alias("support"))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").cast("long").alias("support"))
    weighted = per.agg(
        F.lit("weighted avg").alias("class"),
        *[F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in ("precision", "recall", "f1")],
        F.sum("support").cast("long").alias("support"))
    return rows.unionByName(macro).unionByName(weighted)


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     classes: list[int] = (0, 1, 2)) -> DataFrame:
    """Counts per (label, prediction), zeros kept.

    One row for each of ``classes`` and every other label found; predictions
    outside ``classes`` are counted in ``pred_other``, so no row is lost.
    """
    pairs = _pair_counts(df, label, prediction)
    spark = df.sparkSession
    labels = spark.createDataFrame([(int(c),) for c in classes], "label int").union(pairs.select("_y")).distinct()
    n = F.coalesce(F.col("count"), F.lit(0))
    out = labels.join(pairs, F.col("label").eqNullSafe(F.col("_y")), "left").groupBy("label").agg(
        *[F.sum(F.when(F.col("_p") == c, n).otherwise(0)).cast("long").alias(f"pred_{c}") for c in classes],
        F.sum(F.when(F.col("_p").isin(list(classes)), 0).otherwise(n)).cast("long").alias("pred_other"))
    return out


def run_leaderboard(registry: DataFrame, name: str = "run_name", acc: str = "accuracy",
                    error: str = "error") -> DataFrame:
    """Runs by accuracy descending, failed runs last (T4).

    A run without accuracy scores -1, is shown as ``N/A`` and carries its
    error cut to 60 characters. Up to ``BOARD_ROWS`` runs are counted by one
    window; a longer registry gets its positions from ``numbering.running_total``.
    """
    failed = F.col(acc).isNull()
    score = F.when(failed, F.lit(-1.0)).otherwise(F.col(acc))
    shown = F.when(failed, F.lit("N/A")).otherwise(F.format_number(F.col(acc) * 100, 2))
    status = F.when(failed, F.substring(F.coalesce(F.col(error), F.lit("")), 1, ERROR_CHARS)).otherwise(F.lit("ok"))
    rows = registry.select(name, score.alias("score"), shown.alias("accuracy_pct"), status.alias("status"))
    order = [F.col("score").desc(), F.col(name).asc()]
    if registry.select(name).limit(BOARD_ROWS + 1).count() <= BOARD_ROWS:
        return rows.withColumn("position", F.row_number().over(Window.orderBy(*order)))
    return running_total(rows, order, "position").withColumn("position", F.col("position").cast("int"))


def observed_rows(df: DataFrame, name: str):
    """Row count of a stage as a metric of the job that runs it.

    Returns ``(df_with_metric, observation)``; ``observation.get`` holds
    ``{"rows": n}`` after the first action on the returned DataFrame, so no
    extra pass over the data is needed.
    """
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def drop_counted(df: DataFrame, name: str, reasons: dict[str, Column]):
    """Drop rows for the first of ``reasons`` that holds and count them in the job that does so.

    Returns ``(kept rows, observation)``. A row counts once, for its first
    reason; a condition that is null does not hold. Several stages of one plan
    can each have an observation; ``flow_report`` reads them after the action.
    A task that runs again after a lost executor may count its rows again, so the
    counts are a report and nothing is decided by them.
    """
    from pyspark.sql import Observation

    holds = [F.coalesce(c, F.lit(False)) for c in reasons.values()]
    reason = F.coalesce(*[F.when(c, F.lit(r)) for r, c in zip(reasons, holds, strict=True)], F.lit("kept"))
    obs = Observation(name)
    seen = df.withColumn("_reason", reason)
    counts = [F.count(F.when(F.col("_reason") == r, 1)).alias(r) for r in [*reasons, "kept"]]
    return seen.observe(obs, F.count(F.lit(1)).alias("read"), *counts).where("_reason = 'kept'").drop("_reason"), obs


def flow_report(spark, observations: dict) -> DataFrame:
    """stage, outcome, rows: one row per count of ``{stage: observation}``, in that order; call it after the action."""
    rows = [(stage, outcome, int(n)) for stage, obs in observations.items() for outcome, n in obs.get.items()]
    return spark.createDataFrame(rows, "stage string, outcome string, rows long")
