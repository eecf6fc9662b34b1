"""Scores of predictions: baseline, losses, calibration, concentration, date bootstrap."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from barlab.operators.asof import in_force_by_day
from barlab.operators.ranking import average_ranks, decile_bins
from barlab.session import materialize

SCORE_BLOCK = 4096  # sorted counts walked at once, with a number per replicate each
CLIP = 1e-6  # fixed value: probabilities are kept this far from 0 and 1 in the log loss


def log_loss(p: Column, y: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(CLIP)), F.lit(1 - CLIP))
    return -(y * F.ln(q) + (1 - y) * F.ln(1 - q))


def baseline(samples: DataFrame, folds: DataFrame) -> DataFrame:
    """Per fold: share of positives and mean return of its training sessions (ML7).

    Samples are reduced to one row per session and summed up over sessions once; every
    expanding fold reads its sums at its last training session.
    """
    daily = samples.groupBy("idx").agg(F.count(F.lit(1)).alias("n"), F.sum("positive").alias("y"), F.sum("forward_return").alias("r"))
    upto = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row per session
    sums = daily.select("idx", F.struct(*[F.sum(c).over(upto).alias(c) for c in ("n", "y", "r")]).alias("s"))
    at = in_force_by_day(folds.withColumn("_t", F.col("train_last").cast("int")), sums.withColumn("idx", F.col("idx").cast("int")), "_t", "idx", "s")
    return at.select("fold", "train_last", "test_first", "test_last", F.col("s.n").alias("n_train"),
                     F.try_divide("s.y", "s.n").alias("base_share"), F.try_divide("s.r", "s.n").alias("base_return"))


def scored(rows: DataFrame, base: DataFrame) -> DataFrame:
    """Test rows with baseline and per-sample losses. rows: fold, p, positive, forward_return, predicted."""
    y = F.col("positive")
    out = rows.join(base.select("fold", "base_share", "base_return"), "fold")
    return (out.withColumn("loss", log_loss(F.col("p"), y)).withColumn("base_loss", log_loss(F.col("base_share"), y))
            .withColumn("improvement", F.col("base_loss") - F.col("loss")))


def metrics(rows: DataFrame, by: list[str]) -> DataFrame:
    """Log loss, Brier score, mean absolute error, out-of-sample R² against the baseline mean (ML8)."""
    r, p, y = F.col("forward_return"), F.col("p"), F.col("positive")
    error, base_error = r - F.col("predicted"), r - F.col("base_return")
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg("loss").alias("log_loss"), F.avg("base_loss").alias("base_log_loss"),
        F.avg((p - y) * (p - y)).alias("brier"), F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.sum(base_error * base_error))).alias("r2_oos"))


def auc(rows: DataFrame, by: list[str]) -> DataFrame:
    """Area under the ROC curve per group from mean ranks (ML8)."""
    ranked = average_ranks(rows.select(*by, "p", "positive"), by, "p", "_rank")
    sums = ranked.groupBy(*by).agg(F.sum(F.when(F.col("positive") == 1, F.col("_rank"))).alias("_s"),
                                   F.sum("positive").alias("_n1"), F.count(F.lit(1)).alias("_n"))
    n1, n0 = F.col("_n1").cast("double"), (F.col("_n") - F.col("_n1")).cast("double")
    return sums.select(*by, F.try_divide(F.col("_s") - n1 * (n1 + 1) / 2, n1 * n0).alias("auc"))


def calibration(rows: DataFrame, bins: int = 10) -> DataFrame:
    """Mean prediction and mean outcome per deterministic bin (ML9)."""
    placed = decile_bins(rows.select("p", "positive", "symbol", "trading_date"), [F.asc("p"), F.asc("symbol"), F.asc("trading_date")], bins)
    return placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("p").alias("mean_p"), F.avg("positive").alias("mean_y"))


def calibration_error(table: DataFrame) -> DataFrame:
    return table.agg(F.max(F.abs(F.col("mean_p") - F.col("mean_y"))).alias("mace"))


def concentration(rows: DataFrame, limit: float, minimum: int, fraction: float) -> DataFrame:
    """Contribution of every sector group and fold to the net improvement (ML10).

    Sectors under max(minimum, fraction of all) samples are pooled; without net improvement
    shares are undefined and every group fails.
    """
    group = lambda kind, key: rows.groupBy(key.cast("string").alias("group")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("improvement").alias("contribution")).withColumn("kind", F.lit(kind))
    sectors = group("SECTOR", F.coalesce("sector", F.lit("UNMAPPED")))
    whole = rows.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum("improvement").alias("d"))).scalar()
    sectors = sectors.withColumn("_w", whole)
    small = F.col("n") < F.greatest(F.lit(float(minimum)), F.lit(fraction) * F.col("_w.n"))
    sectors = sectors.withColumn("group", F.when(small, "SMALL_SECTORS").otherwise(F.col("group"))).groupBy("kind", "group").agg(
        F.sum("n").alias("n"), F.sum("contribution").alias("contribution"))
    out = sectors.unionByName(group("FOLD", F.col("fold")).select("kind", "group", "n", "contribution")).withColumn("_w", whole)
    gains = F.col("_w.d") > 0
    share = F.when(gains, F.col("contribution") / F.col("_w.d"))
    return out.select("kind", "group", "n", "contribution", share.alias("share"),
                      (F.col("contribution") / F.col("n")).alias("mean_improvement"),
                      F.coalesce(gains & (share <= limit), F.lit(False)).alias("passes"))


def date_bootstrap(rows: DataFrame, value: str, replicates: int, seed: str) -> DataFrame:
    """Mean of `value` in replicates that resample whole dates (ML11).

    Rows are summed per date first; a replicate then draws as many dates as there are, by a
    seeded hash, so the draw table has replicates times dates rows whatever the sample size.
    """
    daily = rows.groupBy("trading_date").agg(F.sum(value).alias("s"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("trading_date")  # one row per day
    numbered = daily.withColumn("_i", F.row_number().over(order) - 1)
    total = daily.agg(F.count(F.lit(1))).scalar()
    draws = rows.sparkSession.range(replicates).withColumn("_total", total).select(
        F.col("id").alias("replicate"), "_total", F.explode(F.sequence(F.lit(0), (F.col("_total") - 1).cast("int"))).alias("_k"))
    bits = F.md5(F.concat_ws(":", F.lit(seed), F.col("replicate").cast("string"), F.col("_k").cast("string")))
    draws = draws.select("replicate", (F.conv(F.substring(bits, 1, 8), 16, 10).cast("bigint") % F.col("_total")).cast("int").alias("_i"))
    return draws.join(numbered, "_i").groupBy("replicate").agg((F.sum("s") / F.sum("n")).alias("estimate"))


def bootstrap_interval(estimates: DataFrame, low: float = 0.025, high: float = 0.975) -> DataFrame:
    """Interval over the replicates, whose number the caller sets."""
    return estimates.agg(F.percentile("estimate", low).alias("low"), F.percentile("estimate", high).alias("high"))


def rank_correlation(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Per-date cross-sectional rank correlation; ties share their mean rank (ML12)."""
    ranked = average_ranks(rows.select("trading_date", a, b), ["trading_date"], a, "_ra")
    ranked = average_ranks(ranked, ["trading_date"], b, "_rb")
    return ranked.groupBy("trading_date").agg(F.count(F.lit(1)).alias("n"), F.corr("_ra", "_rb").alias("ic"))


class NotConverged(RuntimeError):
    """A fit that stopped at its limit of iterations."""


def logistic_tier(train: DataFrame, validation: DataFrame, score: DataFrame, features: list[str], regularizations: list[float],
                  max_iter: int, tolerance: float = 1e-10) -> DataFrame:
    """Tier-1 probabilities (ML14): scaler and model are fitted on the training rows only, the
    regularization with the lowest log loss on VALIDATION is taken (of equals the largest).

    Rows of `score` with a missing feature stay, with a null p and the reason; rows without all
    features are left out of fitting and choosing. Adds p, p_reason and regularization.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    def whole(df: DataFrame) -> DataFrame:
        return df.dropna(subset=features)

    shape = Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="_raw", handleInvalid="error"),
                             StandardScaler(inputCol="_raw", outputCol="_x", withMean=True, withStd=True)]).fit(whole(train))
    ready, checked = materialize(shape.transform(whole(train)).select("_x", "positive")), shape.transform(whole(validation))
    tried = []
    for penalty in sorted(regularizations, reverse=True):  # the caller's list
        fitted = LogisticRegression(featuresCol="_x", labelCol="positive", regParam=penalty, probabilityCol="_p", maxIter=max_iter, tol=tolerance).fit(ready)
        if fitted.summary.totalIterations >= max_iter:
            raise NotConverged(f"regularization {penalty}: not converged after {max_iter} iterations")
        loss = fitted.transform(checked).agg(F.avg(log_loss(vector_to_array("_p")[1], F.col("positive"))).alias("l")).first()["l"]
        tried.append((float("inf") if loss is None else loss, penalty, fitted))
    _, penalty, model = min(tried, key=lambda t: t[0])
    done = model.transform(shape.transform(whole(score))).withColumn("p", vector_to_array("_p")[1]).drop("_raw", "_x", "_p", "rawPrediction", "prediction")
    return _with_missing(done, score, features).withColumn("regularization", F.lit(penalty))


def _with_missing(done: DataFrame, score: DataFrame, features: list[str]) -> DataFrame:
    """The scored rows and, with a null p and the reason, those of `score` with a missing feature."""
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in features])
    left = score.withColumn("p_reason", missing).filter("p_reason <> ''").withColumn("p", F.lit(None).cast("double")) \
        .withColumn("p_reason", F.concat(F.lit("MISSING_FEATURE:"), "p_reason"))
    return done.withColumn("p_reason", F.lit(None).cast("string")).unionByName(left)


class TierNotAllowed(RuntimeError):
    """A tier whose predecessor has not passed its evidence gate."""


def require_gate(gate: DataFrame) -> None:
    """Raise unless every criterion of the preceding tier's gate (see evidence_gate) is met; a gate without
    rows is not passed."""
    failed = [r["criterion"] for r in gate.filter("not passes").select("criterion").orderBy("criterion").collect()]  # five criteria
    if failed or gate.isEmpty():
        raise TierNotAllowed(f"the preceding tier failed: {', '.join(failed) or 'no gate recorded'}")


def tree_tier(train: DataFrame, validation: DataFrame, score: DataFrame, features: list[str], depths: list[int], trees: int = 1,
              bins: int = 32, seed: int = 1, gate: DataFrame | None = None) -> DataFrame:
    """Tier-2 probabilities: a tree, or a forest of `trees`, fitted on the training rows only; the depth with the
    lowest log loss on VALIDATION is taken (of equals the smallest).

    gate: the recorded gate of the preceding tier; if given, the tier is not started unless it passed. A
    probability is the share of positive training rows in the leaf, averaged over the trees. Rows of
    `score` with a missing feature stay, with a null p and the reason. Adds p, p_reason and depth.
    """
    from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    if gate is not None:
        require_gate(gate)
    gather = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="error")
    whole = lambda df: gather.transform(df.dropna(subset=features))
    ready = materialize(whole(train).select("_x", F.col("positive").cast("double").alias("positive")), "tree")
    checked = materialize(whole(validation).select("_x", "positive"), "tree")
    tried = []
    for depth in sorted(depths):  # the caller's list
        shared = dict(featuresCol="_x", labelCol="positive", probabilityCol="_p", maxDepth=depth, maxBins=bins, seed=seed)
        fitted = (DecisionTreeClassifier(**shared) if trees == 1 else RandomForestClassifier(numTrees=trees, **shared)).fit(ready)
        loss = fitted.transform(checked).agg(F.avg(log_loss(vector_to_array("_p")[1], F.col("positive"))).alias("l")).first()["l"]
        tried.append((float("inf") if loss is None else loss, depth, fitted))
    _, depth, model = min(tried, key=lambda t: t[:2])
    done = model.transform(whole(score)).withColumn("p", vector_to_array("_p")[1]).drop("_x", "_p", "rawPrediction", "prediction")
    return _with_missing(done, score, features).withColumn("depth", F.lit(depth))


# --- intervals that resample whole dates ------------------------------------------------------

def date_draws(dates: DataFrame, replicates: int, seed: str) -> DataFrame:
    """How often each date is drawn in each replicate: (replicate, trading_date, times). As many
    dates are drawn as there are; replicates times dates rows whatever the sample size."""
    numbered = dates.select("trading_date").distinct().withColumn("_i", F.row_number().over(Window.orderBy("trading_date")) - 1)  # one row per day
    total = numbered.agg(F.count(F.lit(1))).scalar()
    draws = dates.sparkSession.range(replicates).withColumn("_total", total).select(
        F.col("id").alias("replicate"), "_total", F.explode(F.sequence(F.lit(0), (F.col("_total") - 1).cast("int"))).alias("_k"))
    bits = F.md5(F.concat_ws(":", F.lit(seed), F.col("replicate").cast("string"), F.col("_k").cast("string")))
    draws = draws.select("replicate", (F.conv(F.substring(bits, 1, 8), 16, 10).cast("bigint") % F.col("_total")).cast("int").alias("_i"))
    return draws.groupBy("replicate", "_i").agg(F.count(F.lit(1)).alias("times")).join(numbered, "_i").select("replicate", "trading_date", "times")


def ratio_bootstrap(rows: DataFrame, above: Column, below: Column, replicates: int, seed: str) -> DataFrame:
    """Sum of `above` over sum of `below` in each replicate; rows are summed per date first (ML11)."""
    daily = rows.groupBy("trading_date").agg(F.sum(above).alias("a"), F.sum(below).alias("b"))
    return date_draws(daily, replicates, seed).join(daily, "trading_date").groupBy("replicate").agg(
        F.try_divide(F.sum(F.col("times") * F.col("a")), F.sum(F.col("times") * F.col("b"))).alias("estimate"))


def auc_bootstrap(rows: DataFrame, replicates: int, seed: str, cells: int | None = None) -> DataFrame:
    """Area under the ROC curve in each replicate (ML11). With `cells` None the order of the scores is exact; as in
    `auc`, rows without a score are left out. With a number, scores of one of so many cells of equal width are
    ties, which is another statistic when scores lie close together.

    Scores are counted per date and place and sorted over all tasks once. A task walks its places with all
    replicates side by side and gives one row for each, so replicates are never shuffled; how often each
    date is drawn is one small table, replicates times dates, that every task gets.
    """
    if cells is None:
        counted = rows.filter(F.col("p").isNotNull()).withColumn("place", F.col("p").cast("double"))
    else:
        counted = rows.withColumn("place", F.least(F.floor(F.col("p") * cells), F.lit(cells - 1)).cast("double"))
    drawn = materialize(date_draws(rows, replicates, seed).groupBy("trading_date").agg(F.collect_list(F.struct("replicate", "times")).alias("t")), "drawn")
    drawn = drawn.withColumn("_d", F.row_number().over(Window.orderBy("trading_date")) - 1).collect()  # one row per day
    times = np.zeros((len(drawn), replicates), np.int64)
    for r in drawn:
        for replicate, n in r["t"]:
            times[r["_d"], replicate] = n
    days = rows.sparkSession.createDataFrame([(r["trading_date"], r["_d"]) for r in drawn], counted.select("trading_date", F.lit(0).alias("_d")).schema)
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    daily = counted.groupBy("trading_date", "place").agg(whole(F.col("positive")).alias("n1"), whole(1 - F.col("positive")).alias("n0"))
    daily = materialize(daily.join(F.broadcast(days), "trading_date").select("place", "_d", "n1", "n0"), "daily")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Twice the pairs in order, positives and negatives per replicate, of places in ascending order."""
        pairs, n1, n0 = (np.zeros(replicates, np.int64) for _ in range(3))
        first = last = None
        open_ = np.zeros((2, replicates), np.int64)  # of the place that may go on in the next batch
        for rows in batches:
            for at in range(0, rows.num_rows, SCORE_BLOCK):
                batch = rows.slice(at, SCORE_BLOCK)
                place, day, pos, neg = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                often = times[day]
                starts = np.flatnonzero(np.concatenate([[True], ~((place[1:] == place[:-1]) | np.isnan(place[1:]) & np.isnan(place[:-1]))]))
                y1, y0 = (np.add.reduceat(often * c[:, None], starts) for c in (pos, neg))
                if last is not None and (place[0] == last or np.isnan(place[0]) and np.isnan(last)):
                    y1[0], y0[0] = y1[0] + open_[0], y0[0] + open_[1]
                else:
                    y1, y0 = np.vstack([open_[:1], y1]), np.vstack([open_[1:], y0])
                first, last, open_ = place[0] if first is None else first, place[-1], np.stack([y1[-1], y0[-1]])
                y1, y0 = y1[:-1], y0[:-1]
                pairs += (y1 * (2 * (n0 + np.cumsum(y0, 0) - y0) + y0)).sum(0)
                n1, n0 = n1 + y1.sum(0), n0 + y0.sum(0)
        if first is not None:
            pairs += open_[0] * (2 * n0 + open_[1])
            n1, n0 = n1 + open_[0], n0 + open_[1]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(replicates, first)), *[pa.array(c) for c in (np.arange(replicates), pairs, n1, n0)]],
                                             names=["first", "replicate", "u", "n1", "n0"])

    walked = daily.repartitionByRange(F.col("place")).sortWithinPartitions("place").select("place", "_d", "n1", "n0") \
        .mapInArrow(walk, "first double, replicate bigint, u bigint, n1 bigint, n0 bigint")
    before = Window.partitionBy("replicate").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    summed = walked.withColumn("_b", F.coalesce(F.sum("n0").over(before), F.lit(0))).groupBy("replicate").agg(
        F.sum(F.col("u") / 2 + F.col("n1") * F.col("_b")).alias("_u"), F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    return summed.filter("n1 + n0 > 0").select("replicate", F.try_divide("_u", (F.col("n1") * F.col("n0")).cast("double")).alias("estimate"))


def evidence_gate(rows: DataFrame, limits: dict[str, float], replicates: int, seed: str, minimum: int, fraction: float,
                  cells: int | None = None) -> DataFrame:
    """The criteria a tier must meet on its test rows, one row each: value, limit, passes (ML16).

    rows: scored test rows. limits: auc, improvement (lower bounds of 95 % intervals must exceed
    them), folds_beaten (least share), calibration_error and concentration (most). Concentration
    also needs at least three folds. cells: as in `auc_bootstrap`; the order of the scores is exact without it.
    """
    lower = lambda estimates: bootstrap_interval(estimates).select("low")
    folds = metrics(rows, ["fold"])
    beaten = folds.agg(F.avg((F.col("log_loss") < F.col("base_log_loss")).cast("double")).alias("v"))
    parts = concentration(rows, limits["concentration"], minimum, fraction)
    spread = parts.agg(F.max("share").alias("v"), (F.bool_and("passes") & (F.count_if(F.col("kind") == "FOLD") >= 3)).alias("ok"))
    one = lambda name, df, value, passes: df.select(F.lit(name).alias("criterion"), value.cast("double").alias("value"),
                                                    F.lit(limits[name]).alias("limit"), F.coalesce(passes, F.lit(False)).alias("passes"))
    low, v = F.col("low"), F.col("v")
    out = one("auc", lower(auc_bootstrap(rows, replicates, seed, cells)), low, low > limits["auc"])
    for part in (one("improvement", lower(ratio_bootstrap(rows, F.col("improvement"), F.lit(1), replicates, seed)), low, low > limits["improvement"]),
                 one("folds_beaten", beaten, v, v >= limits["folds_beaten"]),
                 one("calibration_error", calibration_error(calibration(rows)), F.col("mace"), F.col("mace") <= limits["calibration_error"]),
                 one("concentration", spread, v, F.col("ok"))):
        out = out.unionByName(part)
    return out
