"""Distributed models with ``pyspark.ml`` (definitions ours; the original model
scripts are not public).

* :func:`purchase_horizon_model` (L3): a model per horizon on (client, cutoff)
  rows from ``labels.cutoff_labels``; training uses cutoffs before ``split_date``,
  scoring the rest (a time split, no leakage: features only see purchases on or
  before their cutoff, labels only after it).  ``estimator``: ``linear`` (logistic
  regression) or ``boosted`` (gradient-boosted trees that stop early on the last
  training cutoffs).
* :func:`horizon_report` (L3): exact out-of-time AUC of both, side by side.
* :func:`next_route_model` (R4): random forest over the current route and the
  client's history up to that purchase, predicting the next purchase's route
  among the top-N classes (others ``OUTROS``); time split on the purchase date.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators.evaluate import auc
from eventlake.operators.labels import cutoff_labels
from eventlake.operators.routes import next_route_targets
from eventlake.operators.sequence import with_next, with_running_sum
from eventlake.session import checkpoint_root, staged

FEATURES_7_30 = ["n_purchases", "gmv_before_d", "days_since_last"]
#: Boosting: at most so many trees of so many levels; training ends when the validation loss stops falling.
BOOST_TREES, BOOST_DEPTH, BOOST_STEP = 30, 3, 0.2


def horizon_rows(purchases: DataFrame, cutoffs: list, horizon: int, as_of: str) -> DataFrame:
    """Labelled (client, cutoff) rows, written once: estimators pass over them several times."""
    rows = cutoff_labels(purchases, cutoffs, horizon, as_of).withColumn("gmv_before_d", F.col("gmv_before").cast("double"))
    return staged(rows.filter(F.col("label").isNotNull()).withColumn("label", F.col("label").cast("double")), "horizon-rows")


def horizon_scores(rows: DataFrame, cutoffs: list, split_date: str, estimator: str = "linear", seed: int = 7) -> tuple[DataFrame, object]:
    """(client_id, cutoff, label, score of the cutoffs from ``split_date`` on, fitted model).

    ``boosted`` keeps the last quarter of the training cutoffs for early stopping; training
    and validation never see a cutoff from ``split_date`` on."""
    split = F.lit(split_date).cast("date")
    train, test = rows.filter(F.col("cutoff") < split), rows.filter(F.col("cutoff") >= split)
    assemble = VectorAssembler(inputCols=FEATURES_7_30, outputCol="features")
    if estimator == "boosted":
        before = [c for c in cutoffs if str(c) < split_date]
        train = train.withColumn("is_valid", F.col("cutoff") >= F.lit(str(before[-max(1, len(before) // 4)])).cast("date"))
        model = GBTClassifier(labelCol="label", featuresCol="features", validationIndicatorCol="is_valid", maxIter=BOOST_TREES,
                              maxDepth=BOOST_DEPTH, stepSize=BOOST_STEP, seed=seed)
    else:
        model = LogisticRegression(labelCol="label", featuresCol="features", maxIter=50, regParam=0.01)
    fitted = Pipeline(stages=[assemble, model]).fit(train)
    scored = fitted.transform(test).select("client_id", "cutoff", F.col("label").cast("int").alias("label"),
                                           vector_to_array("probability")[1].alias("score"))
    return scored, fitted.stages[-1]


def purchase_horizon_model(purchases: DataFrame, cutoffs: list, split_date: str, as_of: str, horizons=(7, 30),
                           seed: int = 7, estimator: str = "linear", evaluate: bool = False) -> tuple[DataFrame, dict]:
    """Scores for every (client, cutoff) at or after ``split_date``; returns
    (scores, {horizon: exact test AUC}); the latter only with ``evaluate``."""
    scored, metrics = None, {}
    for h in horizons:
        found, _ = horizon_scores(horizon_rows(purchases, cutoffs, h, as_of), cutoffs, split_date, estimator, seed)
        if evaluate:
            metrics[h] = auc(found.withColumn("model", F.lit(estimator))).first()["auc"]
        out = found.select("client_id", "cutoff", F.col("label").alias(f"label_{h}d"), F.round("score", 6).alias(f"p_{h}d"))
        scored = out if scored is None else scored.join(out, ["client_id", "cutoff"], "full_outer")
    return scored, metrics


def horizon_report(purchases: DataFrame, cutoffs: list, split_date: str, as_of: str, horizons=(7, 30),
                   estimators=("linear", "boosted"), seed: int = 7) -> DataFrame:
    """horizon_days, model, n_trees (null: no trees), n, n_positive, auc over the held-out cutoffs."""
    scored, trees = None, []
    for h in horizons:
        rows = horizon_rows(purchases, cutoffs, h, as_of)
        for estimator in estimators:
            found, model = horizon_scores(rows, cutoffs, split_date, estimator, seed)
            name = f"{estimator}:{h}"
            trees.append((name, h, estimator, model.getNumTrees if estimator == "boosted" else None))
            found = found.select(F.lit(name).alias("of"), "score", "label")
            scored = found if scored is None else scored.unionByName(found)
    models = purchases.sparkSession.createDataFrame(trees, "of string, horizon_days int, model string, n_trees int")
    return auc(scored, by="of").join(models, "of").select("horizon_days", "model", "n_trees", "n", "n_positive", "auc")


def _history_features(purchases: DataFrame) -> DataFrame:
    """Per purchase: the client's purchase count so far and days since the
    previous purchase, from earlier purchases only.  Both come from the balanced
    per-client sequence operators (a hot client is split across tasks): the
    previous purchase of ``x`` is the row whose next purchase is ``x``."""
    order = ["purchased_at", "purchase_id"]
    base = purchases.select("client_id", "purchase_id", "purchased_at")
    nxt = staged(with_next(base, "client_id", order, ["purchase_id", "purchased_at"]), "next-purchases")  # read twice
    prev = nxt.filter(F.col("next_purchase_id").isNotNull()).select(
        F.col("next_purchase_id").alias("purchase_id"), F.col("purchased_at").alias("prev_at"))
    counts = with_running_sum(base, "client_id", order, F.lit(1), "n_so_far")
    following = nxt.select("purchase_id", F.to_date("next_purchased_at").alias("next_d"))
    return counts.join(prev, "purchase_id", "left").join(following, "purchase_id", "left").select(
        "purchase_id", "next_d", F.col("n_so_far").cast("int").alias("n_so_far"),
        F.coalesce(F.datediff(F.to_date("purchased_at"), F.to_date("prev_at")), F.lit(-1))
         .alias("days_since_prev"),
        F.month("purchased_at").alias("month"), F.dayofweek("purchased_at").alias("dow"))


def next_route_model(purchases: DataFrame, split_date: str, top_n: int = 20,
                     num_trees: int = 20, seed: int = 7, evaluate: bool = False) -> tuple[DataFrame, float | None]:
    """Predicted next route per test purchase; returns (predictions, accuracy); the latter only with ``evaluate``."""
    targets = next_route_targets(purchases, top_n)
    feats = _history_features(purchases)
    rows = targets.join(feats, "purchase_id").join(
        purchases.select("purchase_id", F.to_date("purchased_at").alias("d")), "purchase_id")
    # Estimators pass over their input several times: cut the lineage once.  A checkpoint keeps the rows' partitions
    # as they are, on which the forest's bootstrap samples depend.
    checkpoint_root(purchases.sparkSession)
    rows = rows.checkpoint(eager=True)
    # A label is known only once the next purchase is made: it too must lie before the split.
    split = F.lit(split_date).cast("date")
    train = rows.filter((F.col("d") < split) & (F.col("next_d") < split))
    test = rows.filter(F.col("d") >= split)
    route_idx = StringIndexer(inputCol="route", outputCol="route_i", handleInvalid="keep")
    label_idx = StringIndexer(inputCol="next_route", outputCol="label", handleInvalid="keep")
    pipe = Pipeline(stages=[
        route_idx, label_idx,
        OneHotEncoder(inputCols=["route_i"], outputCols=["route_v"], handleInvalid="keep"),
        VectorAssembler(inputCols=["route_v", "n_so_far", "days_since_prev", "month", "dow"],
                        outputCol="features"),
        RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=num_trees,
                               maxDepth=8, seed=seed),
    ])
    model = pipe.fit(train)
    labels = model.stages[1].labels
    pred = model.transform(test)
    pred = IndexToString(inputCol="prediction", outputCol="predicted_route", labels=labels).transform(pred)
    acc = pred.agg(F.avg((F.col("predicted_route") == F.col("next_route")).cast("double"))).first()[0] if evaluate else None
    return pred.select("client_id", "purchase_id", "route", "next_route", "predicted_route"), acc
