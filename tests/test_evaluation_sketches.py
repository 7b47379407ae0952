"""Exact evaluation, boosted trees, sketches, holiday shares and the enrichment tables."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from eventlake.operators.evaluate import auc, class_report, confusion


def auc_brute(rows):
    pairs = [(p, n) for p in rows for n in rows if p[1] == 1 and n[1] == 0]
    return sum(1.0 if p[0] > n[0] else 0.5 if p[0] == n[0] else 0.0 for p, n in pairs) / len(pairs) if pairs else None


def test_auc_equals_pair_counting_with_ties(spark):
    rng = random.Random(2)
    rows = [("ties", rng.choice([0.1, 0.2, 0.3]), rng.randrange(2)) for _ in range(300)] + [("fine", rng.random(), rng.randrange(2)) for _ in range(200)]
    rows += [("all one", 0.5, 1)] * 5 + [("same", 1.0, i % 2) for i in range(90)] + [("ties", None, 1), ("ties", 0.2, None)]
    found = {r.model: r for r in auc(spark.createDataFrame(rows, "model string, score double, label int")).collect()}
    for name in ("ties", "fine", "same", "all one"):
        mine = [(s, y) for m, s, y in rows if m == name and s is not None and y is not None]
        assert found[name].n == len(mine) and found[name].n_positive == sum(y for _, y in mine)
        assert found[name].auc == pytest.approx(auc_brute(mine)) if name != "all one" else found[name].auc is None


def test_class_report(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "a")] * 2 + [("c", "a")] + [(None, "b")]
    table = confusion(spark.createDataFrame(pairs, "x string, y string"), "x", "y")
    assert {(r.actual, r.predicted): r.n for r in table.collect()} == {("a", "a"): 3, ("a", "b"): 1, ("b", "a"): 2, ("c", "a"): 1, (None, "b"): 1}
    found = {r["class"]: r for r in class_report(table).collect()}
    assert (found["a"].n_actual, found["a"].n_predicted, found["a"].n_right) == (4, 6, 3)
    assert found["a"].precision == 0.5 and found["a"].recall == 0.75 and found["a"].f1 == pytest.approx(0.6)
    assert found["c"].precision is None and found["c"].recall == 0 and found[None].n_actual == 1


@pytest.fixture(scope="module")
def purchases(spark):
    rng = random.Random(9)
    rows = []
    for client, (gap, n) in enumerate(itertools.product((4, 9, 25, 60, 120), range(1, 13))):
        day = dt.datetime(2020, 1, 1) + dt.timedelta(days=rng.randrange(60))
        for i in range(n * 4):
            rows.append((f"c{client}", len(rows), day, float(rng.randrange(10, 500)), "X", "Y"))
            day += dt.timedelta(days=gap + rng.randrange(3))
    schema = "client_id string, purchase_id long, purchased_at timestamp, gmv double, origin string, destination string"
    return spark.createDataFrame(rows, schema).withColumn("gmv", F.col("gmv").cast("decimal(18,2)"))


def test_boosted_trees_beside_the_linear_model(spark, purchases):
    from eventlake.operators.labels import cutoff_dates
    from eventlake.operators.ml import horizon_report, horizon_rows, horizon_scores
    r = purchases.agg(F.min(F.to_date("purchased_at")), F.max(F.to_date("purchased_at"))).first()
    cuts, as_of = cutoff_dates(r[0], r[1], 3), str(r[1])
    split = str(cuts[2 * len(cuts) // 3])
    report = {(row.horizon_days, row.model): row for row in horizon_report(purchases, cuts, split, as_of, horizons=(30,)).collect()}
    rows = horizon_rows(purchases, cuts, 30, as_of)
    for estimator in ("linear", "boosted"):
        scored, model = horizon_scores(rows, cuts, split, estimator)
        found = scored.collect()
        assert min(str(x.cutoff) for x in found) >= split
        want = auc_brute([(x.score, x.label) for x in found])
        assert report[30, estimator].auc == pytest.approx(want) and report[30, estimator].n == len(found)
    assert 1 <= report[30, "boosted"].n_trees <= 30 and report[30, "linear"].n_trees is None
    assert report[30, "boosted"].auc > 0.6


def test_sketches_merge_within_their_bounds(spark, purchases):
    from eventlake.operators.sketches import RANK_BOUND, daily_sketches, distinct_bound, estimates, merged
    days = daily_sketches(purchases)
    assert days.count() == purchases.select(F.to_date("purchased_at")).distinct().count()
    spans = estimates(merged(days.withColumn("year", F.year("day")), "year"), 0.9)
    for row in spans.collect():
        mine = [(r.client_id, int(r.gmv * 100)) for r in purchases.where(F.year("purchased_at") == row.year).collect()]
        clients = len({c for c, _ in mine})
        assert row.n == len(mine) and abs(row.n_clients - clients) <= max(1, clients * distinct_bound())
        below, upto = (sum(v < row.quantile_cents for _, v in mine) / len(mine), sum(v <= row.quantile_cents for _, v in mine) / len(mine))
        assert below - RANK_BOUND <= 0.9 <= upto + RANK_BOUND
    empty = purchases.withColumn("purchased_at", F.lit(None).cast("timestamp"))
    assert daily_sketches(empty).count() == 0


def test_holiday_share_and_features(spark, purchases):
    from eventlake.operators.clients import client_features, holiday_share
    from eventlake.operators.enrich import brazil_holidays
    holidays = brazil_holidays(spark, 2020, 2024)
    days = {r.holiday_date for r in holidays.collect()}
    found = {r.client_id: (r.n_holiday, r.holiday_share) for r in holiday_share(purchases, holidays).collect()}
    rows = [(r.client_id, r.purchased_at.date()) for r in purchases.collect()]
    for client, (n, share) in found.items():
        mine = [d in days for c, d in rows if c == client]
        assert n == sum(mine) and share == pytest.approx(sum(mine) / len(mine))
    assert "holiday_share" in client_features(purchases, "2024-01-01", holidays=holidays).columns
    assert "holiday_share" not in client_features(purchases, "2024-01-01").columns


def test_enrichment_job_writes_four_tables(spark, purchases, tmp_dir):
    from eventlake.plans.jobs import ENRICHMENT_TABLES, enrichment_job
    events = spark.createDataFrame([("u1", "Y", dt.datetime(2020, 2, 1)), ("u2", " Y ", dt.datetime(2020, 3, 1)), ("u3", "Z", None)],
                                   "event_url string, city string, event_date timestamp")
    paths = enrichment_job(spark, purchases, events, tmp_dir, "2020-02-15")
    assert tuple(paths) == ENRICHMENT_TABLES
    counts = {name: spark.read.parquet(p).count() for name, p in paths.items()}
    assert (counts["events_past"], counts["events_future"], counts["purchases_enriched"]) == (1, 1, purchases.count())
    enriched = spark.read.parquet(paths["purchases_enriched"])
    for r in enriched.where("purchased_at < '2020-04-01'").collect():
        near = [d for d in (dt.datetime(2020, 2, 1), dt.datetime(2020, 3, 1))]
        assert r.events_prev_30d == sum(dt.timedelta(0) <= r.purchased_at - d <= dt.timedelta(days=30) for d in near)
        assert r.events_next_30d == sum(dt.timedelta(0) <= d - r.purchased_at <= dt.timedelta(days=30) for d in near)
