"""Frames that a job reads more than once are evaluated once."""

from pyspark.sql import functions as F

SF_SMALL = "/root/testdata/sf0.001"


def test_range_partitioning_evaluates_its_input_once(spark):
    from eventlake.operators.sequence import with_running_sum
    rows = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    df = spark.range(5000, numPartitions=4).select((F.col("id") % 3).cast("string").alias("k"), "id").mapInArrow(count, "k string, id long")
    got = with_running_sum(df, "k", ["id"], F.lit(1), "n", n_partitions=6)
    assert got.agg(F.sum("n")).first()[0] == 2 * sum(range(1, 1668)) + sum(range(1, 1667))
    assert rows.value == 5000


def test_published_rows_are_built_once(spark, monkeypatch):
    from eventlake.plans.catalog import QUERIES
    from eventlake.sinks import publish as sink
    files, real = [], sink.publish
    monkeypatch.setattr(sink, "publish", lambda df, *a: files.append(set(df.inputFiles())) or real(df, *a))
    assert QUERIES["catalog_publish"](spark, SF_SMALL).count() > 0
    assert len(files) == 2 and files[0] == files[1] and all("/silver-rows-" in f for f in files[0])


def test_enrichment_builds_events_and_purchases_once(spark, monkeypatch):
    from eventlake.operators import enrich, silver
    from eventlake.plans.catalog import QUERIES
    seen, split, near = {}, silver.split_by_run_date, enrich.event_proximity_counts
    monkeypatch.setattr(silver, "split_by_run_date", lambda df, day: seen.update(events=df.inputFiles()) or split(df, day))
    monkeypatch.setattr(enrich, "event_proximity_counts", lambda p, *a: seen.update(purchases=p.inputFiles()) or near(p, *a))
    for query in ("enrichment_tables", "purchase_event_proximity"):
        assert QUERIES[query](spark, SF_SMALL).count() > 0
        assert all("/silver-rows-" in f for f in seen["events"])
        assert query != "enrichment_tables" or all("/purchases-" in f for f in seen["purchases"])


def test_models_read_written_purchases(spark, monkeypatch):
    from eventlake.operators import ml
    from eventlake.plans.catalog import QUERIES
    files = []
    monkeypatch.setattr(ml, "next_route_model", lambda p, *a: (files.extend(p.inputFiles()) or p, None))
    QUERIES["ml_route"](spark, SF_SMALL)
    assert files and all("/purchases-" in f for f in files)


def test_listing_pages_are_rendered_once(spark):
    from eventlake.plans import standins
    assert all("/listing-pages-" in f for f in standins.listing_pages(spark, SF_SMALL).inputFiles())
