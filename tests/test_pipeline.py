"""The batch run on the written-out fixture, the rank-sum tail and short series."""

import math

import pytest
from pyspark.sql import functions as F

from fixture_data import write_fixture
from mercato.operators import forecast, marts, quality, stats
from mercato.operators import star as star_ops
from mercato.plans import catalog, model, pipeline, snapshots


def test_run_pipeline_publishes_and_reads_back(spark, tmp_path):
    raw = write_fixture(tmp_path / "raw")
    star, before, after = pipeline.run_pipeline(spark, str(raw), str(tmp_path / "out"))
    assert before.filter("not passed").isEmpty() and after.filter("not passed").isEmpty()
    assert all("/out/snapshots/" in f for f in star.fact_orders.inputFiles())
    assert "purchase_month" not in star.fact_orders.columns
    published = pipeline.read_star(spark, str(tmp_path / "out"))
    assert len(published.tables()) == 9 and published.dim_date.count() > 0
    assert published.fact_orders.inputFiles() == star.fact_orders.inputFiles()


def repeat_first_item(raw):
    file = next(p for p in raw.rglob("*order_items*.csv"))
    header, *rows = file.read_text().splitlines()
    file.write_text("\n".join([header, *rows, rows[0]]) + "\n")


def test_blocking_input_publishes_nothing(spark, tmp_path):
    raw = write_fixture(tmp_path / "raw")
    repeat_first_item(raw)
    with pytest.raises(quality.QualityGateError):
        pipeline.run_pipeline(spark, str(raw), str(tmp_path / "out"))
    with pytest.raises(snapshots.NoSnapshotError):
        pipeline.read_star(spark, str(tmp_path / "out"))
    assert not list((tmp_path / "out" / "snapshots").glob("*/star"))


@pytest.mark.parametrize("gate", ["input", "output"])
def test_a_failed_gate_leaves_the_earlier_star(spark, tmp_path, monkeypatch, gate):
    raw, out = write_fixture(tmp_path / "raw"), str(tmp_path / "out")
    pipeline.run_pipeline(spark, str(raw), out, database="mercato_failed")
    earlier = snapshots.current(spark, out)
    rows = sorted(map(tuple, pipeline.read_star(spark, out).fact_order_items.collect()))
    if gate == "input":
        repeat_first_item(raw)
    else:  # a build that loses rows on its way
        monkeypatch.setitem(star_ops._BUILDERS, "fact_order_items", lambda stg: star_ops.fact_order_items(stg["order_items"]).limit(1))
    with pytest.raises(quality.QualityGateError, match=f"{gate} gate failed"):
        pipeline.run_pipeline(spark, str(raw), out, database="mercato_failed")
    assert snapshots.current(spark, out) == earlier
    assert sorted(map(tuple, pipeline.read_star(spark, out).fact_order_items.collect())) == rows
    assert spark.table("mercato_failed.vw_sales").count() > 0


def test_views_read_the_new_snapshot(spark, tmp_path):
    raw, out = write_fixture(tmp_path / "raw"), str(tmp_path / "out")
    star, _, _ = pipeline.run_pipeline(spark, str(raw), out, database="mercato_views")
    for name, view in marts.VIEWS.items():  # the catalog's SQL and the library's frames agree
        there, here = spark.table(f"mercato_views.{name}"), view(star)
        assert there.columns == here.columns
        assert sorted(map(str, there.collect())) == sorted(map(str, here.collect())), name
    first = snapshots.current(spark, out)
    file = next(p for p in raw.rglob("orders*.csv"))
    header, *rows = file.read_text().splitlines()
    fields = header.split(",")
    at, status = fields.index("order_purchase_timestamp"), fields.index("order_status")
    row = next(r.split(",") for r in rows if "canceled" in r or "shipped" in r or "delivered" in r)
    row[0], row[at] = "order-of-the-second-run", "2018-12-30 10:00:00"
    row[status] = "created"
    row[at + 1: at + 4] = ["", "", ""]
    file.write_text("\n".join([header, *rows, ",".join(row)]) + "\n")
    before = spark.table("mercato_views.vw_daily_orders").agg(F.sum("orders")).first()[0]
    pipeline.run_pipeline(spark, str(raw), out, database="mercato_views")
    assert snapshots.current(spark, out) != first
    assert spark.table("mercato_views.vw_daily_orders").agg(F.sum("orders")).first()[0] == before + 1
    assert [r["version"] for r in snapshots.publish_log(spark, out).orderBy("version").collect()] == [1, 2]


def test_views_do_not_broadcast_tables_of_many_rows(spark, tmp_path):
    out, db = str(tmp_path / "out"), "mercato_rows"
    star = model.from_csv(spark, str(write_fixture(tmp_path / "raw"))).star
    sold = sorted(map(str, marts.vw_sales(star).collect()))
    other = spark.range(400_000).select(*[(F.concat(F.lit("x"), "id") if c == "customer_id" else F.lit(None).cast("string")).alias(c)
                                          for c in star.dim_customers.columns])
    star.bind("dim_customers", star.dim_customers.unionByName(other))
    snapshot = snapshots.new_snapshot(out)
    star_ops.publish_star(star, f"{snapshot}/star")
    snapshots.point_to(spark, out, snapshot)
    catalog.remake_views(spark, out, db)
    for view in ("vw_sales", "vw_orders", "vw_customers"):
        plan = spark.sql(f"SELECT count(*) FROM {db}.{view}")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [customer_id" in plan and "BroadcastHashJoin [customer_id" not in plan, view
        assert view != "vw_sales" or "BroadcastHashJoin [product_id" in plan  # four products
    assert sorted(map(str, spark.table(f"{db}.vw_sales").collect())) == sold


def test_slices_read_only_their_months(spark, tmp_path):
    raw, out = write_fixture(tmp_path / "raw"), str(tmp_path / "out")
    star, _, _ = pipeline.run_pipeline(spark, str(raw), out)
    days = [r[0] for r in star.fact_orders.select(F.to_date("order_purchase_timestamp").alias("d")).distinct().orderBy("d").collect()]
    start, end = str(days[0]), str(days[len(days) // 3])
    sliced = marts.slice_star(star, start, end)
    plan = sliced.fact_orders._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_month" in plan
    read = {r[0] for r in sliced.fact_orders.select(F.input_file_name()).distinct().collect()}
    every = {r[0] for r in star.fact_orders.select(F.input_file_name()).distinct().collect()}
    assert read < every
    want = marts.apply_slicers(marts.vw_sales(star), start=start, end=end)
    assert sorted(map(str, marts.vw_sales(sliced).collect())) == sorted(map(str, want.collect()))


def test_removed_fact_rows_are_caught_in_the_published_star(spark, tmp_path):
    raw = write_fixture(tmp_path / "raw")
    star, _, _ = pipeline.run_pipeline(spark, str(raw), str(tmp_path / "out"))
    star.bind("fact_order_items", star.fact_order_items.limit(0))
    staged = {p.name: spark.read.parquet(str(p)) for p in next((tmp_path / "out" / "snapshots").glob("*/staging")).iterdir()}
    with pytest.raises(quality.QualityGateError):
        quality.run_gate(quality.output_checks(star, staged), "output")


def test_erfc(spark):
    xs = [-4.0, -1.5, -0.2, 0.0, 0.3, 1.0, 2.5, 6.0]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", stats.erfc(F.col("x")).alias("y")).collect()
    for r in rows:
        assert r["y"] == pytest.approx(math.erfc(r["x"]), rel=2e-7)


def test_short_series_raise(spark):
    days = spark.range(30).select(F.lit("all").alias("series_id"), F.expr("date_add(DATE'2020-01-01', cast(id as int))").alias("day"),
                                  F.col("id").alias("day_index"), F.lit(3).cast("bigint").alias("orders"))
    with pytest.raises(Exception, match="30 days, 6 folds need 175"):
        forecast.seasonal_naive_forecast(days).collect()
