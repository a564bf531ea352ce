from mercato.sources import csv as csv_source


def test_csv_null_tokens_quotes_and_zips(spark, tmp_path):
    p = tmp_path / "sellers.csv"
    p.write_text('seller_id,seller_zip_code_prefix,seller_city,seller_state\n'
                 's1,01310,"sao ""paulo""\nnorte",SP\n'
                 's2,NA,,null\n')
    df = csv_source.stage_csv(spark, str(p), "sellers")
    got = {r.seller_id: r for r in df.collect()}
    assert got["s1"].seller_zip_code_prefix == "01310"
    assert got["s1"].seller_city == 'sao "paulo"\nnorte'
    assert got["s2"].seller_zip_code_prefix is None and got["s2"].seller_city is None
    assert got["s2"].seller_state is None


def test_missing_source_is_reported(spark, tmp_path):
    import pytest
    with pytest.raises(FileNotFoundError):
        csv_source.require_sources(spark, str(tmp_path))


def test_streaming_daily_orders_matches_batch(spark, tmp_path):
    from fixture_data import write_fixture
    from mercato.operators import marts
    from mercato.plans import model as model_mod
    from mercato.streaming.daily_orders import start_daily_orders

    raw = write_fixture(tmp_path / "raw")
    (tmp_path / "orders_in").mkdir()
    (tmp_path / "orders_in" / "part1.csv").write_text((raw / "orders.csv").read_text())
    q = start_daily_orders(spark, str(tmp_path / "orders_in"), name="daily_orders_test",
                           checkpoint=str(tmp_path / "ck"))
    try:
        q.processAllAvailable()
        got = {(r.order_date, r.orders) for r in spark.sql("SELECT * FROM daily_orders_test").collect()}
    finally:
        q.stop()
    m = model_mod.from_csv(spark, str(raw))
    want = {(r.order_date, r.orders) for r in marts.vw_daily_orders(m.star).collect()}
    assert got == want
