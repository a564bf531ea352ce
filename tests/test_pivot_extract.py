"""The pivot extract joins its sales lines once for its three outputs."""

import datetime

from mercato.sources import sinks


def test_sales_are_read_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch
    rows = [(i // 2, "toys" if i % 3 else None, f"s{i % 4}", datetime.date(2020, 1 + i % 5, 1 + i % 9), i / 4) for i in range(120)]
    schema = "order_id long, product_category_name_english string, customer_state string, order_date date, line_revenue double"
    sales = spark.createDataFrame(rows, schema).repartition(3)
    sinks.pivot_extract_sink(sales.mapInArrow(counted, schema), str(tmp_path / "out"))
    assert read.value == len(rows)
    ext = spark.read.option("header", "true").csv(str(tmp_path / "out" / "raw_extract")).collect()
    assert sorted((int(r["order_id"]), r["category"], float(r["line_revenue"])) for r in ext) == sorted((r[0], r[1] or "unknown", r[4]) for r in rows)
    states = spark.read.option("header", "true").csv(str(tmp_path / "out" / "state_pivot")).collect()
    want = {s: (len({r[0] for r in rows if r[2] == s}), sum(r[4] for r in rows if r[2] == s)) for s in {r[2] for r in rows}}
    assert {r["state"]: (int(r["orders"]), float(r["revenue"])) for r in states} == want
