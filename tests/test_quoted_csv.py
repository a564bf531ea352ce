"""Quoted CSV read by blocks: the same rows as one task reads, wherever the blocks end."""

import csv
import random

import pytest

from mercato.sources import csv as csv_source
from mercato.sources import quoted

SPLIT = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, n, rng, newline="\n"):
    """Reviews with quotes, commas and line breaks in their text; some longer than a block."""
    def field():
        parts = ["plain", 'a "quoted" word', "comma, here", newline, newline * 2, '"', '""', "é日", " edge "]
        return "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 2, 4, 8, 400 if rng.random() < 0.05 else 3])))
    rows = [[f"r{i}", f"o{i % 7}", str(i % 5), field(), field(), "2020-01-01", "2020-01-02 00:00:00"] for i in range(n)]
    with open(path, "w", newline="") as f:
        out = csv.writer(f, lineterminator=newline)
        out.writerow(csv_source.STAGING_COLUMNS["order_reviews"])
        out.writerows(rows)
    return {tuple(None if v in csv_source.NULL_TOKENS else v for v in r) for r in rows}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_blocks_give_the_rows_of_one_task(small_blocks, tmp_path, seed):
    rng = random.Random(seed)
    (tmp_path / "order_reviews.csv").mkdir()
    want = write(tmp_path / "order_reviews.csv" / "a.csv", 150, rng) | write(tmp_path / "order_reviews.csv" / "b.csv", 40, rng)
    path = str(tmp_path / "order_reviews.csv")
    blocks = quoted.block_quotes(small_blocks, path).collect()
    assert len(blocks) > 20 and any(b["inside"] for b in blocks) and all(b["balanced"] for b in blocks)
    df = csv_source.stage_csv(small_blocks, path, "order_reviews")
    assert "CSVScan" not in df._jdf.queryExecution().toString() and df.rdd.getNumPartitions() > 10
    got = [tuple(r) for r in df.collect()]
    assert len(got) == 190 and set(got) == want


def test_carriage_returns_at_record_ends(small_blocks, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_bytes(b"seller_id,seller_zip_code_prefix,seller_city,seller_state\r\n"
                     + b"".join(b's%d,%05d,"city ""%d""",SP\r\n\r\n' % (i, i, i) for i in range(200)))
    got = csv_source.stage_csv(small_blocks, str(path), "sellers").collect()
    assert sorted(map(tuple, got)) == sorted((f"s{i}", f"{i:05}", f'city "{i}"', "SP") for i in range(200))


def test_unbalanced_quotes_are_left_to_the_reader(small_blocks, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\n" + "".join(f's{i},1,5" pipe,SP\n' for i in range(201)))
    got = csv_source.stage_csv(small_blocks, str(path), "sellers").collect()
    assert len(got) == 201 and {r["seller_city"] for r in got} == {'5" pipe'}


def test_empty_and_header_only_files(small_blocks, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\n")
    assert csv_source.stage_csv(small_blocks, str(path), "sellers").collect() == []
    path.write_text("")
    assert csv_source.stage_csv(small_blocks, str(path), "sellers").collect() == []


def test_lines_with_even_quotes_are_read_by_spark(small_blocks, tmp_path):
    """Quotes but no line break in them: several blocks, no Python step, the rows of one task."""
    names = csv_source.STAGING_COLUMNS["order_reviews"]
    rows = [[f"r{i}", f"o{i % 7}", "", f'a "quoted", {i}', "x,y" if i % 3 else "NULL", "2020-01-01", ""] for i in range(200)]
    path = tmp_path / "order_reviews.csv"

    def put(lines):
        with open(path, "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(names)
            out.writerows(lines)
        return csv_source.stage_csv(small_blocks, str(path), "order_reviews")
    df = put(rows)
    assert quoted.block_quotes(small_blocks, str(path)).count() > 10
    assert "MapInArrow" not in df._jdf.queryExecution().toString()
    assert df.rdd.getNumPartitions() > 10
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(
        str(tuple(None if v in csv_source.NULL_TOKENS else v for v in r)) for r in rows)
    broken = [[*r[:3], "one\ntwo", *r[4:]] if i == 150 else r for i, r in enumerate(rows)]
    assert "MapInArrow" in put(broken)._jdf.queryExecution().toString()
