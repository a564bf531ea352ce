"""What the operators leave on disk while they run: no shuffle files of finished queries, and parts of the largest shuffles."""

import numpy as np
import pyarrow as pa
import pytest

from mercato.llm import coordjoin, linejoin, ordering, tables, tokens

from .fixtures import corpus, frame


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {x for x in names if x.startswith("shuffle_") and x.endswith(".data")}


ROWS = [r for r in corpus() if r[0] is None or r[0] < 409]


@pytest.mark.parametrize("step", [
    lambda docs: coordjoin.near_dedup(docs, repeat_ids=True, similar=(4, 5), t=13),
    linejoin.line_matches,
    lambda docs: ordering.write_shards(docs, tables.folder(docs.sparkSession, "t"), length=64, per_shard=100)])
def test_finished_queries_leave_no_shuffle_files(spark, step):
    docs = frame(spark, ROWS)
    docs = docs.sparkSession.createDataFrame(docs.collect(), docs.schema)  # without a shuffle of its own
    had, setting = shuffle_files(spark), spark.conf.get(tables.TIDY, None)
    out = step(docs)  # held: what it needs is not garbage
    left = shuffle_files(spark) - had
    # toLocalIterator and RDD jobs of bounded tables are not queries: theirs are of a few blocks at most
    assert len(left) <= 12, sorted(left)
    assert spark.conf.get(tables.TIDY, None) == setting
    if not isinstance(out, int):
        assert out.count() == out.count() > 0  # a returned frame can be run again


def test_records_of_a_range_of_slots():
    length, per_shard, sizes = 8, 4, [1, 8, 20, 40, 9]
    ids = pa.array([3, None, 5, 6, 7], pa.int64())
    coded = [np.arange(n, dtype="<u2").tobytes() for n in sizes]
    counts = [-(-n // length) for n in sizes]
    starts = pa.array(np.cumsum([0, *counts[:-1]]))
    total = sum(counts)
    batch = pa.RecordBatch.from_arrays([starts, ids, pa.array(coded, pa.binary())], ["start", "id", "tokens"])

    def rows(low=0, high=None):
        return sorted((s, r) for b in ordering._records(iter([batch]), length, total, 1, per_shard, low, high)
                      for s, r in zip(b.column(1).to_pylist(), b.column(2).to_pylist()))
    whole = rows()
    assert [s for s, _ in whole] == list(range(total))
    cut = [0, 4, 8, total]
    assert sum((rows(a, b) for a, b in zip(cut, cut[1:])), []) == whole
    assert all(a <= s < b for a, b in zip(cut, cut[1:]) for s, _ in rows(a, b))
    kind, by_slot = ordering.record_type(length), dict(whole)
    for text, (first, count) in enumerate(zip(starts.to_pylist(), counts)):
        for number, slot in enumerate(ordering.permute(np.arange(first, first + count), total, 1).tolist()):
            record = np.frombuffer(by_slot[slot] + b"\n", kind)[0]
            want = np.frombuffer(coded[text], "<u2")[number * length: (number + 1) * length].tolist()
            assert record["ids"].tolist() == want + [tokens.END] * (length - len(want))
            assert (record["number"], record["n"]) == (number, len(want))
            assert record["doc_id"] == (ordering._NONE if ids[text].as_py() is None else ids[text].as_py())


def test_word_sets_of_lines():
    lines = pa.array(["b a B c a", "", "c  c", " ", "A b c", "é x9 q r s t u v w"])
    counts = np.ones(1 << linejoin.TABLE, np.int32)
    got = linejoin._Sets(lines, counts)
    assert got.place.tolist() == [0, 2, 4, 5] and got.n.tolist() == [3, 1, 3, 9]
    c1, c2 = (x.to_pylist() for x in got.classes())
    assert c1[0] == c1[2] and c2[0] == c2[2] and len(set(c1)) == 3
    whole, first = got.first(got.n).to_pylist(), got.first(np.array([2, 1, 2, 4])).to_pylist()
    assert whole[0] == whole[2] and [x[:n] for x, n in zip(whole, [2, 1, 2, 4])] == first
    bits = [a % 2**64 | b % 2**64 << 64 for a, b in zip(*(x.to_pylist() for x in got.bits()))]
    assert bits == [sum({1 << (w % 2**64 >> 57) for w in words}) for words in whole]
    assert linejoin._Sets(pa.array(["", None], pa.string()), counts).first(np.empty(0, np.int64)).to_pylist() == []
