"""corpus_pipeline.run on whole tables: its rows are those of its stages, one after the other,
and each filter's drops are recomputed from its own input."""

import re
from collections import Counter

import corpus_pipeline
from mercato.llm.tables import written

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text"]


def rows(df):
    return Counter((r["doc_id"], r["text"]) for r in df.select(*COLUMNS).collect())


def windows(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [tuple(words[i: i + 10]) for i in range(max(1, len(words) - 9))] if words else []


def test_run_is_its_stages(spark):
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet"), {}
    columns = docs.columns
    before = rows(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"test-{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert sorted(docs.columns) == sorted(columns)
        after = rows(docs)
        seen[name] = before, after
        before = after
    for name in ("toxicity", "minhash_near_dedup", "benchmark_decontamination"):
        was, now = seen[name]
        assert now and not now - was  # a filter adds nothing
    # decontamination: exactly the rows without a window of any item
    items = [windows(r[0])[1] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    wanted = {w for x in items for w in x}
    lengths = {len(w) for w in wanted}
    was, now = seen["benchmark_decontamination"]

    def hit(text):
        words = windows(text)[0]
        return any(tuple(words[i: i + n]) in wanted for n in lengths for i in range(len(words) - n + 1))
    assert now == Counter({r: n for r, n in was.items() if not hit(r[1])})
    # one row of each text stays, and mixing repeats rows but makes no new ones
    was, now = seen["minhash_near_dedup"]
    assert {" ".join((t or "").split()).lower() for _, t in was} >= {" ".join((t or "").split()).lower() for _, t in now}
    worded = [t for _, t in now.elements() if t and len(t.split()) >= 5]
    assert len(worded) == len(set(worded))
    was, now = seen["source_mixing"]
    assert set(now) <= set(was) and max(now.values()) <= 3 * max(was.values())
    assert seen["sharding"][0] == seen["sharding"][1]
    assert rows(corpus_pipeline.run(spark, SF)) == seen["sharding"][1]
