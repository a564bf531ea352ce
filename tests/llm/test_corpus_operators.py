"""op1, op5, op6 and op8."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from fixtures import LOWER, corpus, frame, key, sentence, words

from mercato.llm import mixing, shards, toxicity, winnow


def level(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        room = sum(weight[s] for s in sizes if s not in full)
        more = {s for s in sizes if s not in full and 3 * sizes[s] * room < weight[s] * rest}
        if not more:
            return {s: float(3 * sizes[s]) if s in full else weight[s] * rest / room for s in sizes}
        full |= more


def test_mixing(spark):
    rows = corpus()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words(text))
    goal = level(sizes)
    got = mixing.copies(frame(spark)).collect()
    assert len(got) == len(rows)
    assert sorted(((r["doc_id"], r["size"], r["source_size"], r["target"]) for r in got), key=key) == sorted(
        ((i, len(words(t)), sizes[s], goal[s]) for i, t, s in rows), key=key)
    assert sum(goal.values()) == pytest.approx(sum(sizes.values()))
    for r in got:
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert int(rate) <= r["copies"] <= min(3, int(rate) + 1)
    emitted = mixing.mix(frame(spark))
    assert emitted.columns == frame(spark).columns
    times = Counter((r["doc_id"], r["text"]) for r in emitted.collect())
    want = Counter()
    for r, (i, t) in zip(sorted(got, key=lambda r: key((r["doc_id"], r["size"]))), sorted(((i, t) for i, t, _ in rows), key=lambda x: key((x[0], len(words(x[1])))))):
        want[(i, t)] += r["copies"]
    assert sum(times.values()) == sum(want.values())
    assert mixing.copies(frame(spark, [])).count() == 0 and mixing.mix(frame(spark, [])).count() == 0


def test_mixing_comes_near(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(1, 40), f"s{i % 7}") for i in range(6000)]
    got = mixing.copies(frame(spark, rows, extra=False)).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] / target[s] - 1) < 0.08 for s in target)


def test_only_empty_sources(spark):
    got = mixing.copies(frame(spark, [(1, "", "a"), (2, None, None)], extra=False)).collect()
    assert [(r["target"], r["copies"]) for r in got] == [(0.0, 0)] * 2


def test_sharding(spark):
    rng = random.Random(2)
    rows = corpus()[:-8] + [(5000 + i, sentence(rng, rng.randint(3, 60)), "s") for i in range(900)]
    rows = [r for r in rows if r[0] != 409]
    rows += [(7000 + i, f"group {i // 3} of three equal texts", "s") for i in range(300)] + [(8000 + i, "one large group of copies", "s") for i in range(700)]
    got = shards.equal_text_shards(frame(spark, rows)).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got if r["doc_id"] is not None and r["text_crc32"] is not None) == sorted(
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t, _ in rows if i is not None and t is not None)
    load, slots = Counter(), defaultdict(list)
    for r in got:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(load) <= set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) - min(load.values()) <= 2 * max(r["size"] for r in got)
    text = {i: t for i, t, _ in rows}
    where = defaultdict(set)
    for r in got:
        where[text[r["doc_id"]]].add(r["shard"])
    groups = [t for t in where if t and t.startswith("group ")]
    assert sum(len(where[t]) == 1 for t in groups) >= 0.75 * len(groups)
    assert len(where["one large group of copies"]) < 8


def test_sharding_rows(spark):
    got = shards.shard_documents(frame(spark))
    assert set(got.columns) == set(frame(spark).columns) | {"slot"}
    assert got.count() == len(corpus())
    assert shards.shard_documents(frame(spark, [])).count() == 0
    assert shards.equal_text_shards(frame(spark, [])).count() == 0


def bench_items():
    rng = random.Random(11)
    items = [(i, sentence(rng, rng.choice([10, 11, 14, 25, 40]))) for i in range(12)]
    items += [(20, "only Three words"), (21, "Solo"), (22, ""), (23, None), (24, "?!"), (25, items[0][1]), (26, items[1][1] + " tail ends here"),
              (26, items[2][1]), (None, "an item without an id")]
    return items


UPPER = str.maketrans({v: chr(k) for k, v in LOWER.items()})


def leaky(items):
    rng = random.Random(12)
    rows = corpus()
    for i in range(25):
        w = items[i % 12][1].split(" ")
        part = w[: rng.randint(5, len(w))] if i % 2 else w
        rows.append((600 + i, sentence(rng, rng.randint(0, 30)) + ". " + ", ".join(part).translate(UPPER) + " - " + sentence(rng, rng.randint(0, 9)), "s"))
    rows += [(700, "has only   three words inside", "s"), (701, "Solo solo SOLO", "s"), (702, "an-item without.an id", "s"),
             (703, " ".join(items[4][1] for _ in range(3)), "s"), (704, items[5][1][:-1], "s")]
    return rows


ITEM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_decontamination(spark):
    items = bench_items()
    rows = leaky(items)
    find = lambda t: ITEM_WORDS.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for i, t in items:
        w = find(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k:k + n])].add(i)
    want = []
    for i, t, _ in rows:
        w, hit, ids = find(t), set(), set()
        for n in range(1, 11):
            for k in range(len(w) - n + 1):
                got = windows.get(tuple(w[k:k + n]))
                if got is not None and n <= 10:
                    hit |= set(range(k, k + n))
                    ids |= got
        ids = sorted(str(x) for x in ids if x is not None)
        want.append((i, len(w), len(hit), ids))
    df = spark.createDataFrame([(*x, "y") for x in items], "item_id long, text string, window string").repartition(3)
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in winnow.contamination(frame(spark, rows), df).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(w[2] > 0 for w in want) > 15
    clean = winnow.decontaminate(frame(spark, rows), df)
    assert clean.columns == frame(spark).columns
    bad = {w[0] for w in want if w[2] and w[0] is not None}
    assert sorted(r["doc_id"] for r in clean.collect() if r["doc_id"] is not None) == sorted(r[0] for r in rows if r[0] is not None and r[0] not in bad)
    assert winnow.contamination(frame(spark, []), df).count() == 0
    assert all(r["n_hit"] == 0 for r in winnow.contamination(frame(spark), df.limit(0)).collect())


def test_query_digest():
    assert hashlib.sha256(b"").hexdigest() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    held = [(r["toxic"], got[r["doc_id"]]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(r["held_out"] for _, r in held) and all((r["score"] >= 0.5) == r["predicted"] and 0 <= r["score"] <= 1 for _, r in held)
    caught = [r["predicted"] for t, r in held if t == 1]
    wrong = [r["predicted"] for t, r in held if t == 0]
    assert sum(caught) / len(caught) > 0.88 and sum(wrong) / len(wrong) < 0.03


def test_toxicity_cases(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, 30) + (" vile slur" if i % 4 == 0 else ""), "s") for i in range(400)] + corpus()
    labels = spark.createDataFrame([(i, int(i % 4 == 0), "z") for i in range(0, 400)] + [(3, 0, "z"), (None, 1, "z"), (9999, 1, "z"), (5, None, "z")],
                                   "doc_id long, toxic int, score string")
    got = toxicity.toxicity(frame(spark, rows), labels).collect()
    assert len(got) == len(rows)
    scores = {r["doc_id"]: r["predicted"] for r in got if r["doc_id"] is not None and 12 <= r["doc_id"] < 100 or r["doc_id"] == 399}
    assert all(scores[i] == int(i % 4 == 0) for i in scores)
    kept = toxicity.keep_clean(frame(spark, rows), labels)
    assert kept.columns == frame(spark).columns and 0 < kept.count() < len(rows)
    assert toxicity.toxicity(frame(spark, []), labels).count() == 0
    none = toxicity.toxicity(frame(spark), labels.limit(0)).collect()
    assert len(none) == len(corpus()) and all(r["score"] == 0.0 and r["predicted"] == 0 for r in none)
    # held-out labels are never learned from: flipping them changes nothing
    flipped = labels.withColumn("toxic", __import__("pyspark").sql.functions.expr("if(crc32(cast(doc_id as string)) % 5 = 0, 1 - toxic, toxic)"))
    assert sorted((tuple(r) for r in toxicity.toxicity(frame(spark, rows), flipped).collect()), key=key) == sorted(map(tuple, got), key=key)
