"""op11 to op13 against brute force, with nulls, empty and very long texts, ties, repeated rows,
empty tables and clashing extra columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import corpus, frame, key, sentence
from hypothesis import given, settings
from hypothesis import strategies as st

from mercato.llm import negatives, periods, queries, repeats

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return SPLIT.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------------ periodic runs


def plain_runs(x, least=24, times=3):
    out = []
    for q in range(1, len(x) // times + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j - i + q >= max(least, times * q) and j > i:
                y = x[i: j + q]
                if not any(y[r:] == y[:-r] for r in range(1, q)):
                    out.append((i, j - i + q, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def op11_row(doc_id, text):
    w = planted(doc_id, text)
    runs = plain_runs(w)
    best = min(runs, key=lambda r: (-(r[1] / r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12)), max_size=5), min_size=1, max_size=4),
       st.sampled_from([24, 6]))
def test_runs_of_several_texts(texts, least):
    texts = [[x for pattern, n in parts for x in pattern * n] for parts in texts]
    word = np.array(sum(texts, []), np.int64)
    doc = np.repeat(np.arange(len(texts)), [len(x) for x in texts])
    found = periods.lag_scan(word, doc, periods.survivors(word, doc, least), least)
    at = np.cumsum([0] + [len(x) for x in texts])
    want = [(s + a, n, q) for a, x in zip(at.tolist(), texts) for s, n, q in plain_runs(x, least)]
    assert list(map(tuple, found.tolist())) == want


def test_splitting_recurses():
    # 1 is rare only after 9 has split the segment, 2 only after 1 has
    x = [2, 1] + [0] * 11 + [9] + [1, 2] + [0] * 30 + [9] + [1, 2] + [0] * 11
    word, doc = np.array(x), np.zeros(len(x), int)
    left = periods.survivors(word, doc)
    assert set(word[left].tolist()) == {0} and len(left) == 30


def test_op11(spark, tmp_path):
    rng = random.Random(5)
    rows = [r[:2] for r in corpus() if r[0] != 409]
    rows += [(i, " ".join(f"{rng.choice(['a b c', 'a b', 'x', 'ré A a'])} " * rng.randint(1, 20) for _ in range(rng.randint(0, 4)))) for i in range(1000, 1150)]
    rows += [(2000, "\t\n".join(["ka lo", "mi"] * 700)), (2001, "é " * 24), (2002, "x " * 23), (2003, "a b " * 30), (2003, "a b " * 30)]
    spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, runs string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=key) == sorted((op11_row(*r) for r in rows), key=key)
    assert sum(r["n_runs"] for r in got) > 20


# ------------------------------------------------------------------ repeats


def plain_repeats(rows, window):
    last = (1 << 63) - 1
    order = lambda i: last if i is None else i
    texts = [(i, words(t)) for i, t in rows]
    least = {}
    for i, w in texts:
        for s in range(len(w) - window + 1):
            k = tuple(w[s: s + window])
            least[k] = min(least.get(k, last), order(i))
    out = []
    for i, w in texts:
        gone = {j for s in range(len(w) - window + 1) if least[tuple(w[s: s + window])] < order(i) for j in range(s, s + window)}
        out.append((i, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return out


def repeat_rows():
    rng = random.Random(6)
    rows = [r[:2] for r in corpus()]
    passage = [sentence(rng, n) for n in (49, 50, 51, 60, 140)]
    for i in range(60):  # passages inside other texts, some changed by a word, some twice
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passage).split(" ")
            if rng.random() < 0.5:
                p[rng.randrange(len(p))] = "changed"
            parts += [sentence(rng, rng.randint(0, 30)), " ".join(p)]
        rows.append((rng.choice([None, *range(5000, 5040)]), "\n".join(parts)))
    rows += [(6000 + i, "same " * 200) for i in range(3)] + [(6100, "Same " * 200), (7000, passage[4].upper())]
    rng.shuffle(rows)
    return rows


def test_op12(spark, tmp_path):
    rows = repeat_rows()
    spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, u string").repartition(5).write.parquet(
        f"{tmp_path}/documents.parquet")
    got = queries.op12_substring_dedup(spark, str(tmp_path)).collect()
    want = plain_repeats(rows, 50)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sum(r[2] for r in want) > 5000


def test_repeat_spans_are_maximal(spark):
    rng = random.Random(8)
    shared = sentence(rng, 120)
    df = frame(spark, [(1, sentence(rng, 40) + " " + shared, "s"), (2, "own start " + shared + " own end", "s"), (3, None, "s")])
    got = {r["doc_id"]: r for r in repeats.drop_repeats(df).collect()}
    assert got[1]["spans"] == [] and got[3]["kept"] == ""
    assert [tuple(x) for x in got[2]["spans"]] == [(2, 122)] and got[2]["kept"] == "own start own end"


# ------------------------------------------------------------------ hard negatives


def plain_negatives(rows, is_anchor):
    known = [(i, la, [int(np.floor(256 * float(x))) for x in v]) for i, v, la in rows
             if la is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (i, la, a) in enumerate(known):
        if not is_anchor(i):
            continue
        score = [(-sum(p * q for p, q in zip(a, v)), j is None, j, same == la) for m, (j, same, v) in enumerate(known)
                 if m != n and len(v) == len(a)]
        score.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        for p, _, j, same in [s for s in score if s[3]][:5]:
            near = [s for s in score if not s[3] and -80 * p <= -100 * s[0] <= -100 * p][:5]
            out += [(i, j, r + 1, s[2], -p, -s[0]) for r, s in enumerate(near)]
    return out


def vectors(n, d=8, seed=3):
    rng = np.random.default_rng(seed)
    middle = rng.standard_normal((4, d))
    rows = []
    for i in range(n):
        v = (middle[rng.integers(4)] + rng.standard_normal(d) * 0.4).round(2)  # few values, so scores tie
        rows.append((i, v.tolist(), int(rng.integers(3)) if i % 3 else 0))
    return rows


def odd_vectors():
    nan, inf = float("nan"), float("inf")
    return [(None, [0.5] * 8, 1), (None, [0.25] * 8, None), (100, None, 1), (101, [], 1), (200, [], 1), (201, [], 2), (300, [nan] * 8, 1),
            (301, [inf] * 8, 1), (302, [None] + [1.0] * 7, 1), (400, [0.0] * 8, 2), (500, [1.0] * 3, 1), (501, [0.9] * 3, 1),
            (502, [0.85] * 3, 2), (503, [0.85] * 3, 2), (600, [-1.0] * 8, 0)]


@pytest.mark.parametrize("block, chunk", [(8192, 4096), (16, 2)])
def test_negatives(spark, block, chunk):
    rows = vectors(260) + odd_vectors()
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, label int, u string").repartition(3)
    at = df.vec_id % 20 == 0
    got = negatives.hard_negatives(df, at, block=block, chunk=chunk).collect()
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], la) for i, v, la in rows]
    want = plain_negatives(rows, lambda i: i is not None and i % 20 == 0)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key) and len(want) > 100


def test_negatives_of_repeated_rows(spark):
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [0.9, 0.5], 1), (2, [0.8, 0.5], 2), (2, [0.8, 0.5], 2)]
    got = negatives.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), negatives.F.col("vec_id") == 0)
    rows = Counter((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"]) for r in got.collect())
    # each of the two anchor rows has the other one and row 1 as positives, both rows 2 as negatives
    assert rows == Counter({(0, p, r, 2): 2 for p in (0, 1) for r in (1, 2)})


def test_search_stops_early():
    rng = np.random.default_rng(0)
    x = rng.integers(-300, 300, (4000, 3))
    lists = negatives.Lists(np.arange(4000), x)
    seen = []
    lists.scores = lambda rows, a, plain=lists.scores: seen.append(len(rows)) or plain(rows, a)
    a = np.array([3, -200, 0])
    found = list(lists.search(a, -1, np.array([-(1 << 62)]), np.array([1 << 62]), 5))
    best = np.sort(x @ a)[::-1]
    assert sum(seen) < 2000 and sorted((s for _, _, s in found), reverse=True)[:5] == best[:5].tolist()


def test_large_components_are_exact_or_raise(spark):
    rows = [(0, [131071.0] * 64, 1), (1, [131071.0] * 64, 1), (2, [131070.0] * 64, 2), (3, [-131071.0] * 64, 2)]
    schema = "vec_id long, embedding array<double>, label int"
    got = negatives.hard_negatives(spark.createDataFrame(rows, schema), negatives.F.col("vec_id") == 0).collect()
    assert [r["negative_score"] for r in got] == [64 * (131071 * 256) * (131070 * 256)]
    with pytest.raises(Exception, match="beyond"):
        negatives.hard_negatives(spark.createDataFrame([(0, [1e9], 1)], schema), negatives.F.col("vec_id") == 0).collect()


# ------------------------------------------------------------------ empty tables


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periods.collapse_runs(docs).collect() == [] and repeats.drop_repeats(docs).collect() == []
    rows = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(rows, negatives.F.col("vec_id") % 100 == 0).collect() == []
    none = spark.createDataFrame([(None, None)], "doc_id long, text string")
    assert [r["kept"] for r in repeats.drop_repeats(none).collect()] == [""]
    assert [r["collapsed"] for r in periods.collapse_runs(none).collect()] == [""]
