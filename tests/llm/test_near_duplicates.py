"""op10, op4 and op2 against all pairs."""

import math
import random

import numpy as np
import pytest
from fixtures import corpus, frame, key, roots, words

from mercato.llm import coordjoin, linejoin, rotcodes
from mercato.llm.components import connected_components


def shingle_sets(rows):
    out = []
    for _, text, _ in rows:
        w = words(text)
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def expected_components(rows, linked):
    root = roots(len(rows), linked)
    least = {}
    for r, (i, *_) in zip(root, rows):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [least.get(r, i) for r, (i, *_) in zip(root, rows)]


def test_minhash_components(spark):
    rows = corpus()
    sets = shingle_sets(rows)
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    comp = expected_components(rows, links)
    want = sorted(((r[0], len(s), c, r[0] == c) for r, s, c in zip(rows, sets, comp)), key=key)
    got = sorted(map(tuple, coordjoin.near_duplicates(frame(spark)).collect()), key=key)
    assert got == want
    assert any(not r[3] for r in got)
    kept = coordjoin.near_dedup(frame(spark))
    assert kept.columns == frame(spark).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({w[0] for w in want if w[3] and w[0] is not None})


def test_minhash_near_groups_chain(spark):
    """A chain of texts, each near only the next: one component, whatever the leaders are."""
    rng = random.Random(3)
    w = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(25):
        rows.append((1000 - i, " ".join(w), "s"))
        for _ in range(2):
            w[rng.randrange(200)] = f"n{rng.random()}"
    got = coordjoin.near_duplicates(frame(spark, rows, extra=False)).collect()
    sets = shingle_sets(rows)
    links = [(i, j) for i in range(25) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    want = dict(zip([r[0] for r in rows], expected_components(rows, links)))
    assert {r["doc_id"]: r["component_id"] for r in got} == want


def test_collisions_are_enough():
    miss = sum(math.comb(coordjoin.COORDINATES, k) * 0.85 ** k * 0.15 ** (coordjoin.COORDINATES - k) for k in range(coordjoin.MATCHES))
    assert miss < 1e-6


@pytest.mark.parametrize("fn", [coordjoin.near_duplicates, coordjoin.near_dedup])
def test_minhash_empty(spark, fn):
    assert fn(frame(spark, [])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (2000, 2001), (2001, 2000)]
    got = {r["v"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(301)}) == 1 and len({got[1000 + i] for i in range(50)}) == 1
    assert len(set(got.values())) == 3
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors():
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(24)) for i in range(300)]
    for i in range(120):  # near copies of three vectors, some at the border
        rows.append((1000 + i, rows[i % 3][1] + rng.standard_normal(24) * (0.1 + 0.15 * (i % 4))))
    rows += [(2000 + i, rows[4][1]) for i in range(5)] + [(2100, rows[4][1] * 3), (2101, rows[5][1][:12])]
    rows = [(i, [float(x) for x in np.float32(v)]) for i, v in rows]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 24), (3003, [float("nan")] * 24), (3004, [float("inf")] + [1.0] * 23),
             (3005, [None] + [1.0] * 23), (3006, [1e-30] * 24), (3007, [2e-30] * 24), (7, rows[7][1]), (None, rows[8][1])]
    return rows


def test_vectors(spark):
    rows = vectors()

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.float32(v).astype(float)
        v = v / np.abs(v).max()
        return v / np.sqrt(v @ v)
    units = [unit(v) for _, v in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if units[i] is not None and units[j] is not None
             and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.95]
    n = [0] * len(rows)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    comp = expected_components(rows, links)
    want = sorted(((r[0], k, c, r[0] == c) for r, k, c in zip(rows, n, comp)), key=key)
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, v string").repartition(3)
    got = sorted(map(tuple, rotcodes.near_vectors(df).collect()), key=key)
    assert got == want
    assert rotcodes.near_vectors(df.limit(0)).count() == 0


def test_vectors_blocks(spark, monkeypatch):
    """Keys cut into many blocks give the same links."""
    monkeypatch.setattr(rotcodes, "BLOCK", 16)
    df = spark.createDataFrame(vectors(), "vec_id long, embedding array<float>")
    monkeypatch.setattr(rotcodes, "CELL", 40)
    small = sorted(map(tuple, rotcodes.near_vectors(df).collect()), key=key)
    monkeypatch.undo()
    assert small == sorted(map(tuple, rotcodes.near_vectors(df).collect()), key=key)


def test_lines(spark):
    rows = sorted(corpus(), key=lambda r: (r[0] is None, r[0]))
    lines = [(d, k, set(words(line))) for d, (_, text, _) in enumerate(rows) if text is not None for k, line in enumerate(text.split("\n"))]
    similar = lambda a, b: bool(a and b) and 5 * len(a & b) >= 4 * len(a | b)
    distinct = {frozenset(s) for _, _, s in lines if s}
    links = {s: sum(t != s and similar(s, t) for t in distinct) for s in distinct}
    removed, n_links = {}, {}
    for x, (d, k, s) in enumerate(lines):
        n_links[d] = n_links.get(d, 0) + links.get(frozenset(s), 0)
        if any(similar(s, t) for _, _, t in lines[:x]):
            removed.setdefault(d, []).append(k)
    repeated = {i for i in [r[0] for r in rows] if [r[0] for r in rows].count(i) > 1}
    want = sorted(((r[0], len(r[1].split("\n")) if r[1] is not None else 0, removed.get(d, []), n_links.get(d, 0))
                   for d, r in enumerate(rows) if r[0] not in repeated), key=key)
    got = linejoin.line_matches(frame(spark)).select("id", "n_lines", "removed", "n_links").collect()
    assert sorted((tuple(r) for r in got if r["id"] not in repeated), key=key) == want
    assert len(got) == len(rows) and any(w[2] for w in want)
    clean = linejoin.dedup_lines(frame(spark))
    assert clean.columns == frame(spark).columns
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    for d, (i, text, _) in enumerate(rows):
        if i not in repeated:
            gone = removed.get(d, [])
            assert texts[i] == (None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone))
    assert linejoin.line_matches(frame(spark, [])).count() == 0


def planted_pairs():
    """Pairs of texts of 104 words; one of each has its last words changed, so that similarities are 90 / 110 = 0.82,
    89 / 111 = 0.801 and 88 / 112 = 0.786; 40 of each."""
    rng = random.Random(8)
    rows = []
    for i, changed in enumerate([10, 11, 12] * 40):
        w = [f"{i}x{rng.random()}" for _ in range(104)]
        rows += [(2 * i, " ".join(w), "s"), (2 * i + 1, " ".join(w[:-changed] + [f"n{rng.random()}" for _ in range(changed)]), "s")]
    return rows


def test_pipeline_takes_pairs_from_0_8(spark):
    import corpus_pipeline

    rows = planted_pairs()
    sets = shingle_sets(rows)
    alike = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, len(rows), 2)]
    assert {0.8 <= s < 0.85 for s in alike} == {True, False}
    want = {i for i, *_ in rows if i % 2 == 0 or alike[i // 2] < 0.8}
    docs = frame(spark, rows, extra=False)
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()} == want
    assert coordjoin.near_dedup(docs).count() == len(rows)  # op10 keeps 0.85


def test_pipeline_collisions_are_enough():
    import corpus_pipeline

    t, (num, den), m = corpus_pipeline.NEAR["t"], corpus_pipeline.NEAR["similar"], coordjoin.COORDINATES
    s = num / den
    assert sum(math.comb(m, k) * s ** k * (1 - s) ** (m - k) for k in range(t)) < 1e-6


def test_minhash_large_group_few_pairs(spark, monkeypatch):
    """Copies of one text with up to four words changed, most of them similar to the text but not to
    one another: a few comparisons a copy, and all links held."""
    rng = random.Random(12)
    w = [f"w{i}" for i in range(150)]
    rows = [(5000, " ".join(w), "s")]
    for i in range(240):
        own = list(w)
        for at in rng.sample(range(150), 1 + i % 4):
            own[at] = f"n{i}x{at}"
        rows.append((i, " ".join(own), "s"))
    made, confirm = [], coordjoin.CoordinateJoin._confirm
    monkeypatch.setattr(coordjoin.CoordinateJoin, "_confirm",
                        lambda self, pairs, *rest: (made.append(pairs.count()), confirm(self, pairs, *rest))[1])
    got = {r["doc_id"]: r["component_id"] for r in coordjoin.near_duplicates(frame(spark, rows, extra=False)).collect()}
    sets = shingle_sets(rows)
    links = [(i, j) for i in range(len(rows)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    assert got == dict(zip([r[0] for r in rows], expected_components(rows, links)))
    assert sum(made) <= 12 * len(rows), made


def test_line_pairs_apart_go_before_their_words_move(spark, monkeypatch):
    """Lines of a small vocabulary share words that they are posted by, but few are similar: the others
    leave no candidates."""
    rng = random.Random(13)
    names = [f"name{i}" for i in range(60)]
    near = rng.sample(names, 12)
    rows = [(i, " ".join(rng.sample(names, 12)), "s") for i in range(80)] + [(100 + i, " ".join([*near, f"x{i}"]), "s") for i in range(3)]
    sizes, written = {}, linejoin.written

    def counted(df, name):
        out = written(df, name)
        sizes[name] = out.count()
        return out
    monkeypatch.setattr(linejoin, "written", counted)
    got = {r["id"]: (r["removed"], r["n_links"]) for r in linejoin.line_matches(frame(spark, rows, extra=False)).collect()}
    assert got == {**{i: ([], 0) for i in range(80)}, 100: ([], 2), 101: ([0], 2), 102: ([0], 2)}
    assert sizes["candidates"] <= 6, sizes


@pytest.mark.parametrize("block", [None, 40])
def test_line_groups_make_no_row_for_each_pair(spark, monkeypatch, block):
    """Lines of two texts with a few words changed, many similar to one another: links and removed lines are those
    of all pairs, but no table grows with the pairs; also with lists cut into blocks."""
    rng = random.Random(21)
    rows = []
    for base in ("p", "q"):
        w = [f"{base}{i}" for i in range(40)]
        for i in range(150):
            own = list(w)
            for at in rng.sample(range(40), rng.randint(0, 6)):
                own[at] = f"{base}n{rng.randint(0, 400)}"
            rows.append((len(rows), " ".join(own), "s"))
    rows += [(1000 + i, " ".join(f"r{x}" for x in rng.sample(range(50), 9)), "s") for i in range(100)]
    rng.shuffle(rows)
    if block:
        monkeypatch.setattr(linejoin, "BLOCK_ROWS", block)
    docs, made = frame(spark, rows, extra=False), []
    kind, count = type(docs), type(docs).checkpoint

    def counted(self, *args):
        out = count(self, *args)
        made.append(out.count())
        return out
    written = linejoin.written
    monkeypatch.setattr(kind, "checkpoint", counted)
    monkeypatch.setattr(linejoin, "written", lambda df, name: (x := written(df, name), made.append(x.count()))[0])
    got = {r["id"]: (r["removed"], r["n_links"]) for r in linejoin.line_matches(docs).collect()}
    sets = {i: frozenset(words(text)) for i, text, _ in rows}
    similar = {i: [j for j, t in sets.items() if 5 * len(s & t) >= 4 * len(s | t)] for i, s in sets.items()}
    assert got == {i: ([0] if min(similar[i]) < i else [], len({sets[j] for j in similar[i]} - {s})) for i, s in sets.items()}
    pairs = sum(n for _, n in got.values()) / 2
    assert pairs > 4000 and max(made) < pairs / 2, (pairs, made)
