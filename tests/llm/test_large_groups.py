"""op5: groups of a large part of all bytes are gathered in as few shards as hold them."""

import math
import random
from collections import Counter

import pytest
from fixtures import frame, sentence

from mercato.llm import shards


@pytest.mark.parametrize("part", [0.05, 1 / 3, 0.6])
def test_large_group(spark, part):
    rng = random.Random(31)
    other = [(i, sentence(rng, rng.randint(3, 20)), "s") for i in range(2400)]
    rest = sum(len(t.encode()) + 1 for _, t, _ in other)
    copy = "one large group of copies"
    n = round(rest * part / (1 - part) / (len(copy) + 1))
    got = shards.equal_text_shards(frame(spark, other + [(10_000 + i, copy, "s") for i in range(n)], extra=False)).collect()
    assert len(got) == len(other) + n
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    assert max(load.values()) - min(load.values()) <= 2 * max(r["size"] for r in got)
    where = Counter(r["shard"] for r in got if r["doc_id"] >= 10_000)
    fewest = math.ceil(8 * part)
    assert sum(k for _, k in where.most_common(fewest)) >= 0.97 * n, where
    if part < 0.1:
        assert len(where) == 1
