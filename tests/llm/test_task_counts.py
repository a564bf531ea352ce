"""Tasks that the pipeline's iterative steps need when each shuffle has a fixed number of partitions:
small tables are not read or shuffled in as many tasks as there are partitions, again and again."""

import random

import pytest

from mercato.llm import components, coordjoin, shards

from .fixtures import corpus, frame, sentence

PARTS = 24


def tasks(spark, name, step):
    """Tasks of all jobs of ``step``."""
    sc, before = spark.sparkContext, {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(PARTS))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sc.setJobGroup(name, name)
    try:
        step()
        jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(name)]
        stages = [sc.statusTracker().getStageInfo(s) for j in jobs if j for s in j.stageIds]
        return sum(s.numCompletedTasks for s in stages if s)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def copies():
    rng = random.Random(5)
    texts = [sentence(rng, 30) for _ in range(150)]
    return [(i, texts[i % 150] if i % 4 else sentence(rng, 30), "s") for i in range(600)]


@pytest.mark.parametrize("name, step, most", [
    ("near", lambda docs: coordjoin.near_dedup(docs, repeat_ids=True, similar=(4, 5), t=13), 60),
    ("shards", shards.shard_documents, 100)])
def test_tasks_stay_few(spark, name, step, most):
    docs = frame(spark, [r for r in corpus() if r[0] is None or r[0] < 409] if name == "near" else copies(), extra=False)
    n = tasks(spark, f"tasks-{name}", lambda: step(docs).count())
    print("TASKS", name, n)
    assert 0 < n <= most * PARTS


@pytest.mark.parametrize("few", [0, 7, components.FEW])
def test_components_by_joins_and_in_one_task(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW", few)
    rng = random.Random(9)
    order = rng.sample(range(1000, 1040), 40)
    edges = [*zip(order, order[1:]), *((5, x) for x in range(6, 30)), (31, 32), (32, 31), (33, 33), (None, 40), (-3, -2), (-2, 2**62)]
    want = [set(order), {5, *range(6, 30)}, {31, 32}, {-3, -2, 2**62}]
    made, written = [], components.written
    monkeypatch.setattr(components, "written", lambda df, name: made.append(name) or written(df, name))
    got = {r["v"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got) == set().union(*want)
    for group in want:
        assert {got[v] for v in group} <= group and len({got[v] for v in group}) == 1
    assert len(made) <= 2 or few < len(edges)
