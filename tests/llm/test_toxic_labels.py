"""op8: all training labels count, however small the classifier's sample, and a word is one entry."""

import random

import numpy as np
from fixtures import frame, sentence

from mercato.llm import toxicity


def test_words_rare_in_the_sample(spark, monkeypatch):
    rng = random.Random(41)
    bad = [f"{a}{b}{c}vilenesses" for a in "bdfg" for b in "uw" for c in "qzj"]  # no two begin alike
    toxic = lambda i: i % 4 == 0
    rows = [(i, sentence(rng, 12) + (f" {bad[i // 4 % len(bad)]}" if toxic(i) else ""), "s") for i in range(800)]
    labels = spark.createDataFrame([(i, int(toxic(i))) for i, *_ in rows], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE", 160)  # a word is in one or two toxic texts of it
    model = toxicity.ToxicityModel(frame(spark, rows, extra=False), labels)
    slots = np.bincount(model.lexicon.rank)
    assert len(slots) > 18 and set(slots.tolist()) == {6}  # a word and its five beginnings are one
    got = {r["id"]: r["score"] >= 0.5 for r in model.scores().collect()}
    assert not any(got[i] for i in got if not toxic(i))
    assert sum(got[i] for i in got if toxic(i)) > 0.75 * 200
