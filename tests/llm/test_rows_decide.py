"""The pipeline's filters decide by row: null and repeated ids, whole rows compared."""

import random

from fixtures import frame, key, sentence

from mercato.llm import coordjoin, toxicity, winnow


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=key)


def check(spark, stage, stay, go):
    df = frame(spark, stay + go)
    assert rows_of(stage(df)) == rows_of(frame(spark, stay))


def test_toxic_rows(spark):
    rng = random.Random(21)
    text = lambda bad=False: sentence(rng, 30) + (" vile slur" if bad else "")
    stay = [(i, text(), "s") for i in range(300)] + [(None, text(), "null id"), (None, None, "no text"), (7, text(), "id again"), (1000, text(), "toxic id")]
    go = [(i, text(True), "s") for i in range(1000, 1100)] + [(None, text(True), "null id"), (None, text(True), "null id"), (7, text(True), "clean id")]
    labels = spark.createDataFrame([(i, 0) for i in range(300) if i != 7] + [(i, 1) for i in range(1001, 1100)], "doc_id long, toxic int")
    check(spark, lambda df: toxicity.keep_clean(df, labels), stay, go)


def test_contaminated_rows(spark):
    rng = random.Random(22)
    item = sentence(rng, 12)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    text = lambda bad=False: sentence(rng, 20) + (" " + item if bad else "")
    stay = [(1, text(), "id again"), (None, text(), "null id"), (None, None, "no text"), (2, "", "empty"), (3, text(), "s")]
    go = [(1, text(True), "s"), (None, text(True), "null id"), (4, text(True), "s"), (4, text(True), "id again")]
    check(spark, lambda df: winnow.decontaminate(df, items), stay, go)


def test_near_rows(spark):
    rng = random.Random(23)
    a, b, c, d, e, f = (sentence(rng, 60) for _ in range(6))
    stay = [(1, a, "least id"), (2, b, "id of a near copy"), (3, c, "s"), (3, d, "id again"), (None, e, "null ids"),
            (9, f, "id before null"), (None, "own text", "null id"), (None, None, "no text"), (None, None, "no text"), (5, " \n", "no words"), (5, "", "no words")]
    go = [(2, a + " more", "near copy"), (None, e, "null ids"), (None, e, "null ids"), (None, f + " more", "near copy"), (4, c, "copy"), (3, c, "s")]
    check(spark, lambda df: coordjoin.near_dedup(df, repeat_ids=True), stay, go)
