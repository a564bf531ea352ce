"""A small corpus with the awkward cases: nulls, empty and very long texts, ties, repeated
rows, and extra columns whose names clash with the operators' own."""

import random
import re

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
CLASH = ["size", "v", "link", "uid", "u", "id", "shard", "copies", "n", "key", "_source", "rate"]


def sentence(rng, n):
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "ré", "tu", "Sen", "or", "x9"]) for _ in range(rng.randint(2, 4)))
                    for _ in range(n))


def corpus():
    rng = random.Random(7)
    rows, base = [], [sentence(rng, 120) for _ in range(12)]
    for i, text in enumerate(base):
        rows.append((i, text, f"s{i % 3}"))
    for i in range(30):  # near copies: a few words changed
        words = base[i % 5].split(" ")
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = sentence(rng, 1)
        rows.append((100 + i, " ".join(words), "s0"))
    for i in range(10):  # exact copies
        rows.append((200 + i, base[7], None if i % 2 else "s9"))
    lines = [sentence(rng, 9) for _ in range(6)]
    for i in range(8):
        own = [rng.choice(lines) if rng.random() < 0.6 else sentence(rng, 8) for _ in range(6)]
        own[0] = own[0].upper()
        rows.append((300 + i, "\n".join([*own, "", "  "]), "s1"))
    rows += [(400, None, "s1"), (401, "", "s1"), (402, " \n\t ", None), (403, "one", "é"), (404, "one", "é"),
             (405, "Two words", "zz"), (406, "two WORDS", "zz"), (407, "a b c d", "zz"), (408, "word " * 7, "s2"),
             (409, sentence(rng, 30_000), "s2"), (None, base[3], "s2"), (None, "no id here at all", "s2"),
             (5, base[5], "s2"), (5, base[5], "s2"), (6, "another text of a repeated id", "s1"),
             (410, "mail me at some.one@example.org or 10.20.30.40 or +49 170 1234567 now", "s1"), (411, "naïve café 日本語 𝒳𝒴 ok", "s1")]
    return rows


def frame(spark, rows=None, extra=True):
    rows = corpus() if rows is None else rows
    schema = "doc_id long, text string, source string" + "".join(f", {c} string" for c in CLASH if extra)
    return spark.createDataFrame([(*r, *["clash"] * len(CLASH)) if extra else r for r in rows], schema).repartition(4)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def key(row):
    return tuple((x is None, str(x)) for x in row)
