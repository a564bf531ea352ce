"""Toxicity: weak supervision of a linear classifier.

1. Lexicon.  On all labelled training rows, words and word beginnings are
   counted by class (each task adds up its own texts); those far more frequent in toxic
   texts become lexicon entries.  Those in exactly the same labelled texts (a word and its own
   beginnings) are one entry; entries that mostly occur in the same texts
   (words with one beginning) share a voter.  Pattern voters (shouting, exclamation marks, stretched
   letters, starred words, unusual symbols) need no labels.
2. Label model.  Every voter votes or abstains on every document (one votes where no entry
   occurs, two where several do), and distinct vote vectors are counted.  A generative model
   with a class prior and, per voter, its rate of votes in either class (its accuracy) is
   fitted by expectation maximisation over the
   vote vectors of the whole corpus; a row's own training label takes part as one more voter.
   Within each class the model then estimates the voters' pairwise correlations, and
   votes that repeat each other are discounted before the next fit, so that a group of
   correlated voters counts about once.
3. Classifier.  The posteriors of the sampled training rows are the targets of a logistic
   regression on lexicon, pattern and hit-count features; it scores whole texts.

The sample is at most ``SAMPLE`` labelled rows of the training folds, those with the least
hash of their id; only the logistic regression is fitted on it.  All else covers all rows:
word counts, overlaps and starting rates all labelled ones, voting, the label model and scoring
all texts.  What comes to the driver has a fixed bound: a lexicon of ``LEXICON`` entries of at
most ``ALIKE`` hashes, sums per entry, voter and pair of these, and the sample's rows of at
most LEXICON + 20 numbers.

Defined results: null and empty texts have no votes and get the score of a text without
features; labels that are null or for unknown ids are ignored; of conflicting labels of one
id the larger counts; a corpus whose own rows have no usable labels of both classes scores all rows 0.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from .tables import lookup
from .words import LETTERS, Words, find_words, mix, pieces, signed, text_bytes

SAMPLE = 20_000
LEXICON = 400
#: Hashes that one entry has at most: a word, its beginnings and others in the same texts.
ALIKE = 16
#: Lengths in bytes of the word beginnings that are counted beside whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
#: A lexicon entry is in at least so many labelled toxic texts, and so many times as
#: frequent in toxic texts as in others.
SUPPORT, LIFT = 5, 18.0
VOTERS = 52
#: Entries share a voter if so large a part of the rarer one's texts has the other.
OVERLAP = 0.6
PATTERNS = ("shouting", "exclaiming", "stretched", "starred", "symbols")
#: Voters on the number of distinct lexicon entries in a text: none, at least 3, at least 6.
COUNTS = (0, 3, 6)
#: Lexicon hits (distinct entries) that get a feature of their own: at least 1, 2, 3, 5, 8.
HITS = (1, 2, 3, 5, 8)
FOLDS = 5
ROUNDS = 12
#: Sums that a task sends in one row.
SLICE = 1024


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo the folds; 0 is held out."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS))


def _entries(found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and word beginnings, and the text each is in.  A beginning is
    mixed with its length, so it is never equal to a whole word."""
    hashes, docs = [found.hashes()], [found.doc]
    for n in BEGINNINGS:
        which, h = found.prefix_hashes(n)
        hashes.append(mix(h ^ np.uint64(n)))
        docs.append(found.doc[which])
    return np.concatenate(hashes), np.concatenate(docs)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, toxic texts, other texts, mark) of the task's texts (text, toxic, uid); the mark
    is an exclusive or over hashes of the texts, equal where the texts are."""
    for batch in batches:
        toxic = np.asarray(batch.column(1).to_pylist(), np.int64)
        text = mix(batch.column(2).to_numpy().view(np.uint64))
        for at, texts in pieces(batch.column(0)):
            h, doc = _entries(find_words(texts, LETTERS))
            pairs = np.unique(np.stack([h, doc.astype(np.uint64)], 1), axis=0)
            entry, first, place = np.unique(pairs[:, 0], return_index=True, return_inverse=True)
            mark = (np.bitwise_xor.reduceat(text[at + pairs[:, 1].astype(np.int64)], first) if len(entry) else entry)
            n1 = np.bincount(place, weights=toxic[at + pairs[:, 1].astype(np.int64)], minlength=len(entry)).astype(np.int64)
            n = np.bincount(place, minlength=len(entry)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed(entry)), pa.array(n1), pa.array(n - n1), pa.array(signed(mark))],
                                             ["entry", "n1", "n0", "mark"])


def _patterns(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """0/1 per text and pattern voter, from the unlowered bytes."""
    def per_text(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(marks)))
        return sums[at[1:]] - sums[at[:-1]]
    upper, lower = (raw >= 0x41) & (raw <= 0x5A), (raw >= 0x61) & (raw <= 0x7A)
    same = np.zeros(len(raw), bool)
    if len(raw) > 3:
        same[3:] = (raw[3:] == raw[2:-1]) & (raw[2:-1] == raw[1:-2]) & (raw[1:-2] == raw[:-3]) & (upper | lower)[3:]
    starred = np.zeros(len(raw), bool)
    if len(raw) > 1:
        starred[1:] = (raw[1:] == 0x2A) & (upper | lower)[:-1]
    odd = np.isin(raw, np.frombuffer(b"#$%&@^~|<>", np.uint8))
    n = np.maximum(1, np.diff(at))
    letters = np.maximum(1, per_text(upper | lower))
    return np.stack([per_text(upper) * 10 > letters * 3, per_text(raw == 0x21) * 200 > n,
                     per_text(same) > 0, per_text(starred) > 0, per_text(odd) * 50 > n], 1).astype(np.uint8)


@dataclass(frozen=True)
class Lexicon:
    """Hashes of the entries, sorted, and their feature numbers (0 is the strongest entry)."""

    entries: np.ndarray
    rank: np.ndarray


def _votes(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[pa.RecordBatch]:
    """Per text: its distinct lexicon entries and patterns, as feature numbers."""
    uid = TaskContext.get().partitionId() << 40
    n = len(lexicon.entries)
    for batch in batches:
        for at, texts in pieces(batch.column(1)):
            found = find_words(texts, LETTERS)
            h, doc = _entries(found)
            if n:
                place = np.minimum(np.searchsorted(lexicon.entries, h), n - 1)
                hit = lexicon.entries[place] == h
                pairs = np.unique(doc[hit] * LEXICON + lexicon.rank[place[hit]])
            else:
                pairs = np.empty(0, np.int64)
            raw_doc, feature = pairs // LEXICON, pairs % LEXICON
            unlowered, bounds = text_bytes(texts)
            row, col = np.nonzero(_patterns(unlowered, bounds))
            raw_doc, feature = np.concatenate([raw_doc, row]), np.concatenate([feature, col + LEXICON])
            order = np.lexsort((feature, raw_doc))
            offsets = np.searchsorted(raw_doc[order], np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(uid, uid + len(texts)), pa.int64()), batch.column(0).slice(at, len(texts)),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(feature[order], pa.int32()))],
                ["uid", "id", "features"])
            uid += len(texts)


def _bits(votes: np.ndarray) -> np.ndarray:
    """Vote vectors as 0/1 columns; the last two columns are a label's votes."""
    return ((votes[:, None] >> np.arange(VOTERS + len(PATTERNS) + len(COUNTS) + 2)) & 1).astype(float)


def _expect(batches: Iterator[pa.RecordBatch], logs: np.ndarray, prior: float, pairs: bool) -> Iterator[pa.RecordBatch]:
    """Expected counts of the task's vote vectors (votes, count): class sums, votes per voter
    and class and, with ``pairs``, joint votes of voter pairs; a row per slice of SLICE sums."""
    width = len(logs)
    out = np.zeros(2 + 2 * width + (2 * width * width if pairs else 0))
    for batch in batches:
        v, count = _bits(batch.column(0).to_numpy()), batch.column(1).to_numpy().astype(float)
        p = 1 / (1 + np.exp(-np.clip(prior + v @ logs, -30, 30)))
        for c, q in enumerate((p * count, (1 - p) * count)):
            out[c] += q.sum()
            out[2 + c * width: 2 + (c + 1) * width] += q @ v
            if pairs:
                at = 2 + 2 * width + c * width * width
                out[at: at + width * width] += ((v * q[:, None]).T @ v).ravel()
    yield _sliced(out)


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the task (features) that have both of two entries, for all pairs, in slices."""
    both = np.zeros((LEXICON, LEXICON))
    for batch in batches:
        lists = batch.column(0)
        at, values = lists.offsets.to_numpy(), lists.flatten().to_numpy()
        row = np.repeat(np.arange(len(lists)), np.diff(at))
        x = np.zeros((len(lists), LEXICON), np.float32)
        x[row[values < LEXICON], values[values < LEXICON]] = 1
        both += x.T @ x
    yield _sliced(both.ravel())


def _sliced(sums: np.ndarray) -> pa.RecordBatch:
    at = range(0, len(sums), SLICE)
    return pa.RecordBatch.from_arrays([pa.array([i // SLICE for i in at], pa.int32()),
                                       pa.array([sums[i: i + SLICE] for i in at], pa.list_(pa.float64()))], ["slice", "sums"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of all tasks, added up by their number (a task holds as many as there are numbers)."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        lists = batch.column(1)
        for number, sums in zip(batch.column(0).to_pylist(), lists):
            part = sums.values.to_numpy()
            total[number] = total[number] + part if number in total else part
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.list_(pa.float64()))],
                                         ["slice", "sums"])


def _gathered(parts: DataFrame, width: int) -> np.ndarray:
    """All tasks' slices added up, on the driver: ``width`` numbers."""
    sums = np.zeros(width)
    for r in parts.repartition("slice").mapInArrow(_add, "slice int, sums array<double>").collect():
        sums[r["slice"] * SLICE: (r["slice"] + 1) * SLICE] = r["sums"]
    return sums


class LabelModel:
    """Naive Bayes over votes with discounts for correlated voters, fitted by EM.

    Start: toxic prior and vote rates from all labelled rows.  ``rates[j]`` are a
    voter's vote probabilities in toxic and other texts; an abstention says nothing (voters
    of one language abstain on all others).
    """

    def __init__(self, prior: float, rates: np.ndarray):
        self.prior, self.rates = prior, rates
        self.weights = np.ones(len(rates))

    def logs(self) -> np.ndarray:
        r = np.clip(self.rates, 1e-5, 1 - 1e-5)
        return np.log(r[:, 0] / r[:, 1]) * self.weights

    def log_prior(self) -> float:
        return float(np.log(self.prior / (1 - self.prior)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_prior() + _bits(votes) @ self.logs(), -30, 30)))

    def fit(self, counted: DataFrame, rounds: int = ROUNDS) -> LabelModel:
        """counted: (votes, count).  Correlations are estimated at the half and the end."""
        width = len(self.rates)
        anchor = self.rates.copy()  # of the labelled rows: counts as much as the corpus does
        for turn in range(rounds):
            pairs = turn in (rounds // 2, rounds - 1)
            step = functools.partial(_expect, logs=self.logs(), prior=self.log_prior(), pairs=pairs)
            sums = _gathered(counted.mapInArrow(step, "slice int, sums array<double>"),
                             2 + 2 * width + (2 * width * width if pairs else 0))  # the driver's bound: voters^2
            both = np.maximum(sums[:2], 1e-9)
            votes = sums[2: 2 + 2 * width].reshape(2, width)
            rates = (votes / both[:, None] + anchor.T) / 2
            moved = np.abs(rates.T - self.rates).max()
            label = self.rates[-2:].copy()
            self.rates, self.prior = rates.T, float(np.clip(both[0] / both.sum(), 1e-3, 0.5))
            self.rates[-2:] = label  # how far labels are trusted is a parameter
            if pairs:
                joint = sums[2 + 2 * width:].reshape(2, width, width)
                total = np.zeros((width, width))
                for c in range(2):
                    mean = votes[c] / both[c]
                    cover = joint[c] / both[c] - np.outer(mean, mean)
                    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
                    total += np.clip(cover / np.outer(spread, spread), 0, 1) * (both[c] / both.sum())
                self.correlation = total
                np.fill_diagonal(total, 0)
                total[total < 0.1] = 0
                self.weights = 1 / (1 + total.sum(1))
                self.weights[-2:] = 1
            elif turn > rounds // 2 and moved < 1e-4:
                break
        return self


@dataclass(frozen=True)
class Classifier:
    """Logistic regression over lexicon entries, patterns and numbers of hits."""

    weights: np.ndarray
    bias: float

    @staticmethod
    def table(features: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(features), LEXICON + len(PATTERNS) + len(HITS)), np.float32)
        for i, f in enumerate(features):
            x[i, f] = 1
        hits = x[:, :LEXICON].sum(1)
        for j, least in enumerate(HITS):
            x[:, LEXICON + len(PATTERNS) + j] = hits >= least
        return x

    @classmethod
    def train(cls, features: list[np.ndarray], target: np.ndarray, decay: float = 1.0, steps: int = 300) -> Classifier:
        """Newton-like descent of the cross entropy against soft targets (deterministic)."""
        x = cls.table(features)
        w, b = np.zeros(x.shape[1]), 0.0
        bound = 0.25 * np.maximum(1, np.square(x).sum(1)).mean() * 2  # of the curvature
        velocity, last_w, last_b = 1.0, w, b
        for _ in range(steps):  # accelerated gradient
            p = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))
            gap = (p - target) / len(target)
            new_w, new_b = w - (x.T @ gap + decay / len(target) * w) / bound, b - gap.sum() / bound
            after = (1 + np.sqrt(1 + 4 * velocity ** 2)) / 2
            w, b = new_w + (velocity - 1) / after * (new_w - last_w), new_b + (velocity - 1) / after * (new_b - last_b)
            last_w, last_b, velocity = new_w, new_b, after
        return cls(last_w, float(last_b))


def _score(batches: Iterator[pa.RecordBatch], model: Classifier) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(2)
        values, at = lists.flatten().to_numpy(), lists.offsets.to_numpy()
        at = at - at[0]
        row = np.repeat(np.arange(len(lists)), np.diff(at))
        z = model.bias + np.bincount(row, weights=model.weights[values], minlength=len(lists))
        hits = np.bincount(row, weights=values < LEXICON, minlength=len(lists))
        for j, least in enumerate(HITS):
            z += model.weights[LEXICON + len(PATTERNS) + j] * (hits >= least)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))],
                                         ["uid", "id", "score"])


def _toxic(texts: pa.Array, lexicon: Lexicon, model: Classifier) -> pa.Array:
    """Whether each text is predicted toxic, in order."""
    rows = pa.RecordBatch.from_arrays([pa.nulls(len(texts), pa.int64()), texts], ["id", "text"])
    scores = [b.column(2).to_numpy() for b in _score(_votes(iter([rows]), lexicon), model)]
    return pa.array(np.concatenate([np.empty(0), *scores]) >= 0.5)


class ToxicityModel:
    """A run over a corpus: lexicon, label model, classifier; ``scores()`` has every row."""

    #: How often a training label and the truth agree.
    TRUST = 0.95

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_id: str = "doc_id", label_col: str = "toxic"):
        spark = docs.sparkSession
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        given = (labels.select(F.col(label_id).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic"))
                 .where((fold("id") != 0) & F.col("toxic").isin(0, 1)).groupBy("id").agg(F.max("toxic").alias("toxic")))
        given = given.checkpoint()
        sample = given.select("id").orderBy(F.xxhash64("id"), "id").limit(SAMPLE)  # the stated bound
        self.labels = lookup(given.join(F.broadcast(sample.withColumn("sampled", F.lit(True))), "id", "left").checkpoint())
        n = {r["toxic"]: r["count"] for r in given.groupBy("toxic").count().collect()}
        self.usable = bool(n.get(0)) and bool(n.get(1))
        self.lexicon = self._lexicon(texts, n) if self.usable else Lexicon(np.empty(0, np.uint64), np.empty(0, np.int64))
        self.rows = texts.mapInArrow(functools.partial(_votes, lexicon=self.lexicon),
                                     "uid long, id long, features array<int>").checkpoint()
        self.classifier = self._fit() if self.usable else None

    def _lexicon(self, texts: DataFrame, n: dict) -> Lexicon:
        rows = (texts.withColumn("uid", F.monotonically_increasing_id()).join(self.labels, "id")
                .select("text", "toxic", "uid"))
        counts = (rows.mapInArrow(_count, "entry long, n1 long, n0 long, mark long").groupBy("entry")
                  .agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"), F.bit_xor("mark").alias("mark")).where(F.col("n1") >= SUPPORT))
        lift = (F.col("n1") / n[1]) / ((F.col("n0") + 0.5) / n[0])
        alike = F.slice(F.array_sort(F.collect_list("entry")), 1, ALIKE).alias("entries")
        best = (counts.withColumn("lift", lift).where(F.col("lift") >= LIFT)
                .groupBy("n1", "n0", "mark", "lift").agg(alike)
                .orderBy(F.desc(F.col("n1") * F.log("lift")), "mark").limit(LEXICON).collect())
        entries = np.array([e for r in best for e in r["entries"]], np.int64).view(np.uint64)
        rank = np.array([i for i, r in enumerate(best) for _ in r["entries"]], np.int64)
        order = np.argsort(entries)
        return Lexicon(entries[order], rank[order])

    def _votes(self) -> DataFrame:
        """(uid, votes): voters and patterns as bits; then two bits of a row's training label."""
        numbers = F.array(*(F.lit(int(v)) for v in self.voter))
        votes = F.aggregate(F.filter(F.transform("features", lambda f: F.element_at(numbers, f + 1)), lambda v: v >= 0),
                            F.lit(0).cast("long"), lambda s, v: s.bitwiseOR(_power(v)))
        hits = F.size(F.filter("features", lambda f: f < LEXICON))
        for place, least in enumerate(COUNTS):
            when = hits == 0 if least == 0 else hits >= least
            votes = votes.bitwiseOR(F.when(when, F.lit(1 << (VOTERS + len(PATTERNS) + place))).otherwise(F.lit(0)))
        first = VOTERS + len(PATTERNS) + len(COUNTS)
        label = F.when(F.col("toxic") == 1, 1 << first).when(F.col("toxic") == 0, 1 << (first + 1)).otherwise(0)
        return (self.rows.withColumn("votes", votes).join(self.labels, "id", "left")
                .select("uid", "features", "toxic", "sampled", F.col("votes").bitwiseOR(label).alias("votes")))

    def _voters(self, both: np.ndarray) -> np.ndarray:
        """The voter of each feature (-1: none), from the number of labelled texts that have both
        of two entries: an entry joins the strongest voter whose first entry it overlaps with,
        or opens the next voter."""
        alone = both.diagonal()
        heads: list[int] = []
        voter = np.full(LEXICON + len(PATTERNS), -1)
        for e in np.flatnonzero(alone).tolist():
            near = [j for j, h in enumerate(heads) if both[e, h] >= OVERLAP * min(alone[e], alone[h])]
            if near or len(heads) < VOTERS:
                voter[e] = near[0] if near else len(heads)
            if not near and len(heads) < VOTERS:
                heads.append(e)
        voter[LEXICON:] = VOTERS + np.arange(len(PATTERNS))
        return voter

    def _fit(self) -> Classifier | None:
        marked = self.rows.join(self.labels.select("id"), "id").select("features")
        both = _gathered(marked.mapInArrow(_overlaps, "slice int, sums array<double>"), LEXICON * LEXICON)
        self.voter = self._voters(both.reshape(LEXICON, LEXICON))
        votes = self._votes().checkpoint()
        labelled = votes.where("toxic IS NOT NULL")
        width = VOTERS + len(PATTERNS) + len(COUNTS) + 2
        sums = {r["toxic"]: r for r in labelled.groupBy("toxic").agg(
            F.count(F.lit(1)).alias("n"), *(F.count_if(F.col("votes").bitwiseAND(F.lit(1 << j)) != 0).alias(f"b{j}") for j in range(width))).collect()}
        if len(sums) < 2:
            return None
        rates = np.array([[(sums[c][f"b{j}"] + 0.5) / (sums[c]["n"] + 1) for c in (1, 0)] for j in range(width)])
        rates[-2], rates[-1] = (self.TRUST, 1 - self.TRUST), (1 - self.TRUST, self.TRUST)
        counted = votes.groupBy("votes").count().checkpoint()
        self.label_model = LabelModel(sums[1]["n"] / (sums[0]["n"] + sums[1]["n"]), rates).fit(counted)
        train = labelled.where("sampled").select("features", "votes").toPandas()  # the sample
        target = self.label_model.posterior(train["votes"].to_numpy(np.int64))
        return Classifier.train([np.asarray(f, np.int64) for f in train["features"]], target)

    def scores(self) -> DataFrame:
        """uid, id, score of every row."""
        if self.classifier is None:
            return self.rows.select("uid", "id", F.lit(0.0).alias("score"))
        return self.rows.mapInArrow(functools.partial(_score, model=self.classifier), "uid long, id long, score double")


def _power(exponent: Column) -> Column:
    """2 to the exponent, as a long."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), exponent.cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    scored = ToxicityModel(docs, labels, id_col, text_col).scores()
    return scored.select(F.col("id").alias("doc_id"), F.coalesce(fold("id") == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns; each row is
    scored by its own text, whatever its id."""
    model = ToxicityModel(docs, labels, id_col, text_col)
    if model.classifier is None:
        return docs
    lexicon, classifier = model.lexicon, model.classifier

    def toxic(texts: pa.Array) -> pa.Array:
        return _toxic(texts, lexicon, classifier)
    return docs.where(~F.arrow_udf(toxic, "boolean")(F.coalesce(F.col(text_col), F.lit(""))))
