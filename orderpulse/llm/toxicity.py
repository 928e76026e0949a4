"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lower-cases, turns look-alike letters and digits into the letter they stand for, and
all else into spaces. Entries are word beginnings or whole words that labelled toxic texts
have, or have twice, far more often than clean ones; their weight is the log-odds. Phrases that hold an entry
and stand in clean texts are exceptions: the entry does not count there. The weights found,
by total and by text length, go through a logistic curve that is fitted to the labels.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderpulse.llm.common import may_train, saved, share, slices, texts

# Characters that stand for a letter. i, l and 1 can't be told apart.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a",
          "$": "s", "|": "i", "l": "i"}
CYRILLIC = {"а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j",
            "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y",
            "х": "x", "ӏ": "i"}
GREEK = {"α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v",
         "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w"}
#: Labelled texts that a model may learn from, by class: about so many, all if there are fewer.
SAMPLE = {0: 8000, 1: 2000}
#: Lengths of word beginnings that are tried as entries.
BEGINNINGS = range(4, 8)
#: Evidence in nats, share of toxic texts among those that hold an entry, and entries kept.
EVIDENCE, PURITY, ENTRIES = 16.0, 0.8, 5000
#: Clean texts that make a phrase an exception, and its highest share of toxic texts.
EXCEPTION_TEXTS, EXCEPTION_PURITY = 3, 0.2
#: Words in a row by which near copies are told in the training sample.
COPY_WORDS = 5
THRESHOLD = 0.3


class Folding(dict):
    """Table for str.translate: letters stay, stand-ins become letters, the rest is space."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        folded = DIGITS.get(char) or CYRILLIC.get(char) or GREEK.get(char)
        self[code] = folded or (char if char.isalnum() else " ")
        return self[code]


FOLDING = Folding()


def folded(text: str) -> str:
    """Words between single spaces, with a space at either end."""
    return f" {' '.join(text.lower().translate(FOLDING).split())} "


@dataclass
class Model:
    """What scoring needs; its size is bounded by ENTRIES."""
    entries: dict[str, float]
    exceptions: list[str]
    curve: tuple[float, float, float]


class Matcher:
    """Finds entries at word beginnings, other than those inside exception phrases."""

    def __init__(self, model: Model):
        self.curve = model.curve
        self.automaton = ahocorasick.Automaton()
        for phrase in model.exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        for entry, weight in model.entries.items():
            self.automaton.add_word(entry, (len(entry), weight))
        self.empty = not model.entries
        if not self.empty:
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, float]]:
        """(place, weight) of each word that an entry matches; the largest weight counts."""
        if self.empty:
            return []
        best: dict[int, float] = {}
        spared = []
        for end, (length, weight) in self.automaton.iter(text):
            if weight is None:
                spared.append((end + 1 - length, end))
            else:
                start = end + 1 - length
                best[start] = max(weight, best.get(start, 0.0))
        if spared:
            # Both in order of place: the exceptions that began so far reach up to one end.
            spared.sort()
            kept, nth, reach = {}, 0, -1
            for at in sorted(best):
                while nth < len(spared) and spared[nth][0] <= at:
                    reach = max(reach, spared[nth][1])
                    nth += 1
                if at >= reach:
                    kept[at] = best[at]
            best = kept
        return list(best.items())

    def weights(self, text: str) -> tuple[float, float]:
        """Total weight, and weight for a hundred words, both as logarithms."""
        whole = folded(text)
        total = sum(weight for _, weight in self.hits(whole))
        words = len(whole.split()) if total else 1
        return math.log1p(total), math.log1p(100 * total / max(1, words))

    def score(self, text: str) -> float:
        total, density = self.weights(text)
        a, b, c = self.curve
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * total + c * density))))


def features_of(text: str) -> Counter:
    """Word beginnings (a space before) and whole words (a space on either side) of a text,
    and how often it has them."""
    found = Counter()
    for word, times in Counter(folded(text).split()).items():
        found[f" {word} "] += times
        for length in BEGINNINGS:
            if len(word) >= length:
                found[" " + word[:length]] += times
    return found


COUNTED = "feature string, n long, k long, n2 long, k2 long"


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, n, k, n2, k2): texts and toxic texts that have it, and that have it twice,
    summed within the task."""
    both, toxic, both2, toxic2 = counters = Counter(), Counter(), Counter(), Counter()

    def rows():
        names = list(both)
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()),
             *(pa.array([counts[x] for x in names], pa.int64())
               for counts in (both, toxic, both2, toxic2))], ["feature", "n", "k", "n2", "k2"])

    for batch in slices(batches):
        for text, label in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
            found = features_of(text)
            twice = [x for x, times in found.items() if times > 1]
            both.update(found.keys())
            both2.update(twice)
            if label == 1:
                toxic.update(found.keys())
                toxic2.update(twice)
        if len(both) > 300_000:
            yield rows()
            for counts in counters:
                counts.clear()
    yield rows()


def _nats(n: Column, k: Column, rate: float) -> Column:
    """Evidence that texts with a feature, k toxic ones of n, are toxic more often than others;
    zero where fewer than PURITY of them are."""
    p = k / n
    return F.when((n > 0) & (p >= max(PURITY, rate)),
                  k * F.log(p / rate) + F.when(p < 1, (n - k) * F.log((1 - p) / (1 - rate)))
                  .otherwise(0.0)).otherwise(0.0)


def _count_phrases(model: Model):
    def run(batches):
        matcher, both, toxic = Matcher(model), Counter(), Counter()
        for batch in slices(batches):
            for text, label in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
                whole, found = folded(text), set()
                for at, _ in matcher.hits(whole):
                    after = whole[at:at + 200].split()[:2]
                    ahead = whole[max(0, at - 100):at].split()[-1:]
                    found.add(" " + " ".join(after) + " ")
                    if ahead and after:
                        found.add(f" {ahead[0]} {after[0]} ")
                both.update(found)
                if label == 1:
                    toxic.update(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(both), pa.string()), pa.array(list(both.values()), pa.int64()),
             pa.array([toxic[x] for x in both], pa.int64())], ["feature", "n", "k"])
    return run


def _weigh(model: Model):
    def run(batches):
        matcher = Matcher(model)
        for batch in slices(batches):
            pairs = [matcher.weights(t) for t in texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.float64()),
                 pa.array([p[1] for p in pairs], pa.float64()), batch.column(1)],
                ["total", "density", "toxic"])
    return run


def training_sample(docs: DataFrame, labels: DataFrame, sizes: dict[int, int] | None = None
                    ) -> DataFrame:
    """(text, toxic) of about SAMPLE labelled rows of either class that may be learnt from.

    Copies would make any word of theirs look telling, so texts with the same least hash of
    COPY_WORDS words in a row count once. Rows whose label is null or neither 0 nor 1 are left
    out, repeated ids take the larger label."""
    sizes = sizes or SAMPLE
    known = labels.filter(may_train(F.col("doc_id")) & F.col("toxic").isin(0, 1)).select(
        "doc_id", F.col("toxic").cast("int").alias("toxic"))
    there = {row.toxic: row.n for row in known.groupBy("toxic").agg(F.count("*").alias("n"))
             .collect()}
    rate = F.lit(0.0)
    for label, n in there.items():
        rate = F.when(F.col("toxic") == label, F.lit(min(1.0, sizes[label] / n))).otherwise(rate)
    chosen = known.filter(share(F.col("doc_id"), rate)).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    chosen = saved(chosen, "toxic-ids")
    # SAMPLE bounds the ids, so texts need not be shuffled to meet them; the size is checked.
    if chosen.count() <= 2 * sum(sizes.values()):
        chosen = F.broadcast(chosen)
    rows = docs.select("doc_id", "text").join(chosen, "doc_id")
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"\s+")
    split = rows.select(F.coalesce("text", F.lit("")).alias("text"), "toxic",
                        words.alias("words"))
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - COPY_WORDS + 1, F.lit(1))),
                       lambda i: F.xxhash64(F.concat_ws(" ", F.slice("words", i, COPY_WORDS))))
    return (split.groupBy(F.array_min(runs).alias("copy"), "toxic")
            .agg(F.min("text").alias("text")).select("text", "toxic"))


def fit_curve(rows: list[tuple[float, float, int]]) -> tuple[float, float, float]:
    """Logistic curve over (total, density) by Newton's method, with a small ridge."""
    if not rows:
        return -30.0, 0.0, 0.0
    data = np.array(rows, float)
    x, y = np.column_stack([np.ones(len(data)), data[:, :2]]), data[:, 2]
    curve, ridge = np.zeros(3), np.diag([1e-3, 1e-1, 1e-1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (y - p) - ridge @ curve)
        curve = curve + step
        if abs(step).max() < 1e-6:
            break
    return tuple(float(np.clip(c, -30, 30)) for c in curve)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn the lexicon, the exceptions and the curve from labelled rows, without held-out ones.

    The driver receives the entries and exceptions kept, and two numbers for each row of the
    sample, which SAMPLE bounds. Without labels nothing is toxic.
    """
    sample = saved(training_sample(docs, labels), "toxic-sample")
    by_label = {row.toxic: row.n for row in
                sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = by_label.get(1, 0), by_label.get(0, 0)
    model = Model({}, [], (-30.0, 0.0, 0.0))
    if not toxic:
        return model
    rate = (toxic + 0.5) / (toxic + clean + 1.0)
    counted = sample.mapInArrow(_count_features, COUNTED).groupBy("feature").agg(
        *(F.sum(c).alias(c) for c in ("n", "k", "n2", "k2")))
    weight = F.log((F.col("k") + 0.5) / (F.col("n") - F.col("k") + 0.5)
                   * F.lit((clean + 0.5) / (toxic + 0.5)))
    nats = F.greatest(_nats(F.col("n"), F.col("k"), rate), _nats(F.col("n2"), F.col("k2"), rate))
    kept = (counted.withColumn("nats", nats).withColumn("weight", weight)
            .filter((F.col("nats") >= EVIDENCE) & (F.col("weight") > 0))
            .orderBy(F.desc("nats"), F.length("feature"), "feature").limit(ENTRIES).collect())
    # Of beginnings of each other, the one with most evidence stays.
    begun = set()
    for row in kept:
        bare = row.feature.rstrip()
        parts = [bare[:n] for n in range(2, len(bare) + 1)]
        if bare not in begun and not any(part in model.entries for part in parts):
            model.entries[row.feature] = row.weight
            begun.update(parts)
    if model.entries:
        phrases = sample.mapInArrow(_count_phrases(model), "feature string, n long, k long")
        spared = (phrases.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
                  .filter((F.col("n") - F.col("k") >= EXCEPTION_TEXTS)
                          & (F.col("k") <= EXCEPTION_PURITY * F.col("n")))
                  .orderBy(F.desc("n"), "feature").limit(ENTRIES).collect())
        model.exceptions = [row.feature for row in spared if row.feature.strip()]
    weighed = sample.mapInArrow(_weigh(model), "total double, density double, toxic int")
    model.curve = fit_curve([(r.total, r.density, r.toxic) for r in weighed.collect()])
    return model


def score(text: Column, model: Model) -> Column:
    """Probability (0 to 1) that the whole text is toxic; null and empty texts have no hits."""

    @F.arrow_udf("double")
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(model)
        for column in arrays:
            yield pa.array([matcher.score(t) for t in texts(column)], pa.float64())

    return run(text)


def kept(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with all their columns; each row is judged by
    its own text, so null ids and repeated rows do no harm."""
    return docs.filter(score(F.col("text"), fit(docs, labels)) < threshold)
