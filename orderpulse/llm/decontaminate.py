"""Benchmark decontamination: rare n-gram seeds joined to test items, then Smith-Waterman.

Seeds. All n-grams of the test items are counted in the corpus. Of each item the cheapest set of
n-grams that do not overlap is chosen, one more than a quarter of its words, where the cost of an
n-gram is its count in the corpus times the items that have it. A changed, lost or added word
spoils one of them at most, so every copy with up to a quarter of the words edited keeps a seed,
however common the spoilt ones are. (A rarest n-gram per window has no such bound: those across
an edit are rarer than the intact ones beside them.) N-grams that no document has are chosen
first and cost nothing, as they are never looked for.

Join. Seeds are a table, and meet the n-grams of the documents in a Spark join. Tasks hold a bit
table of fixed size that keeps n-grams of no item, and later texts without a seed, from the
shuffle; it only saves work.

Alignment. The words around a seed are aligned with the whole item. The score, as a share of the
highest possible one, tells copies and edited copies from chance. The words around reach so far
that no alignment over the bound is cut off.

Items of fewer words than a seed are found where they are all words of a document. Null and empty
texts, of items and documents, hold nothing; the same item twice counts once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from orderpulse.llm.common import saved, slices, texts

WORDS = re.compile(r"\w+")
SEED_WORDS = 3
#: One word in so many may be edited in a copy that surely keeps a seed.
EDITED = 4
#: Words of an item among which seeds are chosen at once.
STRETCH = 64
#: Share of the highest alignment score from which a document counts as contaminated.
SIMILARITY = 0.5
MATCH, MISMATCH, GAP = 2, -1, 1
#: The bit table of n-grams has 2 ** BITS bits, whatever the size of the benchmark.
BITS = 25
#: Bits in one value of Spark's bitmap aggregate.
BITMAP = 1 << 15
#: Words whose hashes a task remembers.
REMEMBERED = 1 << 18
#: Cells of the alignment arrays that are held at once.
CELLS = 2_000_000


class Hashes(dict):
    """Hash of each word, remembered for a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word) if word else 0
        return value


def grams(texts_: list[list[str]], hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, hash) of all n-grams of several texts, given as words. A text of fewer words
    than a seed is one n-gram of its own."""
    words: list[str] = []
    for each in texts_:
        words += each
        if 0 < len(each) < SEED_WORDS:
            words += [""] * (SEED_WORDS - len(each))
    sizes = np.array([max(len(t), SEED_WORDS) if t else 0 for t in texts_], np.int64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    total = np.zeros(max(0, len(each) - SEED_WORDS + 1), np.uint64)
    for k in range(SEED_WORDS):
        total = total * np.uint64(0x9E3779B97F4A7C15) + each[k:len(total) + k]
        total ^= total >> np.uint64(29)
    text = np.repeat(np.arange(len(sizes)), sizes)[:len(total)]
    place = np.arange(len(total)) - np.repeat(np.cumsum(sizes) - sizes, sizes)[:len(total)]
    whole = place <= sizes[text] - SEED_WORDS
    return text[whole], place[whole], total[whole].view(np.int64)


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def bit_places(gram):
    """The two bits of an n-gram, for numpy arrays and for columns."""
    if isinstance(gram, Column):
        return [F.shiftrightunsigned(gram, k).bitwiseAND(F.lit((1 << BITS) - 1)) for k in (0, BITS)]
    return [(gram.view(np.uint64) >> np.uint64(k)) & np.uint64((1 << BITS) - 1) for k in (0, BITS)]


def bit_table(of: DataFrame) -> np.ndarray:
    """Bits of all ``gram`` of a table; at most 2 ** BITS bits come to the driver."""
    bits = of.select(F.explode(F.array(*bit_places(F.col("gram")))).alias("bit"))
    rows = bits.groupBy(F.floor(F.col("bit") / BITMAP).alias("part")).agg(
        F.bitmap_construct_agg((F.col("bit") % BITMAP)).alias("bits")).collect()
    table = np.zeros((1 << BITS) // 8, np.uint8)
    for row in rows:
        at = row["part"] * (BITMAP // 8)
        table[at:at + BITMAP // 8] = np.frombuffer(row["bits"], np.uint8)
    return table


def known(table: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """Places of the n-grams that may be in the table."""
    at = np.arange(len(gram))
    for bit in bit_places(gram):
        bit = bit[at]
        at = at[(table[(bit >> np.uint64(3)).astype(np.int64)]
                 >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return at


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, words): a row for each test item; words are joined by single spaces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1),
                 pa.array([" ".join(words_of(t)) for t in texts(part.column(2))], pa.string())],
                ["item", "item_id", "words"])
    rows = benchmark.select("item_id", "text").filter(
        "item_id is not null and text is not null").distinct()
    rows = rows.select(F.md5(F.concat_ws(":", "item_id", "text")).alias("item"),
                       F.col("item_id").cast("long").alias("item_id"), "text")
    return rows.mapInArrow(run, "item string, item_id long, words string").filter("words <> ''")


def item_grams(items: DataFrame) -> DataFrame:
    """(item, place, gram) of all n-grams of the items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for part in slices(batches):
            item, place, gram = grams([w.split(" ") for w in texts(part.column(1))], hashes)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(item)), pa.array(place.astype(np.int32)),
                 pa.array(gram)], ["item", "place", "gram"])
    return items.select("item", "words").mapInArrow(run, "item string, place int, gram long")


def hits_in(docs: DataFrame, table) -> DataFrame:
    """(text_key, at, gram) of the n-grams of the documents that may be in the bit table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for part in slices(batches):
            text, at, gram = grams([words_of(t) for t in texts(part.column(1))], hashes)
            found = known(table.value, gram)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(text[found])), pa.array(at[found].astype(np.int32)),
                 pa.array(gram[found])], ["text_key", "at", "gram"])
    return docs.select(F.md5("text").alias("text_key"), "text").filter("text <> ''").mapInArrow(
        run, "text_key string, at int, gram long")


def cheapest(costs: list[float]) -> list[int]:
    """Places of the n-grams to seek: of each stretch of words the cheapest that do not overlap,
    one more than the edits that a copy may have, or as many as there is room for. Of equal
    choices the one that ends first stays."""
    count, n = len(costs), SEED_WORDS
    chosen: list[int] = []
    edges = list(range(0, count + n - 1, STRETCH))
    if len(edges) > 1 and count + n - 1 - edges[-1] < n:
        edges.pop()
    for k, start in enumerate(edges):
        stop = edges[k + 1] if k + 1 < len(edges) else count + n - 1
        length = stop - start
        need = max(1, min(length // n, length // EDITED + 1))
        # best[m][i]: least cost of m n-grams within the first i words of the stretch.
        best = np.full((need + 1, length + 1), np.inf)
        best[0] = 0
        for m in range(1, need + 1):
            for i in range(n * m, length + 1):
                best[m, i] = min(best[m, i - 1], best[m - 1, i - n] + costs[start + i - n])
        i = length
        for m in range(need, 0, -1):
            while i > n * m and best[m, i - 1] <= best[m, i]:
                i -= 1
            i -= n
            chosen.append(start + i)
    return sorted(chosen)


def _choose(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in arrays:
        yield pa.array([cheapest([c["cost"] for c in sorted(row, key=lambda c: c["place"])])
                        for row in column.to_pylist()], pa.list_(pa.int32()))


def seeds_of(of_items: DataFrame, hits: DataFrame) -> DataFrame:
    """(gram, item, place): seeds of the items that stand in the corpus."""
    counts = hits.groupBy("gram").agg(F.count("*").alias("count"))
    holders = of_items.groupBy("gram").agg(F.count_distinct("item").alias("items"))
    cost = F.coalesce(F.col("count"), F.lit(0)).cast("double") * F.col("items")
    priced = of_items.join(holders.join(counts, "gram", "left"), "gram").select(
        "item", "place", "gram", cost.alias("cost"))
    choice = priced.groupBy("item").agg(F.collect_list(F.struct("place", "cost")).alias("all"))
    choice = choice.select("item", F.explode(F.arrow_udf(_choose, "array<int>")("all")).alias("place"))
    return priced.filter("cost > 0").join(choice, ["item", "place"]).select("gram", "item", "place")


def align(items: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best Smith-Waterman score of each row of ``items`` in its row of ``windows``, and the
    place in the window where it ends. Negative numbers match nothing."""
    count, width = windows.shape
    slope = np.arange(width, dtype=np.int32) * GAP
    above = np.zeros((count, width + 1), np.int32)
    best, end = np.zeros(count, np.int32), np.zeros(count, np.int64)
    for word in items.T:
        now = np.zeros_like(above)
        step = np.where(windows == word[:, None], MATCH, MISMATCH)
        cell = np.maximum(np.maximum(above[:, :-1] + step, above[:, 1:] - GAP), 0)
        # Gaps along the window: the best earlier cell less its distance.
        cell = np.maximum.accumulate(cell + slope, axis=1) - slope
        now[:, 1:] = cell
        top = cell.argmax(1)
        value = cell[np.arange(count), top]
        better = value > best
        best, end = np.where(better, value, best), np.where(better, top, end)
        above = now
    return best, end


def aligned(pairs: list[tuple[list[str], list[str]]]) -> list[tuple[int, int]]:
    """(score, place where it ends) of each pair of an item's words and a window's words."""
    found: list[tuple[int, int]] = [(0, 0)] * len(pairs)
    order = sorted(range(len(pairs)), key=lambda k: len(pairs[k][1]))
    at = 0
    while at < len(order):
        part, least = [order[at]], len(pairs[order[at]][1])
        for k in order[at + 1:]:
            width = len(pairs[k][1])
            if (len(part) + 1) * width > CELLS or width > 2 * least + 16:
                break
            part.append(k)
        at += len(part)
        number: dict[str, int] = {}
        items = np.full((len(part), max(len(pairs[k][0]) for k in part)), -2, np.int64)
        windows = np.full((len(part), len(pairs[part[-1]][1])), -1, np.int64)
        for row, k in enumerate(part):
            for target, words in zip((items, windows), pairs[k]):
                target[row, :len(words)] = [number.setdefault(w, len(number)) for w in words]
        score, end = align(items, windows)
        for k, s, e in zip(part, score.tolist(), end.tolist()):
            found[k] = (s, e)
    return found


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        key, item, start, window, words = (c.to_pylist() for c in part.columns)
        pairs = [(w.split(" "), around) for w, around in zip(words, window)]
        found = aligned(pairs)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key, pa.string()), pa.array(item, pa.string()),
             pa.array([s / (MATCH * len(w)) for (s, _), (w, _) in zip(found, pairs)], pa.float64()),
             pa.array([a + e + 1 for a, (_, e) in zip(start, found)], pa.int32())],
            ["text_key", "item", "score", "end_word"])


def words_with(docs: DataFrame, table) -> DataFrame:
    """(text_key, all_words) of the texts whose key may be in the bit table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            part = part.take(pa.array(known(table.value, part.column(2).to_numpy())))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([words_of(t) for t in texts(part.column(1))],
                                          pa.list_(pa.string()))], ["text_key", "all_words"])
    key = F.md5("text").alias("text_key")
    return docs.select(key, "text").filter("text <> ''").select(
        "text_key", "text", F.xxhash64("text_key").alias("bits")).mapInArrow(
        run, "text_key string, all_words array<string>")


def leaking_texts(docs: DataFrame, benchmark: DataFrame,
                  similarity: float = SIMILARITY) -> DataFrame:
    """(text_key, item_id, score, words, end_word): a row for each different text, by its digest,
    and test item that it holds. Of several copies in a text the best counts, then the first."""
    spark = docs.sparkSession
    items = saved(items_of(benchmark), "test-items")
    of_items = saved(item_grams(items), "test-grams")
    table = spark.sparkContext.broadcast(bit_table(of_items))
    hits = saved(hits_in(docs, table), "seed-hits")

    sized = items.select("item", F.size(F.split("words", " ")).alias("length"))
    # Gaps use up the score, so an alignment over the bound reaches no further than this.
    reach = F.ceil(F.col("length") * MATCH * (1 - similarity) / GAP).cast("int")
    band = F.greatest(F.floor(F.col("length") / 2), F.lit(4)).cast("int")
    where = saved(hits.join(seeds_of(of_items, hits).join(sized, "item"), "gram").select(
        "text_key", "item", (F.floor((F.col("at") - F.col("place")) / band) * band).alias("from"),
        (F.col("length") + band).alias("span"), reach.alias("reach")).distinct(), "seeded-parts")
    start = F.greatest(F.col("from") - F.col("reach"), F.lit(0)).cast("int")
    stop = (F.col("from") + F.col("span") + F.col("reach")).cast("int")
    table = spark.sparkContext.broadcast(bit_table(
        where.select(F.xxhash64("text_key").alias("gram"))))
    whole = words_with(docs, table).dropDuplicates(["text_key"])
    windows = where.join(whole, "text_key").select(
        "text_key", "item", start.alias("start"),
        F.slice("all_words", start + 1, stop - start).alias("window"))
    scored = windows.join(items.select("item", "words"), "item").select(
        "text_key", "item", "start", "window", "words").mapInArrow(
        _scores, "text_key string, item string, score double, end_word int")
    best = scored.filter(F.col("score") >= similarity).groupBy("text_key", "item").agg(
        F.max(F.struct("score", (-F.col("end_word")).alias("first"))).alias("best"))
    return saved(best.join(items.join(sized, "item"), "item").select(
        "text_key", "item_id", "best.score", F.col("length").alias("words"),
        (-F.col("best.first")).alias("end_word")), "leaks")


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, score, words, end_word): a row for each document and test item it holds,
    with the score as a share of the highest, the words of the item, and the word of the text
    where the alignment ends.

    Repeated documents give repeated rows, clean ones none; a null doc_id stays null.
    """
    found = leaking_texts(docs, benchmark, similarity)
    return docs.select("doc_id", F.md5("text").alias("text_key")).join(found, "text_key").drop(
        "text_key")


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns."""
    found = leaking_texts(docs, benchmark, similarity).select("text_key").distinct()
    rows = docs.select(F.struct("*").alias("row"))
    return rows.join(found, F.md5("row.text") == F.col("text_key"), "left_anti").select("row.*")
