"""Repeated passages by content-defined chunks.

A gear hash rolls over the bytes of a text; where its low bits are zero a chunk ends, and where
that doesn't come in time (a word said over and over) at its least value. A chunk border depends
on the bytes just before it, so an insertion moves the borders near it only and the chunks
behind it are the same again. Chunks are told by digest: those that stand in several places, be
it of one text or of several, are repeated, and neighbouring repeated chunks form a passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from orderpulse.llm.common import saved, slices

#: Shortest chunk, bits that must be zero at its end (16 bytes more on average), longest chunk.
LEAST, BITS, MOST = 12, 4, 48
#: Bytes that the hash remembers: older ones have been shifted out of the tested bits.
MEMORY = 16
#: Words of a run of repeated chunks that make it a repeated passage.
PASSAGE_WORDS = 20
#: A pseudo-random number for each byte, from a rule.
GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "big")
                 for b in range(256)], np.uint64)
BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def gear_hash(raw: np.ndarray) -> np.ndarray:
    """Rolling hash after each byte: h = 2 h + gear[byte], over the last MEMORY bytes, by
    doubling the number of bytes that are summed. The tested bits lie on top of them."""
    h, done = GEAR[raw], 1
    while done < MEMORY:
        h[done:] += h[:-done] << np.uint64(done)
        done *= 2
    return h


def borders(raw: bytes) -> list[int]:
    """Ends of the chunks of a text; none for an empty one."""
    if not raw:
        return []
    h = (gear_hash(np.frombuffer(raw, np.uint8)) & np.uint64((1 << MEMORY) - 1)).astype(np.int64)
    ends = np.flatnonzero(h < 1 << (MEMORY - BITS)) + 1
    found, start, size = [], 0, len(raw)
    for end in [*ends.tolist(), size]:
        while end - start > MOST:
            start += LEAST + int(h[start + LEAST - 1:start + MOST].argmin())
            found.append(start)
        if end - start >= LEAST or start < end == size:
            start = end
            found.append(end)
    return found


def words_of(raw: bytes, ends: list[int]) -> list[int]:
    """How many words begin in each chunk."""
    begins = ~BLANK[np.frombuffer(raw, np.uint8)]
    begins[1:] &= ~begins[:-1]
    return np.diff(np.r_[0, np.cumsum(begins)][[0, *ends]]).tolist()


def chunks(docs: DataFrame, places: bool = True) -> DataFrame:
    """(row, digests, places): the chunks of each text in order; if ``places`` is false, the
    distinct digests, and in place of places how many chunks have each.

    ``row`` is a hash of doc_id and text. A digest is 64 bits long: a passage takes several
    equal ones in a row. A place is start, length and words in one long: 2^17 start + 2^8
    length + words, as a chunk has at most MOST = 48 bytes.
    """
    rows = docs.select(F.xxhash64("doc_id", "text").alias("row"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            digests, where = [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                raw = text or b""
                ends = borders(raw)
                starts = [0, *ends]
                parts = [raw[a:b] for a, b in zip(starts, ends)]
                found = np.frombuffer(b"".join(
                    [hashlib.blake2b(p, digest_size=8).digest() for p in parts]), np.int64)
                if places:
                    digests.append(found)
                    where.append([a << 17 | (b - a) << 8 | n for a, b, n in zip(
                        starts, ends, words_of(raw, ends))])
                else:
                    found, times = np.unique(found, return_counts=True)
                    digests.append(found)
                    where.append(times)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.list_(pa.int64())),
                 pa.array(where, pa.list_(pa.int64()))], ["row", "digests", "places"])

    return rows.mapInArrow(run, "row long, digests array<long>, places array<long>")


def repeated(docs: DataFrame, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """(doc_id, start, end, n_words, n_chunks, copies, places): the repeated passages of each
    document.

    A passage is a longest run of chunks that each stand in at least two places, of one row or
    of several, with at least ``passage_words`` words; ``start`` and ``end`` are bytes,
    ``copies`` is how many rows hold its rarest chunk, and ``places`` how often its rarest chunk
    stands in all rows. Null and empty texts hold none. The same row twice is two copies,
    listed once. Each chunk crosses the network once to be counted, summed in each task first,
    and once to meet its count, where a very common chunk is a skewed join key.
    """
    def each(rows: DataFrame) -> DataFrame:
        return rows.select("row", F.explode(F.arrays_zip(
            F.col("digests").alias("digest"), F.col("places").alias("place"))).alias("c")).select(
            "row", "c.digest", "c.place")

    common = (each(chunks(docs, places=False)).groupBy("digest")
              .agg(F.count("*").alias("copies"), F.sum("place").alias("places"))
              .filter("places > 1"))
    # Written, so that the join deals both sides anew and a very common chunk can be split.
    twice = each(chunks(docs)).join(saved(common, "repeated-chunks"), "digest").groupBy(
        "row", "place").agg(F.first("copies").alias("copies"), F.first("places").alias("places"))
    start = F.shiftright("place", 17)
    order = Window.partitionBy("row").orderBy("start")
    runs = (twice.select("row", start.alias("start"), (start + F.shiftright("place", 8)
                         .bitwiseAND(F.lit(511))).alias("end"),
                         F.col("place").bitwiseAND(F.lit(255)).alias("words"), "copies", "places")
            .withColumn("new", F.coalesce((F.lag("end").over(order) != F.col("start"))
                                          .cast("int"), F.lit(1)))
            .withColumn("run", F.sum("new").over(order)))
    found = (runs.groupBy("row", "run")
             .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                  F.sum("words").alias("n_words"), F.count("*").alias("n_chunks"),
                  F.min("copies").alias("copies"), F.min("places").alias("places"))
             .filter(F.col("n_words") >= passage_words))
    names = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row")).distinct()
    return found.join(names, "row").select("doc_id", "start", "end", "n_words", "n_chunks",
                                           "copies", "places")
