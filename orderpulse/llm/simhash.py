"""SimHash near-duplicates by a grid over segment bit counts.

A fingerprint of 64 bits is embedded by the bit counts of its 2-bit segments. The Manhattan
distance of two embeddings never exceeds the number of differing bits. Of two fingerprints
with at most three differing bits, one half differs in at most one bit, so the 16 counts of
that half are equal or one apart. Each fingerprint therefore stands in the grid cell of its
counts in each half, and looks into the cells that are one step up; what meets in a cell is
verified on all bits. Large cells are dealt to blocks, and each pair of blocks is one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from orderpulse.llm.common import saved, slices
from orderpulse.llm.components import connected

SEED = 42
#: Fingerprints of a cell that are compared in one group; larger cells are dealt to blocks.
BLOCK = 2000
#: Groups of up to this size are compared by shifting, larger ones by search.
SMALL_GROUP = 32


def fingerprint_of(words: list[bytes], shingle: int) -> int:
    """Majority of the bits of the shingles' hashes; no word gives zero."""
    if not words:
        return 0
    if len(words) <= shingle:
        joined = [b" ".join(words)]
    else:
        joined = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest, seed = xxhash.xxh64_digest, SEED
    hashes = np.frombuffer(b"".join([digest(s, seed) for s in joined]), np.uint8).reshape(-1, 8)
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)], axis=1)
        whole = len(bits) // 255 * 255
        if whole:  # sums of 255 bits fit a byte
            total += bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
        total += bits[whole:].sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(key, text_hash, fingerprint) of every row, over its whole text.

    A-Z are lower-cased, words are what stands between ASCII white space. Null and empty
    texts have fingerprint zero; fewer words than a shingle are one shingle.
    """
    rows = docs.select(F.col(key), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))

    def run(batches):
        for batch in slices(batches):
            column = batch.column(1).cast(pa.binary())
            found = [fingerprint_of((t or b"").lower().split(), shingle)
                     for t in column.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.int64())],
                [batch.schema.names[0], "text_hash", "fingerprint"])

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, text_hash long, fingerprint long")


def _counts(half: Column) -> Column:
    """Bit counts of the 16 segments of a half, two bits each."""
    low = F.lit(0x55555555)
    return half.bitwiseAND(low) + F.shiftright(half, 1).bitwiseAND(low)


def _cells(prints: DataFrame) -> DataFrame:
    """(fp, half, cell, base): the own cell of each half, and the cells one step up."""
    halves = F.posexplode(F.array(F.shiftrightunsigned("fp", 32),
                                  F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))))
    own = prints.select("fp", halves.alias("half", "bits")).select(
        "fp", "half", _counts(F.col("bits")).alias("cell"))
    up = F.array(*(F.when(F.shiftright("cell", 2 * j).bitwiseAND(F.lit(3)) < 2,
                          F.col("cell") + F.lit(1 << 2 * j)) for j in range(16)))
    return own.select("fp", "half", "cell", F.lit(True).alias("base")).union(
        own.select("fp", "half", F.explode(F.array_compact(up)).alias("cell"),
                   F.lit(False).alias("base")))


def _groups(prints: DataFrame) -> DataFrame:
    """(half, cell, i, j, fp): fingerprints to compare with each other."""
    cells = _cells(prints)
    sizes = (cells.filter("base").groupBy("half", "cell").agg(F.count("*").alias("n"))
             .withColumn("blocks", F.ceil(F.col("n") / BLOCK)))
    rows = cells.join(sizes, ["half", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    # Blocks of base rows meet each other; blocks of looking rows (-1 - block) meet base blocks.
    base = F.concat(
        F.transform(every, lambda k: F.struct(F.least("block", k).alias("i"),
                                              F.greatest("block", k).alias("j"))),
        F.when(F.col("blocks") > 1, F.transform(every, lambda k: F.struct(
            F.col("block").alias("i"), (-1 - k).alias("j"))))
        .otherwise(F.expr("cast(array() as array<struct<i:bigint,j:bigint>>)")))
    looking = F.transform(every, lambda k: F.struct(
        k.alias("i"), F.when(F.col("blocks") > 1, -1 - F.col("block"))
        .otherwise(F.lit(0).cast("long")).alias("j")))
    return rows.select("half", "cell", "fp", F.explode(
        F.when(F.col("base"), base).otherwise(looking)).alias("pair")).select(
        "half", "cell", "pair.i", "pair.j", "fp")


def _differing(a: np.ndarray, b) -> np.ndarray:
    """Bits in which signed fingerprints differ (a bit count takes the absolute value)."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def _search(prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each print with the first of its component: from one print, all it reaches is found
    among those not yet reached, so a dense group costs far less than its pairs."""
    rest = prints
    nodes, lows = [], []
    while len(rest):
        start, rest = rest[0], rest[1:]
        frontier = [start]
        while frontier and len(rest):
            near = _differing(rest, frontier.pop()) <= bits
            if near.any():
                reached = rest[near]
                rest = rest[~near]
                nodes.append(reached)
                lows.append(np.full(len(reached), start))
                frontier.extend(reached)
    if not nodes:
        return prints[:0], prints[:0]
    return np.concatenate(nodes), np.concatenate(lows)


def links_of(keys: np.ndarray, prints: np.ndarray, bits: int
             ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that hold together what is linked within each run of equal rows of ``keys``."""
    new = np.r_[True, (keys[1:] != keys[:-1]).any(1)]
    run = np.cumsum(new) - 1
    sizes = np.bincount(run)
    for k in np.flatnonzero(sizes > SMALL_GROUP):
        yield _search(np.unique(prints[run == k]), bits)
    small = sizes[run] <= SMALL_GROUP
    run, prints = run[small], prints[small]
    for lag in range(1, int(sizes[sizes <= SMALL_GROUP].max(initial=1))):
        a, b = prints[:-lag], prints[lag:]
        near = (run[:-lag] == run[lag:]) & (_differing(a, b) <= bits) & (a != b)
        yield a[near], b[near]


def link_batches(bits: int):
    """Sorted batches of (half, cell, i, j, fp) to batches of links (a, b); the last group of
    a batch waits for the next one, as it may go on there."""
    def run(batches):
        held: list[np.ndarray] = []

        def links(rows):
            for a, b in links_of(rows[:, :4], rows[:, 4], bits):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = np.column_stack([c.to_numpy().astype(np.int64) for c in batch.columns])
            if held and (held[-1][-1, :4] != rows[0, :4]).any():
                yield from links(np.concatenate(held))
                held = []
            cut = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1))
            if len(cut):
                done = rows[:cut[-1] + 1]
                yield from links(np.concatenate([*held, done]))
                held = [rows[cut[-1] + 1:]]
            else:
                held.append(rows)
        if held:
            yield from links(np.concatenate(held))
    return run


def near_links(prints: DataFrame, bits: int = 3) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints ``fp`` linked by at most ``bits``
    (up to 3) differing bits: not every pair, but every component."""
    if not 0 <= bits <= 3:
        raise ValueError("the grid finds up to 3 differing bits")
    groups = _groups(prints)
    keys = ["half", "cell", "i", "j"]
    return (groups.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(link_batches(bits), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(key, text_hash, fingerprint long, component_id, component) of every row of ``docs``.

    ``component_id`` is the smallest key that is reached over links of at most ``bits``
    differing bits. Rows with a null key are linked too but name no component; where no row
    of a component has a key, it is null. ``component`` is the smallest fingerprint that is
    reached, which tells components apart where one key stands with several texts. Repeated rows give repeated results, an empty table
    none; other columns are not looked at.
    """
    own = saved(fingerprints(docs, shingle, key, text), "fingerprints")
    prints = own.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(key).alias("low_doc"))
    prints = saved(prints, "prints")
    nodes = connected(near_links(prints.select("fp"), bits))
    named = prints.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low_doc", F.coalesce("low", "fp").alias("low"))
    least = named.groupBy("low").agg(F.min("low_doc").alias("component_id"))
    named = named.join(least, "low").select(F.col("fp").alias("fingerprint"), "component_id",
                                            F.col("low").alias("component"))
    return own.join(named, "fingerprint").select(key, "text_hash", "fingerprint", "component_id",
                                                 "component")


def first_of_each(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of each component one row with its smallest doc_id. Where
    one doc_id stands with several texts, each is judged in its own component. Rows without
    doc_id can't be told apart and stay."""
    stay = members.filter("doc_id = component_id").groupBy("doc_id", "component").agg(
        F.min("text_hash").alias("text_hash")).select("doc_id", "text_hash")
    # The row is one column, so that no name of the caller's can clash.
    rows = docs.filter("doc_id is not null").select(
        F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    kept = rows.join(stay, ["doc_id", "text_hash"], "left_semi").dropDuplicates(
        ["doc_id", "text_hash"])
    return kept.select("row.*").union(docs.filter("doc_id is null"))
