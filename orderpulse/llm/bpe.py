"""Byte-level BPE: encode texts to ids by a rank file, decode ids to bytes.

The merges of one piece run on a segment tree over its byte positions. A leaf holds the
rank of the pair that starts there, with the position behind it, so the root is the lowest
rank and among equal ranks the leftmost. A merge changes at most three leaves: the merged
pair, the pair before it, and the one that went away.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from orderpulse.llm.common import chained, slices, texts

#: Units (what stands between two spaces) whose ids a Python worker remembers, and their
#: characters; beyond either it forgets all and starts again.
REMEMBERED, REMEMBERED_CHARS = 400_000, 8_000_000
NO_PAIR = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with one base64 token and its id per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece. A byte that has no rank of its own raises KeyError."""
    if piece in ranks:
        return [ranks[piece]]
    n, rank_of = len(piece), ranks.get
    width = 1 << max(0, (n - 2).bit_length())
    tree = [NO_PAIR] * (2 * width)
    for i in range(n - 1):
        rank = rank_of(piece[i:i + 2])
        if rank is not None:
            tree[width + i] = rank * n + i
    for k in range(width - 1, 0, -1):
        left, right = tree[2 * k], tree[2 * k + 1]
        tree[k] = left if left < right else right
    end = list(range(1, n + 1))
    before = list(range(-1, n))
    while tree[1] < NO_PAIR:
        at = tree[1] % n
        gone = end[at]
        stop = end[at] = end[gone]
        before[stop] = at
        changed = [(gone, None), (at, rank_of(piece[at:end[stop]]) if stop < n else None)]
        if before[at] >= 0:
            changed.append((before[at], rank_of(piece[before[at]:stop])))
        for leaf, rank in changed:
            k = width + leaf
            if k >= 2 * width:
                continue
            low = NO_PAIR if rank is None else rank * n + leaf
            if tree[k] == low:
                continue
            tree[k] = low
            k >>= 1
            while k:
                left, right = tree[2 * k], tree[2 * k + 1]
                low = left if left < right else right
                if tree[k] == low:
                    break
                tree[k] = low
                k >>= 1
    ids, at = [], 0
    while at < n:
        ids.append(ranks[piece[at:end[at]]])
        at = end[at]
    return ids


class Trees:
    """The same merges for many pieces at once: one row of the arrays is one piece."""

    #: Bytes of a piece up to which it shares arrays with others, and cells of an array.
    LONGEST, CELLS = 128, 1 << 20

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)])
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 24 | right] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()], np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or -1."""
        wanted = left.astype(np.int64) << 24 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.values[at], -1)

    def merge_all(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of each piece, as the bytes of 32-bit numbers."""
        known, by_width = {}, {}
        for piece in pieces:
            rank = self.ranks.get(piece)
            if rank is not None:
                known[piece] = packed(rank)
            elif len(piece) > self.LONGEST or len(self.keys) == 0:
                known[piece] = packed(*merge(piece, self.ranks))
            elif piece:
                by_width.setdefault(1 << (len(piece) - 1).bit_length(), []).append(piece)
        for width, same in by_width.items():
            rows = max(1, self.CELLS // width)
            for at in range(0, len(same), rows):
                part = same[at:at + rows]
                known.update(zip(part, self.merge_rows(part, width)))
        return known

    def merge_rows(self, pieces: list[bytes], width: int) -> Iterator[bytes]:
        count = len(pieces)
        size = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        token = self.byte_ids[raw].reshape(count, width)
        place = np.arange(width)
        if (token[place < size[:, None]] < 0).any():
            raise KeyError("a byte without a rank")
        after = np.tile(np.arange(1, width + 2), (count, 1))
        before = np.tile(np.arange(-1, width), (count, 1))
        tree = np.full((count, 2 * width), NO_PAIR, np.int64)
        if width > 1:
            rank = self.pair_ranks(token[:, :-1], token[:, 1:])
            real = (rank >= 0) & (place[1:] < size[:, None])
            tree[:, width:-1] = np.where(real, rank * width + place[:-1], NO_PAIR)
        level = width // 2
        while level:
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2],
                                                  tree[:, 2 * level + 1:4 * level:2])
            level //= 2
        live = np.arange(count)
        while True:
            live = live[tree[live, 1] < NO_PAIR]
            if not len(live):
                break
            rank, at = np.divmod(tree[live, 1], width)
            gone = after[live, at]
            stop = after[live, gone]
            token[live, at] = rank
            after[live, at] = stop
            before[live, stop] = at
            first = before[live, at]
            rows = np.concatenate((live, live, live))
            left = np.concatenate((gone, at, first))
            behind = np.concatenate((np.full(len(live), width + 1), stop, at))
            inside = (left >= 0) & (left < width)
            rows, left, behind = rows[inside], left[inside], behind[inside]
            value = np.full(len(rows), NO_PAIR, np.int64)
            pair = behind < size[rows]
            low = self.pair_ranks(token[rows[pair], left[pair]], token[rows[pair], behind[pair]])
            value[pair] = np.where(low >= 0, low * width + left[pair], NO_PAIR)
            node = width + left
            tree[rows, node] = value
            for _ in range(width.bit_length() - 1):
                node >>= 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
        # Positions that still start a token, in order.
        alive = np.zeros((count, width + 2), bool)
        alive[:, 0] = True
        at = np.zeros(count, np.int64)
        live = np.arange(count)
        while len(live):
            at[live] = after[live, at[live]]
            live = live[at[live] < size[live]]
            alive[live, at[live]] = True
        alive = alive[:, :width]
        ids = token[alive].astype(np.int32).tobytes()
        bounds = [0, *(4 * np.cumsum(alive.sum(1))).tolist()]
        return (ids[a:b] for a, b in zip(bounds, bounds[1:]))


def packed(*ids: int) -> bytes:
    return array("i", ids).tobytes()


class Encoder:
    """Texts to ids. Where no two white-space characters meet, a match of the pattern never
    goes beyond a space, so what stands between spaces is encoded apart and remembered.
    Ids are held as the bytes of 32-bit numbers, which are joined without a look at each."""

    double_space = re.compile(r"\s\s")

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split, self.trees = regex.compile(pattern), Trees(ranks)
        self.units: dict[str, bytes] = {}
        self.chars = 0

    def encode(self, texts_: list[str]) -> list[memoryview]:
        """Ids of each text."""
        return [memoryview(ids).cast("i") for ids in self.encode_packed(texts_)]

    def encode_packed(self, texts_: list[str]) -> list[bytes]:
        """Ids of each text, as the bytes of 32-bit numbers."""
        split, plain = self.split.findall, []
        for text in texts_:
            if self.double_space.search(text):
                plain.append((split(text), []))
            else:
                head, *rest = text.split(" ")
                plain.append((split(head), rest))
        if len(self.units) >= REMEMBERED or self.chars >= REMEMBERED_CHARS:
            self.units.clear()
            self.chars = 0
        new = set(chain.from_iterable(rest for _, rest in plain)).difference(self.units)
        self.chars += sum(map(len, new))
        odd = {unit for unit in new if not unit or unit[0].isspace() or unit[-1].isspace()}
        usual = list(new - odd)
        pieces = split(" " + " ".join(usual)) if usual else []
        apart = [(unit, split(" " + unit)) for unit in odd]
        wanted = set(pieces).union(*(p for _, p in apart), *(head for head, _ in plain))
        by_bytes = self.trees.merge_all([p.encode() for p in wanted])
        ids = {p: by_bytes[p.encode()] for p in wanted}
        starts = [i for i, piece in enumerate(pieces) if piece[0] == " "] + [len(pieces)]
        for unit, a, b in zip(usual, starts, starts[1:]):
            self.units[unit] = ids[pieces[a]] if b == a + 1 else b"".join(
                [ids[p] for p in pieces[a:b]])
        for unit, parts in apart:
            self.units[unit] = b"".join([ids[p] for p in parts])
        get, unit_ids = ids.__getitem__, self.units.__getitem__
        return [b"".join(chain(map(get, head), map(unit_ids, rest))) for head, rest in plain]


_held: list = []


def _encoder(ranks, pattern: str) -> Encoder:
    """One encoder for each Python worker, as its memory pays off over many batches. The
    broadcast it was made of is held with it, so that no other one passes for it."""
    if not _held or _held[0] is not ranks or _held[1] != pattern:
        _held[:] = ranks, pattern, Encoder(ranks.value, pattern)
    return _held[2]


def id_lists(column: pa.ListArray) -> Iterator[list[int]]:
    """The lists of a column; null counts as empty."""
    ids = column.flatten().to_numpy().tolist()
    at = 0
    for length in column.value_lengths().fill_null(0).to_pylist():
        yield ids[at:at + length]
        at += length


def encode_batches(ranks, pattern: str):
    """Batches of (key, text) to batches of (key, ids)."""
    def run(batches):
        encoder = _encoder(ranks, pattern)
        for batch in slices(batches):
            gc.disable()  # the many small objects hold no cycles
            found = encoder.encode_packed(texts(batch.column(1)))
            offsets = np.cumsum([0, *(len(ids) // 4 for ids in found)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(
                np.frombuffer(b"".join(found), np.int32)))
            gc.enable()
            yield pa.RecordBatch.from_arrays([batch.column(0), lists],
                                             [batch.schema.names[0], "ids"])
    return run


def decode_batches(ranks):
    """Batches of (key, ids) to batches of (key, ids, decoded); null ids decode to nothing."""
    def run(batches):
        token = {rank: piece for piece, rank in ranks.value.items()}
        for batch in slices(batches):
            lists = batch.column(1)
            decoded = [b"".join(map(token.__getitem__, ids)) for ids in id_lists(lists)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists, pa.array(decoded, pa.binary())],
                [batch.schema.names[0], "ids", "decoded"])
    return run


def digest_batches(batches):
    """Batches of (key, ids, decoded) to counts and digests of the decimal ids and the bytes."""
    decimal: dict[int, str] = {}
    for batch in batches:
        counts, of_ids, of_bytes = [], [], []
        for ids, decoded in zip(id_lists(batch.column(1)), batch.column(2).to_pylist()):
            counts.append(len(ids))
            for new in set(ids).difference(decimal):
                decimal[new] = str(new)
            line = " ".join(map(decimal.__getitem__, ids))
            of_ids.append(hashlib.sha256(line.encode()).hexdigest())
            of_bytes.append(hashlib.sha256(decoded).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
             pa.array(of_bytes, pa.string())],
            [batch.schema.names[0], "n_tokens", "ids_sha256", "decoded_sha256"])


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """(key, ids) of every row of ``docs``, in whole; null text has no ids, like empty text.

    ``path`` names a rank file, which the driver reads and sends to the executors (its size is
    that of a vocabulary, whatever the data). Other columns are not looked at; repeated rows
    give repeated results.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(path))
    rows = docs.select(F.col(key), F.col(text).alias("text"))
    return rows.mapInArrow(encode_batches(ranks, pattern),
                           f"`{key}` {rows.schema[0].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded bytes) of every row of (key, ids); an unknown id raises KeyError."""
    ranks = encoded.sparkSession.sparkContext.broadcast(load_ranks(path))
    rows = encoded.select(key, "ids")
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(decode_batches(ranks),
                           f"`{key}` {kind}, ids array<int>, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Encode and decode in one task: (key, n_tokens, ids_sha256, decoded_sha256) per row."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(path))
    rows = docs.select(F.col(key), F.col(text).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(
        chained(encode_batches(ranks, pattern), decode_batches(ranks), digest_batches),
        f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
