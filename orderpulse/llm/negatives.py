"""Hard negatives for training pairs, mined from candidate lists that clusters of anchors share.

Anchors are clustered by direction. If all members of a cluster lie within the angle r of its
centre c, no member u has a larger inner product with a candidate x than
|u| |x| cos(max(0, angle(c, x) - r)). Sorted by |x| cos(...), the candidates are one list for
the whole cluster. Every member walks it from the top and stops for certain where the bound of
what is left falls below the worst score that it still keeps.

The lists are never written as a whole: thresholds cut them into a few segments, the same for
every table size, and a round sends the candidates of one segment to the clusters that still
have an open member. Members of a cluster are dealt to blocks and the candidates of a segment
to pieces, so that a cluster or a vector that a third of all rows share is many small groups.
A first walk finds the positives of each anchor, a second one the negatives in the window that
each positive gives. Results are exact; the clusters decide only how far members walk.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from orderpulse.llm.common import saved

#: Rows that clusters and thresholds are fitted on, and numbers in them; clusters at most.
SAMPLE, SAMPLE_NUMBERS, CLUSTERS = 8192, 1 << 20, 16
#: Members and candidates that meet in one group (of candidates, numbers too), rows of a step.
MEMBERS, PIECE, PIECE_NUMBERS, STEP = 1024, 4096, 1 << 19, 256
#: Shares of a list at which its segments end; the last takes what is left.
SEGMENTS = (1 / 1024, 1 / 64, 1 / 8)
#: Whole numbers up to this size are exact as doubles; the limits of a long.
EXACT, LOW, HIGH = 2.0 ** 53, -(1 << 63), (1 << 63) - 1
#: What rounding may take from an angle and from a bound.
ANGLE_SLACK, SLACK = 1e-6, 1e-9
#: The cluster of anchors without a direction or with an uncommon number of components.
NO_CENTRE = -1

GOALS = "array<struct<goal:int,low:bigint,high:bigint,floor:bigint>>"


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists have one length."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _whole(*matrices: np.ndarray) -> list[np.ndarray]:
    """The matrices as they are if all inner products are exact as doubles, else as whole
    numbers of any size."""
    size = [float(np.abs(m).max(initial=0.0)) for m in matrices]
    if max(size) ** 2 * matrices[0].shape[1] < EXACT:
        return list(matrices)
    return [np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
            for m in matrices]


def _units(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; a zero vector has a zero direction."""
    top = np.abs(rows).max(1, keepdims=True, initial=0.0)
    small = rows / np.where(top > 0, top, 1.0)
    length = np.sqrt((small * small).sum(1, keepdims=True))
    return small / np.where(length > 0, length, 1.0), (top * length)[:, 0]


@dataclass
class Lists:
    """Centres of the clusters, the angle within which their members lie, and the thresholds
    that cut the list of each cluster; the last row of ``cuts`` is that of NO_CENTRE."""

    width: int
    centres: np.ndarray
    radii: np.ndarray
    cuts: np.ndarray

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster of each row, and its angle to the centre."""
        units, length = _units(rows)
        if rows.shape[1] != self.width or not len(self.centres):
            return np.full(len(rows), NO_CENTRE), np.zeros(len(rows))
        near = units @ self.centres.T
        best = near.argmax(1)
        angle = np.arccos(np.clip(near[np.arange(len(rows)), best], -1, 1))
        return np.where(length > 0, best, NO_CENTRE), angle

    def bounds(self, rows: np.ndarray) -> np.ndarray:
        """For each row and cluster, NO_CENTRE last, the largest inner product that a member of
        length one can have with the row."""
        units, length = _units(rows)
        out = np.repeat(length[:, None], len(self.centres) + 1, 1)
        if rows.shape[1] == self.width and len(self.centres):
            angle = np.arccos(np.clip(units @ self.centres.T, -1, 1))
            apart = np.maximum(angle - self.radii - ANGLE_SLACK, 0.0)
            out[:, :-1] = np.minimum(length[:, None] * np.cos(np.minimum(apart, np.pi)),
                                     out[:, :-1])
        return out


def centres_of(rows: np.ndarray, clusters: int = CLUSTERS, rounds: int = 8) -> np.ndarray:
    """Centres of the directions of some rows (spherical k-means, the same for the same rows)."""
    units, length = _units(rows)
    units = units[length > 0]
    if not len(units):
        return units
    rng = np.random.default_rng(7)
    chosen = [units[0]]
    far = np.full(len(units), np.inf)
    for _ in range(min(clusters, len(units)) - 1):
        far = np.minimum(far, np.maximum(1 - units @ chosen[-1], 0))
        if far.sum() <= 1e-12:
            break
        chosen.append(units[rng.choice(len(units), p=far / far.sum())])
    centres = np.array(chosen)
    for _ in range(rounds):
        own = (units @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, units)
        unit, size = _units(sums)
        centres = np.where(size[:, None] > 0, unit, centres)
    return centres


def rows_of(vectors: DataFrame) -> DataFrame:
    """(vec_id, mark, label, vector, width) of the rows that take part: no null in vec_id, label
    or vector, at least one component, all finite. Components become floor(256 x). The same row
    twice counts once; ``mark`` tells apart rows that share a vec_id."""
    scaled = F.transform("embedding", lambda x: x.cast("double") * 256.0)
    fine = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # Beyond 2^53 a double is whole; below, floor is a long without loss.
    whole = F.transform(scaled, lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double"))
                        .otherwise(x))
    return (vectors.select("vec_id", "label", "embedding").dropna()
            .filter(F.coalesce(fine, F.lit(False)) & (F.size("embedding") > 0))
            .select(F.col("vec_id").cast("long").alias("vec_id"), "label", whole.alias("vector"))
            .distinct().select("vec_id", F.xxhash64("label", "vector").alias("mark"), "label",
                               "vector", F.size("vector").alias("width")))


def _sample(rows: DataFrame, size: int) -> list[np.ndarray]:
    """Vectors of a bounded number of rows, always the same ones."""
    near = F.xxhash64(F.lit("sample"), "vec_id", "mark")
    return [np.array(r.vector) for r in
            rows.select("vector", near.alias("at")).orderBy("at").limit(size).collect()]


def _fit(rows: DataFrame, anchors: DataFrame, clusters: int) -> tuple[Lists, np.ndarray]:
    """Lists without radii and cuts, and sampled rows of their width to make the cuts of."""
    widest = rows.agg(F.max("width")).first()[0] or 1
    size = max(1, min(SAMPLE, SAMPLE_NUMBERS // widest))
    some = _sample(anchors, size)
    widths, counts = np.unique([len(v) for v in some] or [1], return_counts=True)
    width = int(widths[counts.argmax()])
    own, others = (np.array([v for v in vectors if len(v) == width]).reshape(-1, width)
                   for vectors in (some, _sample(rows, size)))
    centres = centres_of(own, clusters)
    return (Lists(width, centres, np.zeros(len(centres)), np.zeros((len(centres) + 1, 0))),
            others)


def _members(anchors: DataFrame, lists: Lists) -> DataFrame:
    """Anchors with ``cluster``, ``angle`` to its centre and ``norm``."""
    def run(batches):
        for batch in batches:
            width = batch.column("width").to_numpy()
            cluster, angle, norm = (np.zeros(batch.num_rows, t) for t in (np.int32, float, float))
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                own = _matrix(batch.column("vector").take(pa.array(at)))
                cluster[at], angle[at] = lists.nearest(own)
                norm[at] = _units(own)[1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cluster), pa.array(angle), pa.array(norm)],
                [*batch.schema.names, "cluster", "angle", "norm"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema)
    return anchors.mapInArrow(run, f"{kinds}, cluster int, angle double, norm double")


def _segment(rows: DataFrame, lists: Lists, number: int, open_: dict[int, int],
             pieces: dict[int, int]) -> DataFrame:
    """Candidates of one segment for each cluster of ``open_``, which has its member blocks."""
    wanted = sorted(open_)

    def run(batches):
        for batch in batches:
            width = batch.column("width").to_numpy()
            # Not by content, as a third of all rows may share one vector.
            spread = (batch.column("vec_id").to_numpy().astype(np.uint64)
                      * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for w in np.unique(width):
                at = np.flatnonzero(width == w)
                bound = lists.bounds(_matrix(batch.column("vector").take(pa.array(at))))
                for c in wanted:
                    if c != NO_CENTRE and w != lists.width:
                        continue
                    own = bound[:, c]
                    here = own < lists.cuts[c, number - 1] if number else np.full(len(at), True)
                    if number < lists.cuts.shape[1]:
                        here &= own >= lists.cuts[c, number]
                    if not here.any():
                        continue
                    part = batch.take(pa.array(at[here]))
                    piece = (spread[at[here]] % np.uint64(pieces[c])).astype(np.int32)
                    same = np.full(len(part), c, np.int32), np.full(len(part), open_[c], np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(same[0]), pa.array(same[1]), pa.array(piece),
                         pa.array(own[here])],
                        [*part.schema.names, "cluster", "blocks", "piece", "bound"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    sent = rows.mapInArrow(run, f"{kinds}, cluster int, blocks int, piece int, bound double")
    return sent.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))


FOUND = "anchor_id long, anchor_mark long, goal int, vec_id long, score long"


def walker(k: int, same_label: bool):
    """A function over the members and the candidates of one group: the k best candidates for
    each goal of each member, among those that can be better than what it has."""
    def walk(members: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if members.num_rows and rows.num_rows:
            order = np.argsort(-rows["bound"].to_numpy(), kind="stable")
            rows = rows.take(pa.array(order))
            anchors, items = _whole(_matrix(members["vector"]), _matrix(rows["vector"]))
            ids, marks, labels, bound = (rows[c].to_numpy() for c in
                                         ("vec_id", "mark", "label", "bound"))
            a_id, a_mark, a_label, norm = (members[c].to_numpy() for c in
                                           ("anchor_id", "anchor_mark", "label", "norm"))
            goals = [{g["goal"]: (g["low"], g["high"], g["floor"]) for g in own}
                     for own in members["goals"].to_pylist()]
            kept = [{g: (np.empty(0, np.int64), np.empty(0, np.int64)) for g in own}
                    for own in goals]
            floors = np.array([min(g[2] for g in own.values()) for own in goals], float)
            open_ = np.arange(len(norm))
            for start in range(0, len(ids), STEP):
                top = norm[open_] * bound[start]
                open_ = open_[np.maximum(top + SLACK * (1 + np.abs(top)), LOW) >= floors[open_]]
                if not len(open_):
                    break
                at = slice(start, start + STEP)
                scores = anchors[open_] @ items[at].T
                for n, m in enumerate(open_.tolist()):
                    own = scores[n]
                    if own.dtype == object:
                        own = np.array([min(max(x, LOW), HIGH) for x in own], np.int64)
                    some = (labels[at] == a_label[m]) == same_label
                    some &= ~((ids[at] == a_id[m]) & (marks[at] == a_mark[m])) & (own >= floors[m])
                    if not some.any():
                        continue
                    score, vec = own[some].astype(np.int64), ids[at][some]
                    for g, (low, high, floor) in goals[m].items():
                        fits = (score >= max(low, floor)) & (score <= high)
                        if not fits.any():
                            continue
                        s = np.concatenate([kept[m][g][0], score[fits]])
                        v = np.concatenate([kept[m][g][1], vec[fits]])
                        best = np.lexsort((v, -s.astype(object) if s.min() == LOW else -s))[:k]
                        kept[m][g] = s[best], v[best]
                        if len(best) == k:
                            goals[m][g] = low, high, max(floor, int(s[best[-1]]))
                    floors[m] = min(g[2] for g in goals[m].values())
            for m, own in enumerate(kept):
                for g, (s, v) in own.items():
                    found += [(a_id[m], a_mark[m], g, int(y), int(x)) for x, y in zip(s, v)]
        columns = list(zip(*found)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)],
                        ["anchor_id", "anchor_mark", "goal", "vec_id", "score"])
    return walk


def _walk(rows: DataFrame, members: DataFrame, goals: DataFrame, lists: Lists,
          sample: np.ndarray, total: int, k: int, same_label: bool) -> DataFrame:
    """(anchor_id, anchor_mark, goal, vec_id, score, rank): the k best rows of each goal (low,
    high) of each member, over all segments of the lists."""
    key = ["anchor_id", "anchor_mark", "goal"]
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id")
    bounds = lists.bounds(sample)
    best = members.sparkSession.createDataFrame([], f"{FOUND}, rank int")
    for number in range(lists.cuts.shape[1] + 1):
        reached = best.groupBy(*key).agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
        now = goals.join(reached, key, "left").groupBy("anchor_id", "anchor_mark").agg(
            F.collect_list(F.struct("goal", "low", "high", F.greatest(
                "low", F.coalesce("kth", "low")).alias("floor"))).cast(GOALS).alias("goals"))
        walking = members.join(now, ["anchor_id", "anchor_mark"])
        if number:
            rest = F.element_at(F.array(*(F.lit(float(x)) for x in lists.cuts[:, number - 1])),
                                F.col("cluster") + F.when(F.col("cluster") >= 0, 1).otherwise(0))
            top = F.col("norm") * rest
            top = F.greatest(top + SLACK * (1 + F.abs(top)), F.lit(float(LOW)))
            walking = walking.filter(F.exists("goals", lambda g: g["floor"].cast("double") <= top))
        counts = {r.cluster: r["count"] for r in walking.groupBy("cluster").count().collect()}
        if not counts:
            break
        blocks = {c: -(-n // MEMBERS) for c, n in counts.items()}
        size = max(64, min(PIECE, PIECE_NUMBERS // max(1, lists.width)))
        pieces = {}
        for c in counts:
            here = np.full(len(bounds), True)
            if number:
                here &= bounds[:, c] < lists.cuts[c, number - 1]
            if number < lists.cuts.shape[1]:
                here &= bounds[:, c] >= lists.cuts[c, number]
            n = here.sum()
            share = min(1.0, (n + 3 * n ** 0.5 + 9) / max(1, len(bounds)))
            pieces[c] = max(1, -int(-share * total // size))
        width = F.element_at(F.create_map(*(F.lit(x) for i in blocks.items() for x in i)),
                             F.col("cluster"))
        each = F.element_at(F.create_map(*(F.lit(x) for i in pieces.items() for x in i)),
                            F.col("cluster"))
        dealt = walking.withColumn("block", F.pmod(F.xxhash64("anchor_id", "anchor_mark"), width)
                                   .cast("int")).withColumn(
            "piece", F.explode(F.sequence(F.lit(0), each - 1)))
        group = ["width", "cluster", "block", "piece"]
        found = dealt.groupBy(*group).cogroup(
            _segment(rows, lists, number, blocks, pieces).groupBy(*group)).applyInArrow(
            walker(k, same_label), FOUND)
        best = saved(best.drop("rank").union(found).withColumn("rank", F.row_number().over(order))
                     .filter(F.col("rank") <= k), "best")
    return best


def mine(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100, clusters: int = CLUSTERS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` are (vec_id, label, embedding). Anchors are the rows whose vec_id is divisible
    by ``every``. The positives of an anchor are its ``positives`` best other rows of the same
    label, by inner product and then smaller vec_id; for each, ``rank`` counts the best rows of
    other labels with ``low`` * positive_score <= 100 * negative_score <= ``high`` *
    positive_score. Fewer where there are fewer; no row where there is none.

    Rows with a null vec_id, label or vector, with null or non-finite components or without
    components take no part, the same row twice counts once, and vectors meet only those with
    as many components. Where rows of different content share a vec_id, each is a row of its
    own. Scores beyond 64 bits are held at the limit. Other columns are not looked at.
    """
    rows = saved(rows_of(vectors), "vectors")
    anchors = rows.filter(F.col("vec_id") % every == 0)
    total = rows.count()
    lists, sample = _fit(rows, anchors, clusters)
    members = saved(_members(anchors, lists), "anchors").withColumnsRenamed(
        {"vec_id": "anchor_id", "mark": "anchor_mark"})
    for r in members.groupBy("cluster").agg(F.max("angle").alias("angle")).collect():
        if r.cluster != NO_CENTRE:
            lists.radii[r.cluster] = r.angle
    bounds = lists.bounds(sample)
    lists.cuts = np.array([[np.quantile(own, 1 - s) if len(own) else 0.0 for s in SEGMENTS]
                           for own in bounds.T])
    key = ["anchor_id", "anchor_mark"]
    whole = members.select(*key, F.lit(0).alias("goal"), F.lit(LOW).alias("low"),
                           F.lit(HIGH).alias("high"))
    near = _walk(rows, members, whole, lists, sample, total, positives, True).select(
        *key, F.col("rank").alias("goal"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"))
    wide = F.col("positive_score").cast("decimal(38,0)")
    window = near.select(*key, "goal", F.ceil(wide * low / 100).cast("long").alias("low"),
                         F.floor(wide * high / 100).cast("long").alias("high")).filter("low <= high")
    hard = _walk(rows, members, window, lists, sample, total, negatives, False)
    return hard.join(near, [*key, "goal"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
