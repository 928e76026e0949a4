"""Hard negatives against plain loops, on odd rows and with many small groups."""

import math
import random

import numpy as np
import pytest

from orderpulse.llm import negatives

VECTORS = "vec_id long, embedding array<double>, label int, cluster string, bound double"


def plain(rows, every, low=80, high=100, k=5):
    """All inner products, sorted."""
    fine = {(i, tuple(math.floor(256 * x) for x in v), label) for i, v, label in rows
            if None not in (i, v, label) and v and all(x is not None and math.isfinite(x) for x in v)}
    limit = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    out = []
    for a in fine:
        if a[0] % every:
            continue
        scored = sorted((-limit(sum(x * y for x, y in zip(a[1], c[1]))), c[0], c[2])
                        for c in fine if c != a and len(c[1]) == len(a[1]))
        for p, p_id, _ in [s for s in scored if s[2] == a[2]][:k]:
            fits = [s for s in scored if s[2] != a[2] and -low * p <= -100 * s[0] <= -high * p]
            out += [(a[0], p_id, n + 1, s[1], -p, -s[0]) for n, s in enumerate(fits[:k])]
    return sorted(out)


def odd_rows():
    rng = random.Random(11)
    rows = [(i, [rng.gauss(0, 1) + (i % 3) * (d == 0) for d in range(6)], rng.randrange(3))
            for i in range(160)]
    same = [0.5, 0.25, 0.0, 1.0, 0.5, 0.5]
    rows += [(200 + i, same, i % 2) for i in range(90)]            # one vector in many rows
    rows += [(300 + i, [0.0] * 6, i % 2) for i in range(12)]       # no direction
    rows += [(400 + i, [1.0, float(i)], i % 2) for i in range(12)]  # another width
    rows += [(500, [1e30] * 6, 0), (501, [1e30] * 6, 1), (510, [-1e30] * 6, 0)]
    rows += [rows[0], rows[10], (10, [1.0] * 6, 1), (10, [1.0] * 6, 2)]  # repeated row, shared id
    rows += [(None, same, 1), (600, None, 1), (610, same, None), (620, [], 1),
             (630, [None] * 6, 1), (640, [math.nan] * 6, 1), (650, [math.inf] * 6, 1)]
    return rows


@pytest.mark.parametrize("members, piece, clusters", [(1024, 4096, 16), (2, 64, 3)])
def test_as_plain_loops(spark, monkeypatch, members, piece, clusters):
    monkeypatch.setattr(negatives, "MEMBERS", members)
    monkeypatch.setattr(negatives, "PIECE", piece)
    rows = odd_rows()
    if members < 1024:  # numbers beyond 2^53 are slow and need one run only
        rows = [r for r in rows if r[0] is None or not 500 <= r[0] < 520]
    table = spark.createDataFrame([(*r, "x", 1.0) for r in rows], VECTORS)
    got = negatives.mine(table.repartition(3), every=10, clusters=clusters).collect()
    assert sorted(map(tuple, got)) == plain(rows, 10)


def test_empty_and_without_anchor(spark):
    for rows in ([], [(3, [1.0, 2.0], 1, "x", 0.0)], [(0, None, 1, "x", 0.0)]):
        found = negatives.mine(spark.createDataFrame(rows, VECTORS), every=10)
        assert found.collect() == [] and found.columns[0] == "anchor_id"


def test_bounds_hold_and_cut_walks():
    """No inner product beats the bound of a cluster, and tight clusters leave most rows out."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 16)) * 4
    rows = np.concatenate([c + rng.normal(size=(200, 16)) * 0.3 for c in centres])
    found = negatives.centres_of(rows, 4)
    lists = negatives.Lists(16, found, np.zeros(len(found)), np.zeros((len(found) + 1, 0)))
    anchors = rows[::20]
    cluster, angle = lists.nearest(anchors)
    lists.radii = np.array([angle[cluster == c].max(initial=0) for c in range(len(found))])
    bounds = lists.bounds(rows)
    length = np.linalg.norm(anchors, axis=1)
    scores = anchors @ rows.T
    top = length[:, None] * bounds[:, cluster].T
    assert (scores <= top * (1 + 1e-9) + 1e-6).all()
    tenth = np.sort(scores, 1)[:, -10][:, None]
    assert (top >= tenth).mean() < 0.5


def test_hot_vector_is_dealt_to_pieces(spark, monkeypatch):
    """A vector that most rows share does not end up in one group."""
    monkeypatch.setattr(negatives, "PIECE", 64)
    rows = [(i, [1.0, 2.0], i % 2) for i in range(1000)]
    own = negatives.rows_of(spark.createDataFrame(rows, "vec_id long, embedding array<double>, "
                                                  "label int"))
    lists = negatives.Lists(2, np.array([[1.0, 0.0]]), np.array([1.2]), np.zeros((2, 0)))
    sent = negatives._segment(own, lists, 0, {0: 2}, {0: 16})
    sizes = [r["count"] for r in sent.groupBy("block", "piece").count().collect()]
    assert len(sizes) == 32 and max(sizes) < 130 and sum(sizes) == 2000
