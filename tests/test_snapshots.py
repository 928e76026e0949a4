"""The keyed table with snapshots: upserts, folds beside writers, repeated batches, old readers."""

import threading

import pytest
from pyspark.sql.types import LongType, StringType, StructType

from orderpulse.sources.snapshots import Manifest, Snapshots

SCHEMA = StructType().add("id", StringType()).add("n", LongType())


@pytest.fixture
def made(spark, tmp_path):
    return Snapshots(spark, str(tmp_path), SCHEMA, "id", buckets=8)


def rows(spark, **values):
    return spark.createDataFrame(list(values.items()), SCHEMA)


def content(df):
    return {r.id: r.n for r in df.collect()}


def test_puts_folds_and_lookups(spark, made):
    assert content(made.read()) == {} and made.fold() == Manifest()
    made.put(rows(spark, a=1, b=1, c=1))
    made.put(rows(spark, b=2))
    assert content(made.read()) == {"a": 1, "b": 2, "c": 1}
    before = made.manifest()
    folded = made.fold()
    assert folded.deltas == [] and content(made.read()) == {"a": 1, "b": 2, "c": 1}
    made.put(rows(spark, c=3, d=3))
    assert content(made.read()) == {"a": 1, "b": 2, "c": 3, "d": 3}
    for key, n in {"a": 1, "b": 2, "c": 3, "d": 3}.items():
        assert content(made.lookup(key)) == {key: n}
    assert content(made.lookup("e")) == {}
    # Older states stay readable.
    assert content(made.read(before.version)) == {"a": 1, "b": 2, "c": 1}
    assert content(made.read(0)) == {"a": 1, "b": 1, "c": 1}


def test_a_fold_writes_the_touched_buckets_only(spark, made):
    made.put(spark.range(400).selectExpr("cast(id as string) id", "id n"))
    base = made.fold().base
    made.put(rows(spark, **{"7": -7}))
    after = made.fold().base
    assert len(base) == 8 and sum(base[b] != after[b] for b in base) == 1
    assert content(made.read()) == {str(i): -7 if i == 7 else i for i in range(400)}


def test_a_repeated_batch_counts_once(spark, made):
    assert made.put(rows(spark, a=1), "s", 0) and made.put(rows(spark, a=2), "s", 1)
    assert not made.put(rows(spark, a=1), "s", 0) and not made.put(rows(spark, a=9), "s", 1)
    assert made.put(rows(spark, b=5), "other", 0)
    made.fold()
    assert not made.put(rows(spark, a=9), "s", 1)
    assert content(made.read()) == {"a": 2, "b": 5}


def test_puts_while_a_fold_works_stay_open(spark, made, monkeypatch):
    made.put(rows(spark, a=1, b=1))
    change = made._change

    def late(step):
        # Another writer is faster than the manifest of the fold.
        monkeypatch.setattr(made, "_change", change)
        made.put(rows(spark, b=2, c=2))
        return change(step)

    monkeypatch.setattr(made, "_change", late)
    folded = made.fold()
    assert len(folded.deltas) == 1
    assert content(made.read()) == {"a": 1, "b": 2, "c": 2}
    made.fold()
    assert content(made.read()) == {"a": 1, "b": 2, "c": 2}


def test_writers_at_once_lose_nothing(spark, made):
    def put(n):
        for k in range(3):
            made.put(rows(spark, **{f"{n}-{k}": n}))

    threads = [threading.Thread(target=put, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for _ in range(3):
        made.fold()
    for t in threads:
        t.join()
    want = {f"{n}-{k}": n for n in range(4) for k in range(3)}
    assert content(made.read()) == want
    made.fold()
    assert content(made.read()) == want


def test_two_folds_do_not_mix(spark, made, monkeypatch):
    made.put(rows(spark, a=1))
    change = made._change

    def late(step):
        monkeypatch.setattr(made, "_change", change)
        made.fold()
        return change(step)

    monkeypatch.setattr(made, "_change", late)
    with pytest.raises(RuntimeError):
        made.fold()
    assert content(made.read()) == {"a": 1}


def test_null_keys_and_vacuum(spark, made):
    made.put(spark.createDataFrame([(None, 1), ("a", 1)], SCHEMA))
    made.fold()
    made.put(rows(spark, a=2))
    made.fold()
    assert made.vacuum(keep=1) == 3 and content(made.read()) == {"a": 2}
    assert made.vacuum(keep=1) == 0


def test_reads_touch_base_and_open_deltas_only(spark, made):
    for n in range(5):
        made.put(rows(spark, a=n))
    made.fold()
    made.put(rows(spark, b=1))
    assert len(made.manifest().deltas) == 1
    def folders(df):
        return {f.rsplit("/", 1)[0] for f in df.inputFiles()}

    assert len(folders(made.read())) == 2 and len(folders(made.lookup("zzz"))) <= 2
