"""Objects at their own keys: what is put, what failures leave, what a second write does."""

import gzip
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from __spark_entry__ import queries
from orderpulse.plans.catalog import files as catalog
from orderpulse.sources import files, objects


def below(root):
    return sorted(os.path.relpath(os.path.join(folder, name), root)
                  for folder, _, names in os.walk(root) for name in names)


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), objects.COLUMNS)


def text(root, key):
    with open(f"{root}/{key}", newline="") as file:
        return file.read()


def test_each_object_at_its_key(spark, tmp_path):
    odd = {"processed/a.txt": "é\U0001f600\r\n\n", "processed/deep/er/b c+%41.txt": "z", "top": "x" * 300_000}
    objects.put_objects(rows(spark, *odd.items()), f"file://{tmp_path}", tasks=3)
    assert below(tmp_path) == sorted(odd)  # and no staging folder
    assert {key: text(tmp_path, key) for key in odd} == odd
    assert not os.path.exists(tmp_path / objects.STAGING)
    read = files.read_text_files(spark, str(tmp_path), "processed/")
    assert {r.path: r.content for r in read.collect()} == {
        k: v for k, v in odd.items() if k.startswith("processed/")}


def test_a_second_write_replaces_and_adds(spark, tmp_path):
    objects.put_objects(rows(spark, ("a", "1"), ("b", "2")), str(tmp_path))
    for _ in range(2):  # as a repeated batch does
        objects.put_objects(rows(spark, ("b", "3"), ("c", None)), str(tmp_path))
    assert {key: text(tmp_path, key) for key in below(tmp_path)} == {"a": "1", "b": "3", "c": ""}


def test_failed_writes_leave_nothing(spark, tmp_path):
    """One task fails after it has staged objects, others have put theirs: all go."""
    many = spark.range(0, 400, numPartitions=4).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"),
        F.when(F.col("id") == 399, F.raise_error(F.lit("broken"))).otherwise("text").alias("content"))
    with pytest.raises(PySparkException):
        objects.put_objects(many, str(tmp_path))
    assert below(tmp_path) == []


@pytest.mark.parametrize("key", [None, "", "/etc/x", "../x", "a/../../x", "_staging/x", "a/"])
def test_keys_stay_below_the_root(spark, tmp_path, key):
    with pytest.raises(PySparkException):
        objects.put_objects(rows(spark, ("fine", "1"), (key, "2")).coalesce(1), str(tmp_path))
    assert below(tmp_path) == []


def test_overwrite_and_other_columns_are_refused(spark, tmp_path):
    spark.dataSource.register(objects.ObjectSource)
    with pytest.raises(PySparkException):
        rows(spark, ("a", "1")).write.format(objects.FORMAT).mode("overwrite").option(
            "root", str(tmp_path)).save()
    with pytest.raises(PySparkException):
        spark.range(1).write.format(objects.FORMAT).mode("append").option(
            "root", str(tmp_path)).save()


def test_empty_write(spark, tmp_path):
    objects.put_objects(rows(spark).limit(0), str(tmp_path))
    assert below(tmp_path) == []


def test_a_read_lists_in_a_task_what_sparks_reader_lists(spark, tmp_path):
    folder = tmp_path / "uploads" / "lang=__HIVE_DEFAULT_PARTITION__" / "_a=b"
    folder.mkdir(parents=True)
    (tmp_path / "uploads" / ".hidden").mkdir()
    for name, data in (("1+%2F ü.txt", "é\r\n\n".encode()), ("empty", b""), ("_x", b"no"),
                       ("bytes", b"\xff\xfea"), (".crc", b"no"), ("big", b"x" * 6_000_000),
                       ("p.gz", gzip.compress(b"packed")), ("../../.hidden/y", b"no")):
        (folder / name).write_bytes(data)
    plain = spark.read.text(f"{tmp_path}/uploads", wholetext=True, recursiveFileLookup=True)
    for root in (str(tmp_path), f"{tmp_path}/", f"file:{tmp_path}", f"file://{tmp_path}/"):
        read = files.read_text_files(spark, root)
        assert read.inputFiles() == []  # the driver holds no names
        assert sorted(r.c for r in read.select(F.hex("content").alias("c")).collect()) == sorted(
            r.c for r in plain.select(F.hex("value").alias("c")).collect())
        assert {r.path.removeprefix("uploads/lang=__HIVE_DEFAULT_PARTITION__/_a=b/")
                for r in read.select("path").collect()} == {"1+%2F ü.txt", "bytes", "big", "p.gz"}
    assert files.read_text_files(spark, str(tmp_path), "uploads/.hidden/").count() == 1
    with pytest.raises(PySparkException):
        files.read_text_files(spark, str(tmp_path), "nothing/").count()


def test_documents_are_landed_as_objects(spark, tmp_path, monkeypatch):
    """The query puts an object per row, equal rows and odd folder names too."""
    put = []
    monkeypatch.setattr(catalog, "put_objects", lambda df, root: (
        put.append([r.key for r in df.collect()]), objects.put_objects(df, root)))
    odd = [(1, "a", "en", "s"), (1, "a", "en", "s"), (1, None, "en", "s"), (None, "", None, "s"),
           (None, "", "", "s"), (2, "z", 'a/b%"=\x01', ""), (2, "b", 'a/b%"=\x01', "")]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.folder, r.objects, r.characters)
           for r in queries()["read_text_files"](spark, str(tmp_path)).collect()}
    docs.withColumnRenamed("text", "value").select("lang", "source", "value").write.option(
        "maxRecordsPerFile", 1).partitionBy("lang", "source").text(f"{tmp_path}/w/uploads")
    plain = spark.read.text(f"{tmp_path}/w/uploads", wholetext=True, recursiveFileLookup=True)
    at = F.regexp_extract(F.url_decode("_metadata.file_path"), "uploads/[^/]*/[^/]*", 0)
    assert got == {tuple(r) for r in plain.groupBy(at).agg(
        F.count("value"), F.sum(F.length("value"))).collect()}
    assert [len(keys) for keys in put] == [len(set(put[0]))] == [len(odd)]
