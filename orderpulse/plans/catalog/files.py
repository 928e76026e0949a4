"""The file job over all documents."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from orderpulse.functions.text import file_envelope, processed_key
from orderpulse.operators import files as op
from orderpulse.plans.catalog.common import FILES, query, with_
from orderpulse.session import fresh_path
from orderpulse.sources import files as src
from orderpulse.sources import fixtures as fx
from orderpulse.sources.objects import put_objects

# Spark and Python write a sharp s in upper case as SS.
UPPER = "upper(replace(content, 'ß', 'SS'))"
ENVELOPE = (f"chr(10) || '=== PROCESSED FILE ===' || chr(10) || 'Original: ' || path || chr(10) "
            f"|| 'Size: ' || CAST(length(content) AS VARCHAR) || ' bytes' || chr(10) || '---' "
            f"|| chr(10) || {UPPER} || chr(10) || '=== END ===' || chr(10)")
PROCESSED = "replace(path, 'uploads/', 'processed/')"


def folder(column):
    """``column=value`` as Spark's writers name the folder of a value."""
    value = F.col(column).cast("string")
    for char in '%"#\'*/:=?\\{[]^' + "".join(map(chr, [*range(1, 32), 127])):
        value = F.replace(value, F.lit(char), F.lit(f"%{ord(char):02X}"))
    named = F.coalesce(F.nullif(value, F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return F.concat(F.lit(f"{column}="), named)


@query("file_envelope", with_(FILES) + f"""
SELECT path, {ENVELOPE} AS envelope FROM files""")
def envelope(spark, d):
    return fx.text_files(spark, d).select(
        "path", file_envelope(F.col("path"), F.col("content")).alias("envelope"))


@query("processed_key", """
SELECT replace(url || '/uploads/a/uploads/b', 'uploads/', 'processed/') AS key FROM pages""")
def key(spark, d):
    path = F.concat("url", F.lit("/uploads/a/uploads/b"))
    return fx.table(spark, d, "pages").select(processed_key(path).alias("key"))


@query("process_files", with_(FILES) + f"""
SELECT {PROCESSED} AS processed_path,
       replace({ENVELOPE}, 'Original: ', 'Original: s3://bucket/') AS processed_content
FROM files""")
def process_files(spark, d):
    return op.process_files(fx.text_files(spark, d), "s3://bucket/")


@query("process_files_plain", with_(FILES) + f"""
SELECT {PROCESSED} AS processed_path, {UPPER} AS processed_content FROM files""")
def process_files_plain(spark, d):
    return op.process_files(fx.text_files(spark, d), plain=True)


@query("files_processed", "SELECT count(*) AS files_processed FROM documents")
def files_processed(spark, d):
    return op.files_processed(fx.text_files(spark, d))


@query("read_text_files", """
SELECT 'uploads/lang=' || lang || '/source=' || source AS folder, count(*) AS objects,
       CAST(sum(length(text) + 1) AS BIGINT) AS characters
FROM documents GROUP BY ALL""")
def read_text_files(spark, d):
    # One object per document, its text and a line end. Its key is made of the row itself, with
    # a number among equal ones, so that a task that runs again puts the same objects.
    root = fresh_path(spark, "objects")
    docs = (fx.table(spark, d, "documents").select(
        "doc_id", "text", F.xxhash64("text").alias("hash"),
        F.concat_ws("/", F.lit("uploads"), folder("lang"), folder("source")).alias("at"))
            .repartition(spark.sparkContext.defaultParallelism, "doc_id"))
    same = W.partitionBy("doc_id", "at", "hash").orderBy("text")
    name = F.concat_ws("-", "doc_id", F.hex("hash"), F.row_number().over(same))
    put_objects(docs.select(F.concat("at", F.lit("/"), name, F.lit(".txt")).alias("key"),
                            F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).alias("content")),
                root)
    read = src.read_text_files(spark, root)
    return read.groupBy(F.substring_index("path", "/", 3).alias("folder")).agg(
        F.count(F.lit(1)).alias("objects"),
        F.sum(F.length("content")).cast("bigint").alias("characters"))


@query("write_processed_files", with_(FILES) + f"""
SELECT {PROCESSED} AS processed_path, {ENVELOPE} AS processed_content FROM files""")
def write_processed_files(spark, d):
    path = fresh_path(spark, "processed")
    src.write_processed_files(op.process_files(fx.text_files(spark, d)), path)
    return spark.read.parquet(path)


@query("write_processed_objects", with_(FILES) + f"""
SELECT {PROCESSED} AS processed_path, {ENVELOPE} AS processed_content FROM files""")
def write_processed_objects(spark, d):
    path = fresh_path(spark, "processed")
    src.write_processed_files(op.process_files(fx.text_files(spark, d)), path, objects=True,
                              tasks=spark.sparkContext.defaultParallelism)
    # Each object is found at its own key.
    return src.read_text_files(spark, path, "processed/").select(
        F.col("path").alias("processed_path"), F.col("content").alias("processed_content"))
