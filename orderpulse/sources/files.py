"""Text objects in, processed objects out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderpulse.sources.objects import is_local, list_objects, put_objects, read_objects


def read_text_files(spark: SparkSession, root: str, prefix: str = "uploads/",
                    stream: bool = False, max_files: int | None = None) -> DataFrame:
    """Every object below ``prefix`` as (path, content); ``path`` is relative to ``root``.

    As a stream it picks up new objects, at most ``max_files`` a batch. The content
    of one object is one value, since its envelope states its length before its text.

    A bounded read of a folder in a file system is made for very many small objects: their
    names are listed in a task, not in the driver, each time the rows are asked for, and dealt
    to the tasks that read them. What Spark's reader gives no row for has none here either.
    Streams and other stores go through Spark's reader.
    """
    if not stream and is_local(spark, f"{root.rstrip('/')}/{prefix}"):
        return read_objects(list_objects(spark, root, prefix), root)
    reader = spark.readStream if stream else spark.read
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.text(f"{root.rstrip('/')}/{prefix}", wholetext=True,
                        recursiveFileLookup=True)
    # The metadata path is a URI: %-escapes are decoded, a plus sign is itself.
    uri = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    full = F.url_decode(uri)
    base = F.lit("/" + root.strip("/").split("://")[-1] + "/")
    relative = F.substring(full, F.instr(full, base) + F.length(base), F.length(full))
    return files.select(relative.alias("path"), F.col("value").alias("content"))


def write_processed_files(processed: DataFrame, path: str, objects: bool = False,
                          tasks: int | None = None) -> None:
    """Append processed files as table rows, or put each as one object at its own key.

    The table form packs many small files into few large ones. The object form puts
    ``processed/<name>`` below ``path`` (see ``objects``); ``tasks`` spreads the objects
    over that many tasks.
    """
    if not objects:
        processed.write.mode("append").parquet(path)
        return
    put_objects(processed.select(F.col("processed_path").alias("key"),
                                 F.col("processed_content").alias("content")), path, tasks)
