"""The file job: text objects under ``uploads/`` become processed copies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderpulse.functions.text import file_envelope, processed_key


def process_files(files: DataFrame, root: str = "", plain: bool = False) -> DataFrame:
    """(path, content) to (processed_path, processed_content), row by row.

    ``root`` stands before the path in the header, e.g. ``s3://bucket/``. With
    ``plain`` the content is only put in upper case.
    """
    shown = F.concat(F.lit(root), F.col("path"))
    content = F.upper("content") if plain else file_envelope(shown, F.col("content"))
    return files.select(processed_key(F.col("path")).alias("processed_path"),
                        content.alias("processed_content"))


def files_processed(files: DataFrame) -> DataFrame:
    return files.agg(F.count(F.lit(1)).alias("files_processed"))
