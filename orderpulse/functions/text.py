"""Text expressions of the file job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_envelope(path: Column, content: Column) -> Column:
    """The content in upper case between a header and a footer.

    The size is the number of characters.
    """
    # Fixed layout that results must equal.
    return F.concat(
        F.lit("\n=== PROCESSED FILE ===\nOriginal: "), path,
        F.lit("\nSize: "), F.length(content).cast("string"),
        F.lit(" bytes\n---\n"), F.upper(content),
        F.lit("\n=== END ===\n"))


def processed_key(path: Column) -> Column:
    """Every ``uploads/`` in the path becomes ``processed/``."""
    return F.replace(path, F.lit("uploads/"), F.lit("processed/"))
