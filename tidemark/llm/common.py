"""Small helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not use yet, whatever extra columns it has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def whole_text(text: Column) -> Column:
    """Null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Identity of a row by id and text; equal rows share it, null ids and texts have one too."""
    return F.md5(F.concat_ws("\x01", F.coalesce(col(doc_id).cast("string"), F.lit("-")), whole_text(col(text))))


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage through Parquet in the shared folder, which outlives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batches_of(items: Iterator, weight, limit: int) -> Iterator[list]:
    """Group items until their summed weight passes `limit`; one item may pass it alone."""
    held, total = [], 0
    for item in items:
        held.append(item)
        total += weight(item)
        if total >= limit:
            yield held
            held, total = [], 0
    if held:
        yield held
