"""What the text operators share: word rules, held-out folds, keys of documents and ranks that survive hot groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskmart.session import staged

#: Lower-cases A-Z and nothing else, on UTF-8 bytes.
ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def fold(doc_id: str, modulus: int) -> Column:
    """``crc32(doc_id as text) mod modulus``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % modulus


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. Texts of ASCII alone take the byte-wise ``lower``, which does the same there and faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def below_share(share: float) -> int:
    """The signed 64-bit number that a hash falls below with this probability, however small; 1 and more means every hash but the last."""
    return min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63)) if share < 1 else (1 << 63) - 1


def key_columns(doc_id: str, text: str) -> tuple[Column, Column]:
    """A 128-bit key of (id, text). Rows equal in both are one document."""
    t = F.coalesce(F.col(text), F.lit(""))
    return F.xxhash64(F.col(doc_id).cast("string"), F.lit("|"), F.col(text)), F.crc32(t) * F.lit(1 << 31) + F.octet_length(t)


def with_key(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Adds ``__k1, __k2``, the columns of :func:`key_columns`."""
    return df.withColumns(dict(zip(("__k1", "__k2"), key_columns(doc_id, text))))


def ranked(df: DataFrame, group: list[str], name: str, order: list[str], rows_each: int = 200_000) -> DataFrame:
    """``df`` staged, with ``name``: 0, 1, 2 ... inside each group by ``order``, however large a group is.

    The rows are range-partitioned by (group, order), staged with the number of their range, and ranked inside (range, group); what
    earlier ranges hold of the group is added from a table of one row per (range, group). No task gets more than a range.
    Equal rows may swap ranks; all else is fixed. The column names ``_range`` and ``_before`` are used up on the way.
    """
    keys = [*group, *order]
    parts = max(1, -(-df.count() // rows_each)) if rows_each else 1
    at = staged(df.repartitionByRange(parts, *keys).withColumn("_range", F.spark_partition_id()), "ranked")
    per = at.groupBy("_range", *group).agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_range", *[F.col(c).alias(f"_g_{c}") for c in group],
                     F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range", *group).orderBy(*order))
    out = at.withColumn(name, inside.cast("long"))
    same = out["_range"] == per["_range"]
    for c in group:
        same = same & out[c].eqNullSafe(per[f"_g_{c}"])
    return (out.join(per, same, "left").select(*[out[c] for c in df.columns], (F.col(name) - 1 + F.col("_before")).alias(name)))
