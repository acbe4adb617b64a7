"""Mapping to a target schema and conformance with its constraints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions.expr import FALSE_TOKENS, TRUE_TOKENS, clamp, null_apart, round_even
from riskmart.operators.keys import dense_key, rank_within
from riskmart.session import staged
from riskmart.sources.staging import parse_timestamp

# Columns filled by the load itself, and the words accepted as true and false.
SYSTEM_COLUMNS = ("LoadBatchID", "LoadDate", "LastUpdated", "DataSourceFile")
YES = (*TRUE_TOKENS, "enable", "enabled")
NO = (*FALSE_TOKENS, "disable", "disabled")
SUMMED = ("TotalAssets", "TotalLiabilities", "AnnualExpenses", "AnnualBonus")
AVERAGED = ("DebtToIncomeRatio", "CreditUtilizationRatio", "MonthlySavings")
HIGHEST = ("CreditScore", "AnnualIncome", "PaymentHistoryYears")


def find_source(df: DataFrame, name: str) -> str | None:
    """Column by exact, then by case-insensitive name."""
    if name in df.columns:
        return name
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def convert_type(df: DataFrame, source: str, to: T.DataType, as_of=None) -> Column:
    """One column to a target type; unreadable numbers become 0, unreadable dates ``as_of``, missing text ''."""
    v, have = F.col(source), df.schema[source].dataType
    text = v.cast("string")
    if isinstance(to, T.VarcharType):
        return F.substring(F.coalesce(text, F.lit("")), 1, to.length)
    if isinstance(to, T.StringType):
        return F.coalesce(text, F.lit(""))
    number = v.cast("double") if isinstance(have, T.NumericType) else text.try_cast("double")
    number = F.when(F.abs(number) < float("inf"), number)  # neither NaN, which compares above all, nor infinity
    if isinstance(to, T.IntegralType):
        return F.coalesce(number.try_cast(to), F.lit(0).cast(to))
    if isinstance(to, (T.DecimalType, T.DoubleType, T.FloatType)):
        out = F.coalesce(number, F.lit(0.0))
        if isinstance(to, T.DecimalType):
            out = round_even(out, to.scale)
        out = round_even(out, 2) if "ratio" in source.lower() else out
        return F.coalesce(out.try_cast(to), F.lit(0).cast(to))
    if isinstance(to, (T.DateType, T.TimestampType)):
        if source == "report_date":
            parsed = F.try_to_date(F.concat(number.try_cast("int").cast("string"), F.lit("-01-01")), "y-MM-dd").cast("timestamp")
        elif isinstance(have, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            parsed = v.cast("timestamp")
        else:
            parsed = parse_timestamp(text)
        return F.coalesce(parsed, F.lit(as_of).cast("timestamp")).cast(to)
    if isinstance(to, T.BooleanType):
        if isinstance(have, T.BooleanType):
            return F.coalesce(v, F.lit(False))
        if isinstance(have, T.NumericType):
            return F.coalesce(v != 0, F.lit(False))
        token = F.lower(F.trim(text))
        return F.when(token.isNull() | token.isin(*NO) | (token == ""), False).otherwise(True)
    raise TypeError(f"no conversion to {to.simpleString()}")


def map_to_schema(df: DataFrame, schema: T.StructType, mapping: Mapping[str, str], as_of=None) -> tuple[DataFrame, list[str]]:
    """(table with exactly the target columns, names of the target columns left NULL for generation)."""
    cols, absent = [], []
    for f in schema.fields:
        if f.name in SYSTEM_COLUMNS:
            continue
        source = find_source(df, mapping[f.name]) if f.name in mapping else None
        if source is None:
            absent.append(f.name)
            target = T.StringType() if isinstance(f.dataType, T.VarcharType) else f.dataType
            cols.append(F.lit(None).cast(target).alias(f.name))
        else:
            cols.append(convert_type(df, source, f.dataType, as_of).alias(f.name))
    return df.select(*cols), absent


def shared_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col, value, code): the distinct values of columns of one type, numbered from 1 within each column (its place in ``cols``) in their order.

    One shuffle finds the values of all columns; one range partition over (col, value) numbers them, and the least number of a column
    is taken off. NULL has no code.
    """
    cells = [F.struct(F.lit(i).alias("col"), F.col(f"`{c}`").alias("value")) for i, c in enumerate(cols)]
    values = df.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*").where("value IS NOT NULL").distinct()
    placed = dense_key(values, ["col", "value"], "_nth")
    first = placed.groupBy("col").agg(F.min("_nth").alias("_first"))  # one row per column
    return placed.join(F.broadcast(first), "col").select("col", "value", (F.col("_nth") - F.col("_first") + 1).alias("code"))


def ids_to_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace ids by dense integers, one per distinct id of a column in the order of its type; a missing id becomes 0.

    Columns of one type share a dictionary. Several of them are looked up together: (row, column, value) is joined with the dictionary once, the codes
    of a row are put together, and the rows take them by number, so wide rows cross one shuffle whatever the number of columns.
    """
    by_type: dict[str, list[str]] = {}
    for c in dict.fromkeys(cols):
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    for same in by_type.values():
        df = _encoded(df, same)
    return df


def _encoded(df: DataFrame, cols: list[str]) -> DataFrame:
    if len(cols) == 1:
        codes = shared_dictionary(df, cols).select(F.col("value").cast("string").alias("_id"), F.col("code").alias("_int"))
        keep = [F.coalesce("_int", F.lit(0)).alias(x) if x == cols[0] else F.col(f"`{x}`") for x in df.columns]
        return df.withColumn("_apart", null_apart(f"`{cols[0]}`")).join(codes, F.col("_apart") == F.col("_id"), "left").select(*keep)
    # staged: the numbers of the rows must be the same in every pass, and each pass reads its columns only
    rows = staged(df.withColumn("_row", F.monotonically_increasing_id()), "rows-to-encode")
    names = [F.struct(F.lit(i).alias("col"), F.col(f"`{c}`").alias("value")) for i, c in enumerate(cols)]
    cells = rows.select("_row", F.explode(F.array(*names)).alias("_c")).select("_row", "_c.*").where("value IS NOT NULL")
    found = cells.join(shared_dictionary(rows, cols), ["col", "value"]).groupBy("_row").agg(
        *[F.max(F.when(F.col("col") == i, F.col("code"))).alias(f"_code{i}") for i in range(len(cols))])
    keep = [F.coalesce(f"_code{cols.index(x)}", F.lit(0)).alias(x) if x in cols else F.col(f"`{x}`") for x in df.columns]
    return rows.join(found, "_row", "left").select(*keep)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """First row of each key in a stated order (a map-side combined minimum, no window)."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)], F.struct(*rest).alias("_r")))
    return df.groupBy(*keys).agg(pick.alias("_p")).select(*[F.col(c) if c in keys else F.col(f"_p._r.{c}").alias(c) for c in df.columns])


def conform_constraints(df: DataFrame, dataset: str, schema: T.StructType, order_by: Sequence[str] = ()) -> DataFrame:
    """Round to the target scale, whole GDP, one macro row per day and country, loan rates within 0 and 30."""
    changes = {}
    for f in schema.fields:
        if f.name in df.columns and isinstance(df.schema[f.name].dataType, T.NumericType):
            if isinstance(f.dataType, T.DecimalType):
                changes[f.name] = round_even(F.col(f.name).cast("double"), f.dataType.scale)
            if f.name == "GDP":
                changes[f.name] = round_even(F.col(f.name).cast("double")).cast("bigint")
    if dataset == "Loan" and "InterestRate" in df.columns:
        changes["InterestRate"] = clamp(changes.get("InterestRate", F.col("InterestRate").cast("double")), 0, 30)
    df = df.withColumns(changes)
    if dataset == "Macro" and {"ReportDate", "CountryName"} <= set(df.columns):
        rest = [c for c in df.columns if c not in ("ReportDate", "CountryName")]
        df = first_per_key(df, ["ReportDate", "CountryName"], order_by or rest)
    return df


def suffix_duplicate_ids(df: DataFrame, col: str, order_by: Sequence[str]) -> DataFrame:
    """The second and later rows of an id get ``_01``, ``_02``, ... in a stated order."""
    ranked = rank_within(df, [col], order_by, "_rn")
    n = (F.col("_rn") - 1).cast("string")
    suffix = F.when(F.length(n) < 2, F.lpad(n, 2, "0")).otherwise(n)
    return ranked.withColumn(col, F.when(F.col("_rn") > 1, F.concat(F.col(col), F.lit("_"), suffix)).otherwise(F.col(col))).drop("_rn")


def aggregate_customer_snapshot(df: DataFrame, key: str, date_col: str, order_by: Sequence[str]) -> DataFrame:
    """One row per customer and date: sums, means and maxima of the money columns, first non-NULL value of the rest."""
    aggs = []
    for c in df.columns:
        if c in (key, date_col):
            continue
        v = F.col(c)
        if c in SUMMED:
            aggs.append(F.sum(v).alias(c))
        elif c in AVERAGED:
            aggs.append(F.avg(v.cast("double")).alias(c))
        elif c in HIGHEST:
            aggs.append(F.max(v).alias(c))
        else:
            firsts = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order_by)], v.alias("_v"))
            aggs.append(F.min(F.when(v.isNotNull(), firsts))["_v"].alias(c))
    return df.groupBy(key, date_col).agg(*aggs)
