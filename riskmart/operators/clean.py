"""Cleaning of raw tables: text, numbers, dates, categories.

Decisions about whole columns (convert or not, drop or not) come from one aggregate over the table; the change itself
is an expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.functions.expr import has_token, is_blank, null_apart, numeric_columns, round_even, string_columns
from riskmart.functions.moments import correlations, is_beyond
from riskmart.functions.stats import modes, null_rates, order_statistics, small_domains
from riskmart.functions.uniform import uniform
from riskmart.operators.keys import rank_within
from riskmart.session import settle
from riskmart.sources.staging import parse_timestamp

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
NOT_SPECIFIED = "Not Specified"

# Fixed values: (months, days) per unit; words that mark a duration column; units in text.
DURATION_FACTORS = {
    "year": (12, 365), "yr": (12, 365), "years": (12, 365), "month": (1, 30.4), "months": (1, 30.4), "mo": (1, 30.4),
    "week": (0.25, 7), "weeks": (0.25, 7), "wk": (0.25, 7), "day": (0.0329, 1), "days": (0.0329, 1), "d": (0.0329, 1),
}
DURATION_NAMES = ("duration", "period", "term", "history", "age", "time")
# Names never normalised, names converted to whole numbers, words that mean yes.
NOT_NORMALISED = ("id", "count", "num_", "flag", "indicator", "binary")
INTEGER_NAMES = ("num_", "number", "count", "_id", "age", "delayed")
POSITIVE = (
    "employed", "self-employed", "yes", "y", "true", "t", "1", "positive", "pos", "p", "success", "pass", "approved", "high", "active",
    "available", "present", "completed", "achieved", "confirmed", "valid", "succeeded", "done", "in_use", "in_service", "on_time",
    "on_schedule", "in_stock", "in_progress", "in_transit",
)
# Balance column -> type it proves.
BALANCE_TYPES = (("AutoLoanBalance", "Auto"), ("StudentLoanBalance", "Student"), ("PersonalLoanBalance", "Personal"), ("MortgageBalance", "Mortgage"))


# --- text ----------------------------------------------------------------------------------------------------------

def dedupe_column_names(cols: Sequence[str]) -> list[str]:
    """The second ``x`` becomes ``x_1``, the third ``x_2``."""
    seen: dict[str, int] = {}
    out = []
    for c in cols:
        seen[c] = seen.get(c, -1) + 1
        out.append(c if seen[c] == 0 else f"{c}_{seen[c]}")
    return out


def clean_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Remove underscores from text columns that have any; values with a character outside printable ASCII become NULL."""
    changes = {}
    for c in cols if cols is not None else string_columns(df):
        v = F.col(c)
        changes[c] = F.when(~v.rlike(r"[^\x20-\x7E]"), F.replace(v, F.lit("_"), F.lit("")))
    return df.withColumns(changes)


def to_number(c: str | Column) -> Column:
    """Number in a text, NULL if it is none."""
    v = F.col(c) if isinstance(c, str) else c
    return F.when(v.rlike(NUMBER), F.trim(v).try_cast("double"))


def infer_numeric(df: DataFrame, min_share: float = 0.5, cols: Sequence[str] | None = None) -> DataFrame:
    """Text columns in which at least ``min_share`` of the rows are numbers become numeric."""
    cols = list(cols if cols is not None else string_columns(df))
    if not cols:
        return df
    row = df.agg(F.count("*").alias("n"), *[F.count(to_number(c)).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    chosen = [c for i, c in enumerate(cols) if row["n"] and row[f"c{i}"] >= min_share * row["n"]]
    return df.withColumns({c: to_number(c) for c in chosen})


# --- dates ---------------------------------------------------------------------------------------------------------

def parse_dates(df: DataFrame, min_share: float = 0.5) -> DataFrame:
    """Text columns named *date* or *time* become timestamps when more than ``min_share`` of the rows can be read."""
    cols = [c for c in string_columns(df) if has_token(c, ("date", "time"))]
    if not cols:
        return df
    row = df.agg(F.count("*").alias("n"), *[F.count(parse_timestamp(F.col(c))).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    return df.withColumns({c: parse_timestamp(F.col(c)) for i, c in enumerate(cols) if row[f"c{i}"] > min_share * row["n"]})


def duration(text: Column, days: bool) -> Column:
    """Months (or days) in a text such as '2 Years and 3 Months', rounded half to even; NULL when it names no duration."""
    low = F.lower(text)
    units = "|".join(("year", "yr", "years", "month", "months", "mo", "week", "weeks", "wk", "day", "days", "d"))
    pattern = rf"(\d+)\s*({units})"
    amounts = F.regexp_extract_all(low, F.lit(pattern), F.lit(1))
    names = F.regexp_extract_all(low, F.lit(pattern), F.lit(2))
    factors = F.create_map(*[F.lit(x) for unit, f in DURATION_FACTORS.items() for x in (unit, float(f[1 if days else 0]))])
    parts = F.zip_with(amounts, names, lambda n, u: n.cast("double") * factors[u])
    total = F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)
    return F.when(F.size(amounts) > 0, F.rint(total).cast("bigint"))


def parse_durations(df: DataFrame) -> DataFrame:
    """Duration texts become numbers and the column is renamed with its unit.

    Days when the name says day, otherwise the unit of the lowest text that mentions one. Texts without a duration stay
    as they are; a column in which every text is a duration becomes a whole number.
    """
    cols = [c for c in string_columns(df) if has_token(c, DURATION_NAMES)]
    if not cols:
        return df
    aggs = []
    for i, c in enumerate(cols):
        low, hit = F.lower(F.col(c)), duration(F.col(c), False).isNotNull()
        aggs += [F.min(F.when(low.rlike("day|month|year"), low)).alias(f"u{i}"), F.count_if(hit).alias(f"h{i}"),
                 F.count_if(F.col(c).isNotNull() & ~hit).alias(f"m{i}")]
    row = df.agg(*aggs).first()
    out = []
    for c in df.columns:
        if c not in cols or row[f"h{cols.index(c)}"] == 0:
            out.append(F.col(c))
            continue
        i, hint = cols.index(c), row[f"u{cols.index(c)}"]
        days = "day" in hint if hint else "day" in c.lower()
        value = duration(F.col(c), days)
        if row[f"m{i}"]:
            value = F.coalesce(value.cast("string"), F.col(c))
        suffix = "" if c.lower().endswith(("_months", "_days")) else "_Days" if days else "_Months"
        out.append(value.alias(c + suffix))
    return df.select(*out)


# --- numbers -------------------------------------------------------------------------------------------------------

def impute_binary(df: DataFrame, key: Sequence[str], seed: int = 0, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing values of two-valued numbers become one of the two values, chosen by a hash of the row key."""
    cols = list(cols if cols is not None else numeric_columns(df))
    nums = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    pairs = {c: v for c, v in small_domains(nums, cols, 2).items() if len(v) == 2}
    changes = {}
    for c, (a, b) in ((c, sorted(map(float, v))) for c, v in pairs.items()):
        pick = F.when(uniform(key, c, seed) < 0.5, F.lit(a)).otherwise(F.lit(b)).cast(df.schema[c].dataType)
        changes[c] = F.coalesce(F.col(c), pick)
    return df.withColumns(changes)


def _moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float, float]]:
    """(mean, standard deviation, bias-corrected skewness) per column."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"), F.skewness(v).alias(f"k{i}")]
    row = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(cols):
        n, skew = row[f"n{i}"], row[f"k{i}"]
        ok = n > 2 and skew is not None and skew == skew
        out[c] = (row[f"m{i}"], row[f"s{i}"] or 1.0, skew * (n * (n - 1)) ** 0.5 / (n - 2) if ok else 0.0)
    return out


def zscore_normalize(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(x - mean) / standard deviation for skewed columns (more than 1 either way); ids, counts and flags stay."""
    cols = [c for c in (cols if cols is not None else numeric_columns(df)) if not has_token(c, NOT_NORMALISED)]
    if not cols:
        return df
    return df.withColumns({
        c: (F.col(c).cast("double") - mean) / std for c, (mean, std, skew) in _moments(df, cols).items() if abs(skew) > 1})


def round_numeric(df: DataFrame, scale: int = 2) -> DataFrame:
    """Round fractional columns half to even."""
    changes = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            changes[f.name] = round_even(f.name, scale).cast(f.dataType)
        elif isinstance(f.dataType, T.DecimalType):
            changes[f.name] = F.bround(f.name, scale).cast(f.dataType)
    return df.withColumns(changes)


def float_to_int(df: DataFrame, patterns: Sequence[str] = INTEGER_NAMES) -> DataFrame:
    """Fractional columns become whole when their name says so or all their values are whole; NULL and what is no whole number becomes 0."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not cols:
        return df

    def off(c):
        whole = F.rint(c)
        return F.abs(F.col(c) - whole) > 1e-8 + 1e-5 * F.abs(whole)

    row = df.agg(*[F.count_if(off(c)).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    chosen = [c for i, c in enumerate(cols) if has_token(c, patterns) or row[f"c{i}"] == 0]
    return df.withColumns({c: F.coalesce(F.col(c).try_cast("bigint"), F.lit(0)) for c in chosen})


def drop_redundant_columns(df: DataFrame, keep: Sequence[str] = (), threshold: float = 0.95) -> DataFrame:
    """Drop numbers that equal an earlier column (NULL counts as 0) or correlate with one beyond the threshold.

    All pairs come from one scan; only the small matrix reaches the driver.
    """
    cols = [c for c in numeric_columns(df) if c not in keep]
    if len(cols) < 2:
        return df
    found = correlations(df, cols)
    return df.drop(*{b for (_, b), (same, r) in found.items() if same or is_beyond(r, threshold)})


# --- categories ----------------------------------------------------------------------------------------------------

def binarize(df: DataFrame, positive: Sequence[str] = POSITIVE) -> DataFrame:
    """Text columns of two or three values, one of them positive, become 1 for positive and 0 for the rest and NULL."""
    cols = [c for c in string_columns(df) if "name" not in c.lower()]
    filled = df.select(*[F.when(~is_blank(c), F.col(c)).alias(c) for c in cols])
    chosen = [c for c, v in small_domains(filled, cols, 3).items() if len(v) > 1 and any(x.lower() in positive for x in v)]
    return df.withColumns({c: F.when(F.lower(c).isin(*positive), 1).otherwise(0) for c in chosen})


def one_hot(df: DataFrame, max_card: int = 10, cols: Sequence[str] | None = None) -> DataFrame:
    """Text columns without commas and with at most ``max_card`` values become one 0/1 column per value."""
    cols = list(cols if cols is not None else string_columns(df))
    if not cols:
        return df
    row = df.agg(*[F.count_if(F.col(c).contains(",")).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    domains = small_domains(df, [c for i, c in enumerate(cols) if row[f"c{i}"] == 0], max_card)
    flags = [F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}") for c, values in domains.items() for v in values]
    return df.select(*[c for c in df.columns if c not in domains], *flags)


def words(text: Column) -> Column:
    """Lower-case words, cut at white space and at hyphens, underscores and slashes."""
    return F.split(F.trim(F.translate(F.lower(text), "-_/", "   ")), r"\s+")


def common_words(df: DataFrame, col: str) -> DataFrame:
    """Words over three letters at least as frequent as max(2, median + half the way to the 95th percentile of the counts)."""
    counts = df.select(F.explode(words(F.col(col))).alias("word")).filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    # Read several times below; saving one row per different word is far cheaper than cutting all texts again.
    counts = settle(counts)
    sizes, at = order_statistics(counts, {"n": lambda n: {(n - 1) // 2, n // 2, min(int(n * 0.95), n - 1)}})
    size = sizes["n"]
    if size == 0:
        return counts
    median = (at[("n", (size - 1) // 2)] + at[("n", size // 2)]) / 2
    upper = at[("n", min(int(size * 0.95), size - 1))]
    return counts.filter((F.col("n") >= max(2, int(median + (upper - median) * 0.5))) & (F.length("word") > 3))


def strip_words(text: Column, unwanted: Sequence[str]) -> Column:
    """Text without the unwanted words; unchanged when nothing would be left."""
    kept = F.filter(F.split(F.trim(text), r"\s+"), lambda w: ~F.lower(w).isin(*unwanted))
    return F.when(F.size(kept) > 0, F.array_join(kept, " ")).otherwise(text) if unwanted else text


def split_multivalue(df: DataFrame, col: str, key: str, order_by: Sequence[str], unwanted: Sequence[str] = ()) -> DataFrame:
    """Spread a list such as 'Auto, Home and Student' over the rows of its owner.

    Per owner with several rows the first non-NULL list is taken. Rows that hold a positive ``<Type>Balance`` take that
    type if the list has it, the others take what is left in row order, and rows beyond the list get 'Not Specified'.
    Ranks come from :func:`rank_within` and lists are as long as the text, so an owner with very many rows is no
    bottleneck.
    """
    proofs = [(c, kind) for c in df.columns for name, kind in BALANCE_TYPES if name in c]
    own = F.lit(None).cast("string")
    for c, kind in proofs:
        own = F.when(F.col(c) > 0, kind).otherwise(own)
    rows = df.withColumn("_own", own)
    kinds = sorted({k for _, k in proofs})
    ordered = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order_by)], F.col(col).alias("v"))
    aggs = [F.count("*").alias("_size"), F.min(F.when(F.col(col).isNotNull(), ordered))["v"].alias("_text")]
    aggs += [F.count_if(F.col("_own") == k).alias(f"_claim_{k}") for k in kinds]
    aggs += [F.max(F.greatest(F.lit(0), *[(F.col(c) > 0).cast("int") for c, x in proofs if x == k])).alias(f"_any_{k}") for k in kinds]
    owners = rows.groupBy(F.col(key).alias("_key")).agg(*aggs)
    parts = F.transform(F.split(F.regexp_replace(F.coalesce("_text", F.lit("")), " and ", ", "), ","), F.trim)
    parts = F.transform(F.filter(parts, lambda p: p != ""), lambda p: strip_words(p, unwanted))
    parts = F.filter(parts, lambda p: F.lower(p) != NOT_SPECIFIED.lower())
    proved = F.array_compact(F.array(*[F.when(F.col(f"_any_{k}") == 1, k) for k in kinds])) if kinds else F.array().cast("array<string>")
    owners = owners.withColumn("_list", F.when(F.size(parts) > 0, parts).otherwise(proved))
    claims = F.create_map(*[x for k in kinds for x in (F.lit(k), F.col(f"_claim_{k}"))]) if kinds else F.lit(None).cast("map<string,bigint>")
    # An item is taken by a claiming row when it is among the first so many of its type.
    owners = owners.withColumn("_claims", claims).withColumn("_left", F.expr(
        "transform(filter(transform(_list, (x, i) -> struct(x, size(filter(slice(_list, 1, i + 1), y -> y = x)) as nth)),"
        " s -> s.nth > coalesce(_claims[s.x], 0)), s -> s.x)"))
    owners = owners.select("_key", "_size", "_list", "_left")
    owners = owners.withColumn("_key", F.col("_key").cast("string"))
    joined = rows.withColumn("_apart", null_apart(key)).join(owners, F.col("_apart") == F.col("_key"), "left")
    several = F.coalesce(F.col("_size") > 1, F.lit(False))
    single = joined.filter(~several).select(*df.columns)
    ranked = rank_within(joined.filter(several), [key, "_own"], order_by, "_nth")
    offered = F.size(F.filter("_list", lambda x: x == F.col("_own")))
    takes = F.col("_own").isNotNull() & (F.col("_nth") <= offered)
    claimed = ranked.filter(F.coalesce(takes, F.lit(False))).withColumn(col, F.col("_own")).select(*df.columns)
    rest = rank_within(ranked.filter(~F.coalesce(takes, F.lit(False))).drop("_nth"), [key], order_by, "_nth")
    rest = rest.withColumn(col, F.coalesce(F.get("_left", F.col("_nth").cast("int") - 1), F.lit(NOT_SPECIFIED))).select(*df.columns)
    return single.unionByName(claimed).unionByName(rest)


def fill_categorical(df: DataFrame, key: str | None, order_by: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Blank text takes the owner's first non-blank value, then the most frequent value (not in id columns).

    All columns share one aggregate per owner and one join back.
    """
    cols = [c for c in (cols if cols is not None else string_columns(df)) if c != key]
    common = modes(df.select(*[F.when(~is_blank(c), F.col(c)).alias(c) for c in cols]), [c for c in cols if "id" not in c.lower()])
    out, joined = {}, df
    if key is not None:
        def first(c):
            order = [F.col(o).alias(f"_o{i}") for i, o in enumerate(order_by)]
            return F.min(F.when(~is_blank(c), F.struct(*order, F.col(c).alias("v"))))["v"].alias(f"_f_{c}")

        firsts = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(*[first(c) for c in cols])
        firsts = firsts.withColumn("_key", F.col("_key").cast("string"))
        joined = df.withColumn("_apart", null_apart(key)).join(firsts, F.col("_apart") == F.col("_key"), "left")
    for c in cols:
        options = [F.when(~is_blank(c), F.col(c))]
        if key is not None:
            options.append(F.col(f"_f_{c}"))
        if common.get(c) is not None:
            options.append(F.lit(common[c]))
        out[c] = F.coalesce(*options, F.col(c))
    return joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in df.columns])


# --- final ---------------------------------------------------------------------------------------------------------

def cleanup(df: DataFrame, max_missing: float = 0.5) -> DataFrame:
    """Drop rows with too few values, exact copies, then columns with too many NULL."""
    rows = df.dropna(thresh=int(len(df.columns) * (1 - max_missing))).dropDuplicates()
    shares = null_rates(rows)
    return rows.select(*[c for c in rows.columns if shares[c] < max_missing])
