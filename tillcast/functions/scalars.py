"""Column-level helpers (B5-B7, B10-B16, B21-B22, H1-H10). All JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.schemas import MARKDOWNS


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- ingest casts -------------------------------------------------------------

def normalise_name(name: str) -> str:
    """B1: strip, lower case, spaces to underscores."""
    return name.strip().lower().replace(" ", "_")


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_name(c) for c in df.columns])


def try_cast(c, to: str) -> Column:
    """H8: cast that yields null on bad input (ANSI mode raises otherwise)."""
    return F.expr(f"try_cast({c} AS {to})") if isinstance(c, str) else c.try_cast(to)


def parse_date(c) -> Column:
    """Yyyy-MM-dd, null when unparsable."""
    return F.try_to_date(col_(c), "yyyy-MM-dd")


def to_bool(c) -> Column:
    """Null stays null; true/false in any case, 1/0 and other boolean spellings
    via try_cast; anything else null."""
    return col_(c).cast("string").try_cast("boolean")


def first_char(c) -> Column:
    """B7"""
    return F.substring(col_(c).cast("string"), 1, 1)


# -- sales handling -------------------------------------------------------------

def clip_at_zero(c, dtype: str = "double") -> Column:
    """Negatives to 0, null stays null (pandas clip keeps NaN)."""
    c = col_(c)
    return F.when(c < 0, F.lit(0).cast(dtype)).otherwise(c)


def handle_negative_sales(df: DataFrame, strategy: str = "clip", col: str = "weekly_sales") -> DataFrame:
    """B10-B12."""
    if strategy == "clip":
        return df.withColumn(col, clip_at_zero(col, df.schema[col].dataType.simpleString()))
    if strategy == "flag":
        return df.withColumn("is_return", F.coalesce((F.col(col) < 0).cast("int"), F.lit(0)))
    if strategy == "keep":
        return df
    raise ValueError(f"unknown negative sales strategy: {strategy}")


def add_markdown_features(df: DataFrame) -> DataFrame:
    """Fill markdowns with 0, total, has_markdown = total > 0."""
    filled = {m: F.coalesce(F.col(m), F.lit(0).cast(df.schema[m].dataType)) for m in MARKDOWNS}
    total = sum((filled[m] for m in MARKDOWNS[1:]), filled[MARKDOWNS[0]])
    return (df.withColumns(filled)
              .withColumn("markdown_total", total)
              .withColumn("has_markdown", (F.col("markdown_total") > 0).cast("int")))


def any_markdown(prefix: str = "") -> Column:
    """EDA flavour, any of the five markdowns present."""
    return F.coalesce(*[F.col(prefix + m) for m in MARKDOWNS]).isNotNull()


# -- calendar -------------------------------------------------------------------

def add_time_features(df: DataFrame, date_col: str = "week_date") -> DataFrame:
    """H1-H2: ISO week, month, year, day of year."""
    d = F.col(date_col)
    return df.withColumns({
        "week_of_year": F.weekofyear(d),
        "month": F.month(d),
        "year": F.year(d),
        "day_of_year": F.dayofyear(d),
    })


def month_label(c) -> Column:
    """H3: yyyy-MM."""
    return F.date_format(col_(c), "yyyy-MM")


def holiday_weight(flag, weight: float = 5.0) -> Column:
    """H6: weight for holiday rows; a null flag counts as a normal week."""
    return F.when(col_(flag), F.lit(float(weight))).otherwise(F.lit(1.0))


# -- names and rounding ------------------------------------------------------------

def safe_name(c) -> Column:
    """File-safe model name: spaces, '+' and '/' to '_', brackets dropped."""
    return F.regexp_replace(F.regexp_replace(col_(c), r"[ +/]", "_"), r"[()]", "")


def round_doubles(df: DataFrame, places: int = 4, overrides: dict | None = None) -> DataFrame:
    """Round every double column; ``overrides`` gives other places per column."""
    overrides = overrides or {}
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name), overrides.get(f.name, places)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def line_digest(c) -> Column:
    """Per-line sha256."""
    return F.sha2(col_(c), 256)
