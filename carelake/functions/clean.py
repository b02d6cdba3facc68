"""Cleaning and projection expressions (P01-P24), all native Column expressions.

Each helper takes and returns ``Column`` objects (or column names), so Catalyst
can fold, prune and code-generate them; none of them is a Python UDF.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Characters removed by the reference engine's trim (space, tab,
# line breaks and the no-break space), see T10.
TRIM_CHARS = " \t\n\r "


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- P01 / P16 / P17: projections ------------------------------------------------

def project(df: DataFrame, spec: Iterable[tuple[str, Column]]) -> DataFrame:
    """Select a fixed list of ``(name, expression)`` pairs."""
    return df.select(*[expr.alias(name) for name, expr in spec])


def override(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``select *`` with one column replaced (duplicate names are an error, T8)."""
    return df.withColumn(name, expr)


def derive(df: DataFrame, **exprs: Column) -> DataFrame:
    """``select *`` plus derived columns, in one projection."""
    return df.withColumns(exprs)


# --- P02-P06: text and casts ----------------------------------------------------

def clean_text(c: ColumnOrName) -> Column:
    """Trim spaces and the no-break space on both ends."""
    return F.btrim(_c(c).cast("string"), F.lit(TRIM_CHARS))


def clean_upper(c: ColumnOrName) -> Column:
    """Upper-case then trim (names, towns, codes)."""
    return clean_text(F.upper(_c(c)))


def or_default(c: ColumnOrName, value) -> Column:
    """Default for NULL."""
    return F.coalesce(_c(c), F.lit(value))


def safe_cast(c: ColumnOrName, to: str) -> Column:
    """Cast where bad input becomes NULL."""
    return _c(c).try_cast(to)


def strict_cast(c: ColumnOrName, to: str) -> Column:
    """ANSI cast; bad input fails the job."""
    return _c(c).cast(to)


def to_int(c: ColumnOrName, safe: bool = True) -> Column:
    """Number -> int with the reference's rounding.

    Text and decimals round half away from zero ('2.5' -> 3, '3.7' -> 4); the
    target engine would truncate or give NULL instead.
    """
    dec = _c(c).cast("string")
    dec = F.btrim(dec, F.lit(TRIM_CHARS))
    as_dec = dec.try_cast("decimal(38,6)") if safe else dec.cast("decimal(38,6)")
    rounded = F.round(as_dec, 0)
    return rounded.try_cast("int") if safe else rounded.cast("int")


def double_to_int(c: ColumnOrName) -> Column:
    """Double -> int rounding half to even, as the reference does for floats."""
    return F.rint(_c(c)).cast("int")


# --- P07: multi-format dates ------------------------------------------------------

ISO_DATE_RE = r"^\d{4}-\d{1,2}-\d{1,2}$"


def iso_date(c: ColumnOrName) -> Column:
    """Full ISO date only; partial dates such as '1980-05' become NULL (T4)."""
    s = F.btrim(_c(c).cast("string"), F.lit(TRIM_CHARS))
    return F.when(s.rlike(ISO_DATE_RE), s.try_cast("date"))


def parse_date_any(c: ColumnOrName,
                   formats: Iterable[str] = ("M/d/yyyy", "d/M/yyyy")) -> Column:
    """First successful parse wins: month-first, then day-first, then ISO.

    Returns a TIMESTAMP like the reference (T2). Input is trimmed first; 2-digit
    years stay NULL (documented deviation, T11). A text without the format's slash
    is not parsed: each failed parse costs an exception.
    """
    s = F.btrim(_c(c).cast("string"), F.lit(TRIM_CHARS))
    parsed = [F.when(s.contains("/"), F.try_to_timestamp(s, F.lit(fmt))) if "/" in fmt and "'" not in fmt and "[" not in fmt
              else F.try_to_timestamp(s, F.lit(fmt)) for fmt in formats]
    parsed.append(iso_date(s).cast("timestamp"))
    return F.coalesce(*parsed)


# --- P08: decimal comma -------------------------------------------------------------

def parse_decimal_comma(c: ColumnOrName, safe: bool = False) -> Column:
    """P08: '75,5' -> 75.5. Strict by default like the reference."""
    s = F.replace(_c(c).cast("string"), F.lit(","), F.lit("."))
    return s.try_cast("double") if safe else s.cast("double")


# --- P09 / P10: date arithmetic ---------------------------------------------------

def _mmdd(d: Column) -> Column:
    return F.month(d) * 100 + F.dayofmonth(d)


def age_years(end: ColumnOrName, start: ColumnOrName) -> Column:
    """Whole years from ``start`` to ``end``, sign-aware (T5).

    For end >= start: year difference minus one when the anniversary is not
    reached yet; otherwise the negated age the other way round. Not
    ``months_between`` (which rounds differently around month ends).
    """
    e, s = _c(end).cast("date"), _c(start).cast("date")
    fwd = F.year(e) - F.year(s) - F.when(_mmdd(e) < _mmdd(s), 1).otherwise(0)
    back = F.year(s) - F.year(e) - F.when(_mmdd(s) < _mmdd(e), 1).otherwise(0)
    return F.when(e >= s, fwd).otherwise(-back).cast("int")


def seconds_of_day(c: ColumnOrName, safe: bool = False) -> Column:
    """'HH:mm:ss' -> seconds since midnight (TIME stays a string, T6)."""
    s = F.btrim(_c(c).cast("string"), F.lit(TRIM_CHARS))
    ts = F.try_to_timestamp(s, F.lit("H:m:s")) if safe else F.to_timestamp(s, "H:m:s")
    return (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("int")


def duration_minutes(start: ColumnOrName, end: ColumnOrName) -> Column:
    """P10: whole minutes between two clock times, truncated toward zero.

    Crossing midnight gives a negative duration (T7): 23:50:30 -> 09:15:00 = -875.
    """
    diff = seconds_of_day(end) - seconds_of_day(start)
    # double -> int casts truncate toward zero: -875.5 -> -875
    return (diff / 60).cast("int")


# --- P11-P13: codes -----------------------------------------------------------------

def code_category(c: ColumnOrName, n: int = 3) -> Column:
    """Code prefix (ICD-10 three-character category)."""
    return F.substring(_c(c), 1, n)


def departement(postal: ColumnOrName, trim: bool = True) -> Column:
    """French department from a postal code; Corsica splits 2A / 2B.

    '20xxx' with third digit < 2 is 2A; any other third character (even a
    non-digit) is 2B. Codes shorter than 2 characters give NULL.
    """
    cp = clean_text(postal) if trim else _c(postal)
    third = F.substring(cp, 3, 1).try_cast("int")
    corsica = F.when(third < 2, F.lit("2A")).otherwise(F.lit("2B"))
    return (F.when((F.substring(cp, 1, 2) == "20") & (F.length(cp) >= 3), corsica)
             .when(F.length(cp) >= 2, F.substring(cp, 1, 2)))


def iso2_country(c: ColumnOrName) -> Column:
    """Country label -> ISO-2 ('France' variants -> FR, else first 2 chars)."""
    col = _c(c)
    return (F.when(col.isin("France", "FR", "FRANCE"), F.lit("FR"))
             .when(col.isNotNull(), F.left(col, F.lit(2)))
             .otherwise(F.lit("FR")))


# --- P14, P15, P18-P24 -----------------------------------------------------------------

def with_const(df: DataFrame, name: str, value, dtype: str | None = None) -> DataFrame:
    """Constant / provenance column (typed even when NULL)."""
    lit = F.lit(value)
    return df.withColumn(name, lit.cast(dtype) if dtype else lit)


def with_loaded_at(df: DataFrame, as_of, name: str = "loaded_at") -> DataFrame:
    """Audit timestamp injected by the caller so outputs are reproducible."""
    return df.withColumn(name, F.lit(as_of).cast("timestamp"))


def left_n(c: ColumnOrName, n: int) -> Column:
    """First ``n`` characters."""
    return F.left(_c(c), F.lit(n))


def as_code(c: ColumnOrName) -> Column:
    """Identifiers as text."""
    return _c(c).cast("string")


def decode_sex(c: ColumnOrName) -> Column:
    """P20: 1 -> M, 2 -> F, anything else -> INCONNU."""
    col = _c(c)
    return F.when(col == 1, "M").when(col == 2, "F").otherwise("INCONNU")


def alert_flag(c: ColumnOrName, text: str) -> Column:
    """1 when the trimmed text equals ``text`` exactly, else 0."""
    return F.when(clean_text(c) == text, 1).otherwise(0)


def with_counter(df: DataFrame, name: str) -> DataFrame:
    """Constant-1 measure used for additive counting."""
    return df.withColumn(name, F.lit(1))


def pad_code(c: ColumnOrName, n: int, pad: str = "0") -> Column:
    """Left-pad a code to ``n`` characters."""
    return F.lpad(_c(c).cast("string"), n, pad)


def rename_cast(df: DataFrame, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    """P01 variant: ``{new_name: (source_column, type)}``."""
    return df.select(*[F.col(src).cast(t).alias(new) for new, (src, t) in mapping.items()])
