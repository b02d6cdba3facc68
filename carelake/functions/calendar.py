"""Calendar generation (G01-G05) with day/month names, seasons and holidays.

The date spine comes from ``spark.range`` so it is generated in parallel across
partitions; holidays are produced per year by a generator (no literal rows, no
joins): eight fixed (month, day) pairs plus three days derived from Easter,
computed as a Column expression.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.functions import rules

# French public holidays as (month, day, name), and the offsets in
# days from Easter Sunday of the movable ones.
FIXED_HOLIDAYS = [
    (1, 1, "Nouvel An"),
    (5, 1, "Fête du Travail"),
    (5, 8, "Victoire 1945"),
    (7, 14, "Fête Nationale"),
    (8, 15, "Assomption"),
    (11, 1, "Toussaint"),
    (11, 11, "Armistice 1918"),
    (12, 25, "Noël"),
]
EASTER_OFFSETS = [(1, "Lundi de Pâques"), (39, "Ascension"), (50, "Lundi de Pentecôte")]

# Reference bounds of the calendar and of the holiday list.
DEFAULT_START = dt.date(2015, 1, 1)
DEFAULT_END = dt.date(2030, 12, 31)
DEFAULT_HOLIDAY_FROM = 2015
DEFAULT_HOLIDAY_UNTIL = 2025


def _idiv(a: Column, b: int) -> Column:
    # integer division for non-negative operands
    return (a / F.lit(b)).cast("int")


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday of ``year`` (anonymous Gregorian algorithm)."""
    y = year.cast("int")
    a = F.pmod(y, F.lit(19))
    b = _idiv(y, 100)
    c = F.pmod(y, F.lit(100))
    d = _idiv(b, 4)
    e = F.pmod(b, F.lit(4))
    f = _idiv(b + 8, 25)
    g = _idiv(b - f + 1, 3)
    h = F.pmod(19 * a + b - d - g + 15, F.lit(30))
    i = _idiv(c, 4)
    k = F.pmod(c, F.lit(4))
    l_ = F.pmod(32 + 2 * e + 2 * i - h - k, F.lit(7))
    m = _idiv(a + 11 * h + 22 * l_, 451)
    n = h + l_ - 7 * m + 114
    return F.make_date(y, _idiv(n, 31), F.pmod(n, F.lit(31)) + 1)


def date_spine(spark: SparkSession, start=DEFAULT_START, end=DEFAULT_END,
               name: str = "date_complete") -> DataFrame:
    """One row per day, ``start`` .. ``end`` inclusive, generated in parallel."""
    start = dt.date.fromisoformat(str(start)) if not isinstance(start, dt.date) else start
    end = dt.date.fromisoformat(str(end)) if not isinstance(end, dt.date) else end
    n_days = (end - start).days + 1
    return spark.range(0, max(n_days, 0)).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias(name))


def _years(spark: SparkSession, y0: int, y1: int) -> DataFrame:
    return spark.range(y0, y1 + 1).select(F.col("id").cast("int").alias("year"))


def fixed_holidays(spark: SparkSession, y0: int = DEFAULT_HOLIDAY_FROM,
                   y1: int = DEFAULT_HOLIDAY_UNTIL) -> DataFrame:
    """Fixed-date holidays for every year in ``[y0, y1]``."""
    rows = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(n).alias("n"))
                     for m, d, n in FIXED_HOLIDAYS])
    return (_years(spark, y0, y1)
            .select("year", F.inline(rows))
            .select(F.make_date("year", "m", "d").alias("date_ferie"), F.col("n").alias("nom_ferie")))


def movable_holidays(spark: SparkSession, y0: int = DEFAULT_HOLIDAY_FROM,
                     y1: int = DEFAULT_HOLIDAY_UNTIL) -> DataFrame:
    """Easter Monday, Ascension and Whit Monday for every year in ``[y0, y1]``."""
    rows = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(n).alias("n")) for o, n in EASTER_OFFSETS])
    return (_years(spark, y0, y1)
            .select(easter_sunday(F.col("year")).alias("easter"), F.inline(rows))
            .select(F.date_add("easter", F.col("o")).alias("date_ferie"),
                    F.col("n").alias("nom_ferie")))


def holidays(spark: SparkSession, y0: int = DEFAULT_HOLIDAY_FROM,
             y1: int = DEFAULT_HOLIDAY_UNTIL) -> DataFrame:
    """Union of fixed and movable holidays."""
    return fixed_holidays(spark, y0, y1).unionByName(movable_holidays(spark, y0, y1))


def date_key(d: Column) -> Column:
    """Integer key yyyyMMdd."""
    return F.date_format(d, "yyyyMMdd").cast("bigint")


def calendar_parts(d: Column) -> dict[str, Column]:
    """Day, month, quarter, half-year, year, ISO week, ISO weekday (1 = Monday)."""
    return {
        "jour": F.dayofmonth(d),
        "mois": F.month(d),
        "trimestre": F.ceil(F.month(d) / 3.0).cast("int"),
        "semestre": F.ceil(F.month(d) / 6.0).cast("int"),
        "annee": F.year(d),
        "semaine_annee": F.weekofyear(d),
        "jour_semaine": (F.weekday(d) + 1).cast("int"),
    }


def calendar(spark: SparkSession, start=DEFAULT_START, end=DEFAULT_END,
             holiday_from: int = DEFAULT_HOLIDAY_FROM, holiday_until: int = DEFAULT_HOLIDAY_UNTIL,
             as_of=None, extra: bool = False) -> DataFrame:
    """M28 dim_temps: the calendar dimension.

    Holidays are joined on the date (J13). Their table is bounded by 11 rows per
    year, so it is broadcast. A date carrying two holidays would appear once
    (the reference list has no such date).
    """
    spine = date_spine(spark, start, end)
    hol = (holidays(spark, holiday_from, holiday_until)
           .groupBy("date_ferie").agg(F.min("nom_ferie").alias("nom_ferie")))
    d = F.col("date_complete")
    parts = calendar_parts(d)
    cols = [date_key(d).alias("sk_temps"), d]
    cols += [v.cast("int").alias(k) for k, v in parts.items()]
    cols += [
        rules.day_name(d).alias("nom_jour"),
        rules.month_name(d).alias("nom_mois"),
        rules.is_weekend(d).alias("est_weekend"),
        F.col("date_ferie").isNotNull().alias("est_ferie"),
        rules.season(F.month(d)).alias("saison"),
    ]
    if extra:  # P24 (documentation-only columns)
        cols += [
            F.dayofyear(d).alias("jour_annee"),
            (F.dayofmonth(d) == 1).alias("est_debut_mois"),
            (d == F.last_day(d)).alias("est_fin_mois"),
        ]
    cols.append(F.lit(as_of).cast("timestamp").alias("date_chargement"))
    return (spine.join(F.broadcast(hol), spine.date_complete == hol.date_ferie, "left")
            .select(*cols))
