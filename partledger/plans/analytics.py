"""Analytic queries over the published microdata, by the documented column rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partledger.functions.names import month_index


def _rate(hit: Column, known: Column) -> Column:
    """Share of hits among the rows where the question is answered."""
    return F.sum(F.when(known & hit, 1).otherwise(0)) / F.count_if(known)


# --- births -----------------------------------------------------------------


def birth_risk_rates(births: DataFrame, by: Sequence[str] = ("uf", "ano")) -> DataFrame:
    """Rates of low weight (below 2500 g), of short gestation (below 37 weeks), and of either.

    A birth counts for the combined rate once one of the two settles the answer.
    """
    weight, weeks = F.col("PESO"), F.col("SEMAGESTAC")
    either = (weight < 2500) | (weeks < 37)
    return births.groupBy(*by).agg(
        F.count(F.lit(1)).alias("births"),
        _rate(weight < 2500, weight.isNotNull()).alias("low_weight_rate"),
        _rate(weeks < 37, weeks.isNotNull()).alias("premature_rate"),
        _rate(either, either.isNotNull()).alias("either_rate"),
    )


def caesarean_rate(births: DataFrame, by: Sequence[str] = ("uf", "ano")) -> DataFrame:
    """Share of births with ``PARTO = '2'`` among those with a known mode of delivery."""
    mode = F.col("PARTO")
    return births.groupBy(*by).agg(
        F.count(F.lit(1)).alias("births"),
        _rate(mode == "2", mode.isin("1", "2")).alias("caesarean_rate"),
    )


def adequate_prenatal(births: DataFrame, by: Sequence[str] = ("RACACORMAE",)) -> DataFrame:
    """At least seven prenatal visits: ``CONSPRENAT >= 7``, else ``CONSULTAS = '4'``."""
    adequate = F.coalesce(F.col("CONSPRENAT") >= 7, F.col("CONSULTAS") == "4")
    return births.groupBy(*by).agg(
        F.count(F.lit(1)).alias("births"),
        _rate(adequate, adequate.isNotNull()).alias("adequate_rate"),
    )


def harmonized_schooling(
    rows: DataFrame,
    new: str,
    old: str,
    scale: Mapping[str, str],
    output: str = "schooling",
) -> DataFrame:
    """Schooling on the newer scale, falling back to the older column mapped by ``scale``."""
    pairs = [F.lit(x) for item in scale.items() for x in item]
    mapped = F.try_element_at(F.create_map(*pairs), F.col(old))
    return rows.withColumn(output, F.coalesce(F.col(new), mapped))


# --- notifications ----------------------------------------------------------


def epidemic_curve(
    cases: DataFrame,
    week: str = "SEM_PRI",
    confirmed: Mapping[str, Sequence[str]] | None = None,
    by: Sequence[str] = ("ID_AGRAVO",),
) -> DataFrame:
    """Cases per epidemiological week, kept to the given classification values."""
    for column, values in (confirmed or {}).items():
        cases = cases.filter(F.col(column).isin(list(values)))
    return cases.groupBy(*by, week).agg(F.count(F.lit(1)).alias("cases"))


# --- deaths -----------------------------------------------------------------


def mortality_by_cause(deaths: DataFrame, digits: int = 4) -> DataFrame:
    """Fetal (``TIPOBITO = '1'``) and other deaths per cause, year and unit."""
    fetal = F.col("TIPOBITO") == "1"
    return deaths.groupBy(
        F.substring("CAUSABAS", 1, digits).alias("cause"), "ano", "uf"
    ).agg(
        F.count_if(fetal).alias("fetal"),
        F.count_if(F.coalesce(~fetal, F.lit(True))).alias("non_fetal"),
    )


def decode_age(code: Column, units: Mapping[str, str] | None = None) -> Column:
    """``struct(unit, value)`` of a four-character age: unit digit, then the amount.

    ``units`` names the digits; without it the digit itself is kept.
    """
    unit = F.substring(code, 1, 1)
    if units is not None:
        pairs = [F.lit(x) for item in units.items() for x in item]
        unit = F.try_element_at(F.create_map(*pairs), unit)
    value = F.substring(code, 2, 3).try_cast("int")
    return F.when(
        code.rlike(r"^[0-9]{4}\z"), F.struct(unit.alias("unit"), value.alias("value"))
    )


# Unit codes of the age at admission.
ADMISSION_AGE_UNITS = {"0": "hour", "1": "day", "2": "month", "3": "year", "4": "year"}


def hospital_age(unit_code: Column, amount: Column) -> Column:
    """``struct(unit, value)`` of an admission's age, whose unit has a column of its own.

    Unit 4 counts the years beyond one hundred.
    """
    pairs = [F.lit(x) for item in ADMISSION_AGE_UNITS.items() for x in item]
    unit = F.try_element_at(F.create_map(*pairs), unit_code)
    value = F.when(unit_code == "4", amount + 100).otherwise(amount)
    return F.when(unit.isNotNull(), F.struct(unit.alias("unit"), value.cast("int").alias("value")))


# --- hospital admissions ----------------------------------------------------


def hospital_mortality(
    admissions: DataFrame, by: Sequence[str] = ("PROC_REA", "uf")
) -> DataFrame:
    """Admissions, deaths, mortality and spending (kept in cents) per group."""
    died = F.col("MORTE") == "1"
    return admissions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("admissions"),
        F.count_if(died).alias("deaths"),
        (F.count_if(died) / F.count(F.lit(1))).alias("mortality"),
        F.sum("VAL_TOT").alias("spend_cents"),
    )


# --- establishments ---------------------------------------------------------


def name_establishments(
    counts: DataFrame, establishments: DataFrame, code: str = "PA_CODUNI", by: Sequence[str] = ()
) -> DataFrame:
    """Adds the establishment name for the same period; unknown codes keep NULL.

    Join on aggregated counts, so that each code travels once. Leading zeros matter:
    both sides are strings. ``by`` names further columns that must agree, where a register
    of several units lists a code once per unit.
    """
    registry = establishments.select(
        F.col("CNES").alias(code), F.col("COMPETEN").alias("period"), *by, F.col("NO_FANTASI").alias("name")
    )
    return counts.join(registry, [*by, code, "period"], "left")


def establishment_presence(snapshots: DataFrame, entity: str = "CNES") -> DataFrame:
    """First and last month each establishment appears, months present, and months missed
    in between. ``snapshots`` has ``entity, ano, mes``.

    The gap needs no ordering: it is the span of months minus the distinct months seen,
    which are reduced to one row per (entity, month) before they are counted.
    """
    index = month_index(F.col("ano"), F.col("mes"))
    months = snapshots.select(entity, index.alias("_i")).distinct()
    span = months.groupBy(entity).agg(
        F.min("_i").alias("_first"), F.max("_i").alias("_last"), F.count(F.lit(1)).alias("months_present")
    )

    def text(i: Column) -> Column:
        year = F.floor(i / 12).cast("int").cast("string")
        return F.concat(year, F.lit("-"), F.lpad((F.pmod(i, F.lit(12)) + 1).cast("string"), 2, "0"))

    return span.select(
        entity,
        text(F.col("_first")).alias("first_period"),
        text(F.col("_last")).alias("last_period"),
        "months_present",
        (F.col("_last") - F.col("_first") + 1 - F.col("months_present")).alias("months_missing"),
    )


def presence_gaps(snapshots: DataFrame, entity: str = "CNES") -> DataFrame:
    """Each break in an establishment's history: last month before it and first after.

    The window orders at most one row per calendar month and establishment.
    """
    index = month_index(F.col("ano"), F.col("mes"))
    months = snapshots.select(entity, index.alias("_i")).distinct()
    before = F.lag("_i").over(Window.partitionBy(entity).orderBy("_i"))
    return (
        months.withColumn("_before", before)
        .filter(F.col("_i") - F.col("_before") > 1)
        .select(entity, F.col("_before").alias("last_index"), F.col("_i").alias("next_index"))
    )


def inventory(snapshots: DataFrame, by: Sequence[str] = ("TP_UNID", "uf")) -> DataFrame:
    """Establishments per period, type and unit.

    Monthly snapshots repeat an establishment each month, so counts never add up over periods.
    """
    return snapshots.groupBy("COMPETEN", *by).agg(F.count(F.lit(1)).alias("establishments"))


def beds_by_municipality(snapshots: DataFrame, bed_cols: Sequence[str]) -> DataFrame:
    """Total of the bed columns (missing ones count as zero) per period and municipality."""
    total = None
    for c in bed_cols:
        value = F.coalesce(F.col(c), F.lit(0))
        total = value if total is None else total + value
    return snapshots.groupBy("COMPETEN", "CODUFMUN").agg(F.sum(total).alias("beds"))


def municipality_code(code: Column) -> Column:
    """Six-digit municipality code out of the six- or seven-digit form."""
    return F.substring(code, 1, 6)


def join_municipalities(rows: DataFrame, municipalities: DataFrame, code: str) -> DataFrame:
    """Rows with municipality attributes, joined on the first six digits."""
    reference = municipalities.withColumn("_six", municipality_code(F.col("code"))).drop("code")
    return (
        rows.withColumn("_six", municipality_code(F.col(code)))
        .join(reference, "_six", "left")
        .drop("_six")
    )


# --- consumer queries -------------------------------------------------------


def count_by(data: DataFrame, columns: Sequence[str]) -> DataFrame:
    return data.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def count_in_period(data: DataFrame, by: str, period_col: str, period: str) -> DataFrame:
    """Rows per ``by`` for one period; the equality reaches the scan."""
    return data.filter(F.col(period_col) == period).groupBy(by).agg(F.count(F.lit(1)).alias("n"))
