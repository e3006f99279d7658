"""Calendar expressions on business dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

GRAINS = ("day", "week", "month", "quarter", "year")


def period_start(date: Column, grain: str) -> Column:
    """First day of the period; weeks start on Monday."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    return date.cast("date") if grain == "day" else F.trunc(date, grain)


def accounting_period(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def months_spanned(first: Column, last: Column) -> Column:
    """Calendar months touched, both ends included."""
    return (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first) + 1


def by_grains(days: DataFrame, day: str, grains: tuple[str, ...], sums: list[Column], also: list[list[str]] | None = None) -> DataFrame:
    """Figures of days added up for several grains at once: period, grain, the columns of ``also``, the sums.

    ``also`` lists sets of further group columns; each grain comes once with each
    of them, and the grain ``all`` (period NULL) stands for all time. Grouping sets
    read ``days`` once, and partial sums meet in one shuffle. In a set that leaves a
    column out it is NULL and ``total_<column>`` is true, so that a NULL of the data
    stays apart.
    """
    sets, names = also or [[]], {g: f"_{g}" for g in grains if g != "all"}
    others = list(dict.fromkeys(c for own in sets for c in own))
    starts = days.withColumns({name: period_start(F.col(day), g) for g, name in names.items()})
    wanted = [[*([names[g]] if g in names else []), *own] for g in grains for own in sets]
    used = {name: (F.grouping(name) == 0).alias(f"{name}_used") for name in names.values()}
    totals = [(F.grouping(c) == 1).alias(f"total_{c}") for c in others]
    grouped = starts.groupingSets(wanted, *(names[g] for g in names), *others).agg(*used.values(), *totals, *sums)
    period, grain = F.lit(None).cast("date"), F.lit("all")
    for g, name in names.items():
        period = F.when(F.col(f"{name}_used"), F.col(name)).otherwise(period)
        grain = F.when(F.col(f"{name}_used"), g).otherwise(grain)
    figures = [c for c in grouped.columns if c not in {*names.values(), *(f"{n}_used" for n in names.values()), *others, *(f"total_{c}" for c in others)}]
    return grouped.select(period.alias("period"), grain.alias("grain"), *others, *(f"total_{c}" for c in others), *figures)
