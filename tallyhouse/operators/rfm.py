"""Recency, frequency, monetary value: base figures, scores and segments."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F
from pyspark.sql.types import DecimalType

from .relational import revenue_orders
from ..workspace import stage

# Score limits and segment names of the published RFM rules.
RECENCY_DAYS = ((30, 5), (60, 4), (90, 3), (180, 2))
FREQUENCY_ORDERS = ((10, 5), (6, 4), (3, 3), (2, 2))
MONETARY_CUTS = (("0.90", 5), ("0.75", 4), ("0.50", 3), ("0.25", 2))
SEGMENTS = ("Champions", "Loyal", "Potential", "At Risk", "Hibernating", "New")

# Bits of a digit of the order-statistic search; three digits cover every 64-bit number.
_DIGIT = 21


def trailing_year(order_date: Column, as_of: date) -> Column:
    return order_date > F.add_months(F.lit(as_of), -12)


def rfm_base(orders: DataFrame, as_of: date) -> DataFrame:
    """Per customer with revenue: days since the last order, orders in the
    trailing 12 months, total spend."""
    return (
        revenue_orders(orders)
        .where(F.col("order_date") <= F.lit(as_of))
        .groupBy("customer_id")
        .agg(
            F.datediff(F.lit(as_of), F.max("order_date")).alias("recency_days"),
            F.count_if(trailing_year(F.col("order_date"), as_of)).alias("frequency"),
            F.sum("total_amount").alias("monetary"),
        )
    )


def _running(histogram: DataFrame, window: WindowSpec) -> DataFrame:
    """Buckets with the number of rows before them and up to their end."""
    through = F.sum("n").over(window)
    return histogram.withColumns({"before": through - F.col("n"), "through": through})


def _first_digit(values: DataFrame, wanted: DataFrame, shift: int) -> DataFrame:
    """The bucket of the highest digit each wanted rank falls in.

    There are two ranks per cut, so they travel as one small array instead of a
    join without key. The window runs over at most 2^22 buckets.
    """
    ranks = wanted.select(F.collect_list(F.struct("cut", "spot", "rank"))).scalar()
    histogram = values.groupBy(F.shiftright("v", shift).alias("prefix")).agg(F.count("*").alias("n"))
    ranked = _running(histogram, Window.orderBy("prefix")).withColumn("ranks", ranks)
    hits = F.filter("ranks", lambda r: (r["rank"] >= F.col("before")) & (r["rank"] < F.col("through")))
    return ranked.select("prefix", "before", F.explode(hits).alias("r")).select(
        "r.cut", "r.spot", "r.rank", "prefix", (F.col("r.rank") - F.col("before")).alias("rest")
    )


def exact_percentiles(df: DataFrame, amount: str, cuts: list[str]) -> DataFrame:
    """Exact interpolated percentiles of a decimal column, as one row p0, p1, …

    The built-in exact ``percentile`` gathers every distinct value in one task.
    Here the wanted ranks are narrowed down instead, 21 bits at a time: each pass
    counts rows per bucket (pre-aggregated before the shuffle) and keeps the
    bucket each rank falls in. At most 2^21 buckets per open prefix are ever
    ranked, whatever the number of rows. Values count from the least one, so that
    their range, which a first small job finds, says how many passes it takes.

    All digits of the column count. A value that does not fit 64 bits in units of
    its last digit fails the query; nothing is rounded. ``df`` is read once per
    pass, so hand in a staged table.
    """
    kind = df.schema[amount].dataType
    if not isinstance(kind, DecimalType):
        raise TypeError(f"{amount} must be a decimal, not {kind.simpleString()}")
    points = [Decimal(c) for c in cuts]
    if any(not 0 <= p <= 1 for p in points):
        raise ValueError("cuts lie between 0 and 1")
    digits = max(1, *(-p.as_tuple().exponent for p in points))
    exact_cut = f"decimal({digits + 1},{digits})"
    units = (F.col(amount) * F.lit(Decimal(10**kind.scale))).cast("bigint")
    values = df.where(F.col(amount).isNotNull()).select(units.alias("v"))
    rows, least, greatest = values.agg(F.count("*"), F.min("v"), F.max("v")).first()
    spread = (greatest or 0) - (least or 0)
    origin = least if least is not None and spread < 2**63 else 0  # a wider range cannot be moved
    values = values.select((F.col("v") - F.lit(origin).cast("bigint")).alias("v"))
    shifts = [s for s in range(2 * _DIGIT, -1, -_DIGIT) if s == 0 or spread >> s]
    # Rank of a cut: (n - 1) * cut, in exact decimals; its two neighbours are looked up.
    spot = (F.col("n") - 1).cast("decimal(20,0)") * F.col("cut")
    wanted = (
        df.sparkSession.range(1)
        .select(F.lit(rows).cast("bigint").alias("n"))
        .where("n > 0")
        .select("n", F.explode(F.array(*(F.lit(p).cast(exact_cut) for p in points))).alias("cut"))
        .select("cut", spot.alias("spot"))
        .select("cut", "spot", F.explode(F.array_distinct(F.array(F.floor("spot"), F.ceil("spot")))).alias("rank"))
        .select("cut", "spot", F.col("rank").cast("bigint").alias("rank"))
    )
    found = _first_digit(values, wanted, shifts[0])
    for wider, shift in zip(shifts, shifts[1:]):
        histogram = (
            values.select(F.shiftright("v", wider).alias("prefix"), F.shiftright("v", shift).alias("bucket"))
            .join(found.select("prefix").distinct(), "prefix", "left_semi")
            .groupBy("prefix", "bucket")
            .agg(F.count("*").alias("n"))
        )
        inside = (F.col("rest") >= F.col("before")) & (F.col("rest") < F.col("through"))
        found = (
            found.join(_running(histogram, Window.partitionBy("prefix").orderBy("bucket")), "prefix")
            .where(inside)
            .select("cut", "spot", "rank", F.col("bucket").alias("prefix"), (F.col("rest") - F.col("before")).alias("rest"))
        )
    unit = (F.col("prefix") + F.lit(origin).cast("bigint")).cast("decimal(20,0)")
    low = F.min(F.struct("rank", unit.alias("value")))["value"]
    high = F.max(F.struct("rank", unit.alias("value")))["value"]
    by_cut = found.groupBy("cut", "spot").agg(low.alias("low"), high.alias("high"))
    value = F.col("low") + (F.col("high") - F.col("low")) * (F.col("spot") - F.floor("spot"))
    by_cut = by_cut.select("cut", (value * F.lit(Decimal(1).scaleb(-kind.scale))).alias("value"))
    return by_cut.agg(*(F.max(F.when(F.col("cut") == F.lit(p).cast(exact_cut), F.col("value"))).alias(f"p{i}") for i, p in enumerate(points)))


def recency_score(days: Column) -> Column:
    score = F.when(days.isNull(), None)
    for limit, points in RECENCY_DAYS:
        score = score.when(days <= limit, points)
    return score.otherwise(1)


def frequency_score(orders: Column) -> Column:
    score = F.when(orders.isNull(), None)
    for limit, points in FREQUENCY_ORDERS:
        score = score.when(orders >= limit, points)
    return score.otherwise(1)


def segment_of(r: Column, f: Column, m: Column) -> Column:
    """First matching rule in the published order; 'Other' where none matches."""
    champions, loyal, potential, at_risk, hibernating, new = SEGMENTS
    return (
        F.when((r == 5) & (f >= 4) & (m >= 4), champions)
        .when((r >= 3) & (f >= 3) & (m >= 3), loyal)
        .when((r >= 4) & (f <= 2) & (m >= 3), potential)
        .when(r.between(2, 3) & (f >= 3) & (m >= 3), at_risk)
        .when((r <= 2) & (f <= 2), hibernating)
        .when((r == 5) & (f == 1), new)
        .otherwise("Other")
    )


def rfm_score(base: DataFrame) -> DataFrame:
    """Scores 1 to 5. ``base`` is staged once: the monetary cuts read it again."""
    base = stage(base, "rfm-base")
    cuts = exact_percentiles(base, "monetary", [c for c, _ in MONETARY_CUTS])
    limits = cuts.select(F.struct(*cuts.columns)).scalar()
    scored = base.withColumn("_limits", limits)
    monetary = F.when(F.col("monetary").isNull(), None)
    for i, (_, points) in enumerate(MONETARY_CUTS):
        monetary = monetary.when(F.col("monetary") >= F.col(f"_limits.p{i}"), points)
    return scored.select(
        *base.columns,
        recency_score(F.col("recency_days")).alias("r_score"),
        frequency_score(F.col("frequency")).alias("f_score"),
        monetary.otherwise(1).alias("m_score"),
    )


def rfm_segment(scored: DataFrame) -> DataFrame:
    return scored.withColumns(
        {
            "rfm_code": F.format_string("%d%d%d", "r_score", "f_score", "m_score"),
            "rfm_segment": segment_of(F.col("r_score"), F.col("f_score"), F.col("m_score")),
        }
    )
