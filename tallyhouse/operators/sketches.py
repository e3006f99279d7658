"""Column sketches that are kept with a snapshot and compared without reading it again.

Numbers, days and times have a quantile sketch, texts the most frequent values with
their counts, all columns a count of distinct values: Spark's own mergeable sketches, one
pass over the rows, a few kilobytes a column. Sketches of parts add up to that of the
whole. Ranks are off by no more than ``RANK_ERROR`` (99 of 100 sketches), so a distance of
two distributions is off by no more than twice that, and by the step of its grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

K = 800  # of the quantile sketch
RANK_ERROR = 0.005
TOP_TRACKED, TOP = 1000, 100
GRID = [k / 200 for k in range(1, 200)]
MOST_SHIFT, MOST_NULLS = 0.1, 0.05

NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp", "timestamp_ntz")
TOP_TYPE = "struct<sketch:binary,maxItemsTracked:int,itemDataType:string,itemDataTypeDDL:string>"


def _is_number(kind: str) -> bool:
    return kind.split("(")[0] in NUMBERS


def _as_double(column: str, kind: str) -> Column:
    if kind == "date":
        return F.datediff(F.col(column), F.lit("1970-01-01").cast("date")).cast("double")
    if kind in ("timestamp", "timestamp_ntz"):
        return (F.unix_micros(F.col(column).cast("timestamp")) / 1e6).cast("double")
    return F.col(column).cast("double")


def column_sketches(df: DataFrame, table: str, columns: list[str] | None = None) -> DataFrame:
    """One row per column: table_name, column_name, kind, rows, nulls, quantiles, top, distinct."""
    kinds = dict(df.dtypes)
    chosen = [c for c in columns or df.columns if _is_number(kinds[c]) or kinds[c] in ("string", "boolean")]
    plain = df.select(*((_as_double(c, kinds[c]) if _is_number(kinds[c]) else F.col(c).cast("string")).alias(f"c{i}") for i, c in enumerate(chosen)))
    rows = []
    for i, c in enumerate(chosen):
        number, name = _is_number(kinds[c]), f"c{i}"
        top = F.expr(f"approx_top_k_accumulate({name}, {TOP_TRACKED}) FILTER (WHERE {name} IS NOT NULL)")
        rows.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.lit("number" if number else "text").alias("kind"),
                F.count("*").alias("rows"),
                F.count_if(F.col(name).isNull()).alias("nulls"),
                (F.kll_sketch_agg_double(name, F.lit(K)) if number else F.lit(None).cast("binary")).alias("quantiles"),
                (F.lit(None) if number else top).cast(TOP_TYPE).alias("top"),
                F.hll_sketch_agg(name if not number else F.col(name).cast("string")).alias("distinct"),
            )
        )
    return plain.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def merged(sketches: DataFrame) -> DataFrame:
    """Sketches of parts (days, files, tables of one kind) as those of the whole."""
    keys = ("table_name", "column_name", "kind")
    common = (F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"))
    distinct = F.hll_union_agg("distinct").alias("distinct")
    numbers = sketches.where("kind = 'number'").groupBy(*keys).agg(
        *common, F.kll_merge_agg_double("quantiles", F.lit(K)).alias("quantiles"), F.lit(None).cast(TOP_TYPE).alias("top"), distinct
    )
    texts = sketches.where("kind = 'text'").groupBy(*keys).agg(
        *common, F.lit(None).cast("binary").alias("quantiles"), F.expr(f"approx_top_k_combine(top, {TOP_TRACKED})").cast(TOP_TYPE).alias("top"), distinct
    )
    return numbers.unionByName(texts)


def estimates(sketches: DataFrame, shares: list[float] | None = None) -> DataFrame:
    """What the sketches say: rows, nulls, distinct values, quantiles at ``shares``, and the most frequent texts."""
    at = F.array(*(F.lit(x) for x in shares or [0.25, 0.5, 0.75]))
    filled = F.col("rows") > F.col("nulls")
    return sketches.select(
        "table_name",
        "column_name",
        "kind",
        "rows",
        "nulls",
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
        F.when(filled & (F.col("kind") == "number"), F.kll_sketch_get_quantile_double("quantiles", at)).alias("quantiles"),
        F.when(filled & (F.col("kind") == "text"), _top_counts("top")).alias("most_frequent"),
    )


def _top_counts(top: str) -> Column:
    """Text to count, for the most frequent ones."""
    found = F.expr(f"approx_top_k_estimate({top}, {TOP})")
    return F.map_from_entries(F.transform(found, lambda x: F.struct(x["item"].cast("string").alias("key"), x["count"].alias("value"))))


def _number_distance(a: str, b: str) -> Column:
    """Largest difference of the two cumulative distributions, at quantiles of either.

    A distribution at a value is the share of its own quantiles that lie at or below.
    """
    grid = F.array(*(F.lit(x) for x in GRID))
    of_a, of_b = (F.kll_sketch_get_quantile_double(s, grid) for s in (a, b))

    def below(quantiles: Column, value: Column) -> Column:
        return F.size(F.filter(quantiles, lambda q: q <= value)) / len(GRID)

    return F.array_max(F.transform(F.array_distinct(F.concat(of_a, of_b)), lambda x: F.abs(below(of_a, x) - below(of_b, x))))


def _text_distance(a: Column, b: Column, rows_a: Column, rows_b: Column) -> Column:
    """Half the summed differences of shares, the rare texts as one."""
    names = F.array_union(F.map_keys(a), F.map_keys(b))

    def share(counts: Column, name: Column, rows: Column) -> Column:
        return F.coalesce(F.element_at(counts, name), F.lit(0)) / rows

    apart = F.transform(names, lambda n: F.abs(share(a, n, rows_a) - share(b, n, rows_b)))

    def known(counts: Column, rows: Column) -> Column:
        return F.aggregate(F.map_values(counts), F.lit(0).cast("bigint"), lambda s, x: s + x) / rows

    return (F.aggregate(apart, F.lit(0.0), lambda s, x: s + x) + F.abs(known(a, rows_a) - known(b, rows_b))) / 2


def column_drift(before: DataFrame, after: DataFrame, most_shift: float = MOST_SHIFT, most_nulls: float = MOST_NULLS) -> DataFrame:
    """One row per column: kind, shift (0 to 1), null_change, status.

    WARN where values have shifted by more than ``most_shift``, the share of NULLs has
    changed by more than ``most_nulls``, the kind has changed or the column is on one
    side only. A column without values on one side alone has shifted by 1.
    """
    keys = ["table_name", "column_name"]
    figures = ("kind", "rows", "nulls", "quantiles", "top")
    a, b = (s.select(*keys, *(F.col(f).alias(f"{side}_{f}") for f in figures)) for s, side in ((before, "a"), (after, "b")))
    both = a.join(b, keys, "full")
    n_a, n_b = F.col("a_rows") - F.col("a_nulls"), F.col("b_rows") - F.col("b_nulls")
    same_kind = F.col("a_kind") == F.col("b_kind")
    shift = (
        F.when(~F.coalesce(same_kind, F.lit(False)), None)
        .when((n_a == 0) & (n_b == 0), 0.0)
        .when((n_a == 0) | (n_b == 0), 1.0)
        .when(F.col("a_kind") == "number", _number_distance("a_quantiles", "b_quantiles"))
        .otherwise(_text_distance(_top_counts("a_top"), _top_counts("b_top"), n_a, n_b))
    )
    nulls = F.abs(F.try_divide("a_nulls", "a_rows") - F.try_divide("b_nulls", "b_rows"))
    found = both.select(*keys, F.coalesce("b_kind", "a_kind").alias("kind"), shift.alias("shift"), F.coalesce(nulls, F.lit(0.0)).alias("null_change"))
    steady = F.coalesce((F.col("shift") <= most_shift) & (F.col("null_change") <= most_nulls), F.lit(False))
    return found.withColumn("status", F.when(steady, "PASS").otherwise("WARN"))


# ---- kept with a run ---------------------------------------------------------


def keep_sketches(root: str, run_id: str, sketches: DataFrame) -> None:
    sketches.coalesce(1).write.parquet(f"{root}/sketches/{run_id}")


def kept_sketches(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    return spark.read.parquet(f"{root}/sketches/{run_id}")
