"""Declarative data-quality rules and the jobs that run them.

All row, uniqueness and reference rules share one scan per table: the rules a row
breaks are the bits of a number, and rows are counted per such number and per
value of each key and of the columns that refer to it, before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, time, timedelta
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.money import ZERO
from ..schemas import TABLES, Table
from ..sources.snapshots import readable_tables

BLOCKER, MAJOR, MINOR, INFO = "blocker", "major", "minor", "info"

RESULT_COLUMNS = ("rule_id", "table_name", "dimension", "severity", "checked", "failed", "status")


@dataclass(frozen=True)
class Rule:
    """One check. ``kind`` says how it is computed, ``spec`` what is checked.

    row: SQL condition that marks a violating row (NULL is no violation)
    rows: least number of rows
    pk / unique: column that must be unique (and, for pk, not NULL)
    fk: (column, parent table)
    sum: items total up to the order subtotal
    owner: invoices name the customer of their order
    """

    rule_id: str
    table: str
    kind: str
    spec: object
    dimension: str
    severity: str = MAJOR
    allowed: int = 0  # violations that still pass


def _quoted(values: Iterable[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# Shapes of the business codes and the window of the order dates.
CODE_SHAPES = {
    ("customers", "customer_code"): "^CUST-[0-9]{4}-[0-9]{6,}$",
    ("orders", "order_number"): "^ORD-[0-9]{4}-[0-9]{6,}$",
    ("payments", "payment_code"): "^PAY-[0-9]{4}-[0-9]{6,}$",
    ("invoices", "invoice_number"): "^INV-[0-9]{4}-[0-9]{6,}$",
}
DATE_START, DATE_END = date(2024, 1, 1), date(2024, 12, 31)
SUM_TOLERANCE = Decimal("1")
SUM_ALLOWED = 9  # fewer than ten differing orders pass


def rules_for(table: Table) -> list[Rule]:
    """The rules a table's declaration implies."""
    t = table.name
    rules = [Rule(f"{t}.{table.primary_key}.pk", t, "pk", table.primary_key, "uniqueness", BLOCKER)]
    rules += [Rule(f"{t}.{c}.unique", t, "unique", c, "uniqueness", BLOCKER) for c in table.unique]
    rules += [Rule(f"{t}.{c}.fk", t, "fk", (c, parent), "consistency", BLOCKER) for c, parent in table.foreign_keys]
    rules += [
        Rule(f"{t}.{c}.not_null", t, "row", f"{c} IS NULL", "completeness", BLOCKER)
        for c in table.not_null
    ]
    rules += [
        Rule(f"{t}.{c}.accepted_values", t, "row", f"{c} NOT IN ({_quoted(values)})", "validity", MAJOR)
        for c, values in table.domains.items()
    ]
    rules += [Rule(f"{t}.{name}.range", t, "row", f"NOT ({cond})", "validity", MAJOR) for name, cond in table.checks.items()]
    rules += [Rule(f"{t}.{c}.length", t, "row", f"length({c}) > {n}", "validity", MINOR) for c, n in table.lengths.items()]
    rules += [
        Rule(f"{t}.{c}.format", t, "row", f"NOT ({c} RLIKE '{shape}')", "validity", MINOR)
        for (owner, c), shape in CODE_SHAPES.items()
        if owner == t
    ]
    if table.min_rows:
        rules.append(Rule(f"{t}.min_rows", t, "rows", table.min_rows, "completeness", MAJOR))
    return rules


def all_rules(date_start: date = DATE_START, date_end: date = DATE_END) -> list[Rule]:
    declared = [rule for table in TABLES.values() for rule in rules_for(table)]
    outside = f"order_date < DATE'{date_start}' OR order_date > DATE'{date_end}'"
    return declared + [
        Rule("customers.email.format", "customers", "row", "email NOT LIKE '%@%'", "validity", MAJOR),
        # The table allows zero, the published test does not: a warning of its own.
        Rule("orders.total_amount_positive.range", "orders", "row", "total_amount <= 0", "validity", MINOR),
        Rule("orders.order_date.date_range", "orders", "row", outside, "validity", MAJOR),
        Rule("orders.subtotal.sum_match", "orders", "sum", SUM_TOLERANCE, "accuracy", MAJOR, SUM_ALLOWED),
        Rule("invoices.customer_id.owner", "invoices", "owner", None, "consistency", MAJOR),
    ]


def select_rules(rules: Iterable[Rule], suffix: str) -> list[Rule]:
    return [r for r in rules if r.rule_id.endswith("." + suffix)]


# ---- computation -------------------------------------------------------------


def _outcome(rule: Rule) -> str:
    """Result columns of a rule that do not depend on the data, as select list."""
    return (
        f"'{rule.rule_id}' AS rule_id, '{rule.table}' AS table_name, '{rule.dimension}' AS dimension, "
        f"'{rule.severity}' AS severity, {rule.allowed}L AS allowed"
    )


def _result(counted: DataFrame, rules: list[Rule], failed: list[str]) -> DataFrame:
    """One row per rule out of the single row that has all counters."""
    rows = ", ".join(f"struct({_outcome(r)}, checked, {column} AS failed)" for r, column in zip(rules, failed))
    return counted.selectExpr(f"inline(array({rows}))")


def _column(rule: Rule) -> str:
    """The counted column of a key or reference rule, with its table."""
    return f"{rule.table}.{rule.spec[0] if rule.kind == 'fk' else rule.spec}"


def _key_column(rule: Rule) -> str:
    """The key column whose values a key or reference rule is about."""
    return f"{rule.spec[1]}.{TABLES[rule.spec[1]].primary_key}" if rule.kind == "fk" else _column(rule)


WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")
MARKS = 60  # row rules that share one number


class _Counted:
    """What one pass over the tables counts, and where each rule finds its figures.

    Sets of marks: a row's broken row rules are the bits of a number; rows are counted per number.
    Domains: a key column and all columns that refer to it; rows are counted per value, side by side.
    """

    def __init__(self, rules: list[Rule]):
        marked: dict[str, list[Rule]] = {}
        self.columns: dict[str, list[str]] = {}
        for rule in rules:
            if rule.kind in ("row", "rows"):
                marked.setdefault(rule.table, []).append(rule)
            else:
                columns = self.columns.setdefault(_key_column(rule), [_key_column(rule)])
                if _column(rule) not in columns:
                    columns.append(_column(rule))
        self.marks = [(t, own[i : i + MARKS]) for t, own in marked.items() for i in range(0, len(own), MARKS)]
        self.n_groups = len(self.marks) + len(self.columns)
        self.slots = [f"n{j}" for j in range(max((len(c) for c in self.columns.values()), default=1))]

    def entries(self, tables: dict[str, DataFrame]) -> dict[str, list[str]]:
        """What a row of each table adds, as SQL: struct(of, slot, there, k, s) per set of marks and column.

        A whole number stays one (k), any other value is text (s), so that most keys are
        grouped as numbers. ``there`` is false for NULL.
        """
        found: dict[str, list[str]] = {}
        for of, (table, rules) in enumerate(self.marks):
            bits = [f"CASE WHEN {r.spec} THEN {1 << j}L ELSE 0L END" for j, r in enumerate(rules) if r.kind == "row"]
            found.setdefault(table, []).append(f"struct({of} AS of, 0 AS slot, TRUE AS there, {' | '.join(bits) or '0L'} AS k, '' AS s)")
        for of, columns in enumerate(self.columns.values(), len(self.marks)):
            for slot, column in enumerate(columns):
                table, c = column.split(".")
                whole = dict(tables[table].dtypes)[c] in WHOLE_NUMBERS
                value = f"coalesce(bigint({c}), 0L) AS k, '' AS s" if whole else f"0L AS k, coalesce(string({c}), '') AS s"
                found.setdefault(table, []).append(f"struct({of} AS of, {slot} AS slot, {c} IS NOT NULL AS there, {value})")
        return found

    def result(self, rule: Rule) -> str:
        """A rule's row out of the figures of its set or domain, as SQL."""
        if rule.kind in ("row", "rows"):
            of, bit = next((i, own.index(rule)) for i, (_, own) in enumerate(self.marks) if rule in own)
            slot, failed = 0, f"coalesce(marked[{bit}], 0L)" if rule.kind == "row" else f"bigint(rows[0] < {rule.spec})"
        else:
            columns = self.columns[_key_column(rule)]
            of, slot = len(self.marks) + list(self.columns).index(_key_column(rule)), columns.index(_column(rule))
            failed = f"orphans[{slot}]" if rule.kind == "fk" else "repeated"
            if rule.kind == "pk" or (rule.kind == "fk" and rule.spec[0] in TABLES[rule.table].not_null):
                failed += f" + nulls[{slot}]"
        return f"struct({of} AS rule_of, {_outcome(rule)}, rows[{slot}] AS checked, {failed} AS failed)"


def _counted_rules(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """Results of all row, uniqueness and reference rules, each table read once.

    A value that occurs more than once fails its uniqueness rule once; a NULL
    primary key fails row by row. A reference fails per row whose parent is
    missing; NULL counts where the column must be set. The rows of a key and of
    all its references meet in one group per value, so nothing is joined.
    """
    counted = _Counted(rules)
    parts = [tables[name].selectExpr(f"inline(array({', '.join(own)}))") for name, own in counted.entries(tables).items()]
    slots = counted.slots
    values = reduce(DataFrame.unionByName, parts).groupBy("of", "there", "k", "s").agg(
        *(F.count_if(F.col("slot") == j).alias(n) for j, n in enumerate(slots))
    )
    # A row without any count per set and domain, so that empty tables are reported.
    nothing = values.sparkSession.range(counted.n_groups).selectExpr(
        "int(id) AS of", "FALSE AS there", "0L AS k", "'' AS s", *(f"0L AS {n}" for n in slots)
    )
    # Groups of marks count for each of their bits, and like all others once as a whole (-1).
    bits = f"CASE WHEN of < {len(counted.marks)} THEN filter(sequence(-1, {MARKS - 1}), b -> b < 0 OR getbit(k, b) = 1) ELSE array(-1) END"
    there, orphan = F.col("there"), F.col("there") & (F.col("n0") == 0)
    figures = (
        values.unionByName(nothing)
        .withColumn("bit", F.explode(F.expr(bits)))
        .groupBy("of", "bit")
        .agg(
            F.array(*(F.sum(n) for n in slots)).alias("rows"),
            F.array(*(F.sum(F.when(there, 0).otherwise(F.col(n))) for n in slots)).alias("nulls"),
            F.array(*(F.sum(F.when(orphan, F.col(n)).otherwise(0)) for n in slots)).alias("orphans"),
            F.count_if(there & (F.col("n0") > 1)).alias("repeated"),
        )
    )
    whole = F.col("bit") == -1
    marked = F.map_from_entries(F.collect_list(F.struct("bit", F.col("rows")[0])))  # a row per bit
    per_group = figures.groupBy("of").agg(
        *(F.max(F.when(whole, F.col(c))).alias(c) for c in ("rows", "nulls", "orphans", "repeated")), marked.alias("marked")
    )
    judged = per_group.selectExpr("of", f"inline(array({', '.join(counted.result(r) for r in rules)}))")
    return judged.where("of = rule_of").drop("of", "rule_of")


def sum_mismatches(orders: DataFrame, items: DataFrame, tolerance: Decimal = SUM_TOLERANCE) -> DataFrame:
    """Orders with the sum of their lines, and whether the two differ."""
    lines = items.groupBy("order_id").agg(F.sum("line_total").alias("items_total"))
    total = F.coalesce("items_total", F.lit(ZERO))
    diff = F.abs(F.col("subtotal") - total)
    return (
        orders.select(F.col("id").alias("order_id"), "subtotal")
        .join(lines, "order_id", "left")
        .select("order_id", "subtotal", total.alias("items_total"), diff.alias("diff"), (diff > F.lit(tolerance)).alias("differs"))
    )


def owner_mismatches(invoices: DataFrame, orders: DataFrame) -> DataFrame:
    """Invoices with the customer of their order, and whether the two differ."""
    o = orders.select(F.col("id").alias("order_id"), F.col("customer_id").alias("order_customer_id"))
    return (
        invoices.select("id", "order_id", "customer_id")
        .join(o, "order_id")
        .withColumn("differs", ~F.equal_null("customer_id", "order_customer_id"))
    )


def _differing(df: DataFrame, rule: Rule) -> DataFrame:
    return _result(df.selectExpr("count(*) AS checked", "count_if(differs) AS r0"), [rule], ["r0"])


def dq_run(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """Result per rule: rows checked, violations, PASS, WARN or FAIL."""
    counted = [r for r in rules if r.kind not in ("sum", "owner")]
    parts = [_counted_rules(tables, counted)] if counted else []
    for rule in rules:
        if rule.kind == "sum":
            parts.append(_differing(sum_mismatches(tables["orders"], tables["order_items"], rule.spec), rule))
        elif rule.kind == "owner":
            parts.append(_differing(owner_mismatches(tables["invoices"], tables["orders"]), rule))
    passed = F.col("failed") <= F.col("allowed")
    status = F.when(passed, "PASS").when(F.col("severity") == MINOR, "WARN").otherwise("FAIL")
    results = reduce(DataFrame.unionByName, parts).withColumn("status", status)
    return results.select(*RESULT_COLUMNS)


# ---- tables, columns, ranges -------------------------------------------------


def dq_tables_present(tables: dict[str, DataFrame], expected: Iterable[str] = tuple(TABLES)) -> DataFrame:
    """Each expected table: is it there, and does it hold rows?"""
    spark = next(iter(tables.values())).sparkSession

    def rows(name: str) -> DataFrame:
        found = tables[name].agg(F.count("*").alias("rows")) if name in tables else spark.range(1).select(F.lit(0).cast("bigint").alias("rows"))
        return found.select(F.lit(name).alias("table_name"), F.lit(name in tables).alias("present"), "rows")

    status = F.when(F.col("rows") > 0, "PASS").otherwise("FAIL")
    return reduce(DataFrame.unionByName, [rows(name) for name in expected]).withColumn("status", status)


def dq_required_columns(tables: dict[str, DataFrame]) -> DataFrame:
    """Each required column: is it there, and in how many rows is it filled?"""

    def columns(name: str) -> DataFrame:
        df, wanted = tables[name], TABLES[name].required
        filled = [F.count(c) if c in df.columns else F.lit(0).cast("bigint") for c in wanted]
        counted = df.agg(*(f.alias(f"c{i}") for i, f in enumerate(filled)))
        rows = F.array(
            *(
                F.struct(F.lit(c).alias("column_name"), F.lit(c in df.columns).alias("present"), F.col(f"c{i}").alias("filled"))
                for i, c in enumerate(wanted)
            )
        )
        return counted.select(F.lit(name).alias("table_name"), F.explode(rows).alias("r")).select("table_name", "r.*")

    named = [name for name in tables if TABLES[name].required]
    status = F.when(F.col("present"), "PASS").otherwise("FAIL")
    return reduce(DataFrame.unionByName, [columns(name) for name in named]).withColumn("status", status)


def dq_date_range(orders: DataFrame, start: date = DATE_START, end: date = DATE_END) -> DataFrame:
    inside = (F.col("min_date") >= F.lit(start)) & (F.col("max_date") <= F.lit(end))
    return orders.agg(F.min("order_date").alias("min_date"), F.max("order_date").alias("max_date")).withColumn(
        "status", F.when(inside, "PASS").otherwise("FAIL")
    )


# ---- profiles, drift, equality -----------------------------------------------


def dq_profile(df: DataFrame, columns: Iterable[str] | None = None, exact: Iterable[str] = ()) -> DataFrame:
    """Rows, NULLs, distinct values, least and greatest value per column.

    One aggregate with sketches of the distinct values, without any shuffle of
    values. Columns named in ``exact`` are counted exactly instead: their (column,
    value) groups are merged before the shuffle, in one pass for all of them.
    """
    names, exact = list(columns or df.columns), set(exact)
    distinct = {c: F.lit(None).cast("bigint") if c in exact else F.approx_count_distinct(c) for c in names}
    stats = df.agg(
        F.count("*").alias("rows"),
        *(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
                distinct[c].alias("distinct_values"),
                F.min(c).cast("string").alias("min_value"),
                F.max(c).cast("string").alias("max_value"),
            ).alias(f"s{i}")
            for i, c in enumerate(names)
        ),
    )
    stats = stats.select("rows", F.explode(F.array(*(f"s{i}" for i in range(len(names))))).alias("s"))
    stats = stats.select("s.column_name", "rows", "s.nulls", "s.distinct_values", "s.min_value", "s.max_value")
    counted = [c for c in names if c in exact]
    if not counted:
        return stats
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in counted))
    values = df.select(F.explode(pairs).alias("p")).select("p.*").where("value IS NOT NULL").distinct()
    counts = values.groupBy("column_name").agg(F.count("*").alias("counted_values"))
    found = F.coalesce("distinct_values", "counted_values", F.lit(0)).alias("distinct_values")
    return stats.join(counts, "column_name", "left").select("column_name", "rows", "nulls", found, "min_value", "max_value")


def _columns_of(df: DataFrame, side: str, fills: bool) -> DataFrame:
    """Columns of a table with their type and, if asked for, how many rows fill them."""
    named = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias(f"{side}_type"),
            *([F.col(f"c{i}").alias(f"{side}_filled")] if fills else []),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    source = df.agg(*(F.count(c).alias(f"c{i}") for i, c in enumerate(df.columns))) if fills else df.sparkSession.range(1)
    return source.select(F.explode(F.array(*named)).alias("r")).select("r.*")


def dq_schema_drift(previous: DataFrame, current: DataFrame, fills: bool = False) -> DataFrame:
    """Columns added, removed, retyped or unchanged between two snapshots.

    The schemas tell; no row is read unless ``fills`` asks how many rows fill each column.
    """
    change = (
        F.when(F.col("previous_type").isNull(), "added")
        .when(F.col("current_type").isNull(), "removed")
        .when(F.col("previous_type") != F.col("current_type"), "retyped")
        .otherwise("unchanged")
    )
    before, after = _columns_of(previous, "previous", fills), _columns_of(current, "current", fills)
    return before.join(after, "column_name", "full").withColumn("change", change)


def dq_agg_match(source: DataFrame, target: DataFrame, measures: Iterable[str]) -> DataFrame:
    """Row count, and sum, mean and filled count of measures, on both sides."""
    measures = list(measures)

    def figures(df: DataFrame, side: str) -> DataFrame:
        values = [F.count("*").cast("double").alias("row_count")]
        for m in measures:
            total, n = F.sum(m).cast("double"), F.count(m).cast("double")
            values += [total.alias(f"sum_{m}"), n.alias(f"count_{m}"), F.try_divide(total, n).alias(f"avg_{m}")]
        row = df.agg(*values)
        pairs = F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).alias(side)) for c in row.columns))
        return row.select(F.explode(pairs).alias("p")).select("p.*")

    match = F.equal_null("source", "target")
    return figures(source, "source").join(figures(target, "target"), "metric").withColumn(
        "status", F.when(match, "PASS").otherwise("FAIL")
    )


# ---- snapshots and history ---------------------------------------------------


def dq_timeliness(manifest: DataFrame, deadline: time = time(8, 0)) -> DataFrame:
    """Was the snapshot of a day complete before the deadline of the next day?"""
    due = F.date_add("snapshot_date", 1).cast("timestamp_ntz") + F.make_dt_interval(
        hours=F.lit(deadline.hour), mins=F.lit(deadline.minute)
    )
    done = F.col("run_timestamp") + F.make_dt_interval(secs=F.col("duration_seconds").cast("decimal(18,6)"))
    return (
        manifest.where("table_name IS NULL AND status = 'COMPLETE'")
        .groupBy("snapshot_date")
        .agg(F.min(done <= due).alias("every_run_on_time"), F.max(done <= due).alias("on_time"), F.count("*").alias("runs"))
        .withColumn("status", F.when(F.col("on_time"), "PASS").otherwise("WARN"))
    )


def dq_snapshot_gate(
    manifest: DataFrame,
    row_recon: DataFrame,
    drift: DataFrame,
    day: date,
    expected: Iterable[str] = tuple(TABLES),
    longest: timedelta = timedelta(minutes=30),
    sizes: DataFrame | None = None,
    size_range: tuple[float, float] = (0.5, 2.0),
    profile: DataFrame | None = None,
    sample: DataFrame | None = None,
    fmt: str = "parquet",
    column_drift: DataFrame | None = None,
) -> DataFrame:
    """The gate a snapshot passes before anyone reads it.

    Blocking: equal counts, readable files, every table, completion marker.
    Warning: export time, unchanged schema and, given ``sizes``, table sizes within
    a range of the snapshot before; given ``column_drift`` (``sketches.column_drift``),
    columns whose values have shifted since. For information: given a ``profile``, columns
    without any value, and given a ``sample`` comparison, columns that differ from
    the source. ``row_recon`` has read the staged files, so a count is proof that
    they are readable; a table counts as there if readers would get it.
    """
    expected = list(expected)
    today = manifest.where(F.col("snapshot_date") == F.lit(day))
    run = today.where("table_name IS NULL AND status = 'COMPLETE'")
    exported = readable_tables(today, fmt).where(F.col("table_name").isin(*expected))

    def rules(df: DataFrame, *parts: tuple[str, str, str, str]) -> DataFrame:
        """Rules (id, severity, checked, failed) that one pass over ``df`` answers."""
        counted = df.selectExpr(
            *(f"bigint({checked}) AS c{n}" for n, (_, _, checked, _) in enumerate(parts)),
            *(f"bigint({failed}) AS f{n}" for n, (_, _, _, failed) in enumerate(parts)),
        )
        structs = (
            f"struct('snapshot.{name}' AS rule_id, '{severity}' AS severity, c{n} AS checked, f{n} AS failed)"
            for n, (name, severity, _, _) in enumerate(parts)
        )
        return counted.selectExpr(f"inline(array({', '.join(structs)}))")

    gate = [
        rules(
            row_recon,
            ("row_counts", BLOCKER, "count(*)", "count_if(NOT match)"),
            ("readable", BLOCKER, "count(*)", "count_if(staging_count IS NULL)"),
        ),
        rules(exported, ("all_tables", BLOCKER, f"{len(expected)}", f"{len(expected)} - count(DISTINCT table_name)")),
        rules(
            run,
            ("marker", BLOCKER, "1", "count(*) = 0"),
            ("export_time", MINOR, "count(*)", f"count_if(duration_seconds > {longest.total_seconds()})"),
        ),
        rules(drift, ("schema", MINOR, "count(*)", "count_if(change != 'unchanged')")),
    ]
    if sizes is not None:
        low, high = size_range
        gate.append(rules(sizes, ("file_size", MINOR, "count(*)", f"count_if(ratio NOT BETWEEN {low} AND {high})")))
    if column_drift is not None:
        gate.append(rules(column_drift, ("column_drift", MINOR, "count(*)", "count_if(status = 'WARN')")))
    if profile is not None:
        gate.append(rules(profile, ("column_statistics", INFO, "count(*)", "count_if(nulls = rows)")))
    if sample is not None:
        gate.append(rules(sample, ("sample", INFO, "count(*)", "count_if(differing > 0 OR unpaired > 0)")))
    status = F.when(F.col("failed") == 0, "PASS").when(F.col("severity") == MINOR, "WARN").when(F.col("severity") == INFO, "INFO").otherwise("FAIL")
    return reduce(DataFrame.unionByName, gate).withColumn("status", status)


def dq_append_history(results: DataFrame, path: str, run_date: date) -> None:
    """Keep the results of a day; repeating the day replaces them."""
    (
        results.withColumn("run_date", F.lit(run_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_date")
        .parquet(path)
    )


def dq_history(history: DataFrame) -> DataFrame:
    """Rules by outcome per run day and severity."""
    return history.groupBy("run_date", "severity").agg(
        F.count("*").alias("rules"),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(F.col("status") == "WARN").alias("warned"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.sum("failed").alias("violations"),
    )
