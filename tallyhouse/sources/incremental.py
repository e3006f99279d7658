"""Incremental extraction and merging by key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..workspace import broadcastable, stage, staged
from .commits import TRIES, Overlap
from .versions import partition_name, read_at, read_current, write_version


def inc_extract(df: DataFrame, last_run: datetime, column: str = "updated_at") -> DataFrame:
    """Rows changed after the last run. The filter reaches the scan."""
    return df.where(F.col(column) > F.lit(last_run).cast("timestamp_ntz"))


def inc_high_water(df: DataFrame, column: str = "updated_at") -> DataFrame:
    """The mark the next extraction starts from."""
    return df.agg(F.max(column).alias("high_water"))


def latest_per_key(df: DataFrame, pk: str, version: str = "updated_at") -> DataFrame:
    """One row per key, the newest version.

    An aggregate, not a window: versions of a hot key merge before the shuffle.
    The row hash only settles equal versions the same way every time.
    """
    row = F.struct(*df.columns)
    newest = F.max_by(row, F.struct(F.col(version), F.xxhash64(*df.columns)))
    return df.groupBy(F.col(pk).alias("_key")).agg(newest.alias("_row")).select("_row.*")


def newer(new: Column, old: Column) -> Column:
    """A change wins unless the stored version is newer; NULL is older than any version."""
    return old.isNull() | F.coalesce(new >= old, F.lit(False))


def _with_changes(base: DataFrame, delta: DataFrame, pk: str, version: str) -> DataFrame:
    """``delta`` is a written table with one row per key.

    Its size is known from its files. Below the broadcast limit the base is read
    where it lies, neither grouped nor sorted, and a second look at its keys alone
    finds the new ones. Beyond it, one full join reads both sides once.
    """
    delta = delta.select(*base.columns)
    changes = delta.select(F.col(pk).alias("_key"), F.struct(*delta.columns).alias("_new"))
    if not broadcastable(delta):
        stored = base.select(F.col(pk).alias("_key"), F.struct(*base.columns).alias("_old"))
        wins = F.col("_new").isNotNull() & newer(F.col(f"_new.{version}"), F.col(f"_old.{version}"))
        row = F.when(wins, F.col("_new")).otherwise(F.col("_old"))
        return stored.join(changes, "_key", "full").select(row.alias("_row")).select("_row.*")
    kept = F.struct(*(base[c] for c in base.columns))
    wins = F.col("_key").isNotNull() & newer(F.col(f"_new.{version}"), base[version])
    merged = (
        base.join(changes, base[pk] == changes["_key"], "left")
        .select(F.when(wins, F.col("_new")).otherwise(kept).alias("_row"))
        .select("_row.*")
    )
    known = base.select(F.col(pk)).join(delta.select(pk), pk, "left_semi").distinct()
    return merged.unionByName(delta.join(known, pk, "left_anti"))


def _left(merged: DataFrame, deleted: str | None) -> DataFrame:
    """Merged rows without those whose newest version is a deletion."""
    return merged.where(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted) if deleted else merged


def _unmarked(base: DataFrame, deleted: str | None) -> DataFrame:
    return base.withColumn(deleted, F.lit(None).cast("boolean")) if deleted else base


def inc_merge_latest(
    base: DataFrame, delta: DataFrame, pk: str = "id", version: str = "updated_at", deleted: str | None = None
) -> DataFrame:
    """``base`` (one row per key) with the changes of ``delta`` applied; a delta
    row wins unless the base row is newer, and no version is older than any.

    ``deleted`` names a boolean column of the delta: a key whose newest version is
    true there goes. A deletion that is older than the stored row changes nothing.
    """
    changes = stage(latest_per_key(delta, pk, version), "delta")
    return _left(_with_changes(_unmarked(base, deleted), changes, pk, version), deleted)


def moved_keys(table: DataFrame, delta: DataFrame, date_column: str, pk: str = "id") -> DataFrame:
    """Keys of the delta that the table has under another date. Reads key and date of the whole table."""
    old = table.select(pk, F.col(date_column).alias("old_date"))
    new = delta.select(pk, F.col(date_column).alias("new_date")).distinct()
    return old.join(new, pk).where(~F.equal_null("old_date", "new_date"))


def merge_into_dates(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    date_column: str,
    pk: str = "id",
    version: str = "updated_at",
    check_moved: bool = True,
    deleted: str | None = None,
) -> None:
    """Merge a delta into a warehouse table partitioned by date, as a new version of the touched dates.

    Any number of merges may run at a time: one that finds a touched date committed
    by another meanwhile merges anew into what that one left; if only other dates
    were, it keeps its rows and takes the next number.

    A key must keep its date; a delta that moves one is refused before anything is
    written, since its old row lies in a date this merge does not read. That check
    is the only step that looks beyond the touched dates; feeds whose dates cannot
    change do without (``check_moved=False``). NULL is a date like any other.
    Repeating a merge gives the same table, and readers keep the version they
    began with. Rows for which ``deleted`` is true take their key out of the date
    they name; a date that loses its last row is empty from then on.
    """
    fields = [f for f in delta.schema.fields if f.name != deleted]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    with staged(latest_per_key(delta, pk, version), "delta") as latest:

        def refuse_moved() -> None:
            if not moved_keys(read_current(spark, path, schema), latest, date_column, pk).isEmpty():
                raise ValueError(f"a delta row changes {date_column}; rewrite the whole table instead")

        # NULL joins nothing; a filter besides, as a null-safe join would not prune the other dates.
        undated = not latest.where(F.col(date_column).isNull()).isEmpty()
        dates = latest.select(date_column).distinct()
        replaced = [partition_name(date_column, r[0]) for r in dates.collect()] if deleted else []  # one row per date
        for _ in range(TRIES):
            table, number = read_at(spark, path, schema)
            if check_moved:
                refuse_moved()
            affected = table.join(dates, date_column, "left_semi").select(*(f.name for f in fields))
            if undated:
                affected = affected.unionByName(table.where(F.col(date_column).isNull()).select(*affected.columns))
            merged = _left(_with_changes(_unmarked(affected, deleted), latest, pk, version), deleted)
            try:
                write_version(merged, path, date_column, number, refuse_moved if check_moved else None, replaced)
                return
            except Overlap:
                continue
    raise RuntimeError(f"other writers kept changing the same dates of {path}")


def util_touch_updated_at(
    stored: DataFrame, incoming: DataFrame, run_time: datetime, pk: str = "id", column: str = "updated_at"
) -> DataFrame:
    """Incoming rows with ``updated_at`` set to the run where the row changed.

    Unchanged rows keep the stored time, new rows their own.
    """
    content = [c for c in incoming.columns if c not in (pk, column)]
    # Only stored rows of incoming keys take part: while those are few, the stored
    # table is filtered where it lies.
    before = stored.join(incoming.select(pk).distinct(), pk, "left_semi").select(
        F.col(pk).alias("_key"), F.struct(*content).alias("_stored"), F.col(column).alias("_stored_at")
    )
    changed = ~F.equal_null(F.col("_stored"), F.struct(*(incoming[c] for c in content)))
    touched = (
        F.when(F.col("_key").isNull(), incoming[column])
        .when(changed, F.lit(run_time).cast("timestamp_ntz"))
        .otherwise(F.col("_stored_at"))
    )
    return incoming.join(before, incoming[pk] == before["_key"], "left").select(
        *(touched.alias(column) if c == column else incoming[c] for c in incoming.columns)
    )
