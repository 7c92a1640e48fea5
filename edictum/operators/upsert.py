"""Keyed merge of a batch into the policy table, with run statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edictum.functions.names import fresh
from edictum.operators.numbering import number_rows
from edictum.operators.skew import thin_side
from edictum.session import stage

# Error text is at most 4000 characters; a line takes at least 3, so no more lines can matter.
ERROR_CHARS = 4000
ERROR_LINES = ERROR_CHARS // 3 + 1
REQUIRED = ("title", "source_url")


def accepted(batch: DataFrame, required=REQUIRED) -> DataFrame:
    """Rows with every required column."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return batch.where(ok)


def rejected(batch: DataFrame, required=REQUIRED) -> DataFrame:
    """Rows that lack a required column, with a message."""
    message = F.coalesce(
        *[F.when(F.col(c).isNull(), F.lit(f"NOT NULL constraint failed: policies.{c}")) for c in required]
    )
    return batch.withColumn("error", message).where("error IS NOT NULL")


#: Tells rows of a staged batch apart.
ROW = "_row"


def with_rows(batch: DataFrame) -> DataFrame:
    """The batch, staged, with a number for each row: it is read once for its keys and once for its rows."""
    return batch if ROW in batch.columns else stage(batch.withColumn(ROW, F.monotonically_increasing_id()))


def latest_per_key(batch: DataFrame, key: str = "source_url", order: str = "seq") -> DataFrame:
    """Last row of each key by ``order``, with the first position of the key as ``first_seq``.

    Only keys, positions and row numbers are aggregated. A key that has one row keeps it as it is; those
    with more, usually few, tell which row stays. Contents are neither sorted nor aggregated.
    """
    rows = with_rows(batch)
    last, first, of, times = fresh(rows, "last", "first", "of", "times")
    keys = rows.groupBy(F.col(key).alias(of)).agg(F.max_by(ROW, order).alias(last), F.min(order).alias(first), F.count(F.lit(1)).alias(times))
    repeated = thin_side(stage(keys.where(F.col(times) > 1).drop(times)))
    kept = rows.join(repeated, F.col(key).eqNullSafe(F.col(of)), "left").where(F.col(last).isNull() | (F.col(last) == F.col(ROW)))
    values = [c for c in rows.columns if c not in (key, ROW)]
    return kept.select(key, *values, F.coalesce(first, order).alias("first_seq"))


def known(batch: DataFrame, stored: DataFrame, key: str = "source_url") -> DataFrame:
    """Rows whose key is stored."""
    return batch.join(stored.select(key), key, "left_semi")


def unknown(batch: DataFrame, stored: DataFrame, key: str = "source_url") -> DataFrame:
    """Rows whose key is not stored."""
    return batch.join(stored.select(key), key, "left_anti")


def touched_rows(
    stored: DataFrame,
    batch: DataFrame,
    as_of: Column,
    key: str = "source_url",
    order: str = "seq",
    update_cols: tuple[str, ...] | None = None,
) -> DataFrame:
    """The rows a batch inserts or updates, with ``is_new`` and ``first_seq``.

    Only the stored columns that survive an update are read, and only for the keys of the batch: the id,
    the creation time and, where ``update_cols`` names fewer than all columns, the rest.
    """
    system = ("id", "created_at", "updated_at")
    columns = [c for c in stored.columns if c not in (key, *system)]
    incoming = [c for c in columns if c in batch.columns]
    updated = [c for c in incoming if update_cols is None or c in update_cols]
    keep = [c for c in stored.columns if c == key or c in ("id", "created_at") or (c in columns and c not in updated)]
    rows = accepted(with_rows(batch))
    last = latest_per_key(rows.select(key, order, ROW, *incoming), key, order)
    old = stored.join(rows.select(F.col(key).alias("_of")).distinct(), F.col(key) == F.col("_of"), "left_semi")
    old = old.select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_old_{c}") for c in keep if c != key], F.lit(True).alias("_old")
    )
    if set(keep) <= {key, "id", "created_at"}:
        old = thin_side(stage(old))
    is_new = F.col("_old").isNull()

    def value(c: str) -> Column:
        kind = stored.schema[c].dataType
        if c == key:
            return F.col(c)
        if c == "id":
            return F.col("_old_id")
        if c == "created_at":
            return F.coalesce("_old_created_at", as_of.cast(kind)).alias(c)
        if c == "updated_at":
            return as_of.cast(kind)
        new = F.col(c).cast(kind) if c in incoming else F.lit(None).cast(kind)
        return new if c in updated else F.when(is_new, new).otherwise(F.col(f"_old_{c}"))

    return last.join(old, last[key] == old["_key"], "left").select(
        *[value(c).alias(c) for c in stored.columns], is_new.alias("is_new"), "first_seq"
    )


def upsert(
    stored: DataFrame,
    batch: DataFrame,
    as_of: Column,
    key: str = "source_url",
    order: str = "seq",
    update_cols: tuple[str, ...] | None = None,
) -> DataFrame:
    """The table after a batch: touched rows replaced, new rows added, all others as they were.

    Later rows of a batch win; ``id`` and ``created_at`` of a stored row stay, ``updated_at`` is
    ``as_of``. ``update_cols`` limits what an update changes. New rows get no id here, see
    :func:`assign_ids`. Untouched rows only meet the keys of the batch: one that is small next to the
    table moves none of the table's content, and a large one moves it without sorting it, or not at all
    where the table is stored in buckets of the key (:func:`tables.write_bucketed`).
    """
    batch = with_rows(batch)
    touched = touched_rows(stored, batch, as_of, key, order, update_cols).select(*stored.columns, "is_new", "first_seq")
    keys = thin_side(stage(accepted(batch).select(F.col(key).alias("_key")).distinct()))
    rest = stored.join(keys, F.col(key) == F.col("_key"), "left_anti").select(
        *stored.columns, F.lit(False).alias("is_new"), F.lit(None).cast("bigint").alias("first_seq")
    )
    return touched.unionByName(rest)


def assign_ids(merged: DataFrame, stored: DataFrame, key: str = "source_url", top: Column | None = None) -> DataFrame:
    """Give new rows the next ids, in the order they first appeared, after ``top`` or the highest stored one.

    Only keys and positions are numbered; the ids then meet the new rows by key.
    """
    columns = stored.columns
    if top is None:
        top = stored.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint")).scalar()
    new = merged.where("is_new")
    places = number_rows(new.select(F.col(key).alias("_key"), "first_seq"), "first_seq", out="_n").drop("first_seq")
    numbered = new.join(places, F.col(key) == F.col("_key")).withColumn("id", top + F.col("_n")).select(*columns)
    return merged.where("NOT is_new").select(*columns).unionByName(numbered)


# ---------------------------------------------------------------- run statistics


def run_status(errors: Column, new_added: Column) -> Column:
    return F.when(errors == 0, "SUCCESS").when(new_added > 0, "PARTIAL").otherwise("FAILED")


def run_statistics(batch: DataFrame, stored: DataFrame, key: str = "source_url") -> DataFrame:
    """One row: total, new_added (distinct new keys), errors, status."""
    bad = F.col("title").isNull() | F.col(key).isNull()
    per_key = batch.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad"), F.count_if(~bad).alias("good")
    )
    marked = per_key.join(stored.select(F.col(key).alias("_key")), F.col(key) == F.col("_key"), "left")
    totals = marked.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total"),
        F.count_if(F.col("_key").isNull() & (F.col("good") > 0)).alias("new_added"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("errors"),
    )
    return totals.withColumn("status", run_status(F.col("errors"), F.col("new_added")))


def error_details(errors: DataFrame, key: str = "source_url", order: str = "seq") -> DataFrame:
    """One row: ``url: message`` lines in order, cut at 4000 characters.

    Only as many lines as can show are brought together, each cut to what can show.
    """
    line = F.concat(F.coalesce(key, F.lit("None")), F.lit(": "), F.col("error"))
    first = errors.select(order, F.substring(line, 1, ERROR_CHARS).alias("line")).orderBy(order).limit(ERROR_LINES)
    lines = F.transform(F.array_sort(F.collect_list(F.struct(order, "line"))), lambda e: e["line"])
    return first.agg(F.substring(F.array_join(lines, "\n"), 1, ERROR_CHARS).alias("error_details"))


def run_log(batch: DataFrame, stored: DataFrame, task_name: str, start: Column, end: Column) -> DataFrame:
    """The log row of a run, without its id."""
    stats = run_statistics(batch, stored)
    details = error_details(rejected(batch))
    return stats.select(
        F.lit(task_name).alias("task_name"),
        start.cast("timestamp").alias("start_time"),
        end.cast("timestamp").alias("end_time"),
        F.col("total").alias("total_fetched"),
        "new_added",
        F.col("errors").alias("error_count"),
        details.scalar().alias("error_details"),
        "status",
    )


def last_logs(logs: DataFrame, n: int = 20) -> DataFrame:
    return logs.orderBy(F.desc("id")).limit(n)

