"""Dimension build and lookup (L1-L4, J15, J16) and dimension joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence import session
from adherence.constants import DEFAULT_ROUTE_TYPE, VEHICLE_TYPES
from adherence.functions import gtfs_time as T
from adherence.functions.ids import stable_key


#: Rows of a dimension that a broadcast may hold; beyond it the join is planned without a hint.
DIM_ROWS = 200_000


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "inner", rows: int | None = None) -> DataFrame:
    """Join a dimension.  Its rows are counted first, up to one more than ``DIM_ROWS``: so few are broadcast, so
    that facts are neither shuffled nor sorted by the few values of a foreign key; else Spark decides, over as many
    partitions as the facts' ``rows`` ask for where their number is given (``by_rows``)."""
    few = dim.limit(DIM_ROWS + 1).count() <= DIM_ROWS
    if not few and rows is not None and rows > session.TASK_ROWS:
        fact = session.by_rows(fact, rows, on)
    return fact.join(F.broadcast(dim) if few else dim, on=on, how=how)


def vehicle_type_dim(spark: SparkSession) -> DataFrame:
    """L2: the fixed vehicle-type seed; ``vehicle_type_key`` is the seed position (1-based)."""
    return literal_table(spark, [(i + 1, code, name) for i, (code, name) in enumerate(VEHICLE_TYPES)],
                         "vehicle_type_key int, gtfs_route_type int, type_name string")


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed seed table as a JVM-side local relation (no Python RDD scan)."""
    names = [c.strip().split()[0] for c in schema.split(",")]
    types = [c.strip().split()[1] for c in schema.split(",")]

    def lit(v, t):
        if v is None:
            return f"CAST(NULL AS {t})"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"CAST({v!r} AS {t})"

    values = ", ".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")


def bus_key() -> int:
    return next(i + 1 for i, (code, _) in enumerate(VEHICLE_TYPES) if code == DEFAULT_ROUTE_TYPE)


def lookup_vehicle_type(df: DataFrame, vehicle_types: DataFrame, route_type: Column) -> DataFrame:
    """Blank / non-numeric route_type -> 3; unknown code -> the Bus key."""
    code = F.coalesce(F.trim(route_type).try_cast("int"), F.lit(DEFAULT_ROUTE_TYPE))
    vt = F.broadcast(vehicle_types.select("gtfs_route_type", "vehicle_type_key"))  # fixed 8-row seed
    out = df.withColumn("_rt_code", code).join(vt, F.col("_rt_code") == vt.gtfs_route_type, "left")
    return out.withColumn(
        "vehicle_type_key", F.coalesce(F.col("vehicle_type_key"), F.lit(bus_key()))
    ).drop("_rt_code", "gtfs_route_type")


def calendar_from_dates(dates: DataFrame, col: str = "full_date") -> DataFrame:
    """L1: the calendar dimension spanning min..max of a date column (one row per day).

    The span is reduced with a partial aggregate; the exploded sequence has one row per day,
    so its size is bounded by the calendar span, not by the data volume.
    """
    bounds = dates.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return days.select(
        T.date_key("full_date").alias("date_key"),
        "full_date",
        T.iso_day_of_week("full_date").alias("day_of_week"),
        T.day_name("full_date").alias("day_name"),
        T.is_weekend("full_date").alias("is_weekend"),
        F.lit(False).alias("is_swedish_holiday"),
    )


def merge_scd1(existing: DataFrame | None, incoming: DataFrame, natural_key: list[str], operator: str,
               key_col: str) -> DataFrame:
    """L3/L4: SCD-1 upsert on (natural key, operator).

    Incoming attributes overwrite existing ones (of rows that share a key, the greatest attributes, so a
    rerun picks the same); rows only in ``existing`` are kept.  The surrogate
    key is a stable hash of (operator, natural key) (D10), so it never changes across runs and
    needs no global counter.
    """
    rest = [c for c in incoming.columns if c not in natural_key]
    one = incoming.groupBy(*natural_key).agg(F.max(F.struct(*rest)).alias("_w")).select(*natural_key, "_w.*") if rest \
        else incoming.distinct()
    inc = (
        one.withColumn("operator", F.lit(operator))
        .withColumn(key_col, stable_key(F.lit(operator), *natural_key))
    )
    if existing is None:
        return inc
    keys = natural_key + ["operator"]
    kept = existing.join(inc.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(inc.select(*existing.columns))
