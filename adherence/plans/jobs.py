"""Daily jobs as spark-submit entry points: transform, data-quality gate, energy scoring.

    spark-submit -m adherence.plans.jobs transform --service-date 2026-07-12 --raw-base-path s3a://... \\
        --warehouse s3a://.../warehouse --operator sl --operator-name SL [--sample-fraction 0.05]

Every step stays a DataFrame; the driver only sees counts, the load report and the small DQ
report.  Intermediate staging goes under ``--staging`` (default: ``<warehouse>/_staging``), never
a machine-local folder.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adherence.constants import DEFAULT_ZONE, REALTIME_FEED_REGIONAL, STATIC_FEED_NATIONAL
from adherence.operators import dims as D
from adherence.operators import energy as E
from adherence.operators import facts as FACTS
from adherence.operators import match as M
from adherence.operators import quality as Q
from adherence.operators import rollup as U
from adherence.operators import runs as RUNS
from adherence.session import cut_lineage
from adherence.sources import gtfs_static as G
from adherence.sources import landing as L
from adherence.sources import tripupdates as TU
from adherence.sources import versions as V
from adherence.sources import warehouse as W
from adherence.sources.driver import Star

log = logging.getLogger("adherence.jobs")

FACTS_TABLE, REJECTS_TABLE, ENERGY_TABLE = "fact_trip_delay", "fact_rejects", "fact_route_energy_score"


def run_transform(spark: SparkSession, service_date: str, raw_base: str, warehouse: str, operator_name: str,
                  static_feed: str = STATIC_FEED_NATIONAL, realtime_feed: str = REALTIME_FEED_REGIONAL,
                  sample_fraction: float | None = None, dag_run_id: str | None = None, staging: str | None = None,
                  zone: str = DEFAULT_ZONE, mode: str = "latest", keep_unmatched: bool = False,
                  quarantine_out_of_range: bool = False, same_day_only: bool = False, use_calendar: bool = False,
                  with_energy: bool = False, retain: int = 0) -> dict:
    """Raw GTFS + TripUpdates of one service date -> dims merged, facts replaced, run recorded.

    Facts, rejects, both parts of the roll-up and, ``with_energy``, the energy scores of the date are staged
    and then change together (``versions``); a job that ends before that leaves the old load as it was.
    Files of the ``retain`` versions before stay, for readers that are under way.
    ``same_day_only`` drops realtime trips of another start date, ``use_calendar`` scheduled trips whose
    service doesn't run that day (both D6); ``keep_unmatched`` keeps visits without realtime (D5)."""
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    # a folder of this run's own: what an earlier archive had and this one lacks is not read
    staging = f"{staging or f'{warehouse}/_staging/{service_date}'}/{uuid.uuid4().hex}"
    archives = L.list_files(spark, raw_base, "static", "gtfs.zip").filter(
        F.col("service_date") == F.lit(service_date).cast("date"))
    if archives.isEmpty():
        raise L.MissingInputError(f"static GTFS not found for {service_date}")
    members = G.list_members(archives)
    L.check_members(members)
    G.stage_members(members, staging).count()
    feed = G.read_feed(spark, staging)
    if use_calendar:
        calendar, dates = (G.read_optional(spark, staging, t) for t in ("calendar", "calendar_dates"))
        if calendar is not None or dates is not None:
            feed.trips = M.running_trips(feed.trips, M.active_services(calendar, dates, service_date))

    # Only the last snapshot of the day is read (S7), unless all are asked for
    if mode != "all":
        L.latest_snapshot_path(spark, raw_base, service_date)  # there is one, or an error says so
    options = {"from": service_date, "to": service_date, "latest": str(mode != "all").lower()}
    snapshots = cut_lineage(TU.load(spark, f"{raw_base}/realtime", **options))  # decoded once: the match looks at it twice
    letters = TU.dead_letters(snapshots)
    if not letters.isEmpty():
        log.warning("snapshots of %s that cannot be decoded are in %s/dead_letters", service_date, warehouse)
        letters.write.mode("append").parquet(f"{warehouse}/dead_letters")
    rt = M.prepare_realtime(TU.require_rows(TU.updates(snapshots, zone=zone)), static_feed, realtime_feed)
    if same_day_only:
        rt = M.same_service_day(rt, service_date)

    own_routes, _ = M.select_operator(feed, static_feed)
    sched = M.scheduled(feed, static_feed, service_date=service_date, zone=zone, sample_fraction=sample_fraction)
    matched, strategy = M.match(sched, rt, default_date=service_date, keep_unmatched=keep_unmatched)
    derived = cut_lineage(M.derive(matched, zone))  # facts, rejects and the report come from these rows

    routes_in = own_routes.select("route_id", "route_short_name", "route_long_name")
    stops_in = M.referenced_stops(feed.stops, M.operator_stop_times(feed, static_feed)).select(
        "stop_id", "stop_name", F.col("stop_lat").try_cast("double").alias("stop_lat"),
        F.col("stop_lon").try_cast("double").alias("stop_lon"))
    routes = W.replace_dim(D.merge_scd1(W.read_dim(spark, f"{warehouse}/dim_route"), routes_in, ["route_id"], operator_name, "route_key"), f"{warehouse}/dim_route")
    stops = W.replace_dim(D.merge_scd1(W.read_dim(spark, f"{warehouse}/dim_stop"), stops_in, ["stop_id"], operator_name, "stop_key"), f"{warehouse}/dim_stop")

    facts, report, rejects = FACTS.build(derived, routes, stops, D.vehicle_type_dim(spark), quarantine_out_of_range, operator_name)
    dk = int(service_date.replace("-", ""))
    load, day = V.Load(spark, warehouse), [V.partition_of(date_key=dk)]
    load.write(W.arranged(facts), FACTS_TABLE, ["date_key"], day)
    load.write(rejects, REJECTS_TABLE, ["date_key"], day)                 # D12/Q10: set aside with a reason
    star = Star(load.staged(FACTS_TABLE), routes, stops, D.vehicle_type_dim(spark))
    rollup = U.build(star)
    load.write(rollup.delays, W.HISTOGRAM_TABLE, ["date_key"], day)
    load.write(rollup.trips, W.TRIPS_TABLE, ["date_key"], day)
    if with_energy:
        _stage_energy(load, star, dk)
    load.publish(retain=retain)
    rep = report.first().asDict()
    V.delete(spark, staging)
    rep.update(strategy=strategy, service_date=service_date)
    RUNS.append(RUNS.run_record(spark, service_date, "success", rep["rows_loaded"], dag_run_id, started),
                f"{warehouse}/pipeline_runs")
    log.info("transform %s: %s", service_date, rep)
    return rep


def run_quality(spark: SparkSession, service_date: str, warehouse: str, raw_base: str | None = None,
                as_of: dt.datetime | None = None, dag_run_id: str | None = None) -> DataFrame:
    """DQ-001..007 for one date, status persisted as an event, then the ERROR gate."""
    dk = int(service_date.replace("-", ""))
    facts = W.read_star(spark, f"{warehouse}/fact_trip_delay", dk, dk)
    day = spark.range(1).select(F.lit(service_date).cast("date").alias("full_date"))
    dims = {"date": (D.calendar_from_dates(day), "date_key"),
            "route": (W.read_dim(spark, f"{warehouse}/dim_route"), "route_key"),
            "stop": (W.read_dim(spark, f"{warehouse}/dim_stop"), "stop_key"),
            "vehicle_type": (D.vehicle_type_dim(spark), "vehicle_type_key")}
    age = None
    if raw_base is not None:
        side = L.read_sidecars(spark, f"{raw_base}/static/{service_date}")
        ages = L.static_age_days(side, as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        age = ages.agg(F.min("age_days")).first()[0]  # of the newest pull
    p = Q.profile(facts, dims)
    none = spark.range(1).select(F.lit(dk).alias("date_key"), *[F.lit(0).cast("bigint").alias(c) for c in p.columns if c != "date_key"])
    p = p.unionByName(none).groupBy("date_key").agg(*[F.sum(c).alias(c) for c in p.columns if c != "date_key"])  # an empty date has its row too
    # seven rows, computed once: the status, the gate and the caller look at them
    rep = cut_lineage(Q.report_of(p, F.lit(age).cast("double")))
    status = Q.status(rep).first()
    RUNS.append(RUNS.dq_event(spark, service_date, status.dq_status if status else "failed", dag_run_id),
                f"{warehouse}/pipeline_runs")
    Q.gate(rep)
    return rep


def _stage_energy(load: V.Load, star: Star, dk: int) -> None:
    regions = [V.partition_of(date_key=dk, region_id=r) for r, _, _ in E.REGIONS]
    load.write(E.compute(star).repartition("date_key", "region_id"), ENERGY_TABLE, ["date_key", "region_id"], regions)


def run_energy(spark: SparkSession, service_date: str, warehouse: str, retain: int = 0) -> int:
    """Scores of one date for every region; requested partitions are replaced even when empty."""
    dk = int(service_date.replace("-", ""))
    load = V.Load(spark, warehouse)
    _stage_energy(load, W.load_star(spark, warehouse, dk, dk), dk)
    n = load.staged(ENERGY_TABLE).count()
    load.publish(retain=retain)
    return n


def main(argv=None) -> int:
    p = argparse.ArgumentParser(description="adherence daily jobs")
    p.add_argument("job", choices=["transform", "quality", "energy"])
    p.add_argument("--service-date", required=True)
    p.add_argument("--raw-base-path")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--operator", default=STATIC_FEED_NATIONAL, help="static feed family")
    p.add_argument("--operator-name", default="SL")
    p.add_argument("--realtime-feed", default=REALTIME_FEED_REGIONAL)
    p.add_argument("--sample-fraction", type=float)
    p.add_argument("--dag-run-id")
    p.add_argument("--mode", choices=["latest", "all"], default="latest", help="the day's last snapshot, or all of them")
    p.add_argument("--keep-unmatched", action="store_true", help="keep scheduled visits without realtime")
    p.add_argument("--quarantine-out-of-range", action="store_true", help="out-of-range delays go to the rejects")
    p.add_argument("--same-day-only", action="store_true", help="drop realtime trips of another start date")
    p.add_argument("--with-energy", action="store_true", help="score the date in the same load")
    p.add_argument("--retain", type=int, default=0, help="versions before the new one whose files stay")
    p.add_argument("--use-calendar", action="store_true", help="only trips whose service runs that day")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"adherence-{a.job}").getOrCreate()
    from adherence.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    if a.job == "transform":
        run_transform(spark, a.service_date, a.raw_base_path, a.warehouse, a.operator_name, a.operator,
                      a.realtime_feed, a.sample_fraction, a.dag_run_id, mode=a.mode, keep_unmatched=a.keep_unmatched,
                      quarantine_out_of_range=a.quarantine_out_of_range, same_day_only=a.same_day_only, use_calendar=a.use_calendar,
                      with_energy=a.with_energy, retain=a.retain)
    elif a.job == "quality":
        run_quality(spark, a.service_date, a.warehouse, a.raw_base_path, dag_run_id=a.dag_run_id)
    else:
        run_energy(spark, a.service_date, a.warehouse, a.retain)
    return 0


if __name__ == "__main__":
    sys.exit(main())

