"""Delay questions answered from the roll-up alone: the same oracle SQL as over the facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from adherence.operators import delays as A
from adherence.operators import rollup as U
from adherence.plans import registry as REG
from adherence.plans.registry import ORACLE, register


def _rollup(spark, d) -> U.Rollup:
    return U.build(REG.star(spark, d))


@register("rollup_kpis", ORACLE["kpis"])
def q_rollup_kpis(spark, d):
    return U.kpis(_rollup(spark, d))


@register("rollup_filtered_kpis", ORACLE["filtered_kpis"])
def q_rollup_filtered_kpis(spark, d):
    return U.kpis(_rollup(spark, d), REG._FILTERED)


@register("rollup_avg_delay_by_route", ORACLE["avg_delay_by_route"])
def q_rollup_avg_delay_by_route(spark, d):
    return U.avg_delay_by_route(_rollup(spark, d))


@register("rollup_route_lateness", ORACLE["route_lateness"])
def q_rollup_route_lateness(spark, d):
    return U.route_lateness(_rollup(spark, d))


@register("rollup_delay_heatmap", ORACLE["delay_heatmap"])
def q_rollup_delay_heatmap(spark, d):
    return U.delay_heatmap(_rollup(spark, d))


@register("rollup_worst_stops", ORACLE["worst_stops"])
def q_rollup_worst_stops(spark, d):
    return U.worst_stops(_rollup(spark, d))


@register("rollup_stops_map", ORACLE["stops_map"])
def q_rollup_stops_map(spark, d):
    return U.stops_map(_rollup(spark, d))


@register("rollup_color_range", ORACLE["robust_color_range"])
def q_rollup_color_range(spark, d):
    m = A.stops_map_evidence(U.stops_map(_rollup(spark, d)))
    return A.robust_color_range(m.withColumn("avg_delay_min", F.col("avg_delay_sec") / 60), "avg_delay_min")


@register("rollup_punctuality_summary", ORACLE["punctuality_summary"])
def q_rollup_punctuality_summary(spark, d):
    return U.punctuality_summary(_rollup(spark, d))


@register("rollup_punctuality_story", ORACLE["punctuality_story"])
def q_rollup_punctuality_story(spark, d):
    r = _rollup(spark, d)
    return A.punctuality_story(U.punctuality_summary(r)).unionByName(A.punctuality_story(U.punctuality_summary(r, REG._NO_FACTS)))
