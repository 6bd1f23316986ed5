"""The horizon feature job: the order in which the feature blocks are added
to the snapshot rows, as one lazy plan. Every block is a lookup or a join on
(position, day) that keeps the row count; the only actions are the small checks the
blocks themselves make (day-list size, target list)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import ratios
from ..operators import encode as enc
from ..operators import history as hist
from ..operators import model as md
from ..operators import position_features as pf
from ..operators import rollups as ru
from ..operators import snapshots as snap
from ..sources import fixtures as fx
from ..sources.tables import Tables
from .registry import register

EVENT_KINDS = {"proposals": "Proposed", "booking": "Booked", "onboarding": "Onboarding"}
ROLLUP_TARGETS = ("Assigned", "Proposed", "Open")


def horizon_features(spark, t: Tables, days: DataFrame) -> DataFrame:
    """Snapshot rows of active positions with target (D4), date features (D2), event
    distances (W1–W3), running and current proposal counts (W4, A3), view features
    (W5–W7), location × skill roll-up (A4), ratios (D12), scope (P7), typed fills (P8)."""
    pos = fx.v_position(t).withColumn("staffing_channels", F.array("first_channel")) \
        .withColumn("skill_prefix", F.concat(F.lit("P"), (F.col("primary_skill_category_id") % 2).cast("string")))
    active = snap.active_positions(pos, billing_type=None)
    rows = snap.validity_join(days, active, how="inner").drop("valid_from", "valid_to")
    span = snap.billable_span(fx.v_worklog(t)).select("position_id", F.col("first_billable_date").alias("timesheet_date"))
    rows = md.horizon_class(rows.join(span, "position_id", "left").withColumnRenamed("day", "date"))
    rows = pf.position_date_features(rows)

    props = fx.v_proposal(t)
    for name, status in EVENT_KINDS.items():
        ev = props.where(F.col("staffing_status") == status)
        first = hist.first_event(ev, "position_id", "time", ["time"])
        last = hist.last_event(ev, "position_id", "time", ["time"])
        rows = hist.days_since(rows, first, "position_id", "date", "time", f"first_{name}")
        rows = hist.days_since(rows, last, "position_id", "date", "time", f"last_{name}")

    keys = rows.select("position_id", F.col("date").alias("day")).distinct()
    run = hist.running_status_counts(keys, props, "position_id", "day", "time", "staffing_status",
                                     {"proposed_proposals": "Proposed", "booked_proposals": "Booked",
                                      "preselected_proposals": "Preselected", "rejected_proposals": "Rejected"})
    cur = hist.proposal_counts(props.withColumn("day", F.col("time").cast("date")), "position_id", "day")
    views = fx.v_view(t).withColumnRenamed("entity_id", "position_id")
    trail = hist.trailing_views(keys, views, "position_id", 5)
    peak = hist.peak_day_asof(keys, views, "position_id")
    growth = hist.best_weekly_growth_asof(keys, views, "position_id")
    feats = (keys.join(run, ["position_id", "day"], "left").join(cur, ["position_id", "day"], "left")
             .join(trail, ["position_id", "day"], "left").join(peak, ["position_id", "day"], "left")
             .join(growth, ["position_id", "day"], "left"))
    rows = rows.join(feats.withColumnRenamed("day", "date"), ["position_id", "date"], "left")

    counts = rows.groupBy("date", "primary_skill_id", "primary_skill_category_id", "skill_prefix", "city_id",
                          "country_id", F.col("staffing_status").alias("target_status")).agg(
        F.count(F.lit(1)).alias("value")).withColumnRenamed("date", "day")
    rpos = rows.select("position_id", F.col("date").alias("day"), "primary_skill_id", "primary_skill_category_id",
                       "skill_prefix", "city_id", "country_id")
    roll = ru.rollup_features(rpos, counts, "target_status", "value", "active_positions", ROLLUP_TARGETS)
    rows = rows.join(roll.withColumnRenamed("day", "date"), ["position_id", "date"], "left")
    rows = ratios.time_relation_ratios(rows)
    rows = md.scope_label(rows)
    return enc.fill_by_type(rows)


@register("m15_horizon_feature_job")
def q_feature_job(spark, sf_dir):
    """Rows-only: the whole feature chain on two snapshot days."""
    from ..sources import io
    t = Tables(spark, sf_dir)
    return horizon_features(spark, t, io.days(spark, ["1996-01-01", "1998-06-01"]))
