"""Stored models: training, choice by day, scoring and appending of predictions."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from ..functions.dates import days_between
from ..operators import lifecycle as lc
from ..operators import model as md
from ..operators import runs
from ..operators import snapshots as snap
from ..session import ensure_checkpoint_dir
from ..sources import fixtures as fx
from ..sources.tables import Tables
from .q_lookup_runs import _PARAMS_SQL, _params_table
from .registry import register

CATEGORICAL = ["staffing_status", "first_channel", "billing_type_id"]
MULTICATEGORICAL = ["staffing_channels"]
NUMERIC = ["primary_skill_id", "primary_skill_category_id", "city_id", "country_id", "time_after_creation"]
#: Training days are the month ends of this span, scored days its weekly days and those of the month after.
TRAIN_SPAN, SCORE_SPAN = ("1996-05-01", "1996-06-30"), ("1996-05-20", "1996-07-31")


def _store(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/staffsight-models-{uuid.uuid4().hex}"


def _rows(t, days):
    """Positions open on each day, with their first billable day's class and their age."""
    positions = fx.v_position(t).withColumn("staffing_channels", F.array("first_channel"))
    open_ = snap.validity_join(days.withColumnRenamed("date", "day"), positions, how="inner").withColumnRenamed("day", "date")
    span = snap.billable_span(fx.v_worklog(t)).select("position_id", F.col("first_billable_date").alias("timesheet_date"))
    rows = open_.join(span, "position_id", "left").withColumn("time_after_creation", days_between("created", "date"))
    return md.horizon_class(rows)


def _parameters(t) -> dict:
    """The stored parameters of the newest run, as arguments of the trainer."""
    stored = runs.best_params(_params_table(t), "click").first()
    depth = json.loads(stored["best_params"])["depth"] if stored and stored["best_params"] else 4
    return {"max_depth": 1 + depth, "num_trees": 5}


def _train(spark, t, store, days, scopes_of_last=md.SCOPES):
    """Models at each of ``days``; the last day trains ``scopes_of_last`` only and names the others without a path."""
    rows, parameters = _rows(t, spark.createDataFrame([(d,) for d in days], "date date")), _parameters(t)
    # the history and the hours are read and joined once for all days
    needed = dict.fromkeys(["date", *md.SCOPE_COLUMNS, *CATEGORICAL, *MULTICATEGORICAL, *NUMERIC, "target"])
    rows = rows.select(*needed).checkpoint()
    for run, day in enumerate(days):
        mine = rows.where(F.col("date") == F.lit(day))
        scopes = scopes_of_last if day == days[-1] else md.SCOPES
        lc.train_models(mine, store, day, 1_700_000_000 + run, CATEGORICAL, MULTICATEGORICAL, NUMERIC, parameters, scopes)
    others = [(s, days[-1], 1_700_000_000 + len(days), None, "{}", "{}", "none") for s in md.SCOPES if s not in scopes_of_last]
    if others:
        lc.register_models(spark.createDataFrame(others, lc.REGISTRY_SCHEMA), store)


def _wanted(spark, span, weekly=False):
    return sorted(r["date"] for r in runs.wanted_days(spark, *span, weekly=weekly).collect())


_OPEN_SQL = """o as (select d.date, p.*, case when p.staffing_status = 'Assigned' then 'assigned'
    when p.first_channel = 'No staffing required' then 'no_staffing_required' else 'in_staffing' end as scope
  from days d join v_position p on p.valid_from <= d.date and (p.valid_to is null or d.date < p.valid_to))"""


@register("m4_model_registry", f"""
with {_PARAMS_SQL},
days as (select cast(d as date) as date from (values ('1996-05-31'), ('1996-06-30')) t(d)),
{_OPEN_SQL},
s as (select date, 'assigned' as scope from o where staffing_status = 'Assigned'
  union all select date, 'no_staffing_required' from o where first_channel = 'No staffing required'
  union all select date, 'in_staffing' from o where staffing_status <> 'Assigned' and first_channel <> 'No staffing required')
select scope, date, cast(count(*) as bigint) as n_rows, true as stored, 1 + (select cast(json_extract_string(arg_max(best_params, run_id), '$.depth') as int)
  from p where task_type = 'click') as max_depth, true as accurate from s group by 1, 2""", views=("v_run", "v_position"))
def q_registry(spark, sf_dir):
    """A model per scope at each month end, trained with the stored parameters, saved and registered."""
    t = Tables(spark, sf_dir)
    store = _store(spark)
    _train(spark, t, store, _wanted(spark, TRAIN_SPAN))
    entries = lc.read_registry(spark, store)
    accuracy = F.get_json_object("metrics", "$.accuracy").cast("double")
    return entries.select("scope", "date", F.get_json_object("metrics", "$.n_rows").cast("long").alias("n_rows"),
                          F.col("path").isNotNull().alias("stored"), F.get_json_object("params", "$.max_depth").cast("int").alias("max_depth"),
                          accuracy.between(0.25, 1.0).alias("accurate"))


@register("m5_stored_model_scores", f"""
with m as (select unnest(generate_series(date '1996-05-01', date '1996-07-01', interval 1 month)) as m),
days as (select distinct cast(d as date) as date from (
    select unnest(generate_series(cast(m as date), last_day(m), interval 7 day)) as d from m union all select last_day(m) from m) x
  where cast(d as date) between date '1996-05-31' and date '1996-07-31'),
{_OPEN_SQL}
select scope, date, cast(count(*) as bigint) as n_rows, cast(count(*) as double) as sum_probability, cast(1700000500 as bigint) as run_id,
  case when scope <> 'no_staffing_required' and date >= date '1996-06-30' then date '1996-06-30' else date '1996-05-31' end as model_date
from o group by 1, 2""", views=("v_position",))
def q_scores(spark, sf_dir):
    """Each day scored by the model of that day, appended as a run that is tried twice, and read back.

    The last training day has no model of one scope, which goes on with the one before (W9); one
    input column is missing and filled (P12).
    """
    t = Tables(spark, sf_dir)
    store = _store(spark)
    _train(spark, t, store, _wanted(spark, TRAIN_SPAN), ("assigned", "in_staffing"))
    days = spark.createDataFrame([(d,) for d in _wanted(spark, SCORE_SPAN, weekly=True)], "date date")
    rows = md.scope_label(_rows(t, days)).drop("country_id")
    scored = lc.score_days(rows, store, CATEGORICAL, MULTICATEGORICAL, NUMERIC)
    chosen = lc.models_for(lc.read_registry(spark, store), days).select(F.col("day").alias("date"), "scope", "model_date")
    scored = scored.join(chosen, ["date", "scope"])
    for _ in range(2):
        lc.publish_run(scored, f"{store}/predictions", 1_700_000_500)
    back = lc.read_runs(spark, f"{store}/predictions")
    total = sum((F.col(f"probability_{k}") for k in range(1, 4)), F.col("probability_0"))
    return back.groupBy("scope", F.col("date").cast("date").alias("date"), "run_id", "model_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(total), 6).alias("sum_probability"))


@register("w9_model_fill_forward", """
with reg as (select distinct event_type as scope, day as date, case when run_id % 8 = 0 then event_type || cast(day as varchar) end as path
  from v_run where run_id % 4 = 0),
one as (select scope, date, max(path) as path from reg group by 1, 2),
f as (select scope, date, last_value(path ignore nulls) over (partition by scope order by date rows between unbounded preceding and current row) as path,
  last_value(case when path is not null then date end ignore nulls) over (partition by scope order by date rows between unbounded preceding and current row) as model_date,
  lead(date) over (partition by scope order by date) as until from one),
days as (select distinct day from v_run)
select d.day, f.scope, f.model_date, f.path from days d join f on d.day >= f.date and (f.until is null or d.day < f.until)
where f.path is not null""", views=("v_run",))
def q_fill_forward(spark, sf_dir):
    """Every day's model per scope, from a registry in which some entries have no path."""
    r = fx.v_run(Tables(spark, sf_dir))
    path = F.when(F.col("run_id") % 8 == 0, F.concat("event_type", F.col("day").cast("string")))
    registry = r.where(F.col("run_id") % 4 == 0).select(F.col("event_type").alias("scope"), F.col("day").alias("date"), path.alias("path"), "run_id").distinct()
    return lc.models_for(registry, r.select("day").distinct(), "day")
