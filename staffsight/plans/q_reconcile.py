"""Registered queries of the roll-up reconciliation and of the wide CRM input (A10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import crm
from ..operators import reconcile as rec
from ..operators import rollups as ru
from ..sources.tables import Tables
from .q_crm import _CRM_SQL, _amt_sql, _prob, crm_plan
from .q_rollups import TARGETS, _rollup_inputs, _rollup_oracle
from .registry import register

# columns damaged for the query: +1 at some positions on the first, one up and one down on the second
_UP = "positions_open_staffing_locations_city_id_primary_skill_id"
_SWAP = "positions_assigned_company"

_RECONCILE_SQL = f"""with r as ({_rollup_oracle("positions", None)}),
pc as (select distinct p.position_id, cast(p.primary_skill_id as varchar) as skill, cast(u.city as varchar) as city
  from v_position p, unnest(list_distinct([p.city_id, (p.city_id + p.position_id % 3) % 25])) u(city)),
placed as (select position_id, skill, string_agg(city, ',' order by city) as cities from pc group by 1, 2),
bad as (select r.day, '{_UP}' as feature, placed.cities as places, placed.skill, r.{_UP} + 1 as v, r.{_UP} as e
    from r join placed on r.position_id = placed.position_id where r.position_id % 97 = 5
  union all select r.day, '{_SWAP}', '', '', r.{_SWAP} + (case when r.position_id % 89 = 7 then 1 else -1 end), r.{_SWAP}
    from r where r.position_id % 89 in (7, 8))
select day, feature, places, skill, count(*) as n_positions, cast(min(v) as double) as low, cast(max(v) as double) as high,
  cast(max(e) as double) as expected
from bad group by 1, 2, 3, 4"""


def damaged_rollup(matrix):
    p = F.col("position_id")
    swap = F.when(p % 89 == 7, 1).when(p % 89 == 8, -1).otherwise(0)
    return matrix.withColumns({_UP: F.col(_UP) + F.when(p % 97 == 5, 1).otherwise(0), _SWAP: F.col(_SWAP) + swap})


@register("a36_reconcile_rollup", _RECONCILE_SQL, views=("v_position",))
def q_reconcile_rollup(spark, sf_dir):
    """A roll-up matrix with damaged values on two of its 36 columns; the cells that differ are named."""
    pos, feat = _rollup_inputs(spark, sf_dir)
    matrix = damaged_rollup(ru.rollup_features(pos, feat, "target", "value", "positions", TARGETS))
    return rec.reconcile_rollup(matrix, pos, feat, "target", "value", "positions", TARGETS)


_LABELS = {1.0: "100% - Contract Signed", 0.8: "80% - Written win notification", 0.6: "60% - Verbal win notification",
           0.4: "40% - Solution accepted / shortlisted", 0.1: "10% - Qualified"}


def crm_wide(t):
    """The plan as it is delivered: a row per project, snapshot, year and probability label, the months side by side."""
    label = F.element_at(F.create_map(*(F.lit(x) for k, v in _LABELS.items() for x in (int(round(k * 100)), v))),
                         F.round(F.col("probability") * 100).cast("int"))
    months = F.element_at(F.array(*map(F.lit, crm.MONTHS)), F.col("month"))
    return (crm_plan(t).withColumns({"label": label, "m": months})
            .groupBy("project_name", "customer_name", "gbu_id", "date", "year", "label")
            .pivot("m", list(crm.MONTHS)).agg(F.sum("amount")))


@register("a10_wide_scenario_totals", f"""
with {_CRM_SQL.strip()}
select project_name, date, """ + ", ".join(
    f"cast(sum({_amt_sql(s)}) as double) as {s.lower()}_amount" for s in crm.SCENARIOS) + """
from plan group by 1, 2""", views=("v_position",))
def q_wide_scenarios(spark, sf_dir):
    """A10 from the delivered form: months side by side and probability labels."""
    wide = crm_wide(Tables(spark, sf_dir)).withColumn("probability", _prob(crm.probability_of(F.col("label"))))
    ids = ["project_name", "date", "year", "probability"]
    rows = crm.wide_to_long(wide, ids)
    aggs = [F.sum(crm.scenario_amount(s, F.col("amount"), F.col("probability"), F.col("year"), F.col("month"), F.col("date")))
            .cast("double").alias(f"{s.lower()}_amount") for s in crm.SCENARIOS]
    return rows.groupBy("project_name", "date").agg(*aggs)
