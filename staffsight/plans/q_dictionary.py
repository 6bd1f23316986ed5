"""Registered queries of the distributed dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dictionary as dic
from ..sources import fixtures as fx
from ..sources.tables import Tables
from .registry import register

CATEGORICAL = ("staffing_status", "first_channel")
MULTI = ("tags",)
NUMERIC = ("primary_skill_id", "city_id")
MIN_DF = 5

_FEATURES_SQL = """
p as (select position_id, staffing_status, first_channel, [container_name, billing_type_id] as tags,
  primary_skill_id, city_id from v_position),
f as (select position_id, 0 as no, coalesce(staffing_status, '__UNDEFINED__') as value from p
  union all select position_id, 1, coalesce(first_channel, '__UNDEFINED__') from p
  union all select distinct position_id, 2, t from (select position_id, unnest(tags) as t from p) where t is not null),
dict as (select no, value, count(*) as df, row_number() over (order by no, md5(value), value) - 1 as index
  from f group by no, value having count(*) >= 5)"""


def _positions(spark, sf_dir):
    return fx.v_position(Tables(spark, sf_dir)).withColumn("tags", F.array("container_name", "billing_type_id"))


@register("e6_value_dictionary", f"""
with {_FEATURES_SQL}
select case no when 0 then 'staffing_status' when 1 then 'first_channel' else 'tags' end as "column", value, df, index
from dict""", views=("v_position",))
def q_dictionary(spark, sf_dir):
    return dic.build_dictionary(_positions(spark, sf_dir), CATEGORICAL, MULTI, MIN_DF)


@register("e7_indexed_values", f"""
with {_FEATURES_SQL}
select position_id, index from f join dict on f.no = dict.no and f.value = dict.value""", views=("v_position",))
def q_indexed(spark, sf_dir):
    p = _positions(spark, sf_dir)
    return dic.one_hot_indexed(p, "position_id", dic.build_dictionary(p, CATEGORICAL, MULTI, MIN_DF), CATEGORICAL, MULTI)


@register("e8_sparse_rows", f"""
with {_FEATURES_SQL},
n as (select count(*) as n from dict),
e as (select position_id, index, 1.0 as v from f join dict on f.no = dict.no and f.value = dict.value
  union all select position_id, n, cast(primary_skill_id as double) from p, n where primary_skill_id <> 0
  union all select position_id, n + 1, cast(city_id as double) from p, n where city_id <> 0)
select p.position_id, cast(n + 2 as int) as size, cast(count(e.index) as int) as n_nonzero,
  coalesce(string_agg(cast(e.index as varchar) || ':' || cast(cast(e.v as int) as varchar), ',' order by e.index), '') as entries
from p cross join n left join e on e.position_id = p.position_id group by p.position_id, n""", views=("v_position",))
def q_sparse(spark, sf_dir):
    p = _positions(spark, sf_dir)
    rows = dic.encode_rows(p, "position_id", dic.build_dictionary(p, CATEGORICAL, MULTI, MIN_DF), CATEGORICAL, MULTI, NUMERIC)
    entries = F.zip_with("indices", "values", lambda i, v: F.concat_ws(":", i.cast("string"), v.cast("int").cast("string")))
    return rows.select("position_id", "size", F.size("indices").alias("n_nonzero"), F.array_join(entries, ",").alias("entries"))
