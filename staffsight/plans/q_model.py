"""Metric, split, scope, label and model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as mx
from ..operators import model as md
from ..operators import snapshots as snap
from ..operators import splits as sp
from ..session import ensure_checkpoint_dir
from ..sources import fixtures as fx
from ..sources import io
from ..sources.tables import Tables
from .registry import register


def _reg(t):
    l = t.lineitem
    return l.select(F.col("l_quantity").alias("y"),
                    (F.col("l_quantity") + F.col("l_linenumber") - 3).cast("double").alias("p"),
                    (F.col("l_quantity") * 0.8 + F.col("l_linenumber")).alias("base"))


def _r6(c):
    return F.round(c, 6)


_REG_SQL = """
r as (select l_quantity as y, cast(l_quantity + l_linenumber - 3 as double) as p,
        l_quantity * 0.8 + l_linenumber as base from lineitem)"""


def _reg_metrics_sql(p: str) -> str:
    return f"""avg(y) as mean, avg(abs(y - {p})) as mae, quantile_cont(abs(y - {p}), 0.5) as median_ae,
  quantile_cont(abs(y - {p}), 0.9) as p90_ae, avg((y - {p}) * (y - {p})) as mse,
  sqrt(avg((y - {p}) * (y - {p}))) as rmse,
  avg(abs(case when y = 0 then null else (y - {p}) / y end)) * 100 as mape,
  1 - avg((y - {p}) * (y - {p})) / var_pop(y) as r2, 1 - var_pop(y - {p}) / var_pop(y) as explained_variance"""


_M6_COLS = ("mean", "mae", "median_ae", "p90_ae", "mse", "rmse", "mape", "r2", "explained_variance")


@register("m6_regression_metrics", f"""
with {_REG_SQL},
m as (select {_reg_metrics_sql('p')} from r),
b as (select {_reg_metrics_sql('base')} from r)
select """ + ", ".join(f"round(m.{c}, 6) as {c}" for c in _M6_COLS) + ", " + ", ".join(
    f"round(1 - m.{c} / b.{c}, 6) as improvement_{c}" for c in _M6_COLS if c != "mean") + " from m, b")
def q_regression(spark, sf_dir):
    r = _reg(Tables(spark, sf_dir))
    m = mx.regression_metrics(r, "y", "p")
    b = mx.regression_metrics(r.withColumn("p", F.col("base")), "y", "p")
    imp = mx.improvement(m, b, [c for c in _M6_COLS if c != "mean"])
    both = m.unionByName(imp, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in m.columns + imp.columns])
    return both.select(*[_r6(F.col(c)).alias(c) for c in both.columns])


@register("m7_half_life_error", f"""
with {_REG_SQL}
select round(avg(pow(2.0, -y / 30.0) * (greatest(p - y, 0) + 2 * greatest(y - p, 0))), 6) as half_life_error from r""")
def q_half_life(spark, sf_dir):
    out = mx.half_life_error(_reg(Tables(spark, sf_dir)))
    return out.select(_r6(F.col("half_life_error")).alias("half_life_error"))


def _clf_sql(p: str) -> str:
    return f"""
s as (select {p} as score, count(*) filter (where y = 1) as pos, count(*) filter (where y <> 1) as neg
      from v_score group by 1),
c as (select *, sum(neg) over (order by score rows between unbounded preceding and current row) as cum_neg_asc,
        sum(pos) over (order by score desc rows between unbounded preceding and current row) as cum_pos,
        sum(neg) over (order by score desc rows between unbounded preceding and current row) as cum_neg from s),
roc as (select sum(pos * (cum_neg_asc - neg + neg / 2.0)) / (sum(pos) * sum(neg)) as roc_auc from c),
pr as (select sum(pos * (cum_pos * 1.0 / (cum_pos + cum_neg) +
         case when cum_pos - pos + cum_neg - neg = 0 then 1.0
              else (cum_pos - pos) * 1.0 / (cum_pos - pos + cum_neg - neg) end) / 2.0) / sum(pos) as pr_auc from c),
t as (select count(*) as n, count(*) filter (where round_even({p}, 0) = 1 and y = 1) as tp,
        count(*) filter (where round_even({p}, 0) = 1 and y <> 1) as fp,
        count(*) filter (where round_even({p}, 0) <> 1 and y = 1) as fn,
        count(*) filter (where round_even({p}, 0) = y) as correct from v_score),
tm as (select correct * 1.0 / n as accuracy,
         coalesce(case when tp + fp = 0 then null else tp * 1.0 / (tp + fp) end, 0) as precision,
         coalesce(case when tp + fn = 0 then null else tp * 1.0 / (tp + fn) end, 0) as recall from t)
select round(roc_auc, 6) as roc_auc, round(pr_auc, 6) as pr_auc, round(accuracy, 6) as accuracy,
  round(precision, 6) as precision, round(recall, 6) as recall,
  round(coalesce(case when precision + recall = 0 then null else 2 * precision * recall / (precision + recall) end, 0), 6)
    as f1
from roc, pr, tm"""


def _rounded_clf(df):
    return df.select(*[_r6(F.col(c)).alias(c) for c in df.columns])


@register("m8_classification_metrics", "with " + _clf_sql("p").lstrip().replace("\n", " ", 0), views=("v_score",))
def q_classification(spark, sf_dir):
    return _rounded_clf(mx.classification_metrics(fx.v_score(Tables(spark, sf_dir))))


@register("m9_majority_baseline_metrics", "with maj as (select case when count(*) filter (where quality = 1) > "
          "count(*) filter (where quality <> 1) then 1.0 else 0.0 end as m from labels),\n"
          + _clf_sql("(select m from maj)").lstrip(), views=("v_score",))
def q_majority(spark, sf_dir):
    s = fx.v_score(Tables(spark, sf_dir))
    return _rounded_clf(mx.classification_metrics(mx.majority_baseline(s, "y")))


@register("m9_stratified_baseline")
def q_stratified(spark, sf_dir):
    """Rows-only: random draws with the training prior (seeded)."""
    s = fx.v_score(Tables(spark, sf_dir))
    return mx.stratified_baseline(s, "y", seed=7).select("doc_id", "y", "p")


_DRAW_SQL = ("cast(('0x' || substr(md5('7:' || cast(doc_id as varchar)), 1, 12))::bigint as double) / 281474976710656.0 "
             "< (select avg(cast(y = 1 as int)) from v_score)")


@register("m9_stratified_draws", f"select doc_id, y, case when {_DRAW_SQL} then 1.0 else 0.0 end as p from v_score", views=("v_score",))
def q_draws(spark, sf_dir):
    return mx.stratified_baseline(fx.v_score(Tables(spark, sf_dir)), "y", seed=7, key="doc_id").select("doc_id", "y", "p")


@register("m9_stratified_baseline_metrics", f"with drawn as (select *, case when {_DRAW_SQL} then 1.0 else 0.0 end as draw from v_score),\n"
          + _clf_sql("draw").lstrip().replace("from v_score", "from drawn"), views=("v_score",))
def q_stratified_metrics(spark, sf_dir):
    s = fx.v_score(Tables(spark, sf_dir))
    return _rounded_clf(mx.classification_metrics(mx.stratified_baseline(s, "y", seed=7, key="doc_id")))


@register("m10_mae_by_range", """
with r as (select l_quantity as target, cast(l_quantity + l_linenumber - 3 as double) as predictions,
             25.0 as baseline from lineitem),
c as (select *, case when predictions > 60 then 'predictions 60+ days'
                     when predictions > 30 and predictions <= 60 then 'predictions 30-60 days'
                     when predictions > 0 and predictions <= 30 then 'predictions 0-30 days' end as "case" from r)
select "case", round(avg(abs(target - baseline)), 2) as baseline_mae, round(avg(abs(target - predictions)), 2) as model_mae,
  round(1 - round(avg(abs(target - predictions)), 2) / round(avg(abs(target - baseline)), 2), 2) as improvement
from c where "case" is not null group by 1""")
def q_mae_range(spark, sf_dir):
    l = Tables(spark, sf_dir).lineitem
    r = l.select(F.col("l_quantity").alias("target"),
                 (F.col("l_quantity") + F.col("l_linenumber") - 3).cast("double").alias("predictions"),
                 F.lit(25.0).alias("baseline"))
    return mx.mae_by_range(r)


_A34_DAYS = ("1996-01-01", "1997-06-01")


@register("a34_horizon_hours", """
with days as (select cast(d as date) as day from (values ('1996-01-01'), ('1997-06-01')) t(d)),
j as (select d.day as date, p.position_id from days d join v_position p
      on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to)),
pr as (select j.*, h as horizon, ((j.position_id * (h + 1)) % 100) / 100.0 as probability
       from j, unnest([0, 1, 2, 3]) u(h)),
hr as (select position_id, cast(date_trunc('month', timesheet_date) as date) as m, sum(hours) as hours from v_worklog
       group by 1, 2),
x as (select pr.date, pr.horizon, pr.probability, hr.hours from pr left join hr on hr.position_id = pr.position_id
        and hr.m = cast(date_trunc('month', pr.date) + to_months(pr.horizon) as date)),
g as (select date, horizon, coalesce(sum(hours) filter (where probability >= 0.5), 0.0) as predicted_hours,
        coalesce(sum(hours), 0.0) as reported_hours from x group by 1, 2)
select date, horizon, round(predicted_hours, 6) as predicted_hours, round(reported_hours, 6) as reported_hours,
  round(abs(predicted_hours - reported_hours), 6) as abs_error from g""", views=("v_position", "v_worklog"))
def q_horizon_hours(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = snap.validity_join(io.days(spark, _A34_DAYS), fx.v_position(t).select("position_id", "valid_from", "valid_to"),
                           how="inner").withColumnRenamed("day", "date")
    pred = (j.select("date", "position_id", F.explode(F.array(*[F.lit(h) for h in range(4)])).alias("horizon"))
            .withColumn("probability", ((F.col("position_id") * (F.col("horizon") + 1)) % 100) / 100.0))
    hours = fx.v_worklog(t).groupBy("position_id", F.trunc("timesheet_date", "MM").alias("month")) \
        .agg(F.sum("hours").alias("hours"))
    out = mx.horizon_hours(pred, hours, 0.5)
    return out.select("date", "horizon", *[_r6(F.col(c)).alias(c) for c in
                                            ("predicted_hours", "reported_hours", "abs_error")])


@register("a34_horizon_mae", """
with days as (select cast(d as date) as day from (values ('1996-01-01'), ('1997-06-01')) t(d)),
j as (select d.day as date, p.position_id from days d join v_position p
      on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to)),
pr as (select j.*, h as horizon, ((j.position_id * (h + 1)) % 100) / 100.0 as probability
       from j, unnest([0, 1, 2, 3]) u(h)),
hr as (select position_id, cast(date_trunc('month', timesheet_date) as date) as m, sum(hours) as hours from v_worklog
       group by 1, 2),
x as (select pr.date, pr.horizon, pr.probability, hr.hours from pr left join hr on hr.position_id = pr.position_id
        and hr.m = cast(date_trunc('month', pr.date) + to_months(pr.horizon) as date)),
g as (select date, horizon, coalesce(sum(hours) filter (where probability >= 0.5), 0.0) as predicted_hours,
        coalesce(sum(hours), 0.0) as reported_hours from x group by 1, 2)
select horizon, round(avg(abs(predicted_hours - reported_hours)), 6) as mae from g group by 1""",
          views=("v_position", "v_worklog"))
def q_horizon_mae(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = snap.validity_join(io.days(spark, _A34_DAYS), fx.v_position(t).select("position_id", "valid_from", "valid_to"),
                           how="inner").withColumnRenamed("day", "date")
    pred = (j.select("date", "position_id", F.explode(F.array(*[F.lit(h) for h in range(4)])).alias("horizon"))
            .withColumn("probability", ((F.col("position_id") * (F.col("horizon") + 1)) % 100) / 100.0))
    hours = fx.v_worklog(t).groupBy("position_id", F.trunc("timesheet_date", "MM").alias("month")) \
        .agg(F.sum("hours").alias("hours"))
    out = mx.horizon_mae(mx.horizon_hours(pred, hours, 0.5))
    return out.select("horizon", _r6(F.col("mae")).alias("mae"))


@register("m1_time_split", """
select position_id, 'train' as part from v_position where planned_end_date < timestamp '1997-01-01'
union all
select position_id, 'test' from v_position where created >= timestamp '1997-01-01'
  and planned_end_date > timestamp '1997-01-01'""", views=("v_position",))
def q_time_split(spark, sf_dir):
    p = fx.v_position(Tables(spark, sf_dir))
    tr, te = sp.time_split(p, "1997-01-01", sort_col="planned_end_date", date_col="created")
    return tr.select("position_id", F.lit("train").alias("part")).unionByName(
        te.select("position_id", F.lit("test").alias("part")))


def _fold_values(folds) -> str:
    vals = ", ".join(f"({i}, timestamp '{a}', timestamp '{b}', timestamp '{c}', timestamp '{d}')"
                     for i, (a, b, c, d) in enumerate(folds))
    return f"f(fold, train_start, train_end, val_start, val_end) as (values {vals})"


def _fold_sql(folds) -> str:
    return f"""with {_fold_values(folds)}
select p.position_id, f.fold, 'train' as role from v_position p join f
  on p.created >= f.train_start and p.created <= f.train_end
union all
select p.position_id, f.fold, 'validation' from v_position p join f
  on p.created >= f.val_start and p.created <= f.val_end"""


_M2 = sp.rolling_folds("1995-03-01", "1998-12-31", n=3, alf=0.25)
_M3 = sp.monthly_folds("1995-01-01", "1998-12-31", n=4, train_len=6, test_len=2)


@register("m2_rolling_folds", _fold_sql(_M2), views=("v_position",))
def q_rolling(spark, sf_dir):
    p = fx.v_position(Tables(spark, sf_dir)).select("position_id", "created")
    return sp.label_folds(p, sp.fold_table(spark, _M2), "created").select("position_id", "fold", "role")


@register("m3_monthly_folds", _fold_sql(_M3), views=("v_position",))
def q_monthly(spark, sf_dir):
    p = fx.v_position(Tables(spark, sf_dir)).select("position_id", "created")
    return sp.label_folds(p, sp.fold_table(spark, _M3), "created").select("position_id", "fold", "role")


@register("p14_x_y_split", """
select position_id, customer_id, container_name, planned_start_date, staffing_status from v_position""",
          views=("v_position",))
def q_xy(spark, sf_dir):
    p = fx.v_position(Tables(spark, sf_dir)).select(
        "position_id", "customer_id", "container_name", "planned_start_date", "staffing_status", "created",
        F.col("valid_to").alias("max_date"), F.lit(1).alias("target"))
    x, _ = sp.x_y(p)
    return x


def _with_channels(t):
    return fx.v_position(t).withColumn("staffing_channels", F.array("first_channel"))


_SCOPE_SQL = """
with p as (select *, [first_channel] as staffing_channels from v_position)
select '{s}' as scope, staffing_status, count(*) as n from p where {cond} group by 1, 2"""


@register("p6_scope_filter_training", " union all ".join(
    _SCOPE_SQL.strip().replace("{s}", s).replace("{cond}", c) if i == 0 else
    _SCOPE_SQL.strip().split("\n", 1)[1].replace("{s}", s).replace("{cond}", c)
    for i, (s, c) in enumerate((("assigned", "staffing_status = 'Assigned'"),
                                ("no_staffing_required", "staffing_channels[1] = 'No staffing required'"),
                                ("in_staffing", "staffing_status <> 'Assigned' and "
                                                "staffing_channels[1] <> 'No staffing required'")))),
          views=("v_position",))
def q_scope_train(spark, sf_dir):
    p = _with_channels(Tables(spark, sf_dir))
    parts = [md.scope_filter(p, s).groupBy(F.lit(s).alias("scope"), "staffing_status").agg(
        F.count(F.lit(1)).alias("n")) for s in ("assigned", "no_staffing_required", "in_staffing")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("p7_scope_label", """
select case when staffing_status = 'Assigned' then 'assigned' when first_channel = 'No staffing required'
            then 'no_staffing_required' else 'in_staffing' end as scope, count(*) as n from v_position group by 1""",
          views=("v_position",))
def q_scope_label(spark, sf_dir):
    p = md.scope_label(_with_channels(Tables(spark, sf_dir)))
    return p.groupBy("scope").agg(F.count(F.lit(1)).alias("n"))


@register("d14_outcome_class", """
with t as (select position_id, min(timesheet_date) as f from v_worklog where billable group by 1)
select case when t.f is not null then 0 when p.staffing_status = 'Closed' then 1
            when p.staffing_status = 'Terminated' then 2 else 3 end as target, count(*) as n
from v_position p left join t on t.position_id = p.position_id group by 1""", views=("v_position", "v_worklog"))
def q_outcome_class(spark, sf_dir):
    t = Tables(spark, sf_dir)
    span = snap.billable_span(fx.v_worklog(t)).select("position_id", F.col("first_billable_date").alias("timesheet_date"))
    p = fx.v_position(t).join(span, "position_id", "left").withColumnRenamed("staffing_status", "staffing_status_final")
    return md.outcome_class(p).groupBy("target").agg(F.count(F.lit(1)).alias("n"))


@register("d4_horizon_class", """
with days as (select cast(d as date) as day from (values ('1996-01-01'), ('1997-06-01')) t(d)),
j as (select d.day, p.position_id from days d join v_position p
      on p.valid_from <= d.day and (p.valid_to is null or d.day < p.valid_to)),
t as (select position_id, min(timesheet_date) as f from v_worklog where billable group by 1),
k as (select j.day, (year(t.f) * 12 + month(t.f)) - (year(j.day) * 12 + month(j.day)) as m
      from j left join t on t.position_id = j.position_id)
select day as date, cast(case when m between 0 and 2 then m else 3 end as int) as target, count(*) as n
from k group by 1, 2""", views=("v_position", "v_worklog"))
def q_horizon_class(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = snap.validity_join(io.days(spark, _A34_DAYS), fx.v_position(t).select("position_id", "valid_from", "valid_to"),
                           how="inner").withColumnRenamed("day", "date")
    span = snap.billable_span(fx.v_worklog(t)).select("position_id", F.col("first_billable_date").alias("timesheet_date"))
    k = md.horizon_class(j.join(span, "position_id", "left"))
    return k.groupBy("date", "target").agg(F.count(F.lit(1)).alias("n"))


_MODEL_CAT = ["staffing_status", "first_channel", "billing_type_id"]
_MODEL_MULTI = ["staffing_channels"]
_MODEL_NUM = ["primary_skill_id", "primary_skill_category_id", "city_id", "country_id", "time_after_creation"]


def _training_rows(spark, t):
    from ..functions.dates import days_between
    j = snap.validity_join(io.days(spark, ("1996-01-01", "1996-07-01", "1997-01-01")),
                           _with_channels(t), how="inner").withColumnRenamed("day", "date")
    span = snap.billable_span(fx.v_worklog(t)).select("position_id", F.col("first_billable_date").alias("timesheet_date"))
    j = j.join(span, "position_id", "left").withColumn("time_after_creation", days_between("created", "date"))
    return md.horizon_class(j)


@register("m4_train_per_scope")
def q_train(spark, sf_dir):
    """Rows-only: one model per scope; each scope's training accuracy and row count."""
    t = Tables(spark, sf_dir)
    rows = _training_rows(spark, t)
    out = None
    for scope in md.SCOPES:
        tr = md.scope_filter(rows, scope)
        model = md.train_scope_model(tr, _MODEL_CAT, _MODEL_MULTI, _MODEL_NUM, num_trees=20, max_depth=6)
        scored = md.score_scope(model, tr, _MODEL_CAT, _MODEL_MULTI, _MODEL_NUM)
        best = F.array_position(F.array(*[F.col(f"probability_{k}") for k in range(4)]),
                                F.array_max(F.array(*[F.col(f"probability_{k}") for k in range(4)]))) - 1
        s = scored.agg(F.lit(scope).alias("scope"), F.count(F.lit(1)).alias("n_rows"),
                       F.avg((best == F.col("target")).cast("double")).alias("train_accuracy"))
        out = s if out is None else out.unionByName(s)
    return out


@register("m5_score_per_scope")
def q_score(spark, sf_dir):
    """Rows-only: models trained on earlier days score the latest day by scope."""
    t = Tables(spark, sf_dir)
    ensure_checkpoint_dir(spark)
    rows = md.scope_label(_training_rows(spark, t)).checkpoint()  # read by every pass of every fit and by the scoring
    train = rows.where(F.col("date") < F.lit("1997-01-01").cast("date"))
    test = rows.where(F.col("date") == F.lit("1997-01-01").cast("date"))
    out = None
    for scope in md.SCOPES:
        model = md.train_scope_model(md.scope_filter(train, scope), _MODEL_CAT, _MODEL_MULTI, _MODEL_NUM,
                                     num_trees=20, max_depth=6)
        s = md.score_scope(model, test.where(F.col("scope") == scope), _MODEL_CAT, _MODEL_MULTI, _MODEL_NUM)
        s = s.select("position_id", "date", "scope", *[f"probability_{k}" for k in range(4)])
        out = s if out is None else out.unionByName(s)
    return out
