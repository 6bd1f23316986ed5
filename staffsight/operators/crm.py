"""Sales-pipeline (CRM) measures.

The reference keeps CRM data wide (``year`` plus ``jan``…``dec``) and builds each of its
hundreds of measures by a separate group-and-merge. Here the data are long
(``year, month, amount`` per snapshot ``date``); a period is an integer index
(``year·P + period``), so "previous / current / next period of the snapshot" is index
−1 / 0 / +1, and every measure of one base is a conditional sum in a single aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import period_index
from ..functions.ratios import safe_ratio

# Month column names of the wide form, in calendar order.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
# CRM probability labels and their probabilities.
PROBABILITY_LABELS = {
    "0% - Non-qualified": 0.0,
    "10% - Qualified": 0.1,
    "20% - Proposal submitted": 0.2,
    "40% - Solution accepted / shortlisted": 0.4,
    "60% - Verbal win notification": 0.6,
    "80% - Written win notification": 0.8,
    "90% - Contract Negotiation": 0.9,
    "100% - Contract Signed": 1.0,
}
SCENARIOS = ("Standard", "Optimistic", "Pessimistic", "Weighted")
TYPES = {"previous": -1, "current": 0, "next": 1}
RANGES = {"month": 12, "quarter": 4, "half_year": 2, "year": 1}
BASES = {"project": "project_name", "customer": "customer_name", "gbu": "gbu_id"}
# Standard scenario minimum probability by quarter distance from the
# snapshot quarter (0 or earlier, 1, 2; from 3 on every deal counts).
STANDARD_THRESHOLDS = ((0, 0.8), (1, 0.6), (2, 0.4))


def probability_of(label: Column) -> Column:
    """Map a probability label to its probability."""
    m = F.create_map(*[x for k, v in PROBABILITY_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return m[label]


def wide_to_long(df: DataFrame, ids: Sequence[str], amount: str = "amount") -> DataFrame:
    """Wide months → rows (ids..., month 1–12, amount); missing months are 0, decimals stay exact."""
    stacked = F.explode(F.array(*[F.struct(F.lit(i + 1).alias("month"),
                                           F.coalesce(F.col(m), F.lit(0)).alias(amount))
                                  for i, m in enumerate(MONTHS)]))
    return df.select(*ids, stacked.alias("__m")).select(*ids, "__m.month", f"__m.{amount}")


def fte_by_month(df: DataFrame, keys: Sequence[str], month_col: str = "workload_start_date",
                 value: str = "sum_fte") -> DataFrame:
    """Per keys and year, the value pivoted to the twelve month columns (0 if none)."""
    d = df.withColumn("year", F.year(month_col)).withColumn(
        "__m", F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(month_col)))
    wide = d.groupBy(*keys, "year").pivot("__m", list(MONTHS)).agg(F.sum(value))
    return wide.select(*keys, "year", *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in MONTHS])


def quarter_distance(year, month, snap_date) -> Column:
    """Quarters from the snapshot's quarter to (year, month)'s quarter."""
    return period_index(year, month, 4) - period_index(F.year(snap_date), F.month(snap_date), 4)


def scenario_amount(scenario: str, amount: Column, probability: Column, year: Column, month: Column,
                    snap_date: Column) -> Column:
    """Amount under a scenario. Optimistic: all; Pessimistic: signed deals
    (probability 1) only; Weighted: amount × probability; Standard: by quarter distance k
    from the snapshot quarter the deal counts when probability ≥ 0.8 (k ≤ 0), ≥ 0.6
    (k = 1), ≥ 0.4 (k = 2), and always from k = 3 on."""
    a = amount  # decimal amounts stay exact; zero is an integer literal for the same reason
    if scenario == "Optimistic":
        return a
    if scenario == "Pessimistic":
        return F.when(probability >= 1, a).otherwise(F.lit(0))
    if scenario == "Weighted":
        return a * probability
    if scenario == "Standard":
        k = quarter_distance(year, month, snap_date)
        keep = F.lit(True)
        cond = None
        for dist, thr in STANDARD_THRESHOLDS:
            test = (k <= dist) if dist == 0 else (k == dist)
            branch = probability >= thr
            cond = F.when(test, branch) if cond is None else cond.when(test, branch)
        keep = cond.otherwise(F.lit(True))
        return F.when(keep, a).otherwise(F.lit(0))
    raise ValueError(f"unknown scenario {scenario}")


def _amount_sql(scenario: str, amount: str, probability: str, date_col: str) -> str:
    """``scenario_amount`` as SQL text (one parse instead of a tree of Column calls)."""
    a, p = f"`{amount}`", f"`{probability}`"
    if scenario == "Optimistic":
        return a
    if scenario == "Pessimistic":
        return f"case when {p} >= 1 then {a} else 0 end"
    if scenario == "Weighted":
        return f"{a} * {p}"
    k = f"({_index_sql(4, 'year', 'month')} - {_index_sql(4, f'year(`{date_col}`)', f'month(`{date_col}`)')})"
    arms = " ".join(f"when {k} {'<=' if dist == 0 else '='} {dist} then {p} >= {thr}"
                    for dist, thr in STANDARD_THRESHOLDS)
    return f"case when (case {arms} else true end) then {a} else 0 end"


def _index_sql(p: int, y: str, m: str) -> str:
    return f"cast({y} * {p} + floor(({m} - 1) / {12 // p}) as int)"


def apply_scenario(df: DataFrame, scenario: str, amount: str = "amount", probability: str = "probability",
                   date_col: str = "date") -> DataFrame:
    """A10/A11 as a DataFrame transform (amount replaced)."""
    return df.withColumn(amount, scenario_amount(scenario, F.col(amount), F.col(probability), F.col("year"),
                                                 F.col("month"), F.col(date_col)))


def to_periods(df: DataFrame, keys: Sequence[str], range_: str, amount: str = "amount") -> DataFrame:
    """Month amounts summed to quarter / half-year / year (``period`` 1-based)."""
    p = RANGES[range_]
    per = (F.floor((F.col("month") - 1) / F.lit(12 // p)) + 1).cast("int")
    return df.groupBy(*keys, "year", per.alias("period")).agg(F.sum(F.col(amount).cast("double")).alias(amount))


def period_label(range_: str, year: Column, month: Column, snap_date: Column) -> Column:
    """A13: 'previous' / 'current' / 'next' when (year, month) is in the period before,
    at or after the snapshot's period of that length; null otherwise."""
    p = RANGES[range_]
    d = period_index(year, month, p) - period_index(F.year(snap_date), F.month(snap_date), p)
    return F.when(d == -1, "previous").when(d == 0, "current").when(d == 1, "next")


def measure_name(scenario: str, type_: str, range_: str, base: str, value: str) -> str:
    return f"{scenario}_{type_}_{range_}_{base}_{value}"


def crm_measures(df: DataFrame, base: str, value: str, types: Sequence[str] = tuple(TYPES),
                 scenarios: Sequence[str] = SCENARIOS, ranges: Sequence[str] = tuple(RANGES),
                 date_col: str = "date", amount: str = "amount", probability: str | None = "probability",
                 extra: Sequence[Column] = ()) -> DataFrame:
    """Every (scenario, type, range) measure of one base in one aggregate per
    (base key, snapshot date). ``probability=None`` means no scenario effect (positions):
    the scenario copies are then equal, as in the reference. Missing → 0."""
    key = BASES[base]
    y, m, d = F.col("year"), F.col("month"), F.col(date_col)
    # per-row scenario amounts and period offsets once, then plain conditional sums; all
    # written as SQL text: one parse per column instead of a tree of Column calls
    amounts = [F.expr(_amount_sql(s, amount, probability, date_col) if probability else f"`{amount}`")
               .alias(f"__a_{s}") for s in scenarios]
    offsets = [F.expr(f"{_index_sql(RANGES[r], 'year', 'month')} - "
                      f"{_index_sql(RANGES[r], f'year(`{date_col}`)', f'month(`{date_col}`)')}").alias(f"__o_{r}")
               for r in ranges]
    rows = df.select(key, date_col, *amounts, *offsets)
    aggs = [F.expr(f"coalesce(cast(sum(case when __o_{r} = {TYPES[t]} then __a_{s} else 0 end) as double), 0D)")
            .alias(measure_name(s, t, r, base, value)) for t in types for r in ranges for s in scenarios]
    return rows.groupBy(key, date_col).agg(*aggs, *extra)


def correct_previous(measures: DataFrame, act: DataFrame, plan: DataFrame, base: str,
                     scenarios: Sequence[str] = SCENARIOS, date_col: str = "date",
                     amount: str = "amount", probability: str = "probability") -> DataFrame:
    """When the snapshot is on day ≤ 15, the key has actual rows in the previous
    month's year, the Optimistic actual of the previous month is 0 and the plan of that
    month (same scenario) is positive, add that plan to the previous month, and to the
    previous quarter / half-year / year when the previous month closes it."""
    key = BASES[base]
    prev = f"({_index_sql(12, f'year(`{date_col}`)', f'month(`{date_col}`)')} - 1)"
    month_idx = _index_sql(12, "year", "month")
    a = act.groupBy(key, date_col).agg(
        F.expr(f"count_if(year = floor({prev} / 12))").alias("__rows"),
        F.expr(f"coalesce(cast(sum(case when {month_idx} = {prev} then `{amount}` else 0 end) as double), 0D)")
        .alias("__act"))
    pl = plan.groupBy(key, date_col).agg(*[
        F.expr(f"cast(sum(case when {month_idx} = {prev} then {_amount_sql(s, amount, probability, date_col)} "
               f"else 0 end) as double)").alias(f"__plan_{s}") for s in scenarios])
    fix = a.join(pl, [key, date_col], "inner").where(
        (F.col("__rows") > 0) & (F.col("__act") == 0) & (F.dayofmonth(date_col) <= 15))
    out = measures.join(fix.select(key, date_col, *[f"__plan_{s}" for s in scenarios]), [key, date_col], "left")
    pm = f"({prev} % 12 + 1)"
    closes = {"month": "true", "quarter": f"{pm} in (3, 6, 9, 12)", "half_year": f"{pm} in (6, 12)",
              "year": f"{pm} = 12"}
    fixed = {}
    have = set(out.columns)
    for s in scenarios:
        for r, cond in closes.items():
            name = measure_name(s, "previous", r, base, "revenue")
            if name in have:
                fixed[name] = F.expr(f"case when __plan_{s} > 0 and {cond} then `{name}` + __plan_{s} "
                                     f"else `{name}` end")
    # one projection (a withColumn per measure would re-analyse the wide plan each time)
    out = out.select(*[fixed[c].alias(c) if c in fixed else F.col(c) for c in out.columns])
    return out.drop(*[f"__plan_{s}" for s in scenarios])


def crm_features(keys: DataFrame, act: DataFrame, plan: DataFrame, pos: DataFrame,
                 bases: Sequence[str] = tuple(BASES), date_col: str = "date") -> DataFrame:
    """Revenue (plan for current/next, actual for previous, corrected by A15),
    positions (FTE) measures, run rates and period dynamics for every base, joined to
    ``keys`` (rows carrying the base columns and the snapshot date). Missing → 0."""
    bkeys = [BASES[b] for b in bases]
    prev = f"({_index_sql(12, f'year(`{date_col}`)', f'month(`{date_col}`)')} - 1)"
    month_idx = _index_sql(12, "year", "month")

    def by_bases(src: DataFrame, value: str, types, scenario_effect: bool, extra: Sequence[Column]) -> DataFrame:
        """One grouping-sets aggregate of ``src`` for every base: a single pass over the
        source instead of one aggregate per base."""
        amounts = [F.expr(_amount_sql(sc, "amount", "probability", date_col) if scenario_effect else "`amount`")
                   .alias(f"__a_{sc}") for sc in SCENARIOS]
        offsets = [F.expr(f"{_index_sql(RANGES[r], 'year', 'month')} - "
                          f"{_index_sql(RANGES[r], f'year(`{date_col}`)', f'month(`{date_col}`)')}").alias(f"__o_{r}")
                   for r in RANGES]
        keep = ["year", "month", "amount"] + (["probability"] if scenario_effect else [])
        rows = src.select(*bkeys, date_col, *keep, *amounts, *offsets)
        aggs = [F.expr(f"coalesce(cast(sum(case when __o_{r} = {TYPES[t]} then __a_{sc} else 0 end) as double), 0D)")
                .alias(f"{sc}_{t}_{r}__{value}") for t in types for r in RANGES for sc in SCENARIOS]
        sets = [[k, date_col] for k in bkeys]
        return rows.groupingSets(sets, *bkeys, date_col).agg(
            *aggs, *extra, *[F.grouping(k).alias(f"__g_{k}") for k in bkeys])

    def for_base(agg: DataFrame, base: str, value: str, types, extra_cols: Sequence[str] = ()) -> DataFrame:
        k = BASES[base]
        names = [(f"{sc}_{t}_{r}__{value}", measure_name(sc, t, r, base, value))
                 for t in types for r in RANGES for sc in SCENARIOS]
        return agg.where(F.col(f"__g_{k}") == 0).select(
            k, date_col, *[F.col(a).alias(b) for a, b in names], *extra_cols)

    plan_extra = [F.expr(f"cast(sum(case when {month_idx} = {prev} then "
                         f"{_amount_sql(sc, 'amount', 'probability', date_col)} else 0 end) as double)")
                  .alias(f"__plan_{sc}") for sc in SCENARIOS]
    act_extra = [F.expr(f"count_if(year = floor({prev} / 12))").alias("__rows"),
                 F.expr(f"coalesce(cast(sum(case when {month_idx} = {prev} then `amount` else 0 end) as double), 0D)")
                 .alias("__act")]
    plan_agg = by_bases(plan, "revenue", ("current", "next"), True, plan_extra)
    act_agg = by_bases(act, "revenue", ("previous",), True, act_extra)
    pos_agg = by_bases(pos, "positions", tuple(TYPES), False, [])
    pm = f"({prev} % 12 + 1)"
    closes = {"month": "true", "quarter": f"{pm} in (3, 6, 9, 12)", "half_year": f"{pm} in (6, 12)",
              "year": f"{pm} = 12"}
    out = keys
    for base in bases:
        k = BASES[base]
        pl = for_base(plan_agg, base, "revenue", ("current", "next"), [f"__plan_{sc}" for sc in SCENARIOS])
        ac = for_base(act_agg, base, "revenue", ("previous",), ["__rows", "__act"])
        rev = pl.join(ac, [k, date_col], "full")
        fix = f"(__rows > 0 and __act = 0 and day(`{date_col}`) <= 15)"
        cols = []
        for c in rev.columns:
            if c in (k, date_col) or c.startswith("__"):
                continue
            v = f"coalesce(`{c}`, 0D)"
            sc, t = c.split("_")[0], c.split("_")[1]
            if t == "previous":
                r = "half_year" if "_half_year_" in c else c.split("_")[2]
                v = (f"case when {fix} and __plan_{sc} > 0 and {closes[r]} then {v} + __plan_{sc} else {v} end")
            cols.append(F.expr(v).alias(c))
        rev = rev.select(k, date_col, *cols)
        out = out.join(rev, [k, date_col], "left").join(for_base(pos_agg, base, "positions", tuple(TYPES)),
                                                      [k, date_col], "left")
    meas = [c for c in out.columns if c.endswith("_revenue") or c.endswith("_positions")]
    out = out.fillna(0.0, subset=meas)
    def ratio(num: str, den: str, name: str) -> Column:
        # measures are finite doubles: try_divide covers a zero denominator
        return F.expr(f"coalesce(try_divide(`{num}`, `{den}`), 0D)").alias(name)

    extra = []
    for t in TYPES:
        for r in RANGES:
            for base in bases:
                for s in SCENARIOS:
                    extra.append(ratio(measure_name(s, t, r, base, "revenue"), measure_name(s, t, r, base, "positions"),
                                       f"avg_run_rate_{s}_{t}_{r}_{base}"))
    for r in RANGES:
        for base in bases:
            for v in ("revenue", "positions"):
                for s in SCENARIOS:
                    extra.append(ratio(measure_name(s, "current", r, base, v), measure_name(s, "previous", r, base, v),
                                       f"ratio_current_previous_{s}_{v}_{r}_{base}"))
                    extra.append(ratio(measure_name(s, "next", r, base, v), measure_name(s, "current", r, base, v),
                                       f"ratio_next_current_{s}_{v}_{r}_{base}"))
    return out.select("*", *extra)
