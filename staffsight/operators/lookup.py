"""Lookups.

A lookup never changes the row count of the fact side: the dimension is reduced to one
row per key first (by a stated total order), then left-joined. Reducing the dimension is
an aggregate of ``min``/``max`` over a struct — partial aggregation runs map-side, so a
key holding a third of the rows costs no single-task sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def first_by(df: DataFrame, keys, order, values=None, descending: bool = False,
             nulls_last: bool = True) -> DataFrame:
    """One row per key: the row with the smallest ``order`` (largest when ``descending``).

    ``nulls_last`` puts rows with a null order value after all others in the chosen
    direction (``False``: before them, as PostgreSQL does for ``DESC``). Remaining ties
    are broken by the value columns, so the result is deterministic (O2, O6, W1, W2).
    """
    keys, order = _list(keys), _list(order)
    values = [c for c in (values if values is not None else df.columns) if c not in keys]
    null_flags = []
    for o in order:
        isnull = F.col(o).isNull()
        # min picks False first; with descending (max) the flag is inverted accordingly
        flag = isnull if (nulls_last != descending) else ~isnull
        null_flags.append(flag)
    parts = []
    for i, o in enumerate(order):
        parts += [null_flags[i].alias(f"__n{i}"), F.col(o).alias(f"__o{i}")]
    packed = F.struct(*parts, *[F.col(v) for v in values])
    pick = F.max(packed) if descending else F.min(packed)
    agg = df.groupBy(*keys).agg(pick.alias("__p"))
    return agg.select(*keys, *[F.col("__p")[v].alias(v) for v in values])


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str], cols: Sequence[str] | None = None,
           order: str | Sequence[str] | None = None, fill: dict | None = None) -> DataFrame:
    """Attach ``cols`` of ``dim`` by key without changing the fact row count.

    ``order`` (J5 vlookup) picks the first dimension row per key; without it the dimension
    must already be unique per key (check with ``quality.assert_unique``). Catalyst
    broadcasts the dimension when its statistics are under the broadcast threshold and
    shuffles both sides otherwise; no hint here, as dimension sizes are not bounded.
    """
    on = _list(on)
    cols = [c for c in (cols if cols is not None else dim.columns) if c not in on]
    if order is not None:
        d = first_by(dim, on, order, cols)
    else:
        d = dim.select(*on, *cols)
    out = df.join(d, on, "left")
    return out.fillna(fill) if fill else out


def role_lookup(df: DataFrame, dim: DataFrame, roles: dict[str, str], dim_key: str,
                dim_value: str, extra_keys: Sequence[str] = ()) -> DataFrame:
    """For each person column (role) attach the person's unit as ``out`` column.

    ``roles`` maps a person column of ``df`` to its output column. ``extra_keys`` (e.g.
    the snapshot day) must match too. The dimension is reduced to one row per key once and
    reused by every role join.
    """
    keys = [dim_key, *extra_keys]
    d = first_by(dim, keys, dim_value, [dim_value])
    out = df
    for person_col, out_col in roles.items():
        r = d.select(F.col(dim_key).alias(person_col), *extra_keys, F.col(dim_value).alias(out_col))
        out = out.join(r, [person_col, *extra_keys], "left")
    return out


def role_units(df: DataFrame, keys: Sequence[str], dim: DataFrame, roles: dict[str, str], dim_key: str, dim_value: str,
               day_col: str, fill: str | None = None) -> DataFrame:
    """J9 with many roles: each person column's unit on the row's day, in one join for all roles.

    ``keys`` identify a row of ``df``; ``dim`` has (dim_key, day_col, dim_value), of which the
    smallest value counts. A row's persons become (role, person) entries that meet the dimension
    once and are folded back into a map by one aggregate. Roles without a person stay out of the
    join (a null person is no hot key); persons without a unit get ``fill``.
    """
    units = dim.groupBy(F.col(dim_key).alias("__person"), F.col(day_col).alias("__day")).agg(F.min(dim_value).alias("__unit"))
    kind = df.schema[next(iter(roles))].dataType
    entries = F.array(*(F.struct(F.lit(out).alias("role"), F.col(c).cast(kind).alias("person")) for c, out in roles.items()))
    rows = df.select(*keys, F.struct("*").alias("__row"),
                     F.explode_outer(F.filter(entries, lambda e: e["person"].isNotNull())).alias("__e"))
    joined = rows.join(units, (F.col("__e.person") == F.col("__person")) & (F.col(f"__row.{day_col}") == F.col("__day")), "left")
    found = F.map_from_entries(F.collect_list(F.when(F.col("__unit").isNotNull(), F.struct("__e.role", "__unit"))))
    wide = joined.groupBy(*keys).agg(F.first("__row").alias("__row"), found.alias("__units"))
    value = lambda out: F.element_at("__units", F.lit(out))
    return wide.select("__row.*", *((value(o) if fill is None else F.coalesce(value(o).cast("string"), F.lit(fill))).alias(o) for o in roles.values()))
