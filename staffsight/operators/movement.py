"""Reported-hour movement between snapshots.

Input: time entries seen in each snapshot — (snapshot, id, billable flag, hours). An entry
"moves" between consecutive snapshots when it stays (kept), disappears (cancelled) or
appears (new), per billable flag. One full outer join of each snapshot with its
successor on (id, flag) gives all three at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def snapshot_pairs(df: DataFrame, snap: str = "snap") -> DataFrame:
    """(snap, next_snap) for consecutive distinct snapshots. The distinct snapshot list
    is small (one row per snapshot), so an unpartitioned window over it is cheap."""
    s = df.select(snap).distinct()
    return s.withColumn("next_snap", F.lead(snap).over(Window.orderBy(snap)))


def membership(df: DataFrame, a, b, mode: str = "both", id_col: str = "id", snap: str = "snap",
               flag: str = "billable") -> DataFrame:
    """Rows of snapshot ``a`` whose (id, flag) is also in snapshot ``b``
    (``mode='both'``) or not in it (``mode='a_not_b'``)."""
    ra = df.where(F.col(snap) == a)
    rb = df.where(F.col(snap) == b).select(id_col, flag)
    how = {"both": "left_semi", "a_not_b": "left_anti"}[mode]
    return ra.join(rb, [id_col, flag], how)


def hour_movement(df: DataFrame, corr: bool = False, id_col: str = "id", snap: str = "snap",
                  flag: str = "billable", hours: str = "hours") -> DataFrame:
    """Per consecutive snapshots (snap → next_snap) and flag: ``kept_hours`` (hours in
    snap of entries also in next_snap with the same flag), ``cancelled_hours`` (in snap,
    not in next_snap) and ``new_hours`` (in next_snap, not in snap). An entry whose flag
    flips is cancelled under one flag and new under the other. With ``corr``, the hours
    (first snapshot's) of entries present under the flag in both the first and the last
    snapshot are subtracted from every kept value."""
    pairs = snapshot_pairs(df, snap).where(F.col("next_snap").isNotNull())
    cur = df.select(id_col, flag, snap, F.col(hours).alias("__h"), F.lit(True).alias("__in")).join(pairs, snap)
    nxt = df.select(id_col, flag, F.col(snap).alias("next_snap"), F.col(hours).alias("__h2"), F.lit(True).alias("__in2")) \
        .join(pairs.select(F.col("snap").alias("__prev"), "next_snap"), "next_snap")
    j = cur.join(nxt, [id_col, flag, "next_snap"], "full")
    j = j.withColumn(snap, F.coalesce(F.col(snap), F.col("__prev")))
    out = j.groupBy(snap, "next_snap", flag).agg(
        F.sum(F.when(F.col("__in").isNotNull() & F.col("__in2").isNotNull(), F.coalesce("__h", F.lit(0.0))).otherwise(0.0)).alias("kept_hours"),
        F.sum(F.when(F.col("__in").isNotNull() & F.col("__in2").isNull(), F.coalesce("__h", F.lit(0.0))).otherwise(0.0)).alias("cancelled_hours"),
        F.sum(F.when(F.col("__in").isNull() & F.col("__in2").isNotNull(), F.coalesce("__h2", F.lit(0.0))).otherwise(0.0)).alias("new_hours"))
    if corr:
        bounds = df.agg(F.min(snap).alias("__first"), F.max(snap).alias("__last"))
        b = F.broadcast(bounds)
        first = df.join(b, F.col(snap) == F.col("__first")).select(id_col, flag, F.col(hours).alias("__hf"))
        last = df.join(b, F.col(snap) == F.col("__last")).select(id_col, flag)
        c = first.join(last, [id_col, flag], "left_semi").groupBy(flag).agg(F.sum("__hf").alias("__corr"))
        out = (out.join(c, flag, "left")
               .withColumn("kept_hours", F.col("kept_hours") - F.coalesce(F.col("__corr"), F.lit(0.0))).drop("__corr"))
    return out


def movement_edges(movement: DataFrame, snap: str = "snap", flag: str = "billable") -> DataFrame:
    """A31 as an edge list (source, target, value) for a flow chart: kept
    ``snap:flag → next:flag``, cancelled ``snap:flag → cancelled``, new ``new → next:flag``."""
    lab = F.when(F.col(flag), F.lit("billable")).otherwise(F.lit("non billable"))
    src = F.concat_ws(" ", F.col(snap).cast("string"), lab)
    dst = F.concat_ws(" ", F.col("next_snap").cast("string"), lab)
    # three edges from each row: the movement is computed once
    edges = F.array(*(F.struct(a.alias("source"), b.alias("target"), F.col(hours).alias("value")) for a, b, hours in (
        (src, dst, "kept_hours"), (src, F.lit("cancelled"), "cancelled_hours"), (F.lit("new"), dst, "new_hours"))))
    return movement.select(F.inline(edges))


def pivot_snapshots(df: DataFrame, key: Sequence[str] | str, snaps: Sequence, value: str = "hours",
                    snap: str = "snap", prefix: str = "snap_") -> DataFrame:
    """Grouped sums with one column per snapshot (explicit list), replacing a chain
    of outer merges; absent combinations are null, as after an outer merge."""
    keys = [key] if isinstance(key, str) else list(key)
    wide = df.groupBy(*keys).pivot(snap, list(snaps)).agg(F.sum(value))
    return wide.select(*keys, *[F.col(str(s)).alias(f"{prefix}{s}") for s in snaps])


def with_buckets(df: DataFrame, project: str = "project_uid_projection", account: str = "account",
                 billable: str = "billable", billing_type: str = "billing_type_name", own_account: str = "OWN") -> DataFrame:
    """``bucket`` (NPA / VAC / the account) and ``billing_bucket`` (first match:
    vacation, billable, non-project or training, temporary on the company's own account, other
    non-billable)."""
    p = F.col(project)
    bucket = F.when(p == "npa", "NPA").when(p == "vac", "VAC").otherwise(F.col(account))
    bb = (F.when(p == "vac", "Acc_vac").when(F.col(billable), "Acc_bill")
          .when((p == "npa") | (F.col(billing_type) == "On Training"), "Acc_npa")
          .when((F.col(account) == own_account) & (F.col(billing_type) == "Temporary"), f"{own_account}_npa")
          .otherwise("Acc_nonbill"))
    return df.withColumn("bucket", bucket).withColumn("billing_bucket", bb)


def hours_by_bucket(df: DataFrame, snaps: Sequence, snap: str = "snap", hours: str = "hours") -> DataFrame:
    """Hours per (bucket, billable, billing bucket) with one column per snapshot."""
    return pivot_snapshots(with_buckets(df), ["bucket", "billable", "billing_bucket"], snaps, hours, snap)


def split_days(df: DataFrame, person: str, day: str, groups: Sequence[str] = ("billable", "bucket")) -> DataFrame:
    """Persons and days reported under several (billable, bucket) groups, most first."""
    return (df.groupBy(person, day).agg(F.countDistinct(*groups).alias("n_groups"))
            .where(F.col("n_groups") > 1))


def outcome_by_snapshot(df: DataFrame, day_col: str, class_col: str, status_col: str,
                        classes: Sequence = (0, 1, 2, 3), statuses: Sequence[str] = ()) -> DataFrame:
    """Per snapshot, rows per first-billing month class and per final status."""
    aggs = [F.count_if(F.col(class_col) == c).alias(f"class_{c}") for c in classes]
    aggs += [F.count_if(F.col(status_col) == s).alias(f"status_{s.lower().replace(' ', '_')}") for s in statuses]
    return df.groupBy(day_col).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)


def pick_snapshots(days: DataFrame, report_month, col: str = "day") -> DataFrame:
    """Snapshot days to read for a reporting month: every listed day of the next
    month, the first days of later months, and the newest listed day."""
    from .snapshots import latest_snapshot
    nxt = F.add_months(F.trunc(F.lit(report_month).cast("date"), "MM"), 1)
    d = F.col(col)
    listed = days.where((F.trunc(d, "MM") == nxt) | ((F.dayofmonth(d) == 1) & (d > nxt))).select(col)
    return listed.unionByName(latest_snapshot(days.select(col), col)).distinct()
