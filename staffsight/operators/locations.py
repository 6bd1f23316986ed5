"""Location tree and location-list expansion.

The location dimension is a two-level tree: cities (type 6) whose parent is a country
(type 5). Position location lists are JSON text arrays of objects with ``id``, ``name``
and optionally ``parent``. Expansion is an explode of the parsed ids, one equi-join with
the (small, dimension-sized) id → (city, country) mapping, and a ``collect_set`` back per
row key — the key is unique per row, so no group is larger than one list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

CITY_TYPE = 6
COUNTRY_TYPE = 5
ANY_LOCATION_ID = "-1"

LOCATION_JSON_SCHEMA = ("array<struct<id:string,name:string,type:string,_class:string,"
                        "parent:struct<id:string,name:string>,preferred:boolean>>")


def location_tree(loc: DataFrame, id_col: str = "location_id", name_col: str = "location_name",
                  parent_col: str = "parent_location_id", type_col: str = "location_type_id") -> DataFrame:
    """One row per city with its country (parent) and the country's parent
    (region, null at the root), by two self-joins on the parent id."""
    cities = loc.where(F.col(type_col) == CITY_TYPE).select(
        F.col(id_col).alias("city_id"), F.col(name_col).alias("city"), F.col(parent_col).alias("country_id"))
    parents = loc.select(F.col(id_col).alias("country_id"), F.col(name_col).alias("country"),
                         F.col(parent_col).alias("region_id"))
    grand = loc.select(F.col(id_col).alias("region_id"), F.col(name_col).alias("region"))
    return cities.join(parents, "country_id", "left").join(grand, "region_id", "left") \
        .select("city_id", "city", "country_id", "country", "region_id", "region")


def parse_locations(col: Column) -> Column:
    """D18/D19 input: the JSON text list parsed to ``array<struct<id, name, parent, ...>>``."""
    return F.from_json(col, LOCATION_JSON_SCHEMA)


def location_names(col: Column) -> Column:
    """JSON list → list of names."""
    return F.transform(parse_locations(col), lambda x: x["name"])


def location_ids(col: Column, parent_rule: bool = True) -> Column:
    """JSON list → ids. With ``parent_rule``: when any element has a parent, only the
    ids of elements with a parent; otherwise all ids. Without it: every id, parents too."""
    locs = parse_locations(col)
    if not parent_rule:
        # every id in text order, a parent's id right after its child's
        both = F.flatten(F.transform(locs, lambda x: F.array(x["id"], x["parent"]["id"])))
        return F.filter(both, lambda i: i.isNotNull())
    with_parent = F.transform(F.filter(locs, lambda x: x["parent"].isNotNull()), lambda x: x["id"])
    return F.when(F.size(with_parent) > 0, with_parent).otherwise(F.transform(locs, lambda x: x["id"]))


def is_any_location(ids: Column) -> Column:
    """The any-location flag (first id is ``-1``)."""
    return F.coalesce(F.get(ids, 0) == F.lit(ANY_LOCATION_ID), F.lit(False))


def _id_mapping(tree: DataFrame, names: bool) -> DataFrame:
    """id → (city, country) pairs: a city id maps to itself and its country; a country id
    maps to each of its cities and to itself (also when it has no city)."""
    c, k = ("city", "country") if names else ("city_id", "country_id")
    by_city = tree.select(F.col("city_id").alias("__id"), F.col(c).alias("__city"), F.col(k).alias("__country"))
    by_country = tree.select(F.col("country_id").alias("__id"), F.col(c).alias("__city"),
                             F.col(k).alias("__country"))
    return by_city.unionByName(by_country)


def _expand(df: DataFrame, keys: Sequence[str], ids: Column, tree: DataFrame, names: bool,
            out_prefix: str) -> DataFrame:
    c_out, k_out = (f"{out_prefix}_cities", f"{out_prefix}_countries") if names else \
        (f"{out_prefix}_city_ids", f"{out_prefix}_country_ids")
    base = df.select(*keys, ids.alias("__ids"))
    base = base.withColumn("__any", is_any_location(F.col("__ids")))
    # explode_outer keeps rows with empty lists and any-location rows (their id is null),
    # so one aggregate yields every key and no join back to the parsed lists is needed.
    exploded = base.select(*keys, "__any", F.explode_outer(F.when(~F.col("__any"), F.col("__ids"))).alias("__id"))
    mapping = _id_mapping(tree, names)  # dimension-sized
    got = (exploded.join(mapping, "__id", "left")
           .groupBy(*keys).agg(F.max("__any").alias("__any"), F.array_sort(F.collect_set("__city")).alias(c_out),
                               F.array_sort(F.collect_set("__country")).alias(k_out)))
    c, k = ("city", "country") if names else ("city_id", "country_id")
    everything = tree.agg(F.array_sort(F.collect_set(c)).alias("__all_c"),
                          F.array_sort(F.collect_set(k)).alias("__all_k")).withColumn("__any", F.lit(True))
    out = got.join(F.broadcast(everything), "__any", "left")  # one row
    return out.select(*keys,
                      F.when(F.col("__any"), F.col("__all_c")).otherwise(F.col(c_out)).alias(c_out),
                      F.when(F.col("__any"), F.col("__all_k")).otherwise(F.col(k_out)).alias(k_out))


def expand_location_ids(df: DataFrame, keys: Sequence[str], col: str, tree: DataFrame,
                        out_prefix: str = "staffing_locations") -> DataFrame:
    """JSON location list → sorted distinct city ids and country ids.

    Elements with a parent win (D19); first id ``-1`` means every city and country; a
    country id expands to its cities; the country list holds each country id and each
    city's country. Unknown ids are skipped. ``keys`` must identify a row of ``df``.
    The all-locations row is a one-row aggregate of the dimension joined on a flag."""
    return _expand(df, keys, location_ids(F.col(col)), tree, False, out_prefix)


def expand_location_names(df: DataFrame, keys: Sequence[str], col: str, tree: DataFrame,
                          out_prefix: str = "staffing_locations") -> DataFrame:
    """As J11 but returning city and country names, reading every id of the list
    (parent ids included, as the reference's text split does)."""
    return _expand(df, keys, location_ids(F.col(col), parent_rule=False), tree, True, out_prefix)


def explode_cities(df: DataFrame, city_ids_col: str, tree: DataFrame,
                   city_col: str = "city_id", country_col: str = "country_id") -> DataFrame:
    """One row per city of the list (a row with an empty list stays, with nulls), and
    the city's country looked up again from the tree."""
    out = df.withColumn(city_col, F.explode_outer(F.col(city_ids_col)))
    return out.join(tree.select(F.col("city_id").alias(city_col), F.col("country_id").alias(country_col)),
                    city_col, "left")
