"""Content dedup with first-wins canonicals, vertex dedup with remapped indices, material numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def content_key(*parts: Column) -> Column:
    """Digest of all content (not a sample of it); null content has key "0"."""
    body = F.concat(*(F.coalesce(p.cast("binary"), F.lit(b"")) for p in parts))
    return F.when(parts[-1].isNull(), F.lit("0")).otherwise(F.sha2(body, 256))


def first_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Adds canonical: the smallest order value of the key. A hot key's rows meet only as a partial minimum and in a join that can be split."""
    firsts = rows.groupBy(key).agg(F.min(order).alias("canonical"))
    return rows.join(firsts, key)


def number_distinct(rows: DataFrame, group: str, value: str) -> DataFrame:
    """group, value, index: each distinct non-null value of a group numbered from 0 in its order."""
    distinct = rows.select(group, value).filter(F.col(value).isNotNull()).distinct()
    return distinct.withColumn("index", F.row_number().over(Window.partitionBy(group).orderBy(value)) - 1)


def material_index(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Rows with the index of their value among the group's; 0 where they have none."""
    numbered = number_distinct(rows, group, value)
    return rows.join(numbered, [group, value], "left").withColumn("index", F.coalesce("index", F.lit(0)))


def dedup_vertices(vertices: DataFrame, group: str, ordinal: str, values: list[str]) -> DataFrame:
    """group, ordinal, new_index: equal vertices share the index of the first, indices are dense in first-seen order (then by value)."""
    firsts = vertices.groupBy(group, *values).agg(F.min(ordinal).alias("first"))
    dense = firsts.withColumn("new_index", F.row_number().over(Window.partitionBy(group).orderBy("first", *values)) - 1)
    match = [F.col(f"v.{c}").eqNullSafe(F.col(f"f.{c}")) for c in (group, *values)]
    condition = match[0]
    for m in match[1:]:
        condition = condition & m
    return vertices.alias("v").join(dense.alias("f"), condition).select(*(F.col(f"v.{c}") for c in (group, ordinal)), "new_index")
