"""Connected components by contraction, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatplan.llm import common


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every id of ``links(a, b)``: the least id that it is linked with, itself included.

    Each round gives every node the least of its closed neighbourhood and contracts the edges to these labels, so the
    least node of a component keeps its own label until it is alone. Rounds are few (logarithmic as a rule); edges and
    maps of a round are written tables.
    """
    edges = common.written(links.filter("a <> b").selectExpr("least(a, b) as a", "greatest(a, b) as b").distinct(), "edges")
    label = None
    while not edges.isEmpty():
        step = (
            edges.select(F.col("b").alias("id"), F.col("a").alias("to"))
            .unionByName(edges.select(F.col("a").alias("id"), F.col("a").alias("to")))
            .groupBy("id")
            .agg(F.min("to").alias("to"))
        )
        step = common.written(step, "labels")
        ends = (
            edges.join(step.withColumnsRenamed({"id": "a", "to": "_a"}), "a")
            .join(step.withColumnsRenamed({"id": "b", "to": "_b"}), "b")
            .filter("_a <> _b")
            .selectExpr("least(_a, _b) as a", "greatest(_a, _b) as b")
            .distinct()
        )
        edges = common.written(ends, "edges")
        if label is None:
            label = step.withColumnRenamed("to", "component")
        else:
            on = step.withColumnsRenamed({"id": "component", "to": "_next"})
            label = label.join(on, "component", "left").select("id", F.coalesce("_next", "component").alias("component"))
            label = common.written(label, "components")
    if label is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return label
