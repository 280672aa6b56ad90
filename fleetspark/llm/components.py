"""Connected components of a graph of links, by hooking and pointer jumping over staged tables.

Every round hooks the larger label of each link that joins two labels onto the smaller one, and
follows the hooks to their ends. The driver sees one number a round. A node with very many links
only meets grouped minima and joins whose other side holds one row for each label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspark.functions.staging import release, stage


def merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (id, label) after joining what ``links`` (a, b) connects; labels become the least id.

    Links whose ends have no label are not looked at. Tables without rows are fine.
    """
    named = links.select("a", "b")
    for end in ("a", "b"):
        own = labels.select(F.col("id").alias(end), F.col("label").alias(f"{end}_label"))
        named = named.join(own, end)
    edges = _between(named.select("a_label", "b_label"), "a_label", "b_label")
    edges, moved, used = stage(edges, "edges"), None, []
    while edges.limit(1).count():
        hooks = stage(edges.groupBy("high").agg(F.min("low").alias("low")), "hooks")
        used += [edges, hooks]
        while True:
            onward = hooks.select(F.col("high").alias("low"), F.col("low").alias("next"))
            jumped = stage(hooks.join(onward, "low", "left").select("high", F.coalesce("next", "low").alias("low"), F.col("next").isNotNull().alias("went")), "hooks")
            used.append(jumped)
            hooks = jumped.select("high", "low")
            if not jumped.where("went").limit(1).count():
                break
        edges = stage(_between(_moved(_moved(edges, "high", hooks), "low", hooks), "high", "low"), "edges")
        if moved is None:
            moved = hooks
        else:
            moved = stage(_moved(moved, "low", hooks).unionByName(hooks), "moves")
            used.append(moved)
    merged = labels if moved is None else stage(_moved(labels, "label", moved), "labels")
    release(*used, edges)
    return merged


def _between(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct()


def _moved(df: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    to = hooks.select(F.col("high").alias(column), F.col("low").alias("_to"))
    return df.join(to, column, "left").select(*[F.coalesce("_to", column).alias(c) if c == column else c for c in df.columns])
