"""Connected components of links, as joins over the links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node that it reaches, for every node that has a link.

    Each round every node takes the least label around it, and then its label's
    label, so that labels jump along chains and the rounds grow with the logarithm of a
    component's width. Minima are combined before the shuffle, so a node with very many links costs one
    row per task. Labels live in tables in the shared folder; one sum per round comes to the driver.
    """
    one = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = materialize(one.union(one.select("v", "u")).distinct(), "graph-links")
    labels = both.groupBy("u").agg(F.min("v").alias("__v")).select(F.col("u").alias("node"), F.least("u", "__v").alias("component"))
    labels = materialize(labels, "graph-labels")
    total = _total(labels)
    while True:
        near = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("component").alias("__near"))
        step = labels.join(near, labels["node"] == near["u"]).select("node", F.least("component", "__near").alias("component"))
        to = labels.select(F.col("node").alias("__to"), F.col("component").alias("__jump"))
        step = step.join(to, step["component"] == to["__to"], "left")
        labels = materialize(
            step.select("node", F.least("component", F.coalesce("__jump", "component")).alias("component")), "graph-labels"
        )
        now = _total(labels)
        if now == total:
            return labels
        total = now


def _total(labels: DataFrame):
    # Labels only fall, so an equal sum means that none has changed.
    return labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
