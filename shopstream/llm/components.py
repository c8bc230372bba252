"""Connected components of a graph given as links, by alternating large and small stars.

Nothing but the two numbers that tell whether anything changed reaches the
driver. A star centre may hold a third of all links: its smallest neighbour is
an aggregate that combines before the shuffle, and the join that hands it back
reads both sides from written tables, so that AQE can split the centre's rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import checkpointed


def _least(links: DataFrame, key: str, other: str) -> DataFrame:
    return checkpointed(links.groupBy(key).agg(F.least(key, F.min(other)).alias("least")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours its smallest neighbour."""
    both = checkpointed(links.union(links.select("low", "high")).toDF("node", "near").distinct())
    least = _least(both, "node", "near")
    larger = both.where("near > node").join(least, "node")
    return larger.select(F.col("near").alias("high"), F.col("least").alias("low")).where("high > low").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, the smallest of them."""
    links = checkpointed(links)
    least = _least(links, "high", "low")
    handed = links.join(least, "high").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return handed.union(least.select("high", F.col("least").alias("low"))).where("high > low").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for every id in ``links`` (two columns of one type that has an order).

    ``component`` is the smallest id reachable. Self links, repeated links and
    links with a null end are allowed and change nothing; no links, no rows.
    """
    a, b = links.columns
    links = checkpointed(
        links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    mark = None
    while True:
        found = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")),
        ).first()
        if found == mark or found[0] == 0:
            break
        mark = found
        links = checkpointed(_small_star(_large_star(links)))
    centres = links.select(F.col("low").alias("id")).distinct()
    return links.select(F.col("high").alias("id"), F.col("low").alias("component")).union(
        centres.select("id", F.col("id").alias("component"))
    )


def join_labels(labels: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``labels`` (each the index of a member of its own group) after joining groups by the given pairs."""
    while len(left):
        a, b = labels[left], labels[right]
        apart = a != b
        if not apart.any():
            break
        left, right = left[apart], right[apart]
        a, b = a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = labels[labels]
            if (further == labels).all():
                break
            labels = further
    return labels
