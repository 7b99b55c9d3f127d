"""Connected components by least-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mcqflow.session import materialize


def components(edges: DataFrame, a: str = "u", b: str = "v", max_rounds: int = 64) -> DataFrame:
    """(node, label): label is the least node of the node's component.

    Every round sets a node's label to the least label of its neighbours and
    then to that label's own label, so paths shorten by more than half.  The
    least label of a hub's neighbours is a partial aggregate, never a gathered
    list.  Each round's labels are written to the shared folder; only the
    number of changes reaches the driver.
    """
    own = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("s"), F.least(a, b).alias("t")).distinct()
    least = own.groupBy("s").agg(F.min("t").alias("m"))
    # tie every node to its least neighbour, and its other neighbours to that one: few distinct edges stay
    both = (own.join(least, "s").select(F.explode(F.array(F.struct(F.col("s"), F.col("m").alias("t")), F.struct(F.col("t").alias("s"), F.col("m").alias("t")))).alias("e"))
            .select("e.s", "e.t").where("s <> t").distinct())
    both = materialize(both.union(both.select(F.col("t"), F.col("s"))).distinct(), "component-edges")
    labels = materialize(both.groupBy(F.col("s").alias("node")).agg(F.least(F.min("t"), F.col("node")).alias("label")), "component-labels")
    for _ in range(max_rounds):
        near = (both.join(labels.select(F.col("node").alias("t"), F.col("label").alias("l")), "t")
                .groupBy(F.col("s").alias("node")).agg(F.min("l").alias("l")))
        low = labels.join(near, "node").select("node", "label", F.least("label", "l").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("up"))
        nxt = materialize(low.join(jump, "new", "left")
                          .select("node", F.least("new", F.coalesce("up", "new")).alias("label"),
                                  (F.least("new", F.coalesce("up", "new")) < F.col("label")).alias("changed")), "component-labels")
        labels = nxt.select("node", "label")
        if nxt.where("changed").limit(1).count() == 0:
            return labels
    raise RuntimeError("labels did not settle")
