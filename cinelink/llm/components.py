"""Connected components of a stored table of edges."""

from pyspark.sql import functions as F

from cinelink.runtime import materialize


def merge_components(edges, a, b, node, part):
    """(node, part) for every node of an edge; `part` is the smallest node it is connected with.

    Every node hooks to its smallest neighbour, pointers are doubled until they end in
    roots, and edges are contracted to roots. Each repetition at least halves the roots that
    still have edges; every step is a stored table.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    labels = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("n"), F.least("a", "b").alias("up"))
        up = materialize(up, "parents")
        while True:
            above = up.select(F.col("n").alias("up"), F.col("up").alias("top")).where("up <> top")
            moved = up.join(above, "up", "left").select("n", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved"))
            moved = materialize(moved, "parents")
            up = moved.select("n", "up")
            if moved.where("moved").isEmpty():
                break
        if labels is None:
            labels = up
        else:
            labels = materialize(labels.withColumnRenamed("up", "root").join(
                up.select(F.col("n").alias("root"), "up"), "root", "left").select("n", F.coalesce("up", "root").alias("up")), "labels")
        edges = materialize(
            edges.join(up.select(F.col("n").alias("a"), F.col("up").alias("x")), "a")
            .join(up.select(F.col("n").alias("b"), F.col("up").alias("y")), "b")
            .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels.select(F.col("n").alias(node), F.col("up").alias(part))
