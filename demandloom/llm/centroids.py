"""Centroid clustering of integer vectors by an incremental distance matrix.

Every vector keeps its exact integer dot product with every centroid.  The squared distance
is |v|^2 - 2 v.c + |c|^2, so an assignment needs only the kept products.  When a round moves
the centroids, a vector's product with a centroid is updated by the components of that
centroid that changed, and by nothing else; the argmin is taken anew.  The products start at
zero, as for centroids at the origin, so the first centroids are a change like any other.

The vectors with their products are a written table, one per round; the former goes once the
next is written.  The driver holds the centroids alone: ``n_centroids`` times ``dims`` integers
and as many sums per round, whatever the number of vectors.  A cluster may hold any share
of the rows: sums are combined on the map side.

Defined results: a row is kept if its vector has exactly ``dims`` components, none null, NaN or
infinite; other rows, null vectors included, have no result.  Repeated rows each get a result
and count each time.  Starting centroids are the kept rows with the smallest SHA-256 of
``1:<id>``, on ties the smaller vector; with fewer rows than centroids there are fewer
centroids; a null id comes last.  Ties in distance go to the centroid with the smaller number.
An empty cluster keeps its centroid.  An empty table gives an empty result.  Other columns are
ignored.  Components whose squares could leave 64 bits are an error, not a wrong distance.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import prepare
from demandloom.session import remove_path, scratch_path

N_CENTROIDS, ROUNDS, DIMS, SCALE = 16, 3, 64, 64
#: The squared distance of two vectors of up to 1024 components within it fits in 62 bits.
LARGEST = 1 << 25


def integers(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the kept rows, each component x as floor(scale * x)."""
    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    scaled = F.transform(x, lambda e: F.floor(e.cast("double") * scale))
    safe = F.forall(x, lambda e: F.abs(e.cast("double") * scale) < LARGEST)
    checked = F.when(safe, scaled).otherwise(F.raise_error(F.lit("a component is too large for exact distances")))
    return vectors.filter((F.size(x) == dims) & finite).select("vec_id", checked.cast("array<int>").alias("v"))


def first_centroids(ints: DataFrame, n_centroids: int = N_CENTROIDS) -> np.ndarray:
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = ints.orderBy(key.asc_nulls_last(), "v").select("v").limit(n_centroids).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def advance(state: DataFrame, before: np.ndarray, after: np.ndarray, last: bool = False) -> DataFrame:
    """The state after the centroids moved: products updated, cluster and distance anew.

    ``state`` has ``v`` and, after the first step, ``dots``.  The last step leaves both out.
    """
    moved = after - before
    changed = [np.flatnonzero(row) for row in moved]
    lengths = (after * after).sum(axis=1)
    has_dots = "dots" in state.columns

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            v = batch.column(1).flatten().to_numpy().reshape(n, -1).astype(np.int64)
            if has_dots:
                dots = batch.column(2).flatten().to_numpy().reshape(n, -1).copy()
            else:
                dots = np.zeros((n, len(after)), np.int64)
            for k, at in enumerate(changed):
                if at.size:
                    dots[:, k] += v[:, at] @ moved[k, at]
            distances = (v * v).sum(axis=1)[:, None] - 2 * dots + lengths
            cluster = distances.argmin(axis=1)
            out = [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distances[np.arange(n), cluster])]
            if not last:
                ends = pa.array(np.arange(n + 1, dtype=np.int32) * dots.shape[1])
                out += [batch.column(1), pa.ListArray.from_arrays(ends, pa.array(dots.ravel()))]
            yield pa.RecordBatch.from_arrays(out, names=["vec_id", "cluster", "distance", "v", "dots"][: len(out)])

    id_type = state.schema["vec_id"].dataType.simpleString()
    kept = "" if last else ", v array<int>, dots array<bigint>"
    columns = ["vec_id", "v", "dots"] if has_dots else ["vec_id", "v"]
    return state.select(*columns).mapInArrow(run, f"vec_id {id_type}, cluster int, distance bigint{kept}")


def moved_centroids(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the componentwise floor of its cluster's mean; empty ones where they are."""
    sums = [F.sum(F.get("v", F.lit(j))).alias(f"s{j}") for j in range(centroids.shape[1])]
    after = centroids.copy()
    for row in state.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        after[row["cluster"]] = [row[f"s{j}"] // row["n"] for j in range(centroids.shape[1])]
    return after


def cluster(
    vectors: DataFrame, n_centroids: int = N_CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept row, and the final centroids."""
    spark = prepare(vectors.sparkSession)
    state = integers(vectors, dims, scale)
    centroids = first_centroids(state, n_centroids)
    if not len(centroids):
        empty = state.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return empty, centroids
    at, former = np.zeros_like(centroids), None
    for step in range(rounds + 1):
        path = scratch_path(spark, f"centroids-{step}")
        advance(state, at, centroids, last=step == rounds).write.parquet(path)
        if former:
            remove_path(spark, former)
        state, former, at = spark.read.parquet(path), path, centroids
        if step < rounds:
            centroids = moved_centroids(state, centroids)
    return state, centroids


def report(vectors: DataFrame, **sizes: int) -> DataFrame:
    """Per vector its cluster, distance, both inertias and its centroid's digest."""
    state, centroids = cluster(vectors, **sizes)
    # At most one row per centroid comes to the driver.
    found = state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {r["cluster"]: int(r["s"]) for r in found}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def of(values: dict, kind: str):
        chosen = F.lit(None)
        for k, value in values.items():
            chosen = F.when(F.col("cluster") == k, F.lit(value)).otherwise(chosen)
        return chosen.cast(kind)

    return state.select(
        "vec_id",
        "cluster",
        "distance",
        of(inertia, "bigint").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("bigint").alias("inertia"),
        of(dict(enumerate(digests)), "string").alias("centroid_sha256"),
    )
