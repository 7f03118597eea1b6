"""Clusters of vectors around centroids, by expressions that stay in the JVM.

Vectors become integers, so that every sum is exact and no result hangs on the order in which tasks
finish.  Distances are array functions over the centroids as literals; the nearest is the least of
an array of structs.  A round hands on a sum per component and cluster, nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import packed, quoted, stored

#: Components as integers: floor(SCALE * x).
SCALE = 256
SIZE, CLUSTERS, ROUNDS, SEED = 64, 40, 5, "2"
#: Integers of components stay below this, so that a squared distance fits a long.
MOST = 1 << 27

Centroids = list[list[int]]


def whole_numbers(vec: Column, size: int = SIZE) -> Column:
    """The components as integers; null if there are not ``size``, or any is null or non-finite."""
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    far = F.raise_error(F.lit(f"components must stay below {MOST // SCALE} in magnitude")).cast("long")

    def whole(x: Column) -> Column:
        scaled = F.floor(x.cast("double") * SCALE)
        return F.when(F.abs(x.cast("double")) < MOST // SCALE, scaled).otherwise(far)

    return F.when((F.size(vec) == size) & good, F.transform(vec, whole))


def _literal(values: Sequence[int]) -> Column:
    return F.expr(f"array({', '.join(f'{int(x)}L' for x in values)})")


def nearest(vec: Column, centroids: Centroids) -> Column:
    """Struct ``d, k``: squared distance to the nearest centroid and its number, ties to the smaller.

    The centroids are one literal, folded when the plan is made.  ``vec`` is bound by a lambda, so
    that it isn't worked out again for each centroid.
    """
    known = ", ".join(f"struct(array({', '.join(f'{x}L' for x in c)}) AS v, {k} AS k)" for k, c in enumerate(centroids))

    def to(v: Column, c: Column) -> Column:
        squares = F.zip_with(v, c["v"], lambda a, b: (a - b) * (a - b))
        return F.struct(F.aggregate(squares, F.lit(0).cast("long"), lambda s, x: s + x).alias("d"), c["k"].alias("k"))

    return F.transform(F.array(vec), lambda v: F.array_min(F.transform(F.expr(f"array({known})"), lambda c: to(v, c))))[0]


def first_centroids(rows: DataFrame, clusters: int, seed: str) -> Centroids:
    """The vectors with the smallest SHA-256 of ``seed:id``; ``clusters`` rows reach the driver."""
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    chosen = rows.select(by.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(clusters)
    return [list(r.v) for r in chosen.collect()]


def moved(rows: DataFrame, centroids: Centroids) -> Centroids:
    """One round: every non-empty centroid becomes the floored mean of its vectors.

    Sums are per component, so tasks hand on a row a cluster whatever its size; a sum that doesn't
    fit a long fails.  The division is the driver's, on whole numbers.
    """
    size = len(centroids[0])
    near = rows.select("v", nearest(F.col("v"), centroids)["k"].alias("k"))
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(size)]
    out = list(centroids)
    for r in near.groupBy("k").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        out[r.k] = [r[f"s{i}"] // r.n for i in range(size)]
    return out


def digest(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    size: int = SIZE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: str = SEED,
) -> tuple[DataFrame, Centroids]:
    """Rows of ``vectors`` that have a usable vector, with ``cluster``, ``distance`` (squared),
    ``cluster_inertia`` and ``inertia`` (distance summed over the cluster and over all) and
    ``centroid_sha256``; and the final centroids.

    Centroids start as the ``clusters`` vectors of smallest hashed id.  Each of ``rounds`` assigns every
    vector to the nearest centroid, the smaller number where two are as near, and moves every
    centroid that has vectors to their floored mean; the others stay.  Then vectors are assigned
    once more.

    Rows whose vector is null, of another length than ``size``, or holds nulls or non-finite
    numbers are left out.  A row without an id is clustered, and made a centroid after all others;
    rows that share an id go by their vectors.  Repeated rows count as often as they are there, and
    two equal vectors may both be centroids, of which the second stays empty.  With fewer vectors than
    ``clusters`` each is a centroid; an empty table gives no rows.  A component of 2^19 or more in
    magnitude fails the job, as its distance might not fit.  Input columns with the names of new
    ones give way.
    """
    own = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    vec = whole_numbers(quoted(vector_col), size)
    rows = vectors.select(quoted(id_col).alias("id"), vec.alias("v")).where("v IS NOT NULL")
    centroids = first_centroids(rows, clusters, seed)
    if centroids:
        for _ in range(rounds):
            centroids = moved(rows, centroids)
        near = nearest(F.col("v"), centroids)
    else:
        near = F.lit(None).cast("struct<d:long,k:int>")
    kept = vectors.select(packed(vectors, own), vec.alias("v")).where("v IS NOT NULL")
    assigned = stored(kept.select("_row", near.alias("near")), "clusters")
    found = assigned.groupBy("near.k").agg(F.sum("near.d").alias("d")).collect()
    inertia = {r.k: r.d for r in found}
    numbers = range(len(centroids))
    sums = _literal([inertia.get(k, 0) for k in numbers])
    digests = F.array(*(F.lit(digest(c)) for c in centroids)).cast("array<string>")
    at = F.col("near.k") + 1
    labelled = assigned.select(
        "_row.*",
        F.col("near.k").alias("cluster"),
        F.col("near.d").alias("distance"),
        (F.element_at(sums, at) if centroids else F.lit(None).cast("long")).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        (F.element_at(digests, at) if centroids else F.lit(None).cast("string")).alias("centroid_sha256"),
    )
    return labelled, centroids
