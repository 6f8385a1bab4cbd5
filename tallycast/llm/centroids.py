"""Integer centroid clustering of embedding vectors in JVM expressions."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread_scan, write_out

#: Integer components stay below this, so that squared distances of up to 1,024 components fit 63 bits.
LARGEST = 1 << 25


def integers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; a component of ``LARGEST`` or more stops the job, as no distance would be right."""
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return F.when(F.exists(scaled, lambda x: F.abs(x) >= LARGEST), F.raise_error(F.lit("a component is too large"))).otherwise(scaled)


def usable(vector: Column, size: int) -> Column:
    """Whether a vector has exactly ``size`` components, none of them null, NaN or infinite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == size) & fine, F.lit(False))


def _literal(rows: Sequence[Sequence[int]]) -> Column:
    """An array of arrays as one literal, read by the JVM's parser (element calls from Python would take seconds)."""
    return F.expr("array(" + ", ".join("array(" + ", ".join(f"{x}L" for x in row) + ")" for row in rows) + ")")


def nearest(vector: Column, centroids: Sequence[Sequence[int]]) -> Column:
    """(distance, cluster) of the nearest centroid by squared distance; ties go to the smaller number."""

    def far(centroid: Column) -> Column:
        return F.aggregate(F.zip_with(vector, centroid, lambda x, c: (x - c) * (x - c)), F.lit(0).cast("long"), lambda s, d: s + d)

    return F.array_min(F.transform(_literal(centroids), lambda c, i: F.struct(far(c).alias("distance"), i.alias("cluster"))))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors with the ``k`` least SHA-256 hashes of ``seed:vec_id``, in the order of the hashes; fewer if there are fewer.

    Rows without an id start no centroid; rows that share an id follow one
    another in the order of their components.
    """
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [r["v"] for r in vectors.filter("vec_id is not null").orderBy(rank, "v").limit(k).select("v").collect()]


def updated(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Floor of the mean of each centroid's vectors; one without vectors stays. k rows reach the driver."""
    n = len(centroids[0])
    sums = vectors.select(nearest(F.col("v"), centroids)["cluster"].alias("cluster"), "v")
    sums = sums.select("cluster", *[F.get("v", F.lit(i)).alias(f"v{i}") for i in range(n)])
    sums = sums.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(n)])
    moved = {r["cluster"]: [r[f"v{i}"] // r["n"] for i in range(n)] for r in sums.collect()}
    return [moved.get(i, c) for i, c in enumerate(centroids)]


def clustered(
    embeddings: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: int = 2
) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance) of each usable vector, centroids) after ``rounds`` rounds and one more assignment.

    Distances, sums and means are integers, so the result does not depend on
    the order of the rows or on the number of tasks. Per round the vectors are
    read once and k rows of sums, made on the map side, are all that is
    shuffled; the centroids (k x size numbers, parameters) are literals of the
    plan. Null, short, long or non-finite vectors have no row. Repeated rows
    count as often as they occur; a null vec_id stays null. No usable vector
    with an id gives no centroids and no rows.
    """
    kept = spread_scan(embeddings.select("vec_id", "embedding")).filter(usable(F.col("embedding"), size)).select("vec_id", integers(F.col("embedding"), scale).alias("v"))
    centroids = first_centroids(kept, k, seed)
    if not centroids:
        return kept.limit(0).select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    for _ in range(rounds):
        centroids = updated(kept, centroids)
    # inline makes both columns of one evaluation
    near = kept.select("vec_id", F.inline(F.array(nearest(F.col("v"), centroids))))
    return near.select("vec_id", "cluster", "distance"), centroids


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds cluster_inertia, inertia and centroid_sha256; what is joined has a row for each cluster."""
    assigned = write_out(assigned, "assigned")
    rows = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids)]
    names = assigned.sparkSession.createDataFrame(rows, "cluster int, centroid_sha256 string")
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    per_cluster = F.broadcast(sums.join(names, "cluster"))
    total = sums.agg(F.sum("cluster_inertia").alias("inertia")).collect()[0]["inertia"]
    return assigned.join(per_cluster, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), "centroid_sha256"
    )


def op11_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return with_inertia(*clustered(spark.read.parquet(f"{sf}/embeddings.parquet")))


def centroids_sql(k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: int = 2) -> str:
    """The same in DuckDB: rounds as a chain of common table expressions."""
    distance = "list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    near = f"SELECT vec_id, v, (min(ROW({distance}, cluster)))[2] AS cluster, (min(ROW({distance}, cluster)))[1] AS distance FROM kept, {{c}} GROUP BY id, vec_id, v"
    steps = [
        f"""kept AS (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})""",
        f"""c0 AS (SELECT (row_number() OVER (ORDER BY h, v) - 1)::INT AS cluster, v AS c
            FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM kept WHERE vec_id IS NOT NULL ORDER BY h, v LIMIT {k}))""",
    ]
    for i in range(rounds):
        steps += [
            f"a{i} AS ({near.format(c=f'c{i}')})",
            f"""s{i} AS (SELECT cluster, list(m ORDER BY pos) AS c FROM (
                SELECT cluster, pos, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
                FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{i}) GROUP BY cluster, pos) GROUP BY cluster)""",
            f"c{i + 1} AS (SELECT cluster, coalesce(s{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN s{i} USING (cluster))",
        ]
    steps.append(f"a AS ({near.format(c=f'c{rounds}')})")
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
            sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a JOIN c{rounds} USING (cluster)"""


OP11_SQL = centroids_sql()
