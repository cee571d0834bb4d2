"""K-means on integer vectors with an equal-average equal-variance search for the nearest centroid.

Each component x becomes the integer floor(``SCALE`` * x). Centroids stand in the order of their component sums. A vector's
search starts at its own sum and goes outward; with k components, sum S and A = k * (sum of squares) - S^2,

    k * d^2  >=  (Sx - Sc)^2                               equal average
    k * d^2  >=  (Sx - Sc)^2 + (sqrt(Ax) - sqrt(Ac))^2     equal variance

so a centroid beyond the first bound ends the search, and one beyond the second is passed over; bounds in floating point
are taken a little low. What is left gets its exact integer distance. Each round reads the integer vectors once and
returns at most one row of sums per centroid and task, summed by Spark; only ``k`` rows reach the driver.

Defined cases: vectors that are null, of another length, or hold null or non-finite components, or one whose integer lies
beyond ``LARGEST`` (its squared distances would not fit a long), are left out; a null id is written as empty text in the
order of the first centroids; equal ids there go by components; repeated rows are vectors of their own; with fewer vectors
than centroids each is a centroid; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resalelake.llm.common import written

SCALE = 64
DIMS = 64
CLUSTERS = 16
ROUNDS = 3
LARGEST = 1 << 27
#: Relative and absolute room for rounding in the bounds.
SLACK = 1e-9
ROWS = 4096


class Search:
    """Nearest of some integer centroids by squared distance; ties go to the smaller number. ``exact`` counts exact distances."""

    def __init__(self, centres: np.ndarray):
        sums = centres.sum(axis=1)
        self.order = np.lexsort((np.arange(len(centres)), sums))
        self.centres = centres[self.order]
        self.sums = sums[self.order].astype(np.float64)
        self.spread = _spread(self.centres)
        self.exact = 0

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and squared distance, per point."""
        n, k, dims = len(points), len(self.centres), points.shape[1]
        sums, spread = points.sum(axis=1).astype(np.float64), _spread(points)
        high = np.searchsorted(self.sums, sums)
        low = high - 1
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, k)
        active = np.arange(n)
        while len(active):
            below = np.where(low[active] >= 0, sums[active] - self.sums[np.maximum(low[active], 0)], np.inf)
            above = np.where(high[active] < k, self.sums[np.minimum(high[active], k - 1)] - sums[active], np.inf)
            down = below <= above
            gap = np.minimum(below, above)
            # No side is left, or the nearer one is out by its mean: then so is all that lies beyond.
            limit = dims * best[active].astype(np.float64)
            open_ = np.isfinite(gap) & (gap * gap * (1 - SLACK) - SLACK <= limit)
            active, down, gap, limit = active[open_], down[open_], gap[open_], limit[open_]
            at = np.where(down, low[active], high[active])
            low[active[down]] -= 1
            high[active[~down]] += 1
            apart = np.abs(spread[active] - self.spread[at])
            apart = np.maximum(apart - SLACK * (spread[active] + self.spread[at] + 1), 0)
            near = (gap * gap + apart * apart) * (1 - SLACK) - SLACK <= limit
            who, at = active[near], at[near]
            self.exact += len(who)
            gaps = points[who] - self.centres[at]
            distance = np.einsum("ij,ij->i", gaps, gaps)
            numbers = self.order[at]
            closer = (distance < best[who]) | ((distance == best[who]) & (numbers < number[who]))
            best[who[closer]], number[who[closer]] = distance[closer], numbers[closer]
        return number, best


def _spread(points: np.ndarray) -> np.ndarray:
    """sqrt(k * sum of squares - square of the sum): the deviation times k."""
    wide = points.astype(np.float64)
    centred = wide - wide.mean(axis=1, keepdims=True)
    return np.sqrt(wide.shape[1] * (centred * centred).sum(axis=1))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(-1, dims)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def quantised(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """id and integer vector of the rows that are kept."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * F.lit(float(scale))) <= F.lit(float(LARGEST))))
    kept = vectors.select("vec_id", F.when((F.size("embedding") == dims) & fine, F.col("embedding")).alias("embedding")).where("embedding is not null")
    return kept.select("vec_id", F.transform(whole, lambda x: x.cast("int")).alias("v"))


def first_centroids(vectors: DataFrame, k: int = CLUSTERS) -> np.ndarray:
    """The vectors with the smallest sha256 of ``1:<vec_id>``, in that order: a top-k, so each task returns k rows at most."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = vectors.select(digest.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def _sums(centres: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centres)
        k, dims = centres.shape
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in _pieces(batches):
            points = _matrix(batch.column("v"), dims)
            number, _ = search.nearest(points)
            counts += np.bincount(number, minlength=k)
            np.add.at(sums, number, points)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int32()), pa.array(counts[seen]), *(pa.array(sums[seen, d]) for d in range(dims))],
            ["cluster", "n", *(f"s{d}" for d in range(dims))],
        )

    return rows


def moved(vectors: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Each centroid becomes the floor of the mean of its vectors, in exact integers; one without vectors stays."""
    names = ["n", *(f"s{d}" for d in range(centres.shape[1]))]
    parts = vectors.select("v").mapInArrow(_sums(centres), "cluster int, " + ", ".join(f"{c} long" for c in names))
    out = centres.copy()
    for row in parts.groupBy("cluster").agg(*[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in names]).collect():
        out[row.cluster] = [int(row[c]) // int(row.n) for c in names[1:]]
    return out


def _assigned(centres: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centres)
        for batch in _pieces(batches):
            number, distance = search.nearest(_matrix(batch.column("v"), centres.shape[1]))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    return rows


def clustered(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid: one row per kept vector."""
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    points = written(quantised(vectors, dims, scale), "integer-vectors")
    centres = first_centroids(points, k)
    if not len(centres):
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<int>")
    for _ in range(rounds):
        centres = moved(points, centres)
    found = written(points.mapInArrow(_assigned(centres), f"vec_id {kind}, cluster int, distance long"), "assigned-vectors")
    sums = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()}
    rows = [(c, _long(sums.get(c, 0)), _long(sum(sums.values())), centre.tolist()) for c, centre in enumerate(centres)]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid array<int>")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def _long(value: int) -> int | None:
    """Null where a sum does not fit."""
    return value if value < 1 << 63 else None


def centroid_sha256(centre: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest()


_ROUND = """
a{n} AS (SELECT p.r, c.cluster, p.v, c.v AS cv, list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM p CROSS JOIN c{n} c),
b{n} AS (SELECT * FROM a{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, cluster) = 1),"""
_MOVE = """
m{n} AS (SELECT cluster, i, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM b{n}) GROUP BY cluster, i),
c{next} AS (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN
  (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM m{n} GROUP BY cluster) m USING (cluster)),"""

#: The whole of the query, with every distance.
ORACLE = (
    """WITH p AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM {vectors}
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS cluster, v FROM
  (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM p) QUALIFY row_number() OVER (ORDER BY h, v) <= 16),"""
    + "".join(_ROUND.format(n=n) + _MOVE.format(n=n, next=n + 1) for n in range(ROUNDS))
    + _ROUND.format(n=ROUNDS).rstrip(",")
    + f"""
SELECT p.vec_id, b.cluster, CAST(b.d AS BIGINT) AS distance, CAST(sum(b.d) OVER (PARTITION BY b.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(b.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(b.cv, ',')) AS centroid_sha256
FROM b{ROUNDS} b JOIN p USING (r)"""
)
