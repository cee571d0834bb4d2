"""Embedding near-dedup by product quantisation.

Equal vectors of a label are one class first. A coarse quantiser puts each class into an inverted list; the residual is
coded by ``SUBSPACES`` codebooks. Every class queries the ``PROBES`` nearest lists of its label, looks up asymmetric
distances there (query exact, code quantised) and reranks what is left by exact cosine in double precision.

* Of the nearest lists, those are left out that cannot hold a link: ones the query lies farther than ``reach`` from, seen
  from the plane between the two centroids.
* An asymmetric distance is off by at most the code's own error, which is stored; candidates are those within ``reach``
  plus that error. So within the probed lists nothing is lost, and with up to ``PROBES`` lists nothing at all.

Lists hold about ``LIST_CODES`` classes of a label as long as ``MOST_LISTS`` suffice, up to about 500,000 classes of a label; the work
then grows with the table. Beyond that lists grow, and with them the work of a query: raise ``MOST_LISTS`` and ``SAMPLE`` together. A pair is found
when either side probes the other's list, so beyond ``PROBES`` lists a few can be missed (README has the recall); the exact way is
``probes`` of at least the number of lists. Where both sides probe, the list with the lower number counts the pair. The groups of one list are cut
into blocks of about ``BLOCK`` codes and ``BLOCK`` queries, so a hot list is many bounded tasks. A block returns sums of links
and a spanning forest, not pairs.

Only the quantisers are fitted on a sample (``SAMPLE`` classes by hash); all vectors are coded.

Defined cases: null labels and vectors that are null, empty, zero or hold null or non-finite components have no links and are their own
component; vectors of unequal length do not link; repeated rows are vectors of their own, linked with each other; null
ids have component null unless a linked vector has an id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resalelake.llm.common import written
from resalelake.llm.components import components, joined_labels

COSINE = 0.93
SUBSPACES = 16
CODES = 256
SAMPLE = 20_000
MOST_LISTS = 4096
LIST_CODES = 128
PROBES = 16
BLOCK = 4096
SLACK = 1e-6
GROUP = ["label", "dim", "list", "tile", "part"]


def kmeans(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        nearest = _nearest(points, centres)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray, rows: int = 8192) -> np.ndarray:
    half = (centres * centres).sum(axis=1) / 2
    return np.concatenate([np.argmax(points[at : at + rows] @ centres.T - half, axis=1) for at in range(0, len(points), rows)]) if len(points) else np.zeros(0, int)


class Index:
    """The fitted quantisers; small, and of a size set by parameters."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES):
        self.dims = -(-sample.shape[1] // subspaces) * subspaces
        points = self.padded(sample)
        self.centres = kmeans(points, min(lists, len(points)))
        residuals = points - self.centres[_nearest(points, self.centres)]
        parts = residuals.reshape(len(points), subspaces, -1)
        self.books = np.stack([kmeans(np.ascontiguousarray(parts[:, m]), CODES) for m in range(subspaces)])

    def padded(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros((len(points), self.dims))
        out[:, : points.shape[1]] = points
        return out

    def coded(self, points: np.ndarray, reach: float, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[int]]]:
        """List, codes, code error and lists to probe of unit vectors."""
        squares = (points * points).sum(1)[:, None] - 2 * points @ self.centres.T + (self.centres * self.centres).sum(1)
        own = np.argmin(squares, axis=1)
        parts = (points - self.centres[own]).reshape(len(points), len(self.books), -1)
        codes = np.stack([_nearest(parts[:, m], self.books[m]) for m in range(len(self.books))], axis=1)
        rebuilt = np.stack([self.books[m][codes[:, m]] for m in range(len(self.books))], axis=1)
        error = np.sqrt(((parts - rebuilt) ** 2).sum(axis=(1, 2)))
        most = min(most, len(self.centres))
        nearest = np.argpartition(squares, most - 1, axis=1)[:, :most]
        gaps = np.sqrt(np.maximum(((self.centres[nearest] - self.centres[own][:, None]) ** 2).sum(-1), 1e-300))
        beyond = (np.take_along_axis(squares, nearest, 1) - squares[np.arange(len(own)), own][:, None]) / (2 * gaps)
        keep = (beyond <= reach + SLACK) | (nearest == own[:, None])
        return own, codes.astype(np.uint8), error, [n[k].tolist() for n, k in zip(nearest, keep)]

    def distances(self, queries: np.ndarray, number: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of queries to the codes of a list, by table look-up."""
        residuals = queries - self.centres[number]
        parts = residuals.reshape(len(queries), len(self.books), -1)
        total = np.repeat((residuals * residuals).sum(axis=1)[:, None], len(codes), axis=1)
        for m, book in enumerate(self.books):
            table = (book * book).sum(axis=1) - 2 * parts[:, m] @ book.T  # of one subspace: queries x codes
            total += table[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Unit vectors in double precision, filled up with zeros to one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(sizes), dims))
    if len(sizes) and (sizes == sizes[0]).all():
        out[:, : sizes[0]] = flat.reshape(len(sizes), -1)
    else:
        out[np.arange(dims)[None] < sizes[:, None]] = flat
    out /= np.abs(out).max(axis=1, keepdims=True)  # squares of very small or large components stay in range
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def _coded(shared, reach: float, most: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                own, codes, error, probes = index.coded(_matrix(batch.column("embedding"), index.dims), reach, most)
                columns = [batch.column(c) for c in ("cid", "label", "dim", "n", "embedding")]
                columns += [pa.array(own, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(probes, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, ["cid", "label", "dim", "n", "embedding", "list", "code", "error", "probes"])

    return rows


def _block_links(shared, cosine: float, reach: float):
    def found(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        index: Index = shared.value
        out = pa.schema([("cid", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        queries, vectors = _matrix(left.column("embedding"), index.dims), _matrix(right.column("embedding"), index.dims)
        number = key[2].as_py()
        codes = np.frombuffer(b"".join(right.column("code").to_pylist()), np.uint8).reshape(len(vectors), -1)
        bound = reach + SLACK + right.column("error").to_numpy()
        ids = [t.column("cid").to_numpy() for t in (left, right)]
        sizes = [t.column("n").to_numpy() for t in (left, right)]
        own = left.column("own").to_numpy()
        lists = right.column("probes").combine_chunks()
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        probed = lists.flatten().to_numpy()
        # Codes whose own query probes a list, as sorted pairs.
        back = np.sort(probed.astype(np.int64) * len(vectors) + np.repeat(np.arange(len(vectors)), np.diff(ends)))
        nodes, place = np.unique(np.concatenate(ids), return_inverse=True)
        labels, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
        for at in range(0, len(queries), 128):
            some = slice(at, at + 128)
            near = index.distances(queries[some], number, codes) <= bound
            near &= (own[some, None] != number) | (ids[0][some, None] < ids[1][None])
            q, v = np.nonzero(near)
            exact = np.einsum("ij,ij->i", queries[some][q], vectors[v]) >= cosine
            q, v = q[exact] + at, v[exact]
            wanted = own[q].astype(np.int64) * len(vectors) + v
            place_of = np.minimum(np.searchsorted(back, wanted), max(0, len(back) - 1))
            once = (own[q] >= number) | (back[place_of] != wanted)
            q, v = q[once], v[once]
            a, b = place[q], place[len(queries) + v]
            np.add.at(links, a, sizes[1][v])
            np.add.at(links, b, sizes[0][q])
            labels = joined_labels(labels, a, b)
        some = np.flatnonzero(links)
        return pa.table({"cid": nodes[some], "root": nodes[labels[some]], "links": links[some]}, out)

    return found


def classes(vectors: DataFrame) -> DataFrame:
    """Distinct linkable vectors: cid, label, dim, embedding, n rows and the least vec_id."""
    sound = (
        F.col("label").isNotNull()
        & (F.size(F.coalesce("embedding", F.array().cast("array<double>"))) > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    # Zero of either sign is one value to grouping, and so for the join later.
    found = vectors.where(sound).groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    return written(found.withColumn("cid", F.monotonically_increasing_id()).withColumn("dim", F.size("embedding")), "pq-classes")


def fitted(found: DataFrame) -> Index | None:
    shape = found.agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("dim"), F.approx_count_distinct("label").alias("labels")).first()
    if not shape.n:
        return None
    sample = found.select("embedding").orderBy(F.xxhash64("embedding")).limit(SAMPLE).toArrow()
    lists = max(1, min(MOST_LISTS, shape.n // (LIST_CODES * max(1, shape.labels))))
    return Index(_matrix(sample.column("embedding"), shape.dim), lists)


def links(found: DataFrame, index: Index, cosine: float = COSINE, probes: int = PROBES) -> DataFrame:
    """(cid, root, links): per block, the linked rows of each class and a node that it is connected to."""
    spark = found.sparkSession
    reach = float(np.sqrt(2 - 2 * cosine))
    shared = spark.sparkContext.broadcast(index)
    kind = {c: found.schema[c].dataType.simpleString() for c in ("label", "embedding")}
    schema = f"cid bigint, label {kind['label']}, dim int, n bigint, embedding {kind['embedding']}, list int, code binary, error double, probes array<int>"
    coded = written(found.select("cid", "label", "dim", "n", "embedding").mapInArrow(_coded(shared, reach, probes), schema), "pq-codes")
    key = ["label", "dim", "list"]
    probing = coded.select("cid", "label", "dim", "n", "embedding", F.col("list").alias("own"), F.explode("probes").alias("list"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    counts = (
        coded.groupBy(*key).agg(F.count(F.lit(1)).alias("codes"))
        .join(coded.select("label", "dim", F.explode("probes").alias("list")).groupBy(*key).agg(F.count(F.lit(1)).alias("queries")), key)
        .select(*key, blocks("codes").alias("tiles"), blocks("queries").alias("parts"))
    )
    counts = written(counts, "pq-lists")
    spread = lambda n: F.pmod(F.xxhash64("cid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    again = coded.select(*[F.col(c).alias(c) for c in coded.columns])  # names of its own for the cogroup
    codes = again.join(counts, key).withColumn("tile", spread("tiles")).withColumn("part", every("parts")).select(*GROUP, "cid", "n", "code", "error", "probes", "embedding")
    queries = probing.join(counts, key).withColumn("part", spread("parts")).withColumn("tile", every("tiles")).select(*GROUP, "cid", "n", "own", "embedding")
    return queries.groupBy(*GROUP).cogroup(codes.groupBy(*GROUP)).applyInArrow(_block_links(shared, cosine, reach), "cid bigint, root bigint, links bigint")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, probes: int = PROBES) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    rows = vectors.select("vec_id", "label", "embedding")
    found = classes(rows)
    index = fitted(found)
    alone = [F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")]
    if index is None:
        return rows.select("vec_id", *alone)
    linked = written(links(found, index, cosine, probes), "pq-links")
    roots = components(linked.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    sums = linked.groupBy("cid").agg(F.sum("links").alias("links"))
    rooted = found.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid")).join(sums, "cid", "left")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    per_class = rooted.join(least, "root").select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id", F.lit(True).alias("linkable"))
    out = rows.join(per_class, ["label", "embedding"], "left")
    component = F.when(F.col("linkable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


#: The links and counts on DuckDB by comparing all pairs of a label; components by spreading the least id.
ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM {vectors}
), ok AS (
  SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), component AS (
  SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT component.vec_id, (SELECT count(*) FROM links WHERE links.a = component.vec_id) AS n_links, component_id,
       component.vec_id = component_id AS kept
FROM component
"""
