"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; the texts of all training documents, labels unseen, are the unlabelled sample of
the whole. With class prior ``p`` the risk of a classifier is ``p R+(P) + max(0, R-(U) - p R-(P))``; where the bracket turns
negative, the step goes against it, so the model cannot call unlabelled toxic text clean by memorising. Labels 0 only enter the
prior, which is the toxic share of labelled training texts.

Training counts texts, not rows: positives, document counts, the unlabelled sample and the prior have each distinct text (by a
128-bit hash) once, however many copies there are. A bitmap of fixed size tells rows that surely have no copy, which are counted where
they are read; the others meet by their hash, copies of a task merged before the shuffle.

Features are hashed words and word beginnings of 4 to 6 bytes, present or not, so that length does not matter. Document counts
of all of them are taken over every training text. Those far more frequent among positives than chance allows are kept, scaled by
their shrunken log ratio, and weighted by a linear model in numpy.

Bounds: positives are at most ``POSITIVES`` distinct texts and the fit sees at most ``UNLABELLED`` distinct texts, both by their
hash; these hashes, the counts (``BUCKETS`` at most) and the model are all that the driver holds. Counts, features and
scores cover all rows.

Defined cases: null and empty texts have no features and score the model's base rate; a null id counts as an empty id for the fold;
repeated labels of an id, and labels of copies, count as toxic if any is 1, null labels are no labels; labels without a document
do not count; null and empty texts are one text; repeated rows score alike; without positives every
score is the prior; other columns are never read and pass through ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resalelake.llm.common import ALNUM, LOWER, crc32_of_id, names_kept, slices, span_hashes, span_sums, spans, text_bytes, written

BUCKETS = 1 << 18
PREFIXES = (4, 5, 6)
POSITIVES = 20_000
UNLABELLED = 50_000
LEAST_DOCUMENTS = 5
LEAST_DEVIATION = 6.0
SHRINK = 20.0
THRESHOLD = 0.7
DEFAULT_PRIOR = 0.1
#: log2 of the bits that tell which texts may have copies.
COPY_BITS = 23
FOLDS = 3
HELD_OUT = 1


def held_out() -> Column:
    return crc32_of_id() % FOLDS == HELD_OUT


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Text number and bucket of each feature occurrence, and the number of texts."""
    raw, offsets = text_bytes(column)
    raw = LOWER[raw]
    starts, ends, first = spans(raw, offsets, ALNUM)
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    sums = span_sums(raw)
    texts, hashes = [text_of], [span_hashes(raw, starts, ends, sums)]
    for n in PREFIXES:
        longer = np.flatnonzero(ends - starts > n)
        texts.append(text_of[longer])
        # A beginning is not the word of the same bytes.
        hashes.append(span_hashes(raw, starts[longer], starts[longer] + n, sums) ^ np.uint64(0x5555555555555555))
    buckets = (np.concatenate(hashes) >> np.uint64(64 - 18)).astype(np.int64)
    return np.concatenate(texts), buckets, len(first) - 1


@dataclass
class Model:
    """Base and weight per kept bucket (``place`` is -1 for the others)."""

    place: np.ndarray
    weights: np.ndarray
    base: float

    def present(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
        """Text number and place of each kept feature, once per text."""
        texts, buckets, n = features(column)
        places = self.place[buckets]
        kept = places >= 0
        pairs = np.unique(texts[kept] * len(self.weights) + places[kept]) if kept.any() else np.zeros(0, np.int64)
        size = max(1, len(self.weights))
        return pairs // size, pairs % size, n

    def scores(self, column: pa.Array) -> np.ndarray:
        texts, places, n = self.present(column)
        z = self.base + np.bincount(texts, weights=self.weights[places], minlength=n)[:n] if len(texts) else np.full(n, self.base)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], ratios: np.ndarray, prior: float, rounds: int = 600, rate: float = 0.05, ridge: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and base that minimise the non-negative risk of the sigmoid loss, by full gradients (Adam)."""

    def side(rows: list[np.ndarray]):
        places = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        texts = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        return places, texts, len(rows)

    p_places, p_texts, n_p = side(positive)
    u_places, u_texts, n_u = side(unlabelled)
    k = len(ratios)
    theta, m1, m2 = np.zeros(k + 1), np.zeros(k + 1), np.zeros(k + 1)
    theta[k] = np.log(prior / (1 - prior))

    def risen(places, texts, n, z_slope):
        """Gradient over (weights, base) of the mean over texts, given each text's slope."""
        g = np.zeros(k + 1)
        g[:k] = np.bincount(places, weights=z_slope[texts] * ratios[places], minlength=k)[:k] / n if len(places) else 0
        g[k] = z_slope.mean()
        return g

    for step in range(1, rounds + 1):
        w = theta[:k] * ratios
        z_p = theta[k] + np.bincount(p_texts, weights=w[p_places], minlength=n_p)
        z_u = theta[k] + np.bincount(u_texts, weights=w[u_places], minlength=n_u)
        s_p, s_u = 1 / (1 + np.exp(-z_p)), 1 / (1 + np.exp(-z_u))
        slope_p, slope_u = s_p * (1 - s_p), s_u * (1 - s_u)
        negative_risk = s_u.mean() - prior * s_p.mean()
        up_p = risen(p_places, p_texts, n_p, slope_p)
        negative = risen(u_places, u_texts, n_u, slope_u) - prior * up_p
        gradient = negative - prior * up_p if negative_risk >= 0 else -negative
        gradient[:k] += ridge * theta[:k]
        m1 = 0.9 * m1 + 0.1 * gradient
        m2 = 0.999 * m2 + 0.001 * gradient**2
        theta -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return theta[:k] * ratios, float(theta[k])


def hashed(docs: DataFrame) -> DataFrame:
    """Text with its 128-bit hash ``h1, h2``; null is empty."""
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"text": text, "h1": F.xxhash64(text), "h2": F.xxhash64(F.lit(1), text)})


def _copies(texts: DataFrame) -> np.ndarray:
    """One bit per leading bits of the hash of any text that more than one row has."""
    several = texts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    slot = F.shiftrightunsigned("h1", 64 - COPY_BITS)
    words = several.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h1, {64 - COPY_BITS}) & 63 AS INT))")).alias("bits"))
    found = words.toArrow()
    out = np.zeros(1 << (COPY_BITS - 6), np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _may_have_copies(batch: pa.RecordBatch, copies: np.ndarray) -> np.ndarray:
    slots = _column(batch, "h1").view(np.uint64) >> np.uint64(64 - COPY_BITS)
    return (copies[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) == 1


def _among(batch: pa.RecordBatch, chosen: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.isin(_column(batch, "h1"), chosen[0]) & np.isin(_column(batch, "h2"), chosen[1])


def _with_copies(copies):
    """Rows whose text may have copies."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(_may_have_copies(batch, copies.value)))

    return rows


def _counts(positives, copies=None):
    """Per task: documents with each bucket, and positives among them; bucket -1 counts documents. Rows whose text may
    have ``copies`` are left out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, toxic = np.zeros(BUCKETS + 1, np.int64), np.zeros(BUCKETS + 1, np.int64)
        for batch in slices(batches, "text"):
            if copies is not None:
                batch = batch.filter(pa.array(~_may_have_copies(batch, copies.value)))
            if not batch.num_rows:
                continue
            texts, buckets, n = features(batch.column("text"))
            mine = _among(batch, positives.value)
            pairs = np.unique(texts * BUCKETS + buckets)
            texts, buckets = pairs // BUCKETS, pairs % BUCKETS
            every[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
            toxic[:BUCKETS] += np.bincount(buckets[mine[texts]], minlength=BUCKETS)
            every[BUCKETS] += n
            toxic[BUCKETS] += mine.sum()
        some = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(every[some]), pa.array(toxic[some])], ["bucket", "every", "toxic"])

    return rows


def _sampled(model, positives, unlabelled):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            toxic, other = _among(batch, positives.value), _among(batch, unlabelled.value)
            wanted = np.flatnonzero(toxic | other)
            if not len(wanted):
                continue
            # Copies within the slice once.
            wanted = wanted[np.unique(np.stack([_column(batch, "h1")[wanted], _column(batch, "h2")[wanted]]), axis=1, return_index=True)[1]]
            texts, places, n = model.value.present(batch.column("text").take(pa.array(wanted)))
            found = np.split(places.astype(np.int32), np.searchsorted(texts, np.arange(1, n)))
            columns = [*(batch.column(c).take(pa.array(wanted)) for c in ("h1", "h2")), pa.array(toxic[wanted]), pa.array(other[wanted]), pa.array([f.tobytes() for f in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "toxic", "other", "places"])

    return rows


def _chosen(texts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of at most ``limit`` distinct texts, in their order."""
    found = texts.select("h1", "h2").distinct().orderBy("h1", "h2").limit(limit).toArrow()
    return found.column("h1").to_numpy(), found.column("h2").to_numpy()


def train(docs: DataFrame, labels: DataFrame) -> Model:
    sc = docs.sparkSession.sparkContext
    training = hashed(docs.where(~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    marked = written(training.select("doc_id", "h1", "h2").join(marks, "doc_id").groupBy("h1", "h2").agg(F.max("toxic").alias("toxic")), "toxicity-marked")
    share = marked.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    prior = float(np.clip(share.toxic / share.n, 0.01, 0.5)) if share.n else DEFAULT_PRIOR
    base = Model(np.full(BUCKETS, -1, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))
    chosen = _chosen(marked.where("toxic = 1"), POSITIVES)
    if not len(chosen[0]):
        return base
    positives = sc.broadcast(chosen)
    texts = training.select("text", "h1", "h2")
    copies = sc.broadcast(_copies(training.select("h1", "h2")))
    kind = "bucket bigint, every bigint, toxic bigint"
    several = texts.mapInArrow(_with_copies(copies), "text string, h1 bigint, h2 bigint").groupBy("h1", "h2").agg(F.first("text").alias("text"))
    both = texts.mapInArrow(_counts(positives, copies), kind).union(several.mapInArrow(_counts(positives), kind))
    counted = both.groupBy("bucket").agg(F.sum("every").alias("every"), F.sum("toxic").alias("toxic")).toArrow()
    every, seen = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    at = counted.column("bucket").to_numpy()
    every[at], seen[at] = counted.column("every").to_numpy(), counted.column("toxic").to_numpy()
    rate = seen[BUCKETS] / every[BUCKETS]
    expected = every[:BUCKETS] * rate
    seen = seen[:BUCKETS]
    kept = np.flatnonzero((seen >= LEAST_DOCUMENTS) & (seen - expected >= LEAST_DEVIATION * np.sqrt(expected)))
    ratios = np.log((seen[kept] + SHRINK * rate) / (expected[kept] + SHRINK * rate))
    base.place[kept] = np.arange(len(kept))
    base.weights = ratios
    if not len(kept):
        return base
    unlabelled = sc.broadcast(_chosen(texts, UNLABELLED))
    found = texts.mapInArrow(_sampled(sc.broadcast(base), positives, unlabelled), "h1 bigint, h2 bigint, toxic boolean, other boolean, places binary")
    sample = found.groupBy("h1", "h2").agg(*[F.first(c).alias(c) for c in ("toxic", "other", "places")]).toArrow().sort_by([("h1", "ascending"), ("h2", "ascending")])
    rows = [np.frombuffer(x, np.int32) for x in sample.column("places").to_pylist()]
    marks_of = sample.column("toxic").to_pylist(), sample.column("other").to_pylist()
    weights, start = fit([r for r, t in zip(rows, marks_of[0]) if t], [r for r, o in zip(rows, marks_of[1]) if o], ratios, prior)
    return Model(base.place, weights, start)


def _scored(model, names: list[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(model.value.scores(batch.column("text")))], [*names, "__score"])

    return rows


def scored(docs: DataFrame, model: Model, names: list[str]) -> DataFrame:
    """Columns ``names`` of every row of ``docs`` with ``__score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names) + ", __score double"
    needed = names if "text" in names else [*names, "text"]
    return docs.select(*[F.col(f"`{c}`") for c in needed]).mapInArrow(_scored(shared, names), schema)


@names_kept
def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that a model trained on them and ``labels`` calls toxic."""
    return scored(docs, train(docs, labels), docs.columns).where(F.col("__score") < threshold).drop("__score")
