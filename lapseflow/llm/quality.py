"""Quality by the votes of the nearest labelled texts in a latent-semantic space.

A text is described by its words, by the shapes of its tokens (runs of letters, capitals and
digits are one sign each, other signs stand for themselves) and by how often a token
repeats the one before. Words and shapes are hashed to fixed numbers of features and weighted by
inverse document frequencies over all documents. A truncated singular value decomposition of the
labelled sample gives the latent space. The labelled vectors, bounded by ``SAMPLE``, go to every task,
which multiplies blocks of its texts' vectors with all of them: the neighbours are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapseflow.llm import tokens
from lapseflow.llm.labelled import labelled_sample, remainder
from lapseflow.llm.registry import query, table

#: Labelled documents to learn from at most.
SAMPLE = 4096
WORDS, SHAPES = 2048, 1024
#: Features of words, shapes, and the two of repetition.
FEATURES = WORDS + SHAPES + 2
#: What each of the three counts for in a vector.
WEIGHTS = (0.6, 1.0, 1.0)
RANK = 64
NEIGHBOURS = 25
#: Texts that are compared with the sample at once, and bytes of text in a piece.
BLOCK, PIECE = 512, 1 << 19

#: Capitals, other letters and digits by class; other signs stay.
_SHAPE = np.array(
    [
        0x20 if c == 0x20 or 9 <= c <= 13 else 0x41 if 0x41 <= c <= 0x5A else 0x61 if 0x61 <= c <= 0x7A or c >= 0x80 else 0x30 if 0x30 <= c <= 0x39 else c
        for c in range(256)
    ],
    dtype=np.uint8,
)
_CASED = np.where(_SHAPE == 0x20, 0x20, np.arange(256)).astype(np.uint8)


def _shapes(column: pa.Array) -> tokens.Words:
    raw, starts = tokens.text_bytes(column)
    signs = _SHAPE[raw]
    new = np.ones(len(signs), bool)
    new[1:] = signs[1:] != signs[:-1]
    new[starts[:-1][starts[:-1] < len(signs)]] = True
    at = np.concatenate([[0], np.cumsum(new)])
    return tokens.words_of(signs[new], at[starts], _CASED)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts' features as (text, feature, count), sorted by text."""
    n = len(column)
    found = tokens.words(column, tokens.ALNUM)
    shapes = _shapes(column)
    same = tokens.words(column, tokens.SOLID)
    owner = same.owners()
    again = np.zeros(len(owner), bool)
    again[1:] = (same.hashes[1:] == same.hashes[:-1]) & (owner[1:] == owner[:-1])
    place = np.concatenate(
        [
            found.owners() * FEATURES + (found.hashes % np.uint64(WORDS)).astype(np.int64),
            shapes.owners() * FEATURES + WORDS + (shapes.hashes % np.uint64(SHAPES)).astype(np.int64),
            owner * FEATURES + WORDS + SHAPES + again,
        ]
    )
    at, count = np.unique(place, return_counts=True)
    return at // FEATURES, at % FEATURES, count


def _family(feature: np.ndarray) -> np.ndarray:
    return (feature >= WORDS).astype(np.int64) + (feature >= WORDS + SHAPES)


def weighted(text: np.ndarray, feature: np.ndarray, count: np.ndarray, n: int, idf: np.ndarray) -> np.ndarray:
    """Values of the features: roots of shares times idf, each family scaled to its weight."""
    family = _family(feature)
    place = text * 3 + family
    total = np.bincount(place, weights=count, minlength=3 * n)
    value = np.sqrt(count / total[place]) * idf[feature]
    norm = np.sqrt(np.bincount(place, weights=value**2, minlength=3 * n))
    return value / np.maximum(norm[place], 1e-12) * np.array(WEIGHTS)[family]


def _projected(column: pa.Array, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Unit vectors of texts in the latent space; texts without words get zeros."""
    n = len(column)
    text, feature, count = features(column)
    vectors = np.zeros((n, basis.shape[1]), np.float32)
    if len(text):
        value = weighted(text, feature, count, n, idf).astype(np.float32)
        first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        vectors[text[first]] = np.add.reduceat(value[:, None] * basis[feature], first, axis=0)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.where(norm > 1e-9, vectors / np.maximum(norm, 1e-9), 0).astype(np.float32)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """The number of all texts and for each feature the number of texts with it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for low, high in tokens.slices(batch.column(0), PIECE):
                _, feature, _ = features(batch.column(0).slice(low, high - low))
                seen[:FEATURES] += np.bincount(feature, minlength=FEATURES)
                seen[FEATURES] += high - low
        has = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(has), pa.array(seen[has])], names=["feature", "n"])

    sums = docs.select(F.col("text").cast("string")).mapInArrow(count, "feature bigint, n bigint")
    # At most one row per feature comes to the driver.
    rows = sums.groupBy("feature").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(FEATURES + 1, np.int64)
    for feature, n in rows:
        seen[feature] = n
    return int(seen[FEATURES]), seen[:FEATURES]


@dataclass
class Model:
    """idf per feature, latent basis (features by rank), the labelled unit vectors and their labels."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def latent_basis(rows: np.ndarray, rank: int = RANK, seed: int = 1) -> np.ndarray:
    """The leading right singular vectors, by a randomised range finder with power steps."""
    rank = min(rank, *rows.shape)
    rng = np.random.default_rng(seed)
    span = rows @ rng.standard_normal((rows.shape[1], min(rank + 16, min(rows.shape)))).astype(np.float32)
    for _ in range(4):
        span = rows @ (rows.T @ np.linalg.qr(span)[0])
    q = np.linalg.qr(span)[0]
    return np.linalg.svd(q.T @ rows, full_matrices=False)[2][:rank].T.astype(np.float32)


def fit(docs: DataFrame, sample: DataFrame) -> Model | None:
    """A model from (doc_id, text, label) rows, of which there are ``SAMPLE`` at most; None without any."""
    total, seen = document_frequencies(docs)
    idf = np.log((1 + total) / (1 + seen)) + 1
    # Each labelled text's features, a bounded table.
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in tokens.slices(batch.column(1), PIECE):
                text, feature, count = features(batch.column(1).slice(low, high - low))
                value = weighted(text, feature, count, high - low, idf)
                bounds = np.searchsorted(text, np.arange(high - low + 1))
                yield pa.record_batch(
                    [
                        batch.column(0).slice(low, high - low),
                        batch.column(2).slice(low, high - low),
                        tokens.nested(feature, bounds, pa.int32()),
                        tokens.nested(value, bounds, pa.float32()),
                    ],
                    names=["doc_id", "label", "feature", "value"],
                )

    described = sample.select("doc_id", "text", "label").mapInArrow(
        describe, "doc_id bigint, label int, feature array<int>, value array<float>"
    )
    rows = sorted(described.collect(), key=lambda r: (r["doc_id"], r["feature"], r["value"]))
    rows = [r for r in rows if r["feature"]]
    if not rows:
        return None
    matrix = np.zeros((len(rows), FEATURES), np.float32)
    for i, r in enumerate(rows):
        matrix[i, r["feature"]] = r["value"]
    basis = latent_basis(matrix)
    vectors = matrix @ basis
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return Model(idf, basis, vectors, np.array([r["label"] for r in rows], np.float64))


def votes(model: Model, vectors: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """The similarity-weighted share of label 1 among each vector's ``k`` nearest labelled ones.

    Vectors without a positive similarity get the share in the sample. The blocked product is exact;
    of neighbours that tie for the last place those with the smallest ids are taken.
    """
    k = min(k, len(model.labels))
    out = np.full(len(vectors), model.labels.mean())
    for low in range(0, len(vectors), BLOCK):
        likeness = vectors[low : low + BLOCK] @ model.vectors.T
        near = np.argpartition(-likeness, k - 1, axis=1)[:, :k]
        last = np.take_along_axis(likeness, near, axis=1).min(axis=1)
        for i in np.flatnonzero((likeness >= last[:, None]).sum(axis=1) > k):
            among = np.flatnonzero(likeness[i] >= last[i])
            near[i] = among[np.argsort(-likeness[i, among], kind="stable")[:k]]
        weight = np.maximum(np.take_along_axis(likeness, near, axis=1), 0).astype(np.float64)
        total = weight.sum(axis=1)
        some = total > 1e-9
        out[low : low + BLOCK][some] = (weight * model.labels[near]).sum(axis=1)[some] / total[some]
    return np.clip(out, 0, 1)


def scored(docs: DataFrame, model: Model | None, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``, in place of one of that name, from column ``text``.

    Null texts count as empty; texts without words get the share of label 1 in the sample,
    and all texts 0.5 if there was nothing to learn from.
    """
    docs = docs.drop(name)
    if model is None:
        return docs.withColumn(name, F.lit(0.5))
    at = docs.columns.index("text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(at)
            found = [
                votes(sent.value, _projected(text.slice(low, high - low), sent.value.idf, sent.value.basis))
                for low, high in tokens.slices(text, PIECE)
            ]
            values = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def learnt(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model of this corpus, from labels outside the hold-out."""
    return fit(docs, labelled_sample(docs, labels, "quality", remainder("doc_id", 3) != 1, SAMPLE))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; see :func:`scored`.

    Rows without an id are scored as all others and not held out.
    """
    rows = scored(docs.select("doc_id", "text"), learnt(docs, labels))
    return rows.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def of_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` whose score is 0.5 or more."""
    name = "_".join(["score", *docs.columns])
    return scored(docs, learnt(docs, labels), name).where(F.col(f"`{name}`") >= 0.5).drop(name)


@query("op8_quality")
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality, learnt from the labels outside the hold-out."""
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))
