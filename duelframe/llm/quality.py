"""Quality classifier: averaged word and subword embeddings with a softmax, trained by stochastic gradient descent."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from duelframe.llm.text import BLOCK_BYTES, blocks, run_hashes, spaces, utf8, word_runs


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled rows that a fit reads; everything else covers all rows."""

    sample_rows: int = 4000
    bits: int = 16
    dim: int = 8
    ngrams: tuple[int, ...] = (3, 4)
    epochs: int = 10
    rate: float = 1.0
    seed: int = 7


@dataclass(frozen=True)
class QualityModel:
    """The log odds that each hashed feature adds to a document's average, and the constant.

    Averaging and the output layer are both linear, so a document's log odds are the average over its features of
    embedding times weight difference: one number per bucket is the whole model when scoring.
    """

    odds: np.ndarray
    constant: float
    settings: Settings


def buckets(data: np.ndarray, settings: Settings, firsts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and buckets of all features of a byte block: words, word pairs by shape, and character n-grams.

    A pair's shape is whether the word stands twice in a row; texts that begin at ``firsts`` share no pair.
    Character n-grams may touch a word's borders and hold no white space inside.
    """
    shift = np.uint64(64 - settings.bits)
    space = spaces(data)
    starts, ends = word_runs(space)
    words = run_hashes(data, starts, ends)
    again, second = words[1:] == words[:-1], starts[1:]
    if firsts is not None:
        own = np.searchsorted(firsts, starts, "right")
        together = own[1:] == own[:-1]
        again, second = again[together], second[together]
    where, found = [starts, second], [words >> shift, again.astype(np.uint64)]
    for n in settings.ngrams:
        if len(data) < n:
            continue
        m = len(data) - n + 1
        code = np.zeros(m, np.uint64)
        inside = np.ones(m, bool)
        for k in range(n):
            code = code << np.uint64(8) | data[k : k + m]
            if 0 < k < n - 1:
                inside &= ~space[k : k + m]
        at = np.flatnonzero(inside)
        where.append(at)
        found.append((code[at] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> shift)
    return np.concatenate(where), np.concatenate(found).astype(np.int64)


def _parts(text: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A text in pieces that meet at a shared white space byte, so that no word or n-gram is lost or doubled.

    Only the word pair at each cut is left out.
    """
    i = 0
    while len(text) - i > limit:
        at = np.flatnonzero(spaces(text[i + 1 : i + limit]))
        cut = i + 1 + int(at[-1]) if len(at) else i + limit
        yield text[i : cut + 1]
        i = cut
    yield text[i:]


def _padded(text: np.ndarray) -> np.ndarray:
    return np.concatenate(([np.uint8(10)], text, [np.uint8(10)]))


def scores(column: pa.Array, model: QualityModel) -> np.ndarray:
    """The probability of label 1 for each text of an Arrow string column; whole texts, in bounded blocks."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    total, count = np.zeros(n), np.zeros(n)
    for i, j in blocks(offsets, BLOCK_BYTES):
        if j == i + 1 and offsets[j] - offsets[i] > BLOCK_BYTES:
            for part in _parts(_padded(data[offsets[i] : offsets[j]]), BLOCK_BYTES):
                _, found = buckets(part, model.settings)
                total[i] += model.odds[found].sum()
                count[i] += len(found)
            continue
        # a line feed around each text: words and n-grams end there
        size = np.diff(offsets[i : j + 1])
        block = np.full(int(size.sum()) + (j - i) + 1, 10, np.uint8)
        at = np.arange(offsets[j] - offsets[i]) + np.repeat(np.arange(1, j - i + 1), size)
        block[at] = data[offsets[i] : offsets[j]]
        first = offsets[i : j + 1] - offsets[i] + np.arange(j - i + 1)
        where, found = buckets(block, model.settings, first)
        own = np.searchsorted(first, where, "right") - 1
        inside = own < j - i
        total[i:j] = np.bincount(own[inside], model.odds[found[inside]], j - i)
        count[i:j] = np.bincount(own[inside], minlength=j - i)
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + model.constant, -30, 30)))


def train(texts: list[str], labels: np.ndarray, settings: Settings) -> QualityModel:
    """Stochastic gradient descent over the documents in a seeded random order, with a falling rate."""
    rng = np.random.default_rng(settings.seed)
    size = 1 << settings.bits
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return QualityModel(np.zeros(size, np.float32), float(np.log(share / (1 - share))) if len(labels) else 0.0, settings)
    rows = []
    for text in texts:
        raw = _padded(np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8))
        found = np.concatenate([buckets(part, settings)[1] for part in _parts(raw, BLOCK_BYTES)])
        index, n = np.unique(found, return_counts=True)
        rows.append((index.astype(np.int32), (n / max(len(found), 1)).astype(np.float32)))
    vectors = rng.uniform(-1 / settings.dim, 1 / settings.dim, (size, settings.dim)).astype(np.float32)
    output = np.zeros((settings.dim, 2), np.float32)
    bias = np.zeros(2, np.float32)
    steps, step = settings.epochs * len(rows), 0
    for _ in range(settings.epochs):
        for k in rng.permutation(len(rows)):
            rate = np.float32(settings.rate * (1 - step / steps))
            step += 1
            index, weight = rows[k]
            hidden = weight @ vectors[index]
            raw = hidden @ output + bias
            error = np.exp(raw - raw.max())
            error /= error.sum()
            error[labels[k]] -= 1
            back = output @ error
            # steps are divided by their input's squared length: no document can throw the weights far off
            inner = rate / ((weight @ weight) * (1 + np.sum(output * output)))
            output -= rate / (1 + hidden @ hidden) * np.outer(hidden, error)
            bias -= np.float32(0.05) * rate * error
            vectors[index] -= np.outer(inner * weight, back)
    side = output[:, 1] - output[:, 0]
    return QualityModel(vectors @ side, float(bias[1] - bias[0]), settings)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> QualityModel:
    """Fit on at most ``sample_rows`` labelled rows outside the held-out part, the first in hash order.

    Null labels, labels without a document and null ids are left out; a null text counts as empty. Repeated label
    rows count as often as they stand; a repeated document is read once. Without any label the score is 0.5
    everywhere; with one class only it is that class's smoothed share.
    """
    ids = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(settings.sample_rows)
    )
    # at most sample_rows small rows, so the broadcast is bounded
    rows = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id", "quality"])

    def once(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "quality"])
        model = train(group["text"].tolist(), group["quality"].to_numpy(), settings)
        return pd.DataFrame({"odds": [model.odds.astype(np.float32).tobytes()], "constant": [model.constant]})

    got = rows.groupBy(F.lit(0).alias("all")).applyInPandas(once, "odds binary, constant double").collect()
    if not got:
        return train([], np.zeros(0, int), settings)
    return QualityModel(np.frombuffer(got[0]["odds"], np.float32), got[0]["constant"], settings)


def score(documents: DataFrame, model: QualityModel) -> DataFrame:
    """All columns of ``documents`` but an old ``score``, with ``score``; the text of a row is its only input."""
    kept = documents.drop("score")
    schema = StructType([*kept.schema.fields, StructField("score", DoubleType(), False)])
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(scores(batch.column(batch.schema.get_field_index("text")), shared.value))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "score"])

    return kept.mapInArrow(run, schema)


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(documents, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents that the classifier does not reject, with the columns they came with."""
    model = fit(documents, labels, settings)
    marked = score(documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), "text"), model)
    return marked.where("score >= 0.5").select("row.*")
