"""Toxicity by a character n-gram linear classifier over naive Bayes features.

Features are the letter n-grams (n from 4 to 6) that a text has, in hashed slots. Each is scaled by its naive Bayes
log-count ratio between the classes (0 where that is within twice its standard error), and a logistic regression
over the scaled features gives the score. Orders and ridge were chosen on the labelled rows outside the
held-out fold, one half against the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common

BITS, ORDERS = 20, range(4, 7)
#: Bounds of the sample that the model is fitted on: labelled doc_ids of each class (about; chosen by a hash of doc_id,
#: however long their texts), and distinct n-grams of all their texts: 96 MB. Texts are taken in the order of a hash
#: until those are used up.
PER_CLASS, SAMPLE_SLOTS = 2500, 24_000_000
ALPHA, RIDGE, ROUNDS, LEAST_DOCS, LEAST_Z = 1.0, 10.0, 80, 3, 2.0
TOXIC = 0.7
#: Slots that one step of the fit looks at together; they bound its memory, not its result.
PART_SLOTS = 1 << 20


def _slots(text: str, seen: np.ndarray) -> np.ndarray:
    """The slots of a text, each once. seen: all False, and again afterwards."""
    s = common.gram_slots(common.letter_runs(text), ORDERS, BITS)
    seen[s] = True
    out = np.flatnonzero(seen)
    seen[s] = False
    return out


def _parts(rows: list[bytes], place: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of rows with the places of their slots, one after another, and the row (from the range's start) of each.
    place: of each slot, -1 for those that don't tell."""
    at, own, held = 0, [], 0
    for k, row in enumerate(rows, 1):
        s = place[common.unpacked(row)]
        own.append(s[s >= 0])
        held += len(own[-1])
        if held >= PART_SLOTS or k == len(rows):
            yield at, k, np.concatenate(own), np.repeat(np.arange(k - at, dtype=np.int32), [len(s) for s in own])
            at, own, held = k, [], 0


@dataclass
class ToxicityModel:
    weights: np.ndarray  # by slot
    bias: float

    @classmethod
    def fit(cls, texts: list[str], toxic: list[int]) -> ToxicityModel:
        seen = np.zeros(1 << BITS, bool)
        return cls.fit_slots([common.packed(_slots(t, seen), BITS) for t in texts], toxic)

    @classmethod
    def fit_slots(cls, rows: list[bytes], toxic: list[int]) -> ToxicityModel:
        """Fits on packed slots. Rows are unpacked one at a time, and only the slots that tell the classes apart are kept.

        Without rows of both classes: a model that says the share of toxic rows (or 0) of every text.
        """
        y = np.array(toxic, np.float64)
        size = 1 << BITS
        if not len(y) or y.min() == y.max():
            return cls(np.zeros(size, np.float32), 9.0 if len(y) and y[0] else -9.0)
        docs = np.zeros((2, size), np.int32)
        for row, t in zip(rows, toxic, strict=True):
            docs[int(t), common.unpacked(row)] += 1
        slots = np.flatnonzero(docs[0] + docs[1] >= LEAST_DOCS)
        p, q = docs[1, slots] + ALPHA, docs[0, slots] + ALPHA
        ratio = np.log(p / (y.sum() + 2 * ALPHA)) - np.log(q / ((1 - y).sum() + 2 * ALPHA))
        # n-grams whose ratio is within the noise of their counts tell nothing, and there are very many of them
        told = np.abs(ratio) >= LEAST_Z * np.sqrt(1 / p + 1 / q)
        slots, ratio = slots[told], ratio[told]
        del docs, p, q, told
        place, n = np.full(size, -1, np.int32), len(slots)
        place[slots] = np.arange(n, dtype=np.int32)
        parts = list(_parts(rows, place))
        weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())  # the classes weigh the same
        w, b, m, v = np.zeros(n), 0.0, np.zeros(n + 1), np.zeros(n + 1)
        for t in range(1, ROUNDS + 1):  # Adam on all rows
            scaled, pull, total = ratio * w, np.zeros(n), 0.0
            for at, to, flat, doc in parts:
                z = np.bincount(doc, weights=scaled[flat], minlength=to - at) + b
                g = weight[at:to] * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[at:to])
                pull += np.bincount(flat, weights=g[doc], minlength=n)
                total += g.sum()
            grad = np.append(ratio * pull + RIDGE * w / len(y), total)
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            step = 0.03 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
            w -= step[:-1]
            b -= step[-1]
        weights = np.zeros(size, np.float32)
        weights[slots] = w * ratio
        return cls(weights, float(b))

    def score(self, texts: list[str]) -> np.ndarray:
        told = self.weights != 0
        own = (common.gram_slots(common.letter_runs(t), ORDERS, BITS) for t in texts)
        z = np.array([self.weights[np.unique(s[told[s]])].sum(dtype=np.float64) for s in own]) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of a bounded sample, on an executor: the weights that are not 0, and their slots."""
    toxic, rows = [], []
    for batch in batches:
        toxic += batch.column(0).to_pylist()
        rows += batch.column(1).to_pylist()
    model = ToxicityModel.fit_slots(rows, toxic)
    slots = np.flatnonzero(model.weights)
    yield pa.RecordBatch.from_arrays([pa.array([slots.astype("<i4").tobytes()], pa.binary()), pa.array([model.weights[slots].astype("<f4").tobytes()], pa.binary()), pa.array([model.bias])], names=["slots", "weights", "bias"])


def drawn(docs: DataFrame, labels: DataFrame, held_out_fold: int | None = 1, folds: int = 3) -> DataFrame:
    """(dice, doc_id, toxic, slots): the bounded sample of labels(doc_id, toxic) with their docs(doc_id, text), outside the held-out fold.

    A doc_id with several labels counts as toxic if one of them says so; labels without a doc_id or a 0 or 1 are left
    out. Of several texts of one doc_id that of the least hash is taken.
    """
    marks = common.slim(labels, "doc_id", "toxic").where("toxic in (0, 1) and doc_id is not null")
    if held_out_fold is not None:
        marks = marks.where(common.fold("doc_id", folds) != held_out_fold)
    dice = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    wanted = F.lit(False)
    for r in marks.groupBy("toxic").count().collect():
        wanted |= (F.col("toxic") == r["toxic"]) & (dice < int(min(1.0, PER_CLASS / r["count"]) * (1 << 30)))
    # at most about 2 * PER_CLASS rows of two numbers each
    chosen = marks.where(wanted).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = common.slim(docs, "doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    slots = common.packed_slots(texts.select("doc_id", "toxic", F.xxhash64("text").alias("h"), "text"), "text", ORDERS, BITS)
    each = slots.groupBy("doc_id").agg(F.min_by(F.struct("toxic", "slots", "n_slots"), "h").alias("x")).select(F.xxhash64("doc_id").alias("dice"), "doc_id", "x.*")
    sample = common.materialise(each, "labelled")
    total, last = 0, None
    for r in sorted(sample.select("dice", "n_slots").collect(), key=lambda r: r["dice"]):
        total += r["n_slots"]
        if total > SAMPLE_SLOTS:
            break
        last = r["dice"]
    return sample.where(F.col("dice") <= F.lit(last) if last is not None else F.lit(False)).select("dice", "doc_id", "toxic", "slots")


def learn(docs: DataFrame, labels: DataFrame, held_out_fold: int | None = 1, folds: int = 3) -> ToxicityModel:
    """Fits, in one task, on the rows that drawn gives. No row: a model that knows nothing."""
    # in order of the hash, whatever files the rows were in, so that sums are the same in each run
    rows = drawn(docs, labels, held_out_fold, folds).repartition(1).sortWithinPartitions("dice", "doc_id").select("toxic", "slots")
    fitted = common.materialise(common.slim_batches(rows).mapInArrow(common.trimmed(_fit), "slots binary, weights binary, bias double"), "weights").first()
    if fitted is None:
        return ToxicityModel.fit_slots([], [])
    weights = np.zeros(1 << BITS, np.float32)
    weights[np.frombuffer(fitted["slots"], "<i4")] = np.frombuffer(fitted["weights"], "<f4")
    return ToxicityModel(weights, fitted["bias"])


def score(docs: DataFrame, model: ToxicityModel, toxic_from: float = TOXIC, out: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs with score and predicted, or columns of other names. Null text counts as empty, and empty texts get the bias alone.

    Only the text is looked at. Repeated rows, null ids and other columns stay; a column of docs that has one of the
    two names is replaced, and common.unused gives names that it lacks. An empty table gives an empty one. Nothing is shuffled.
    """
    docs = docs.drop(*out)
    kept, schema = docs.columns, docs.select("*").schema.add(out[0], "double").add(out[1], "integer")
    at = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = common.whole(batch.column(at))
            for a, b in common.blocks(texts):
                s = model.score(texts.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.array(s), pa.array((s >= toxic_from).astype(np.int32))], names=[*kept, *out])

    return common.slim_batches(docs).mapInArrow(common.trimmed(run), schema)
