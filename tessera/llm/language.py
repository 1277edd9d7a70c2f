"""Language identification by a string kernel.

The kernel of two texts is the number of letter n-grams (n from 1 to 4, in hashed slots) that both have, over the
root of the product of their numbers of n-grams: a blended-spectrum presence kernel. Nyström landmarks stand for the
sample, one-versus-rest ridge regression is solved in their space, and batches of texts are scored by one matrix
product: the landmarks' rows times the solved coefficients are folded into one matrix beforehand, which gives the
same scores as the kernel values would.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common

BITS, ORDERS = 16, range(1, 5)
#: Bounds of the sample that the model is fitted on: rows of each language (about; chosen by a hash over all rows, however
#: long their texts), and rows of all languages, which share them where there are many, at least LEAST rows each. A row
#: comes to the driver as its presence bits, 8 KB at most.
PER_LANG, SAMPLE_ROWS, LEAST = 300, 20_000, 8
#: Landmarks, and landmarks of each language where that is more.
LANDMARKS, PER_LANDMARK, RIDGE = 128, 2, 1e-3
UNKNOWN = "und"


def _slots(text: str) -> np.ndarray:
    return common.gram_slots(common.letter_runs(text), ORDERS, BITS)


def _presence(slots: list[np.ndarray]) -> np.ndarray:
    """Presence rows of texts, one column for each slot."""
    out = np.zeros((len(slots), 1 << BITS), np.float32)
    for row, s in zip(out, slots, strict=True):
        row[s] = 1
    return out


def _rows(runs: list[np.ndarray]) -> np.ndarray:
    return _presence([common.gram_slots(c, ORDERS, BITS) for c in runs])


def _scaled(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))


@dataclass
class LanguageModel:
    langs: list[str]
    weights: np.ndarray  # slots x languages

    @classmethod
    def fit(cls, texts: list[str], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
        return cls.fit_slots([_slots(t) for t in texts], langs, landmarks, ridge)

    @classmethod
    def fit_slots(cls, slots: list[np.ndarray], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
        """Landmarks are taken in turn from the languages, in the order of the rows. No rows: a model that knows none."""
        names = sorted(set(langs))
        if not names:
            return cls([], np.zeros((1 << BITS, 0), np.float32))
        y = (np.array(langs)[:, None] == np.array(names)).astype(np.float64)
        seen: dict[str, int] = {}
        turn = [(seen.__setitem__(a, seen.get(a, -1) + 1), seen[a])[1] for a in langs]
        chosen = np.lexsort((np.arange(len(langs)), turn))[: max(landmarks, PER_LANDMARK * len(names))]
        marks = _scaled(_presence([slots[c] for c in chosen]))
        seen = np.flatnonzero(marks.any(0))  # what no landmark has adds nothing to a product with one
        some = np.ascontiguousarray(marks[:, seen].T)
        k = np.concatenate([_scaled(_presence(slots[a : a + 64]))[:, seen] @ some for a in range(0, len(slots), 64)]).astype(np.float64)
        among = (some.T @ some).astype(np.float64)
        a = np.linalg.solve(k.T @ k + ridge * len(slots) * among + 1e-6 * np.eye(len(among)), k.T @ y)
        return cls(names, (marks.T @ a).astype(np.float32))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """A language for each text, and its share of the positive outputs. No letter, or no language known: und, 0."""
        names, scores = [], np.zeros(len(texts))
        for a in range(0, len(texts), 64):
            runs = [common.letter_runs(t) for t in texts[a : a + 64]]
            if not self.langs:
                names += [UNKNOWN] * len(runs)
                continue
            out = np.maximum(_rows(runs) @ self.weights, 0)
            best = out.argmax(1)
            share = out.max(1) / np.maximum(out.sum(1), 1e-12)
            none = np.array([len(c) < 2 for c in runs])  # a single space
            names += [UNKNOWN if n else self.langs[b] for b, n in zip(best, none, strict=True)]
            scores[a : a + len(runs)] = np.where(none, 0, np.clip(share, 0, 1))
        return names, scores


def learn(docs: DataFrame, held_out_fold: int | None = 0, folds: int = 5) -> LanguageModel:
    """Fits on a bounded sample of docs(doc_id, text, lang) with a language, outside the held-out fold; every language
    that has a text is learned. A null doc_id is in no held-out fold. The languages themselves are collected, one row each.
    """
    rows = common.slim(docs, "doc_id", "text", "lang").where("lang is not null and text <> ''")
    if held_out_fold is not None:
        rows = rows.where(F.coalesce(common.fold("doc_id", folds) != held_out_fold, F.lit(True)))
    known = rows.groupBy("lang").count().collect()
    if not known:
        return LanguageModel.fit([], [])
    each = min(PER_LANG, max(LEAST, SAMPLE_ROWS // len(known)))
    dice = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    below = F.create_map(*[F.lit(x) for r in known for x in (r["lang"], int(min(1.0, each / r["count"]) * (1 << 30)))])
    drawn = rows.select("lang", dice.alias("dice"), "text").where(F.col("dice") < F.element_at(below, F.col("lang")))
    # equal rows count once, so rows that repeat can't crowd the sample
    sample = common.packed_slots(drawn, "text", ORDERS, BITS).dropDuplicates(["lang", "dice"]).orderBy("dice", "lang").collect()
    return LanguageModel.fit_slots([common.unpacked(r["slots"]) for r in sample], [r["lang"] for r in sample])


def identify(docs: DataFrame, model: LanguageModel, out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """docs with lang_pred and score, or columns of other names. Null text, or no letter in it: und, 0.

    Only the text is looked at. Repeated rows, null ids and other columns stay; a column of docs that has one of the
    two names is replaced, and common.unused gives names that it lacks. An empty table gives an empty one. Nothing is shuffled.
    """
    docs = docs.drop(*out)
    kept, schema = docs.columns, docs.select("*").schema.add(out[0], "string").add(out[1], "double")
    at = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = common.whole(batch.column(at))
            for a, b in common.blocks(texts):
                names, scores = model.predict(texts.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.array(names, pa.string()), pa.array(scores)], names=[*kept, *out])

    return common.slim_batches(docs).mapInArrow(common.trimmed(run), schema)
