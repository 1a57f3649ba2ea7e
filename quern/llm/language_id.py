"""Language identification with error-correcting output codes.

Every learned language has a codeword of +1 and -1. One linear classifier per bit reads hashed
byte n-grams of the whole text (lengths 2 and 3, ASCII letters in lower case, other ASCII
as a space). Each classifier's loss weighs by how well it did on rows kept from its fit; the
codeword with the least weighted loss wins. A text is ambiguous when the runner-up is nearly
as close. A text that is null or has no letter is ``und`` with score 0.

The classifiers are fitted on the ``per_language`` labelled rows of each language whose ids have
the least hashes; that bound is the only one, and every labelled language has rows. Without labelled rows
every text is ``und``.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern.llm.common import plain, prepare, text_slices
from quern.llm.words import raw

BINS = 4096
UNDETERMINED = "und"


def codewords(languages: int, seed: int = 7) -> np.ndarray:
    """One row per language: every split of few languages, else random columns far apart."""
    if languages <= 1:
        return np.ones((languages, 0))
    if languages <= 6:
        columns = [(1, *rest) for rest in product((1, -1), repeat=languages - 1)][1:]
        return np.array(columns, float).T
    bits = 12 * int(np.ceil(np.log2(languages)))
    random, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = random.choice([-1.0, 1.0], (languages, bits))
        least = int(((bits - code @ code.T) / 2 + bits * np.eye(languages)).min())
        if least > apart and (np.abs(code.sum(0)) < languages).all():
            best, apart = code, least
    return best if best is not None else code


def _letters_only() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for b in range(128):
        c = chr(b)
        table[b] = ord(c.lower()) if c.isalpha() else 0x20
    return table


_PLAIN = _letters_only()


def features(column: pa.Array) -> np.ndarray:
    """Unit vectors of n-gram counts under a square root, one row per text."""
    parts = []
    for a, b in text_slices(column):
        data, offsets = raw(column.slice(a, b - a))
        rows = b - a
        count = np.zeros(rows * BINS)
        if len(data) >= 2:
            x = _PLAIN[data]
            text = np.repeat(np.arange(rows), np.diff(offsets)) * BINS
            two = x[:-1] * np.uint32(0x9E3779B1) + x[1:] * np.uint32(0x85EBCA6B)
            same = text[:-1] == text[1:]
            count += np.bincount((text[:-1] + (two >> np.uint32(20)))[same], minlength=rows * BINS)
            if len(data) >= 3:
                three = (two[:-1] ^ (x[2:] * np.uint32(0xC2B2AE35))) * np.uint32(0x27D4EB2F)
                same = text[:-2] == text[2:]
                count += np.bincount((text[:-2] + (three >> np.uint32(20)))[same], minlength=rows * BINS)
        made = np.sqrt(count.reshape(rows, BINS).astype(np.float32))
        parts.append(made / np.maximum(np.sqrt((made * made).sum(1, keepdims=True)), 1e-9))
    return np.concatenate(parts) if parts else np.zeros((0, BINS), np.float32)


class Model:
    """The fitted bits; all arrays, so that it travels with the tasks."""

    def __init__(self, languages: list[str], weights: np.ndarray, scale: np.ndarray, trust: np.ndarray):
        self.languages, self.weights, self.scale, self.trust = languages, weights, scale, trust
        self.code = codewords(len(languages))

    @classmethod
    def fit(cls, x: np.ndarray, labels: list[str], ridge: float = 0.03) -> Model:
        languages = sorted(set(labels))
        code = codewords(len(languages))
        bits = code.shape[1]
        if not bits:
            return cls(languages, np.zeros((BINS + 1, 0), np.float32), np.zeros(0), np.zeros(0))
        place = {language: i for i, language in enumerate(languages)}
        target = code[[place[language] for language in labels]]
        x = np.concatenate([x, np.ones((len(x), 1), np.float32)], 1).astype(float)
        # Languages count alike however many rows each has.
        count = np.bincount([place[language] for language in labels], minlength=len(languages))
        share = np.sqrt(len(labels) / len(languages) / count)[[place[language] for language in labels]][:, None]

        def solved(rows: np.ndarray) -> np.ndarray:
            a, b = x[rows] * share[rows], target[rows] * share[rows]
            return a.T @ np.linalg.solve(a @ a.T + ridge * np.eye(len(a)), b)

        every, kept = np.arange(len(x)), np.arange(len(x)) % 5 == 4
        scale, trust = np.full(bits, 2.0), np.ones(bits)
        if kept.any() and not kept.all():
            margin = x[kept] @ solved(every[~kept]) * target[kept]
            right = (margin > 0).mean(0)
            trust = np.clip(2 * right - 1, 0.05, 1.0)
            scale = 2.0 / np.maximum(np.median(np.abs(margin), axis=0), 0.1)
        return cls(languages, solved(every).astype(np.float32), scale, trust / trust.sum())

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the winning language, its score, and the score's lead over the next."""
        if len(self.languages) == 1:
            return np.zeros(len(x), int), np.ones(len(x)), np.ones(len(x))
        said = (x @ self.weights[:-1] + self.weights[-1]) * self.scale
        loss = np.stack([(np.logaddexp(0, -said * word) * self.trust).sum(1) for word in self.code], 1)
        # The share of a codeword: likelihoods of bits, raised to how many bits tell codewords apart.
        share = np.exp(-(loss - loss.min(1, keepdims=True)) * self.code.shape[1])
        share /= share.sum(1, keepdims=True)
        ordered = np.sort(share, 1)
        return share.argmax(1), ordered[:, -1], ordered[:, -1] - ordered[:, -2]

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, languages=np.array(self.languages), weights=self.weights, scale=self.scale, trust=self.trust)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, blob: bytes) -> Model:
        held = np.load(io.BytesIO(blob))
        return cls(held["languages"].tolist(), held["weights"], held["scale"], held["trust"])


def _reach(wanted: int, count: int, least: int) -> int:
    """A 64-bit hash at or below which about ``wanted`` of ``count`` rows lie, the one of hash ``least`` included."""
    return max(least, -(2**63) + min(2**64 - 1, (wanted << 64) // count))


def fit(labelled: DataFrame, per_language: int = 400, most_rows: int = 4_000) -> Model | None:
    """Fit on ``labelled`` (doc_id, text, lang), in one task; rows without text or label are left out."""
    prepare(labelled.sparkSession)
    rows = labelled.select(
        F.xxhash64("doc_id").alias("h"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    counted = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("least")).collect()
    count = {r["lang"]: (r["n"], r["least"]) for r in counted}
    if not count:
        return None
    each = max(1, min(per_language, most_rows // len(count)))
    # Narrowed to more than enough hashes of 64 bits, the least one at any rate, then to exactly ``each``.
    bound: Column = reduce(
        lambda rest, item: F.when(F.col("lang") == item[0], F.lit(_reach(2 * each + 40, *item[1]))).otherwise(rest),
        sorted(count.items()),
        F.lit(None).cast("long"),
    )
    order = Window.partitionBy("lang").orderBy("h", F.xxhash64("text"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, labels = [], []
        for batch in batches:
            x.append(features(batch.column(0)))
            labels += batch.column(1).to_pylist()
        if labels:
            order = np.lexsort((np.concatenate(x).sum(1), labels))  # whatever order rows arrive in
            made = Model.fit(np.concatenate(x)[order], [labels[i] for i in order])
            yield pa.RecordBatch.from_arrays([pa.array([made.to_bytes()], pa.binary())], ["model"])

    near = rows.where(F.col("h") <= bound)
    chosen = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= each).select("text", "lang")
    found = chosen.repartition(1).mapInArrow(learn, "model binary").collect()
    return Model.from_bytes(bytes(found[0]["model"])) if found else None


def identify(documents: DataFrame, model: Model | None, lead: float = 0.2) -> DataFrame:
    """All columns of ``documents`` and lang_pred, score and ambiguous, which replace any of that name.

    ``ambiguous`` holds where the best score leads the next by less than ``lead``.
    """
    prepare(documents.sparkSession)
    made = ("lang_pred", "score", "ambiguous")
    rows, names = plain(documents, *made)
    at = names.index("text")
    schema = StructType(list(rows.schema.fields))
    for name, kind in zip(made, ("string", "double", "boolean"), strict=True):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(at).cast(pa.string())
            lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in text.to_pylist()], bool)
            if model is None:
                lettered[:] = False
                best, score, gap = (np.zeros(len(batch)) for _ in range(3))
                spoken = [UNDETERMINED]
            else:
                best, score, gap = model.predict(features(text))
                spoken = model.languages
            said = [spoken[int(k)] if ok else UNDETERMINED for k, ok in zip(best, lettered, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(said, pa.string()),
                    pa.array(np.where(lettered, score, 0.0).astype(float)),
                    pa.array(lettered & (gap < lead)),
                ],
                [*batch.schema.names, *made],
            )

    return rows.mapInArrow(run, schema).toDF(*names, *made)
