"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

N-grams of one to four characters (letters, with every other run of characters as one blank) are
hashed into buckets. Document frequencies come from every training document; the weights are fitted on
a bounded, hash-chosen sample with follow-the-regularised-leader (FTRL-proximal) steps under an elastic
net, and a temperature is calibrated on a part of the sample that the weights never saw. Predictions
read whole texts.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.workers import tidy

BUCKET_BITS = 16
LONGEST = 4
#: Labelled rows per language that the weights and the temperature may be fitted on.
SAMPLE_PER_LANGUAGE = 1000
EPOCHS = 4
#: FTRL step size, its offset, and the elastic net.
ALPHA, BETA, L1, L2 = 2.0, 0.5, 0.002, 0.0005
UNDETERMINED = "und"
_SCALE = 30.0


@cache
def _letters() -> np.ndarray:
    """Per code point, whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)


def buckets(text: str | None) -> np.ndarray:
    """The bucket of every n-gram of a text, repeats included; empty if it has no letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, dtype=np.int64)
    # blanks only where a run of other characters begins, and one at both ends
    codes, letter = codes.copy(), letter.copy()
    codes[~letter] = 32
    keep = letter | np.concatenate(([False], letter[:-1]))
    codes = np.concatenate((_BLANK, codes[keep], _BLANK)) * np.uint32(0x9E3779B1)
    found, gram = [], np.zeros(len(codes), dtype=np.uint32)
    for size in range(1, LONGEST + 1):
        if size > len(codes):
            break
        gram = (gram[: len(codes) - size + 1] * np.uint32(0x85EBCA6B)) ^ codes[size - 1 :]
        mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(0xC2B2AE35 + 2 * size)
        found.append(mixed >> np.uint32(32 - BUCKET_BITS))
    return np.concatenate(found).astype(np.int64)


_BLANK = np.array([32], dtype=np.uint32)


@dataclass
class Model:
    """Weights per bucket and language (with the inverse document frequency in them), and the temperature."""

    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        found = buckets(text)
        if not len(found) or not self.languages:
            return UNDETERMINED, 0.0
        # the TF-IDF row is normalised by its sum, so scores are weighted means over the n-grams
        logits = _SCALE * self.weights[found].sum(axis=0) / self.idf[found].sum() + self.bias
        shares = _softmax(logits / self.temperature)
        best = int(np.argmax(shares))
        return self.languages[best], float(shares[best])


def _softmax(logits: np.ndarray) -> np.ndarray:
    shares = np.exp(logits - logits.max())
    return shares / shares.sum()


def _document_frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """In how many of ``docs`` each bucket occurs, and how many have a letter. Counted per task, then summed."""
    size = 1 << BUCKET_BITS

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size + 1, dtype=np.int64)
        for part in parts:
            for value in part.column(0).to_pylist():
                found = buckets(value)
                if len(found):
                    here = np.zeros(size + 1, dtype=bool)
                    here[found] = here[size] = True
                    counts += here
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    rows = docs.select(text).mapInArrow(tidy(batches), "bucket long, n long").groupBy("bucket").agg(F.sum("n")).toPandas()
    totals = np.zeros(size + 1, dtype=np.int64)  # one number per bucket, whatever the table's size
    totals[rows.iloc[:, 0].to_numpy(dtype=np.int64)] = rows.iloc[:, 1].to_numpy(dtype=np.int64)
    return totals[:size], int(totals[size])


def _sample(docs: DataFrame, text: str, label: str, per_language: int) -> DataFrame:
    """About ``per_language`` different texts of each label, chosen by a hash; never more than that times the labels.

    Copies of a text under one label count once, so neither can they crowd out a language nor be its only chance.
    """
    rows = docs.select(F.col(text).alias("_text"), F.col(label).alias("_label"), F.xxhash64(text).alias("_hash"))
    counts = rows.select("_label", "_hash").distinct().groupBy("_label").count().collect()  # one row per language
    share = F.lit(1 << 30)
    for language, count in ((row[0], row["count"]) for row in counts):
        share = F.when(F.col("_label") == language, F.lit(math.ceil((1 << 30) * min(1.0, per_language / count)))).otherwise(share)
    picked = rows.where(F.col("_hash").bitwiseAND(F.lit((1 << 30) - 1)) < share)
    once = picked.groupBy("_label", "_hash").agg(F.first("_text").alias("_text"))
    return once.orderBy(F.xxhash64("_hash", F.lit(7)), "_label").limit(per_language * max(1, len(counts)))


def train(docs: DataFrame, text: str = "text", label: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on the rows of ``docs`` whose ``label`` is not null. Without labels or letters the model knows no language.

    Repeated rows count in the document frequencies, but a text is at most once per label among the rows fitted on.
    """
    labelled = docs.where(F.col(label).isNotNull())
    frequencies, total = _document_frequencies(docs, text)
    idf = np.log((1 + total) / (1 + frequencies)) + 1

    def fit(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[np.ndarray, np.ndarray, str]] = []
        for part in parts:
            for value, language in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                found, times = np.unique(buckets(value), return_counts=True)
                if len(found):
                    tfidf = times * idf[found]
                    rows.append((found, _SCALE * tfidf / tfidf.sum(), language))
        if rows:
            yield _packed(*_fit(rows, len(idf)))

    sample = _sample(labelled, text, label, per_language).select("_text", "_label").coalesce(1)
    found = sample.mapInArrow(tidy(fit), "languages array<string>, weights binary, bias array<double>, temperature double").first()
    if found is None:
        return Model([], idf, np.zeros((len(idf), 0), dtype=np.float32), np.zeros(0), 1.0)
    weights = np.frombuffer(bytes(found.weights), dtype=np.float32).reshape(len(idf), -1)
    return Model(list(found.languages), idf, (weights * idf[:, None]).astype(np.float32), np.array(found.bias), found.temperature)


def _packed(languages: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "languages": pa.array([languages]), "weights": pa.array([weights.astype(np.float32).tobytes()], pa.binary()),
        "bias": pa.array([bias.tolist()]), "temperature": pa.array([temperature]),
    })


def _fit(rows: list[tuple[np.ndarray, np.ndarray, str]], size: int) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """FTRL-proximal over the rows; every fifth row is kept for the temperature."""
    languages = sorted({row[2] for row in rows})
    number = {language: at for at, language in enumerate(languages)}
    kept, used = rows[::5] if len(rows) >= 5 else [], [r for at, r in enumerate(rows) if at % 5] or rows
    # the last bucket is the bias
    gathered, squares = np.zeros((size + 1, len(languages))), np.zeros((size + 1, len(languages)))

    def weights_at(at: np.ndarray | slice) -> np.ndarray:
        z, n = gathered[at], squares[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for at in order.permutation(len(used)).tolist():
            found, values, language = used[at]
            found, values = np.append(found, size), np.append(values, 1.0)
            current = weights_at(found)
            error = _softmax(values @ current)
            error[number[language]] -= 1
            step = values[:, None] * error
            grown = squares[found] + step**2
            gathered[found] += step - (np.sqrt(grown) - np.sqrt(squares[found])) / ALPHA * current
            squares[found] = grown
    weights = weights_at(slice(None))
    logits = np.array([values @ weights[found] + weights[size] for found, values, _ in kept]).reshape(-1, len(languages))
    truth = np.array([number[language] for *_, language in kept], dtype=int)
    return languages, weights[:size], weights[size], _temperature(logits, truth)


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature of the smallest mean log loss; 1 without rows. It is kept within 1/8 and 8."""
    if not len(logits):
        return 1.0
    choices = np.exp(np.linspace(math.log(1 / 8), math.log(8), 97))

    def loss(temperature: float) -> float:
        scaled = logits / temperature
        scaled = scaled - scaled.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(scaled).sum(axis=1)) - scaled[np.arange(len(truth)), truth]))

    return float(min(choices, key=loss))


def predict(docs: DataFrame, model: Model, text: str = "text", language: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its probability; columns of these names are replaced.

    Texts that are null or have no letter give ``und`` with score 0. Only the text is an input.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages numbers

    def batches(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for texts in parts:
            yield pd.DataFrame([known.predict(value) for value in texts], columns=["language", "score"])

    @F.pandas_udf("language string, score double")
    def judged(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from tidy(batches)(parts)

    kept = [c for c in docs.columns if c not in (language, score)]
    return docs.select(*kept, judged(F.col(text)).alias("_judged")).select(
        *kept, F.col("_judged.language").alias(language), F.col("_judged.score").alias(score)
    )


def held_out(id: str = "doc_id") -> Column:
    """Whether a row is left out of the training: crc32 of the id as text is 2 modulo 4. False without an id."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
