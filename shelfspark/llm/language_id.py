"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams (1 to 3 characters of the lower-cased text, white space as one space) of the whole text:
(1 + log count) * idf, scaled to length 1.  The document frequencies behind idf come from all documents that may be
learned from.  The weights are fitted by follow-the-regularised-leader (FTRL-proximal) with elastic-net penalties on a
bounded sample, then one temperature is calibrated on a part of the sample that the weights have not seen.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; with no labelled document everything is
``und``; with one label that label gets every text; repeated rows are scored alike; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import only, ship

DIM = 1 << 16
ORDERS = (1, 2, 3)
#: Labelled rows that the weights and the temperature are fitted on, at most.
SAMPLE_ROWS = 2000
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 0.02, 0.5
CHUNK = 1 << 20
#: Rows of every language that the sample holds at least, where there are as many.
LABEL_ROWS = 50


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # DIM x languages
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        return value @ self.weights[index] + self.bias


def counts(text: str) -> np.ndarray:
    """How often each hashed n-gram occurs in the whole text; long texts go by in chunks that overlap."""
    clean = " ".join(text.lower().split())
    total = np.zeros(DIM, np.int64)
    keep = max(ORDERS) - 1
    for start in range(0, len(clean), CHUNK):
        chunk = clean[max(0, start - keep) : start + CHUNK]
        new = min(start, keep)  # characters of the chunk before
        code = np.frombuffer(chunk.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        for n in ORDERS:
            first = max(0, new - n + 1)
            if len(code) - first < n:
                continue
            h = np.full(len(code) - first - n + 1, n, np.uint64)
            for k in range(n):
                h = (h ^ code[first + k : first + k + len(h)]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            total += np.bincount((h & np.uint64(DIM - 1)).astype(np.int64), minlength=DIM)
    return total


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    c = counts(text)
    index = np.flatnonzero(c)
    value = (1 + np.log(c[index])) * idf[index]
    norm = np.sqrt(value @ value)
    return index, value / norm if norm else value


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """For every feature the number of texts that have it, and the number of texts: DIM + 1 rows reach the driver."""
    schema = "feature int, n long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(DIM + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                seen[:DIM] += counts(text.as_py()) > 0
                seen[DIM] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["feature", "n"])

    out = np.zeros(DIM + 1, np.int64)
    for feature, n in docs.mapInArrow(count, schema).groupBy("feature").agg(F.sum("n")).collect():
        out[feature] = n
    return out[:DIM], int(out[DIM])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], k: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights (DIM + 1, k) by per-coordinate FTRL-proximal steps, the last row being the bias."""
    z, n = np.zeros((DIM + 1, k)), np.zeros((DIM + 1, k))

    def weights(at) -> np.ndarray:
        rate = (BETA + np.sqrt(n[at])) / ALPHA + L2
        return np.where(np.abs(z[at]) > L1, -(z[at] - np.sign(z[at]) * L1) / rate, 0.0)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            index, value, label = rows[r]
            at, x = np.append(index, DIM), np.append(value, 1.0)
            w = weights(at)
            p = softmax(x @ w)
            p[label] -= 1
            g = np.outer(x, p)
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(slice(None))
    return w[:DIM], w[DIM]


def calibrate(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on logits ``z`` and labels ``y``."""
    grid = np.exp(np.linspace(np.log(0.05), np.log(5), 60))
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS, label_rows: int = LABEL_ROWS) -> list:
    """At most ``rows`` (text, lang) rows, chosen by a hash of the id and the text's checksum.  A language of which these
    hold fewer than ``label_rows`` comes with its first ``label_rows`` rows by that hash instead, so that the languages
    learned are those of all rows, however rare; this adds at most ``label_rows`` rows a language."""
    keyed = docs.withColumn("h", F.xxhash64(F.crc32(F.col("text").cast("binary")), "id"))
    least = keyed.select("h").orderBy("h").limit(rows).agg(F.max("h")).first()[0]
    if least is None:
        return []
    found = keyed.where(F.col("h") <= least).select("text", "lang").limit(rows).collect()
    held = Counter(r["lang"] for r in found)
    every = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    short = [r["lang"] for r in every if held[r["lang"]] < min(label_rows, r["n"])]
    if not short:
        return found
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    few = keyed.where(F.col("lang").isin(short)).withColumn("place", place).where(F.col("place") <= label_rows)
    return [r for r in found if r["lang"] not in short] + few.select("text", "lang").collect()


def train(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on (id, text, lang) rows; texts without letters and null labels are left out."""
    docs = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    df, n = document_frequencies(docs.select("text"))
    data = sorted(tuple(r) for r in sample(docs, rows))
    languages = sorted({lang for _, lang in data})
    if not languages:
        return None
    idf = np.log((1 + n) / (1 + df)) + 1
    made = [(*vector(text, idf), languages.index(lang)) for text, lang in data]
    apart = [r for i, r in enumerate(made) if i % 5 == 0]
    kept = [r for i, r in enumerate(made) if i % 5]
    learned = {y for *_, y in kept}
    kept += [r for r in apart if r[-1] not in learned]
    w, b = ftrl(kept, len(languages))
    model = Model(languages, idf, w, b)
    model.temperature = calibrate(np.array([model.logits(i, v) for i, v, _ in apart]), np.array([y for *_, y in apart]))
    return model


def identify(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             rows: int = SAMPLE_ROWS) -> DataFrame:
    """id, lang_pred, score for every row; ``learn_from`` (over ``id``) says which rows may be learned from."""
    src = only(docs, id_col, text_col, lang_col).toDF("id", "text", "lang")
    ship(src.sparkSession)
    # vocabulary and weights have a fixed size: DIM features by the languages of the sample
    sent = src.sparkSession.sparkContext.broadcast(train(src.where(learn_from), rows))
    schema = T.StructType([
        T.StructField(id_col, src.schema["id"].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    ])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            names, scores = [], []
            for text in batch.column(1):
                t = text.as_py()
                if m is None or not has_letter(t):
                    names.append("und")
                    scores.append(0.0)
                    continue
                p = softmax(m.logits(*vector(t, m.idf)) / m.temperature)
                best = int(np.argmax(p))
                names.append(m.languages[best])
                scores.append(float(min(1.0, p[best])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return src.select("id", "text").mapInArrow(predict, schema)
