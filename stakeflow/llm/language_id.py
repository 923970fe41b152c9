"""Operator 9: language identification by sparse multinomial logistic regression on character n-grams.

A text's features are its n-grams of one to three lower-cased characters, hashed into buckets; a bucket's value is its
share of the text's n-grams times its inverse document frequency over all learning documents. Weights are learned by
follow-the-regularised-leader with an elastic net, which leaves most of them zero, and the scores are calibrated by one
temperature on rows that the weights were not learned from.

Document frequencies are counted in Spark over every learning document. The weights are fitted on a bounded sample,
at most ``FIT_ROWS`` documents of each language, those of the smallest hash of doc_id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from stakeflow.llm.common import FIT_CHARS, map_batches, sampled_ids, table

BUCKETS = 1 << 16
FIT_ROWS = 800
UNKNOWN = "und"


def grams(text: str) -> np.ndarray:
    """The buckets of a text's n-grams; white space counts as one space."""
    chars = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "replace"), np.uint32)
    a, b, c = (chars * np.uint32(k) for k in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))
    pairs = a[:-1] ^ ((b[1:] << np.uint32(7)) | (b[1:] >> np.uint32(25)))
    both = pairs[:-1] * np.uint32(0x27D4EB2F) + c[2:]
    found = np.concatenate((chars * np.uint32(0x165667B1), pairs, both))
    return ((found ^ (found >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(16)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray  # of idf times weight, by bucket and label
    bias: np.ndarray
    temperature: float

    def probabilities(self, text: str) -> np.ndarray:
        h = grams(text)
        total = np.zeros(len(self.labels))
        for at in range(0, len(h), 1 << 16):  # long texts in parts, for the memory of the gathered rows
            total += self.table[h[at : at + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return softmax((total / len(h) + self.bias) / self.temperature)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, str]], idf: np.ndarray, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.002, l2: float = 0.02, epochs: int = 4) -> Model:
    """Weights from (text, label) rows in the given order; every fifth is kept for the temperature."""
    labels = sorted({lang for _, lang in rows})
    index = {lang: i for i, lang in enumerate(labels)}
    data = []
    for text, lang in rows:
        b, n = np.unique(grams(text), return_counts=True)
        data.append((np.append(b, BUCKETS), np.append(n / n.sum() * idf[b], 1.0), index[lang]))
    learn, hold = [x for i, x in enumerate(data) if i % 5 != 4], [x for i, x in enumerate(data) if i % 5 == 4]
    z, n = np.zeros((BUCKETS + 1, len(labels))), np.zeros((BUCKETS + 1, len(labels)))

    def weights(b: np.ndarray) -> np.ndarray:
        zb = z[b]
        return -np.sign(zb) * np.maximum(np.abs(zb) - l1, 0) / ((beta + np.sqrt(n[b])) / alpha + l2)

    for _ in range(epochs):
        for b, x, y in learn:
            w = weights(b)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            nb = n[b]
            z[b] += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / alpha * w
            n[b] = nb + g * g
    w = weights(np.arange(BUCKETS + 1))
    scores, truth = [x @ w[b] for b, x, _ in hold], [y for *_, y in hold]
    temperature = 1.0
    if scores:
        s, t = np.array(scores), np.array(truth)
        loss = lambda k: -np.log(softmax(s / k)[np.arange(len(t)), t] + 1e-12).mean() + 1e-3 * np.log(k) ** 2
        temperature = float(min(np.exp(np.linspace(-4, 3, 141)), key=loss))
    return Model(labels, np.ascontiguousarray(w[:-1] * idf[:, None], np.float32), w[-1], temperature)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Of all rows of ``docs`` (text): how many there are, and how many have each bucket. One vector a task is summed."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches):
        n, count = 0, np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += 1
                mark = np.zeros(BUCKETS, bool)
                mark[grams(text or "")] = True
                count += mark
        if n:
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(some, BUCKETS), pa.int32()), pa.array(np.append(count[some], n), pa.int64())], schema=schema)

    rows = docs.select("text").mapInArrow(run, from_arrow_schema(schema)).groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS + 1, np.int64)
    out[rows["bucket"]] = rows["n"]
    return int(out[BUCKETS]), out[:BUCKETS]


def learn(docs: DataFrame, rows_per_label: int = FIT_ROWS) -> Model | None:
    """A model from ``docs`` (doc_id, text, lang); rows of null lang or no letter teach nothing, and those of
    more than ``FIT_CHARS`` characters or of a null doc_id count for document frequencies only. None without rows."""
    known = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    n, df = document_frequencies(known)
    if not n:
        return None
    ids = sorted({(i,) for _, *some in sampled_ids(docs, "lang", rows_per_label).values() for i in some})
    chosen = F.broadcast(docs.sparkSession.createDataFrame(ids, "doc_id long"))
    sample = known.where(F.char_length("text") <= FIT_CHARS).join(chosen, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id", "text").select("text", "lang").collect()
    return fit([(r.text, r.lang) for r in sample], np.log((1 + n) / (1 + df)) + 1.0) if sample else None


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score for each row of ``docs`` (doc_id, text).

    A null text, one without a letter, and any text where nothing could be learned is ``und`` with score 0; of languages
    of equal score the first by name is taken. Repeated rows give repeated rows, an empty table none; columns but doc_id
    and text are not read, and whole texts are, whatever their length.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(cols: dict[str, list]) -> dict[str, list]:
        m, langs, scores = sent.value, [], []
        for text in cols["text"]:
            if m is None or not has_letter(text):
                langs.append(UNKNOWN)
                scores.append(0.0)
            else:
                p = m.probabilities(text)
                langs.append(m.labels[int(p.argmax())])
                scores.append(float(p.max()))
        return {"doc_id": cols["doc_id"], "lang_pred": langs, "score": scores}

    return map_batches(docs.select("doc_id", "text"), run, schema)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 4, 2)
    found = identify(docs, learn(docs.where(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")
