"""Operator 3: document quality by a linear-chain conditional random field over lines.

Each line is good or bad. Its features are shares of kinds of characters and words, its length, and whether it recurs
in its document, for itself and for its neighbours; a transition weight ties it to the line before. Labels are known
for documents only, so every line of a learning document is taught its document's label. Forward-backward gives each
line's marginal; their mean, weighted by line length, is the document's score.

The weights are fitted on a bounded sample: the ``FIT_ROWS`` labelled learning documents of each label with the smallest
hash of doc_id. Rows of both labels weigh as they occur among all learning rows, which Spark counts.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.llm.common import FIT_CHARS, map_batches, sampled_ids, table
from stakeflow.llm.language_id import held_out

FIT_ROWS = 1500
THRESHOLD = 0.3

#: Classes of characters: the columns of CLASS.
LETTER, UPPER, DIGIT, SPACE, STOP, SHOUT, BAR, MARKUP, OTHER = range(9)
_CODES = 0x3000


def _class(code: int) -> int:
    c = chr(code)
    if c.isalpha():
        return UPPER if c.isupper() else LETTER
    if c.isdigit():
        return DIGIT
    if c.isspace():
        return SPACE
    return {",": STOP, ".": STOP, ";": STOP, ":": STOP, "'": STOP, '"': STOP, "-": STOP, "?": STOP, "!": SHOUT, "|": BAR}.get(c, MARKUP if code < 128 else OTHER)


CLASS = np.array([_class(i) for i in range(_CODES)], np.uint8)
N_OWN = 23


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of the lines of a text, with those of their neighbours, and the lines' lengths. No line for no text."""
    lines = [x for x in (text or "").split("\n") if x.strip()]
    if not lines:
        return np.zeros((0, 1 + 3 * N_OWN), np.float32), np.zeros(0)
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "replace"), np.uint32)
    lengths = np.array(list(map(len, lines)))
    starts = np.concatenate(([0], lengths.cumsum()[:-1]))
    kinds = CLASS[np.minimum(codes, _CODES - 1)]
    share = np.stack([np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in range(9)], axis=1)
    n_words = np.maximum(1, share[:, SPACE] + 1)
    solid = np.maximum(1, lengths - share[:, SPACE])
    seen = Counter(lines)
    own = np.empty((len(lines), N_OWN), np.float32)
    own[:, :9] = share / solid[:, None]
    own[:, SPACE] = share[:, SPACE] / lengths
    own[:, 9] = np.log1p(lengths) / 8
    own[:, 10] = lengths < 30
    own[:, 11] = np.minimum(solid / n_words, 20) / 10
    own[:, 12] = own[:, UPPER] > 0.5
    own[:, 13] = share[:, SHOUT] / n_words
    own[:, 14] = share[:, BAR] / n_words
    own[:, 15] = share[:, MARKUP] / n_words
    own[:, 16] = [seen[x] > 1 for x in lines]
    words = [x.split() for x in lines]
    own[:, 17] = [1 - len(set(w)) / len(w) for w in words]
    own[:, 18] = [sum(map(eq, w, w[1:])) / len(w) for w in words]
    own[:, 19] = (own[:, 17] > 0.5) | (own[:, 18] > 0.2)
    own[:, 20] = own[:, 14] > 0.2
    own[:, 21] = own[:, 13] > 0.2
    own[:, 22] = own[:, 15] > 0.2
    none = np.zeros((1, N_OWN), np.float32)
    near = np.concatenate((own, np.concatenate((none, own[:-1])), np.concatenate((own[1:], none)), np.ones((len(lines), 1), np.float32)), axis=1)
    return near, lengths.astype(np.float64)


@dataclass
class Chain:
    """Weights of the good state's features, and of equal neighbouring states."""

    weights: np.ndarray
    tie: float

    def marginals(self, x: np.ndarray) -> np.ndarray:
        """The probability that each line is good, by forward-backward."""
        return forward_backward((x @ self.weights)[None, :].astype(np.float64), np.array([len(x)]), self.tie)[1][0]

    def score(self, text: str | None) -> float:
        """Length-weighted mean of the lines' marginals; without a line, that of a line without features."""
        x, lengths = line_features(text)
        if not len(x):
            x, lengths = np.eye(1, len(self.weights), len(self.weights) - 1, dtype=np.float32), np.ones(1)
        return float(np.clip((self.marginals(x) * lengths).sum() / lengths.sum(), 0.0, 1.0))


def forward_backward(unary: np.ndarray, n: np.ndarray, tie: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For chains in rows of ``unary`` (the good state's), of lengths ``n``: log partition, marginals of the good state,
    and the expected number of equal neighbours. In logs; lines beyond a chain's length count nothing."""
    rows, width = unary.shape
    inside = np.arange(width) < n[:, None]
    f = np.zeros((rows, width, 2))
    b = np.zeros((rows, width, 2))
    f[:, 0, 1] = unary[:, 0]
    for t in range(1, width):
        same, other = f[:, t - 1] + tie, f[:, t - 1, ::-1]
        f[:, t] = np.logaddexp(same, other)
        f[:, t, 1] += unary[:, t]
    for t in range(width - 2, -1, -1):
        nxt = b[:, t + 1].copy()
        nxt[:, 1] += unary[:, t + 1]
        b[:, t] = np.where(inside[:, t + 1, None], np.logaddexp(nxt + tie, nxt[:, ::-1]), 0.0)
    last = f[np.arange(rows), np.maximum(n, 1) - 1]
    z = np.logaddexp(last[:, 0], last[:, 1])
    good = np.where(inside, np.exp(np.minimum(f[:, :, 1] + b[:, :, 1] - z[:, None], 0)), 0.0)
    equal = np.zeros(rows)
    for t in range(1, width):
        nxt = b[:, t].copy()
        nxt[:, 1] += unary[:, t]
        both = np.exp(np.minimum(f[:, t - 1] + tie + nxt - z[:, None], 0)).sum(axis=1)
        equal += np.where(inside[:, t], both, 0.0)
    return z, good, equal


def fit(rows: list[tuple[str, int, float]], steps: int = 150, ridge: float = 1e-3) -> Chain:
    """A chain from (text, label, weight) rows by Adam on the conditional log likelihood. Chains of like length go together."""
    data = [(x, y, w) for text, y, w in rows if len(x := line_features(text)[0])]
    size = 1 + 3 * N_OWN
    if not data:
        return Chain(np.zeros(size), 0.0)
    data.sort(key=lambda d: len(d[0]))
    blocks, at = [], 0
    while at < len(data):
        end = at + 1
        while end < len(data) and len(data[end][0]) <= 1.3 * len(data[at][0]) + 4:
            end += 1
        part = data[at:end]
        n = np.array([len(x) for x, *_ in part])
        blocks.append((np.concatenate([x for x, *_ in part]), n, np.array([y for _, y, _ in part]), np.array([w for *_, w in part])))
        at = end
    total = sum(w for *_, w in data)
    theta, m, v = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        g = ridge * theta
        for x, n, y, w in blocks:
            inside = np.arange(n.max()) < n[:, None]
            unary = np.zeros(inside.shape)
            unary[inside] = x @ theta[:-1]
            _, good, equal = forward_backward(unary, n, theta[-1])
            # a chain weighs by its document's weight, whatever its number of lines
            per = w / n / total
            g[:-1] += (((good - y[:, None]) * per[:, None])[inside]) @ x
            g[-1] += ((equal - (n - 1)) * per).sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Chain(theta[:-1], float(theta[-1]))


def learn(docs: DataFrame, labels: DataFrame, rows_per_label: int = FIT_ROWS) -> Chain:
    """A chain from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    Null labels and ids, texts of more than ``FIT_CHARS`` characters and ids of either table alone teach nothing; of
    several labels of one id the greater one counts. Without rows the chain scores every text alike."""
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = sampled_ids(known, "quality", rows_per_label)
    of = {i: y for y, (_, *ids) in chosen.items() for i in ids}
    sample = docs.sparkSession.createDataFrame([(i,) for i in of], "doc_id long")
    texts = docs.select("doc_id", "text").where(F.char_length("text") <= FIT_CHARS)
    rows = sorted(map(tuple, texts.join(F.broadcast(sample), "doc_id").collect()))
    got = Counter(of[i] for i, _ in rows)
    return fit([(text, of[i], chosen[of[i]][0] / got[of[i]]) for i, text in rows])


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for each row of ``docs`` (doc_id, text).

    Null and empty texts, and those of white space, get the chain's base score. Texts are scored whole, whatever their
    length. Repeated rows give repeated rows, an empty table none; columns but doc_id and text are not read, and a null
    doc_id stays null."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])
    sent = docs.sparkSession.sparkContext.broadcast(chain)

    def run(cols: dict[str, list]) -> dict[str, list]:
        scores = [sent.value.score(t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "score": scores, "predicted": [int(s >= threshold) for s in scores]}

    return map_batches(docs.select("doc_id", "text"), run, schema)


def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5, 0)
    chain = learn(docs.where(~out), table(spark, sf_dir, "labels").where(~out))
    return score(docs, chain).select("doc_id", out.alias("held_out"), "score", "predicted")
