"""Operator 10: near duplicates among embeddings by quantised tile products with rigorous bounds.

Unit vectors are rounded to signed bytes at a scale of their own; what rounding loses is a residual whose length is
known. The product of two rounded vectors, which is an exact integer, differs from the cosine by at most
|a||rb| + |b||ra| + |ra||rb|, where a and b are the rounded vectors at their scales and ra and rb the residuals. Pairs
that the bound leaves below the threshold are dropped, those above are links, and those between are computed again in
double precision.

Equal vectors are one class. Classes are dealt to blocks by their hash, and each pair of blocks is a tile of its own
task. A tile returns a count for each of its classes and the edges of a spanning forest, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.llm.common import checkpointed, table
from stakeflow.llm.components import components

THRESHOLD = 0.9
#: Vectors of a block at most, blocks while they are smaller, and the side of the products inside a tile.
BLOCK, BLOCKS, SIDE = 16_384, 8, 1024
#: Rounding of doubles in sums of this many terms stays far below it.
SLACK = 1e-9


class Quantised:
    """Unit vectors as signed bytes with scales and the lengths of residuals."""

    def __init__(self, vectors: np.ndarray):
        x = vectors.astype(np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        self.unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        self.scale = np.abs(self.unit).max(axis=1) / 127.0
        self.codes = np.rint(self.unit / self.scale[:, None]).astype(np.int8)
        near = self.codes * self.scale[:, None]
        self.lost = np.sqrt(((self.unit - near) ** 2).sum(axis=1)) + SLACK
        self.length = np.sqrt((near * near).sum(axis=1)) + SLACK
        self.singles = self.codes.astype(np.float32)

    def ordered(self, order: np.ndarray) -> Quantised:
        out = object.__new__(Quantised)
        out.__dict__.update({k: v[order] for k, v in self.__dict__.items()})
        return out

    def products(self, rows: slice, other: Quantised, cols: slice) -> np.ndarray:
        """Exact integer products of codes: sums below 2**24 are exact in single precision."""
        dims = self.codes.shape[1]
        if dims <= 1024:
            return self.singles[rows] @ other.singles[cols].T
        return sum((self.singles[rows, at : at + 1024] @ other.singles[cols, at : at + 1024].T).astype(np.float64) for at in range(0, dims, 1024))

    def links(self, rows: slice, other: Quantised, cols: slice, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns, from the slices' starts, of the pairs whose cosine is at the threshold or above."""
        got = self.products(rows, other, cols)
        s, t = self.scale[rows], other.scale[cols]
        # one bound for each column that holds for all rows; vectors of like scale stand together, so that it is close
        most = self.length[rows].max() * other.lost[cols] + self.lost[rows].max() * (other.length + other.lost)[cols] + SLACK
        least = np.maximum(threshold - most, 0.0) / (s.max() * t) * (1 - 1e-6)
        r, c = np.nonzero(got >= least.astype(got.dtype)[None, :])
        near = got[r, c] * s[r] * t[c]
        off = self.length[rows][r] * other.lost[cols][c] + self.lost[rows][r] * (other.length + other.lost)[cols][c] + SLACK
        linked = near - off >= threshold
        unsure = np.flatnonzero((near + off >= threshold) & ~linked)
        for at in range(0, len(unsure), 65_536):
            k = unsure[at : at + 65_536]
            linked[k] = np.einsum("nd,nd->n", self.unit[rows][r[k]], other.unit[cols][c[k]]) >= threshold
        return r[linked], c[linked]


def forest(r: np.ndarray, c: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the ids of rows and columns as the links (r, c) do, at most one an id where links are many."""
    if len(r) <= len(rows) + len(cols):
        return rows[r], cols[c]
    linked = np.zeros((len(rows), len(cols)), bool)
    linked[r, c] = True
    far = np.iinfo(np.int64).max
    of_row, of_col = rows.copy(), cols.copy()
    while True:
        new_row = np.minimum(of_row, np.where(linked, of_col[None, :], far).min(axis=1))
        new_col = np.minimum(of_col, np.where(linked, new_row[:, None], far).min(axis=0))
        if (new_row == of_row).all() and (new_col == of_col).all():
            break
        of_row, of_col = new_row, new_col
    a, b = np.concatenate((rows, cols)), np.concatenate((of_row, of_col))
    return a[a != b], b[a != b]


def _tile(threshold: float):
    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        _, left, right = key
        sides = []
        for block in dict.fromkeys((left, right)):
            own = part[part["block"] == block]
            if not len(own):
                break
            q = Quantised(np.array(own["embedding"].tolist(), np.float64))
            order = np.argsort(q.scale)
            sides.append((own["id"].to_numpy(np.int64)[order], own["copies"].to_numpy(np.int64)[order], q.ordered(order)))
        out: list[pd.DataFrame] = []
        if len(sides) == (1 if left == right else 2):
            (ids, copies, a), (ids2, copies2, b) = sides[0], sides[-1]
            n = np.zeros(len(ids), np.int64)
            n2 = n if left == right else np.zeros(len(ids2), np.int64)
            for i in range(0, len(ids), SIDE):
                for j in range(i if left == right else 0, len(ids2), SIDE):
                    rows, cols = slice(i, min(i + SIDE, len(ids))), slice(j, min(j + SIDE, len(ids2)))
                    r, c = a.links(rows, b, cols, threshold)
                    if left == right and i == j:
                        r, c = r[r < c], c[r < c]
                    if not len(r):
                        continue
                    np.add.at(n, r + i, copies2[c + j])
                    np.add.at(n2, c + j, copies[r + i])
                    x, y = forest(r, c, ids[rows], ids2[cols])
                    out.append(pd.DataFrame({"id": x, "other": y, "n": 0}))
            for of, k in ((ids, n),) if left == right else ((ids, n), (ids2, n2)):
                out.append(pd.DataFrame({"id": of[k > 0], "other": of[k > 0], "n": k[k > 0]}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"id": [], "other": [], "n": []}, dtype="int64")

    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, blocks: int = BLOCKS) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding).

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; vectors of different
    lengths don't link with each other. Equal rows are vectors of their own, which link. Null ids are kept, unlinked.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    valid = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(~bad & some, F.lit(False))
    classes = checkpointed(rows.where(valid).groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")))
    n = classes.count()
    parts = max(1, math.ceil(n / block), min(blocks, math.ceil(n / SIDE)))
    dealt = classes.select("id", "copies", "embedding", F.size("embedding").alias("dims"), F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("block"))
    pairs = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda k: F.struct(F.least("block", k).alias("left"), F.greatest("block", k).alias("right")))
    tiles = dealt.withColumn("t", F.explode(pairs)).select("id", "copies", F.col("embedding").cast("array<double>"), "dims", "block", "t.left", "t.right")
    found = checkpointed(tiles.groupBy("dims", "left", "right").applyInPandas(_tile(threshold), "id long, other long, n long"))
    of = components(found.where("n = 0").select(F.col("id").alias("a"), F.col("other").alias("b")))
    links = found.where("n > 0").groupBy("id").agg(F.sum("n").alias("n"))
    known = classes.select("embedding", "id", "copies").join(links, "id", "left").join(of, "id", "left")
    known = known.select("embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    # invalid vectors have no class; their embedding is left out of the key
    keyed = rows.select("vec_id", F.when(valid, F.col("embedding")).alias("embedding"))
    joined = keyed.join(known, "embedding", "left")
    out = joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH RECURSIVE ok AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND len(embedding) > 0
    AND list_bool_and([isfinite(x) FOR x IN embedding]) AND list_bool_or([x <> 0 FOR x IN embedding])
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS id, vec_id AS other FROM embeddings
  UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
), least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, l.component_id, v.vec_id = l.component_id AS kept
FROM embeddings v JOIN least l ON l.id = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""
