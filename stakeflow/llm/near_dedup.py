"""Operator 4: near duplicates by DartMinHash signatures and banded joining.

A text's elements are its shingles, each weighted by how often the text has it. Darts are thrown at the plane of weights and ranks of each element, a Poisson number into each unit cell, where and
for which coordinate of the signature the element's hash decides. Those under the element's weight and below a rank
limit hit; each coordinate keeps the hit of the lowest rank. The limit falls with the total weight, so that a document
gets about k (ln k + 5) hits whatever its size; where a coordinate stays empty, it is doubled. Two documents agree in
a coordinate with the probability of their weighted Jaccard similarity.

Equal word sequences are one class, of which one text goes on. Classes that agree in a band of coordinates share a
bucket. First its members are compared exactly with one pivot each. What is then in one component needs no more
comparison. In small buckets the other pairs are compared one by one. Documents that share large buckets are dealt to
blocks, and each pair of blocks is a tile of its own task, which compares the pairs that share a band and aren't joined
yet, and returns the links that join components only. So no link of a bucket is lost, and what is shuffled and returned
stays in proportion to the documents and the tiles that they are in.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.llm.common import map_batches, removed, small, table, with_group, with_side, words_of, written
from stakeflow.llm.components import components
from stakeflow.llm.hashing import Runs, mix, text_key, word_hashes

SHINGLE, THRESHOLD = 5, 0.8
#: Bands of so many coordinates: a pair at the threshold shares no band once in 300,000 times.
BANDS, ROWS = 24, 4
#: Buckets of more members are compared in tiles, of blocks of so many documents.
HOT, BLOCK = 64, 512

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _steps(n: int) -> np.uint64:
    return np.uint64(n * int(_STEP) & (1 << 64) - 1)


def shingles(words: list[bytes], n: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of n words, in order; fewer words are one run. None for no words."""
    return Runs(word_hashes(words)[0]).all_of(min(n, len(words))) if words else np.zeros(0, np.uint64)


def weighted(text: str | None, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingles of a text and how often each occurs: its elements and their weights."""
    return np.unique(shingles(words_of(text), n), return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: the sum of lesser weights by that of greater ones."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    at = np.minimum(np.searchsorted(a[0], b[0]), len(a[0]) - 1)
    common = int(np.minimum(a[1][at], b[1])[a[0][at] == b[0]].sum())
    return common / (int(a[1].sum()) + int(b[1].sum()) - common)


@lru_cache(maxsize=8)
def _poisson(limit: int = 24) -> np.ndarray:
    """Above which hash a unit cell has more than 0, 1, ... darts."""
    total, term, out = 0.0, math.exp(-1), []
    for m in range(limit):
        total += term
        term /= m + 1
        out.append(min(int(total * 2.0**64), (1 << 64) - 1))
    return np.array(out, np.uint64)


def dart_signature(elements: np.ndarray, weights: np.ndarray, k: int = BANDS * ROWS) -> np.ndarray:
    """k coordinates for distinct hashed elements of positive weights.

    Each unit cell of an element's region, and of ranks, has its darts; all cells of a document are looked at together.
    """
    w = weights.astype(np.float64)
    limit = k * (math.log(k) + 5) / w.sum()
    above = _poisson()
    units = np.ceil(w).astype(np.int64)
    of = np.repeat(np.arange(len(w)), units)
    unit = np.arange(len(of)) - np.repeat(units.cumsum() - units, units)
    base, low, high = mix(elements[of] + unit.astype(np.uint64) * _STEP), unit.astype(np.float64), w[of]
    while True:
        ids, ranks, coords = [], [], []
        ranks_at = np.arange(math.ceil(limit), dtype=np.uint64)
        cell = mix(base[:, None] ^ mix(ranks_at * _STEP + np.uint64(1))[None, :]).ravel()
        rank_at, at = np.tile(ranks_at.astype(np.float64), len(base)), np.repeat(np.arange(len(base)), len(ranks_at))
        for m, least in enumerate(above):
            more = cell >= least
            if not more.any():
                break
            cell, rank_at, at = cell[more], rank_at[more], at[more]
            dart = mix(cell + _steps(m + 1))
            second = mix(dart ^ _STEP)
            rank = rank_at + (dart >> np.uint64(11)) * 2.0**-53
            hit = (rank < limit) & (low[at] + (second >> np.uint64(32)) * 2.0**-32 < high[at])
            ids.append(dart[hit])
            ranks.append(rank[hit])
            coords.append((second[hit] & np.uint64(0xFFFFFFFF)) % np.uint64(k))
        if ids:
            ids, ranks, coords = (np.concatenate(x) for x in (ids, ranks, coords))
            order = np.lexsort((ids, ranks))[::-1]
            out, full = np.zeros(k, np.uint64), np.zeros(k, bool)
            coords = coords.astype(np.int64)
            out[coords[order]] = ids[order]  # the lowest rank is written last
            full[coords] = True
            if full.all():
                return out
        limit *= 2


def band_hashes(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    parts = signature.reshape(-1, rows)
    h = mix(np.arange(len(parts), dtype=np.uint64) * _STEP)
    for c in range(rows):
        h = mix(h ^ parts[:, c]) + _STEP
    return h.view(np.int64)


def signatures(docs: DataFrame, n: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, key (of the word sequence) and the bands of every row of ``docs``; both null for texts without words."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(cols: dict[str, list]) -> dict[str, list]:
        keys, out = [], []
        for text in cols["text"]:
            words = words_of(text)
            keys.append(text_key(words))
            out.append(band_hashes(dart_signature(*weighted(text, n), bands * rows), rows).tolist() if words else None)
        return {"doc_id": cols["doc_id"], "key": keys, "bands": out}

    return map_batches(docs.select("doc_id", "text"), run, schema)


def similar(pairs: DataFrame, texts: DataFrame, threshold: float, n: int) -> DataFrame:
    """Of ``pairs`` (a, b) those whose texts' weighted shingles are similar enough."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(cols: dict[str, list]) -> dict[str, list]:
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        a, b = [], []
        for x, y, s, t in zip(cols["a"], cols["b"], cols["text_a"], cols["text_b"]):
            sets = []
            for key, text in ((x, s), (y, t)):
                if key not in known:
                    if len(known) >= 64:
                        known.pop(next(iter(known)))
                    known[key] = weighted(text, n)
                sets.append(known[key])
            if similarity(*sets) >= threshold:
                a.append(x)
                b.append(y)
        return {"a": a, "b": b}

    one = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    two = one.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return map_batches(two.select("a", "b", "text_a", "text_b"), run, schema)


def tiled(hot: DataFrame, reps: DataFrame, texts: DataFrame, threshold: float, n: int, block: int) -> DataFrame:
    """Links (a, b) that join components of ``hot`` (bucket, rep, pivot, component), among reps (rep, bands) with a common band."""
    groups = components(hot.select(F.col("rep").alias("a"), F.col("pivot").alias("b")))  # of documents that large buckets connect
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    of = hot.select("rep", F.col("component").alias("of")).distinct()
    dealt = with_side(written(groups), sizes, ["component"]).select(F.col("id").alias("rep"), F.col("component").alias("g"), "parts", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("block"))
    rows = written(dealt.join(of, "rep").join(reps, "rep").join(texts.withColumnRenamed("doc_id", "rep").dropDuplicates(["rep"]), "rep"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))
    tiles = rows.withColumn("t", F.explode(pairs)).select("g", "t.i", "t.j", "block", "rep", "of", "bands", "text")

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        part = part.sort_values("rep")
        bands = np.array(part["bands"].tolist(), np.int64)
        reps, label = part["rep"].to_numpy(), part["of"].to_numpy().copy()
        sets = [weighted(t, n) for t in part["text"]]
        sizes = np.array([c.sum() for _, c in sets])
        left, right = (np.flatnonzero(part["block"].to_numpy() == k) for k in (i, j))
        out = []
        for x in left:
            # sums of weights that are similar enough are near each other
            fits = (np.minimum(sizes[right], sizes[x]) >= threshold * np.maximum(sizes[right], sizes[x])) & (label[right] != label[x]) & (right != x)
            near = right[fits]
            near = near[(bands[near] == bands[x]).any(axis=1)]
            if not len(near):
                continue
            mine, weight = sets[x]
            others, weights = (np.concatenate([sets[y][k] for y in near]) for k in (0, 1))
            at = np.minimum(np.searchsorted(mine, others), len(mine) - 1)
            shared = np.where(mine[at] == others, np.minimum(weight[at], weights), 0)
            lengths = np.array([len(sets[y][0]) for y in near])
            common = np.add.reduceat(shared, lengths.cumsum() - lengths, dtype=np.int64)
            for y in near[common / (sizes[near] + sizes[x] - common) >= threshold]:
                if label[x] != label[y]:
                    out.append((min(reps[x], reps[y]), max(reps[x], reps[y])))
                    label[label == label[y]] = label[x]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return tiles.groupBy("g", "i", "j").applyInPandas(run, "a long, b long")


def near_duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD, n: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """doc_id and class_id of every row of ``docs`` (doc_id, text).

    A class holds what is reachable over pairs whose n-word shingles, weighted by how often a text has them, have a
    weighted Jaccard similarity of ``threshold`` or more; its id is its smallest doc_id. Words are runs of anything but
    ASCII white space, unchanged; texts of fewer than n words are one shingle. Texts without words, null ones included,
    are each a class of their own; so are rows with a null doc_id, whose class_id is null. Repeated rows come back as
    often, in one class. An empty table gives no rows; other columns are not read. Shingles are compared by 64-bit hashes.
    """
    sig = written(signatures(docs.where("doc_id is not null"), n, bands, rows))
    words = sig.where("key is not null")
    first = words.groupBy("key").agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands"))
    banded = written(first.select("rep", F.explode("bands").alias("bucket")))
    pivot = F.min(F.struct(F.xxhash64("rep", "bucket").alias("h"), "rep"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n"), pivot.alias("p")).where("n > 1")
    members = written(with_side(banded, shared, ["bucket"]).select("bucket", "rep", F.col("p.rep").alias("pivot"), "n"))
    removed(banded)
    texts = docs.select("doc_id", "text").join(small(members.select(F.col("rep").alias("doc_id")).distinct(), 16), "doc_id", "left_semi")

    tried = written(members.where("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct())
    links = written(similar(tried, texts, threshold, n))
    of = components(links)
    joined = written(members.join(of.withColumnRenamed("id", "rep"), "rep", "left").select("bucket", "rep", "pivot", "n", F.coalesce("component", "rep").alias("component")))
    removed(members)
    mixed = written(with_group(joined, ["bucket"], {"lo": F.min("component"), "hi": F.max("component")}, F.col("lo") < F.col("hi")).drop("lo", "hi"))
    removed(joined)
    few = mixed.where(F.col("n") <= hot).select("bucket", "rep", "component")
    found = few.select("bucket", F.col("rep").alias("a"), F.col("component").alias("ca")).join(few.select("bucket", F.col("rep").alias("b"), F.col("component").alias("cb")), "bucket").where("a < b and ca <> cb")
    found = written(found.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"))
    more = written(similar(found, texts, threshold, n))
    large = mixed.where(F.col("n") > hot).drop("n")
    if not large.isEmpty():
        more = more.unionByName(written(tiled(large, first, texts, threshold, n, block)))
    if not more.isEmpty():
        of = components(links.unionByName(more))
    copies = written(with_group(written(words.select("doc_id", "key")), ["key"], {"rep": F.min("doc_id")}, F.lit(True)).select("doc_id", "rep"))
    known = with_side(copies, of.withColumnRenamed("id", "rep"), ["rep"], "left").select("doc_id", F.coalesce("component", "rep").alias("class_id"))
    alone = sig.where("key is null").select("doc_id", F.col("doc_id").alias("class_id"))
    lost = docs.where("doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"))
    return known.unionByName(alone).unionByName(lost)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicate_classes(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, array_to_string(CASE WHEN len(w) < 5 THEN w ELSE w[i : i + 4] END, ' ') AS shingle, count(*) AS weight
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM w WHERE len(w) > 0) GROUP BY 1, 2
), n AS (SELECT doc_id, sum(weight) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.weight, y.weight)) AS c FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE c::DOUBLE / (x.n + y.n - c) >= 0.8
), reach AS (
  SELECT doc_id AS id, doc_id AS other FROM documents
  UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT id AS doc_id, min(other) AS class_id, id = min(other) AS kept FROM reach GROUP BY id
"""
