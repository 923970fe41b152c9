"""Operator 13: phrases of two to five words that stand together more often than their parts suggest.

Phrases are counted by length. A phrase can be frequent only if both phrases that are one word shorter are, so that each
length is counted behind a filter of the frequent phrases before it: bits of bounded size that never lose one; what they
let through in excess is counted exactly and falls below the threshold.

What the scores need besides is read from the counts as two sorted streams, without a table of hashes. In prefix order,
by words from the first on, the first m words of a phrase are the last row of m words that went by; in suffix order, by
words from the last on, so are its last m words. So one merge over either stream gives the counts of all left parts, of
all right parts, and of the phrases that a phrase extends on its right and on its left. Streams are cut into ranges
of like size whatever word they start with; of each range only its last row of either length is carried on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from stakeflow.llm.common import released, small, table, written
from stakeflow.llm.hashing import mix
from stakeflow.operators.ranking import global_index

FEWEST, LONGEST, TOP = 100, 5, 2000
SPREAD = np.uint64(0xD1342543DE82EF95)
#: Bytes that end a piece become stops, tabs spaces, and A to Z lower case.
FOLDED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz.......... ")
STOP, SPACE = ord("."), ord(" ")
#: Bytes of text whose phrases are counted at once; a single longer text is cut between words.
CHUNK = 4 << 20
#: Bits of a filter: so many for each phrase, and no more in all, which is 16 MB.
KEY_BITS, MOST_BITS, PROBES = 16, 1 << 27, 3

COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])
BITS = pa.schema([("word", pa.int64()), ("bits", pa.int64())])


class Words:
    """The words of bytes, between spaces: where they start and end, the piece between stops that each stands in, and hashes."""

    def __init__(self, data: bytes, stop: int = STOP):
        self.data = np.frombuffer(data + bytes(8), np.uint8)
        stops = self.data == stop
        word = ~(stops | (self.data == SPACE))
        word[len(data) :] = False
        edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.piece = np.cumsum(stops, dtype=np.int32)[self.starts]
        self.hashes = self._hashed()

    def _hashed(self) -> np.ndarray:
        """Eight bytes of each word at a time, of those that have so many."""
        eight = np.lib.stride_tricks.sliding_window_view(self.data, 8)
        out = (self.ends - self.starts).astype(np.uint64)
        rest, at = np.arange(len(out)), self.starts
        while len(rest):
            left = self.ends[rest] - at
            block = np.ascontiguousarray(eight[np.minimum(at, len(eight) - 1)]).view(np.uint64).ravel()
            unused = (8 * (8 - np.minimum(left, 8))).astype(np.uint64)
            out[rest] = mix(out[rest] * SPREAD + ((block << unused) >> unused))
            more = left > 8
            rest, at = rest[more], at[more] + 8
        return out

    def runs(self, k: int, lang: str) -> np.ndarray:
        """Hashes of all runs of k words of a language, across pieces too."""
        n = max(0, len(self.hashes) - k + 1)
        out = np.full(n, np.uint64(k))
        for j in range(k):
            out = (out ^ self.hashes[j : j + n]) * SPREAD
        return mix(mix(out) ^ salt(lang))

    def texts(self, first: np.ndarray, k: int) -> tuple[pa.Array, np.ndarray]:
        """The k words from each of ``first`` on, a space between; those that stand otherwise come last, hence their order."""
        starts, ends = self.starts[first], self.ends[first + k - 1]
        plain = ends - starts == sum(self.ends[first + j] - self.starts[first + j] for j in range(k)) + k - 1
        order = np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain)))
        n = ends[plain] - starts[plain]
        to = np.concatenate((np.zeros(1, np.int64), np.cumsum(n)))
        bytes_ = self.data[np.repeat(starts[plain] - to[:-1], n) + np.arange(to[-1])]
        found = pa.Array.from_buffers(pa.string(), len(n), [None, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(bytes_)])
        others = [b" ".join(self.data[s:e].tobytes().split()) for s, e in zip(starts[~plain], ends[~plain])]
        return pa.concat_arrays([found, pa.array(others, pa.binary()).cast(pa.string())]), order


def chunks(texts: list[str], keep: int) -> Iterator[Words]:
    """The words of texts; a chunk starts with the ``keep`` last words of the one before it, so that each phrase of one word
    more stands in one chunk."""
    data = ".".join(texts).encode("utf-8", "replace").translate(FOLDED)
    at = end = 0
    while end < len(data):
        end, before = end + 2 * CHUNK, end
        if end < len(data):
            cut = max(data.rfind(b" ", before, end), data.rfind(b".", before, end))
            after = [p for p in (data.find(b" ", end), data.find(b".", end)) if p >= 0]
            end = cut if cut > before else min(after, default=len(data))
        words = Words(data[at:end])
        yield words
        at = at + int(words.starts[max(0, len(words.starts) - keep)]) if keep and len(words.starts) else end


def salt(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


class Filter:
    """Bits that hold a set of hashes, with some others."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(hashes: np.ndarray, n_bits: int) -> Iterator[np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for j in range(PROBES):
            yield (hashes + np.uint64(j) * step) & np.uint64(n_bits - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for p in self.places(hashes, 64 * len(self.bits)):
            found &= ((self.bits[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)).astype(bool)
        return found


def filter_of(frequent: DataFrame, k: int) -> Filter:
    """The filter of ``frequent`` (lang, phrase), phrases of k words; its bits are brought together by their words of 64."""
    wanted = max(1 << 12, KEY_BITS * frequent.count())
    n_bits = min(MOST_BITS, 1 << (wanted - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, phrases = (batch.column(j).to_pylist() for j in (0, 1))
            hashes = np.zeros(len(langs), np.uint64)
            for lang in set(langs):
                mine = np.array([g == lang for g in langs])
                hashes[mine] = Words(".".join(p for p, m in zip(phrases, mine) if m).encode()).runs(k, lang)[::k]
            places = np.unique(np.concatenate(list(Filter.places(hashes, n_bits))))
            at, first = np.unique(places >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (places & np.uint64(63)), first) if len(at) else places
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(bits.view(np.int64))], schema=BITS)

    found = frequent.select("lang", "phrase").mapInArrow(run, from_arrow_schema(BITS)).groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(n_bits // 64, np.uint64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Filter(bits)


def counted(docs: DataFrame, k: int, shorter: Filter | None, fewest: int) -> DataFrame:
    """lang, phrase, n of the phrases of k words that occur ``fewest`` times or more, none of whose parts ``shorter`` lacks.
    With k = 1 also the empty phrase, whose n is that of all words of the language."""
    sent = docs.sparkSession.sparkContext.broadcast(shorter)

    def grams(lang: str, texts: list[str]) -> Iterator[tuple[pa.Array, np.ndarray]]:
        for words in chunks(texts, k - 1):
            hashes = words.runs(k, lang)
            first = np.arange(len(hashes))
            if k > 1 and len(first):
                known = sent.value.has(words.runs(k - 1, lang))
                first = np.flatnonzero(known[:-1] & known[1:] & (words.piece[k - 1 :] == words.piece[: 1 - k]))
            _, at, n = np.unique(hashes[first], return_index=True, return_counts=True)
            phrases, order = words.texts(first[at], k)
            yield phrases, n[order]
            if k == 1:
                yield pa.array([""]), np.array([len(first)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = {}
        size = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                for phrases, n in grams(lang, texts):
                    yield pa.RecordBatch.from_arrays([pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int32))), phrases, pa.array(n.astype(np.int64))], schema=COUNTS)
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.setdefault(lang, []).append(text.as_py())
                size += len(held[lang][-1])
                if size >= CHUNK:
                    yield from flushed()
                    size = 0
        yield from flushed()
        released()

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, from_arrow_schema(COUNTS)).groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where((F.col("n") >= fewest) | (F.col("phrase") == ""))


def streamed(rows: DataFrame, key: Column, name: str, longest: int) -> DataFrame:
    """``rows`` (lang, words, f and others; a row a phrase) with, in the array ``name``, the counts of the first 1, 2, ...
    words of ``key``; null beyond its length."""
    size, row = F.size("words"), F.struct("lang", "key", "f")
    parts = written(rows.withColumn("key", key).repartitionByRange("lang", "key").withColumn("part", F.spark_partition_id()))
    lasts = [F.max_by(F.when(size == m, F.col("f")), F.when(size == m, F.struct("lang", "key"))).alias(f"last{m}") for m in range(1, longest)]
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    carried = parts.groupBy("part").agg(*lasts).select("part", *[F.last(f"last{m}", ignorenulls=True).over(before).alias(f"last{m}") for m in range(1, longest)])
    here = Window.partitionBy("part").orderBy("lang", "key").rowsBetween(Window.unboundedPreceding, 0)
    found = [F.when(size == m, F.col("f")).when(size > m, F.coalesce(F.last(F.when(size == m, F.col("f")), ignorenulls=True).over(here), F.col(f"last{m}"))) for m in range(1, longest)]
    return parts.join(F.broadcast(carried), "part").withColumn(name, F.array(*found)).drop("part", "key", *[f"last{m}" for m in range(1, longest)])


def phrase_counts(docs: DataFrame, fewest: int = FEWEST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """lang, words, f of all phrases of up to ``longest`` words that occur ``fewest`` times or more, and lang, n of all words."""
    found, shorter = [], None
    for k in range(1, longest + 1):
        now = written(counted(docs, k, shorter, fewest))
        if k == 1:
            totals = now.where("phrase = ''").select("lang", "n")
            now = now.where("phrase <> ''")
        found.append(now.select("lang", F.split("phrase", " ").alias("words"), F.col("n").alias("f")))
        if k < longest:
            shorter = filter_of(now, k)
    counts = found[0]
    for other in found[1:]:
        counts = counts.unionByName(other)
    return counts, totals


def collocations(docs: DataFrame, fewest: int = FEWEST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases of each language of ``docs`` (lang, text).

    Texts in lower case (A to Z only) fall into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and tabs; a is
    a phrase's count, n that of all words, l and r those of the parts of its weakest cut, the first of equal ones, and score
    a thousand times a n / (l r), rounded down. Phrases that always stand in one longer phrase aren't reported. Ties go by
    count, then by the phrase's bytes. Null texts are empty, a null lang is ``und``; repeated rows count each, an empty table
    has no phrases, and other columns aren't read. Texts are read whole, in chunks of CHUNK bytes."""
    counts, totals = phrase_counts(docs, fewest, longest)
    both = streamed(streamed(counts, F.col("words"), "left", longest), F.reverse("words"), "right", longest).where(F.size("words") > 1).join(small(totals, 64), "lang")
    both = written(both)
    size, wide = F.size("words"), lambda c: c.cast("decimal(15,0)")
    part = lambda side, m: F.get(side, m - 1)

    def cut(j: int) -> Column:
        left, right = part("left", F.lit(j)), part("right", size - j)
        score = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * wide(F.col("f")) * wide(F.col("n")), wide(left) * wide(right))
        return F.when(size > j, F.struct(score.alias("score"), F.lit(j).alias("cut"), left.alias("l"), right.alias("r")))

    weakest = F.array_min(F.filter(F.array(*[cut(j) for j in range(1, longest)]), lambda c: c.isNotNull()))
    longer = both.where(size > 2)
    held = [
        longer.where(part("left", size - 1) == F.col("f")).select("lang", F.slice("words", F.lit(1), size - 1).alias("words")),
        longer.where(part("right", size - 1) == F.col("f")).select("lang", F.slice("words", F.lit(2), size - 1).alias("words")),
    ]
    kept = both.join(held[0].unionByName(held[1]).distinct(), ["lang", "words"], "left_anti").withColumn("w", weakest)
    out = kept.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "w.l", "w.r", "n", "w.score")
    # one order of all languages, cut into ranges; a phrase's rank is its place less that of its language's first
    placed = global_index(out, F.col("lang"), F.desc("score"), F.desc("a"), F.col("phrase"), name="place")
    first = placed.groupBy("lang").agg(F.min("place").alias("first"))
    ranked = placed.join(small(first, 40), "lang").withColumn("rank", F.col("place") - F.col("first") + 1).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)
  GROUP BY lang, k, phrase HAVING count(*) >= 100
), totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang
), candidates AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM grams WHERE k > 1
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, j, l.f AS l, r.f AS r, n, CAST(CAST(1000 AS HUGEINT) * c.f * n // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
  JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.j], ' ')
  JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.j + 1:c.k], ' ')
  JOIN totals t ON t.lang = c.lang
), weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inner_ AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, f FROM (
    SELECT lang, w, f, m, unnest(range(1, k - m + 2)) AS i FROM candidates, (SELECT unnest([2, 3, 4]) AS m) WHERE k > m)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, phrase, a, l, r, n, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest
  WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = weakest.lang AND i.phrase = weakest.phrase AND 100 * i.f >= 100 * weakest.a))
WHERE rank <= 2000
"""
