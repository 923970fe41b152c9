"""Operator 11: quality rules and bands of n-gram perplexity.

Base rules count words, symbols, repeated lines and repeated five-word windows. What passes them, has few symbols and isn't
mostly capitals teaches a modified Kneser-Ney model of its language over characters, so that prose is what it expects: Spark counts every n-gram of the highest order in all documents, and
each lower order's counts, how many characters go before an n-gram, follow from the order above. Texts fall into two
folds by their hash, and are scored by the other fold's model, so that no text, nor a copy of it, teaches its own score.

A model is a set of sorted arrays of hashes, one an order, with the logarithm of the interpolated probability of every
n-gram, and the weight of every context; values are fixed-point integers, so that sums don't depend on their order. Of a
model of more rows than MODEL_ROWS the tasks get the n-grams of the highest counts, which most places of texts have; the
others' n-grams are joined to the whole model, with the same result.

Bits a character of all documents that pass the base rules give each language its quartiles, and these its band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from stakeflow.llm.common import released, removed, slices, small, table, with_side, written
from stakeflow.llm.hashing import mix
from stakeflow.llm.phrases import Words

LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5
SYMBOLS = "#*$%&|<>"
#: Texts teach that have at most one symbol to so many words, and one capital of A to Z to so many bytes.
WORDS_A_SYMBOL, BYTES_A_CAPITAL = 10, 4
#: Characters of an n-gram; what stands at a text's ends, which no normalised text holds; log2 of a value's unit.
ORDER, EDGE, UNIT = 4, "\n", 16
LEAST_DISCOUNT = 0.1
#: Rows of a model that are sent to the tasks, of 20 bytes each; n-grams that a task holds; characters scored at once.
MODEL_ROWS, HELD, STEP = 4_000_000, 1_000_000, 1 << 19
#: How far a band reaches beyond the quartiles, in ranges between them, each of 1/10 bit a character at least; and the words of
#: texts for which it reaches twice as far, as means of few words vary more.
WIDTH, LEAST_RANGE, FEW_WORDS = 3, 100, 64
SPREAD = np.uint64(0xD1342543DE82EF95)
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
ENDS = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")

GROUP = ["lang", "fold"]
GRAMS = pa.schema([("lang", pa.string()), ("fold", pa.int32()), ("gram", pa.string()), ("n", pa.int64())])
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Of a scored row: the sum of the values that its task knew, how many places there are, and the n-grams of the others.
REST = pa.struct([("gram", pa.string()), ("n", pa.int64())])
SCORED = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("fold", pa.int32()), ("key", pa.binary()), *[(c, pa.int64()) for c in BASE], ("base_failed", pa.bool_()), ("known", pa.int64()), ("places", pa.int64()), ("rest", pa.list_(REST))])


def base_counts(texts: list[str]) -> dict[str, list]:
    """The columns of BASE, base_failed, and whether a text teaches, of texts."""
    coded = [t.encode("utf-8", "replace") for t in texts]
    words = Words(b"\xff".join(coded).translate(ENDS), 0xFF)
    n_words = np.bincount(words.piece, minlength=len(texts)) if texts else np.zeros(0, int)
    repeated = np.zeros(len(texts), np.int64)
    if len(words.piece) >= WINDOW:
        first = np.flatnonzero(words.piece[WINDOW - 1 :] == words.piece[: 1 - WINDOW])
        runs = mix(words.runs(WINDOW, "")[first] + words.piece[first].astype(np.uint64) * SPREAD)
        order = np.argsort(runs)
        same = runs[order][1:] == runs[order][:-1]
        twice = first[order[np.append(same, False) | np.append(False, same)]] if len(first) else first
        covered = np.cumsum(np.bincount(twice, minlength=len(words.piece) + WINDOW) - np.bincount(twice + WINDOW, minlength=len(words.piece) + WINDOW))
        repeated = np.bincount(words.piece[covered[: len(words.piece)] > 0], minlength=len(texts))
    out = {"n_words": n_words.tolist(), "word_chars": [], "n_symbols": [], "n_dup_lines": [], "n_repeat_words": repeated.tolist()}
    for t in texts:
        out["word_chars"].append(len(t) - sum(map(t.count, " \t\n\x0b\x0c\r")))
        out["n_symbols"].append(sum(map(t.count, SYMBOLS)))
        lines = [x for x in t.split("\n") if x.strip(" \t\x0b\x0c\r")]
        out["n_dup_lines"].append(len(lines) - len(set(lines)))
    capitals = [len(b) - len(b.translate(None, CAPITALS)) for b in coded]
    out["base_failed"] = [n < LEAST_WORDS or 100 * r > MOST_REPEATED * n for n, r in zip(out["n_words"], out["n_repeat_words"])]
    prose = [WORDS_A_SYMBOL * s <= n and BYTES_A_CAPITAL * c <= len(b) for s, n, c, b in zip(out["n_symbols"], out["n_words"], capitals, coded)]
    out["teaches"] = [p and not f for p, f in zip(prose, out["base_failed"])]
    return out


class Chars:
    """Code points of texts, words with a space between, each between edges; n-grams end at the places ``ends``."""

    def __init__(self, texts: list[str]):
        bare = (EDGE * (ORDER - 1)).encode().join(b" ".join(t.encode("utf-8", "replace").split()) for t in texts).decode()
        self.codes = np.frombuffer((EDGE * (ORDER - 1) + bare + EDGE).encode("utf-32-le"), np.uint32)
        edge = self.codes == ord(EDGE)
        self.ends = np.flatnonzero(~edge[ORDER - 1 :] | ~edge[ORDER - 2 : -1]) + ORDER - 1
        # each text's last place is its edge; texts without a word have none
        self.sizes = np.diff(np.flatnonzero(edge[self.ends]), prepend=-1)

    def hashes(self, ends: np.ndarray, k: int, salt: int) -> np.ndarray:
        """Hashes of the k characters up to each of ``ends``."""
        out = np.full(len(ends), np.uint64(salt + k))
        for j in range(k):
            out = (out ^ self.codes[ends - j]) * SPREAD
        return mix(out)


def group_salt(lang: str, fold: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{fold} {lang}".encode()) >> 8


def grams(docs: DataFrame) -> DataFrame:
    """lang, fold, gram, n: how often each n-gram of ORDER stands in the texts of ``docs`` (lang, fold, text) that
    teach. A task adds up what it finds, HELD n-grams at most at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, fold), (_, n, codes) in held.items():
                text = codes.tobytes().decode("utf-32-le")
                cols = [pa.array([lang] * len(n), pa.string()), pa.array([fold] * len(n), pa.int32()), pa.array([text[i : i + ORDER] for i in range(0, len(text), ORDER)], pa.string()), pa.array(n)]
                yield pa.RecordBatch.from_arrays(cols, schema=GRAMS)
            held.clear()

        for batch in batches:
            for part in slices(batch, 2000, 4 << 20):
                cols, of = part.to_pydict(), {}
                for lang, fold, text, teaches in zip(cols["lang"], cols["fold"], cols["text"], base_counts(cols["text"])["teaches"]):
                    if teaches:
                        of.setdefault((lang, fold), []).append(text)
                for key, texts in of.items():
                    chars = Chars(texts)
                    for at in range(0, len(chars.ends), 4 * STEP):
                        ends = chars.ends[at : at + 4 * STEP]
                        h, first, n = np.unique(chars.hashes(ends, ORDER, 0), return_index=True, return_counts=True)
                        codes = chars.codes[ends[first][:, None] + np.arange(1 - ORDER, 1)]
                        if key in held:
                            h, first, to = np.unique(np.concatenate((held[key][0], h)), return_index=True, return_inverse=True)
                            n = np.bincount(to, np.concatenate((held[key][1], n))).astype(np.int64)
                            codes = np.concatenate((held[key][2], codes))[first]
                        held[key] = (h, n.astype(np.int64), codes)
                if sum(len(n) for _, n, _ in held.values()) > HELD:
                    yield from flushed()
        yield from flushed()
        released()

    return docs.select("lang", "fold", "text").mapInArrow(run, from_arrow_schema(GRAMS)).groupBy(*GROUP, "gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> DataFrame:
    """lang, fold and the three discounts of counts of one, two, and three or more, from how many n-grams have 1 to 4; something
    is left to shorter contexts always."""
    n = [F.sum(F.when(F.col("n") == j, 1).otherwise(0)).alias(f"n{j}") for j in (1, 2, 3, 4)]
    y = F.coalesce(F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")), F.lit(0.5))

    def d(j: int) -> Column:
        return F.greatest(F.lit(LEAST_DISCOUNT), F.least(F.lit(float(j)), F.coalesce(j - (j + 1) * y * F.try_divide(F.col(f"n{j + 1}"), F.col(f"n{j}")), F.lit(j / 2)))).alias(f"d{j}")

    return counts.groupBy(*GROUP).agg(*n).select(*GROUP, d(1), d(2), d(3))


def fixed(p: Column) -> Column:
    """A logarithm as an integer; probabilities of zero become those of 2 to the -64."""
    return F.round(F.greatest(F.log2(p), F.lit(-64.0)) * (1 << UNIT)).cast("int")


def model(counts: DataFrame) -> DataFrame:
    """lang, fold, kind, k, gram, value and, of the highest order, n of a modified Kneser-Ney model of the n-grams ``counts`` (lang, fold, gram, n).

    Rows of kind p have the logarithm of the interpolated probability of an n-gram's last character after the others; those
    of kind b the weight that the characters ``gram`` leave to shorter contexts. The empty n-gram stands for any character:
    one more than there are share what is left. Rows of n-grams are shared by few others, an alphabet at most."""
    levels = {ORDER: written(counts)}
    for k in range(ORDER - 1, 0, -1):
        levels[k] = levels[k + 1].groupBy(*GROUP, F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n"))
        if k > 2:
            levels[k] = written(levels[k])
    below = levels[1].groupBy(*GROUP).agg((1 / (F.count("*") + 1)).alias("p")).withColumn("gram", F.lit(""))
    out = [below.select(*GROUP, F.lit("p").alias("kind"), F.lit(0).alias("k"), "gram", fixed(F.col("p")).alias("value"), F.lit(None).cast("long").alias("n"))]
    for k in range(1, ORDER + 1):
        n = F.col("n")
        rows = levels[k].select(*GROUP, "gram", "n", F.substring("gram", 1, k - 1).alias("context"), F.substring("gram", 2, k - 1).alias("shorter"))
        kinds = [F.sum(F.when(c, 1).otherwise(0)).alias(f"c{j}") for j, c in ((1, n == 1), (2, n == 2), (3, n > 2))]  # integers, so that sums are exact
        contexts = rows.groupBy(*GROUP, "context").agg(F.sum("n").alias("total"), *kinds).join(small(discounts(levels[k]), 48), GROUP)
        contexts = written(contexts.withColumn("less_in_all", sum(F.col(f"d{j}") * F.col(f"c{j}") for j in (1, 2, 3))))
        shorter = below.select(*GROUP, F.col("gram").alias("shorter"), F.col("p").alias("below"))
        less = F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
        p = F.greatest((n - less) / F.col("total"), F.lit(0.0)) + F.col("less_in_all") / F.col("total") * F.col("below")
        below = written(rows.join(contexts, [*GROUP, "context"]).join(shorter, [*GROUP, "shorter"]).select(*GROUP, "gram", "n", p.alias("p")))
        out.append(below.select(*GROUP, F.lit("p"), F.lit(k), "gram", fixed(F.col("p")), F.when(F.lit(k == ORDER), F.col("n"))))
        out.append(contexts.select(*GROUP, F.lit("b"), F.lit(k - 1), "context", fixed(F.col("less_in_all") / F.col("total")), F.lit(None).cast("long")))
    rows = out[0]
    for other in out[1:]:
        rows = rows.union(other)
    found = written(rows)
    removed(*[levels[k] for k in range(3, ORDER + 1)])
    return found


class Hashes:
    """A sorted array of hashes with a value each, and where hashes with the same first bits begin."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.values = np.append(hashes[order], np.uint64(2**64 - 1)), np.append(values[order], 0).astype(np.int32)
        bits = max(1, len(hashes).bit_length())
        self.shift = np.uint64(64 - bits)
        self.begin = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is there, and its value, or 0."""
        at = self.begin[hashes >> self.shift]
        there = self.hashes[at]
        on = np.flatnonzero(there < hashes)
        while len(on):
            at[on] += 1
            there[on] = self.hashes[at[on]]
            on = on[there[on] < hashes[on]]
        hit = there == hashes
        return hit, np.where(hit, self.values[at], 0)


class Model:
    """The arrays of all languages and folds; ``table`` as of ``model``, all or the most frequent of it, its n-grams hashed in
    Spark tasks."""

    SCHEMA = pa.schema([("place", pa.int32()), ("hash", pa.int64()), ("value", pa.int32())])

    def __init__(self, table: DataFrame, whole: bool):
        self.whole = whole

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                c = batch.to_pydict()
                place = [2 * k + (kind == "b") for k, kind in zip(c["k"], c["kind"])]
                out = np.zeros(len(place), np.uint64)
                ks, salts = np.array(c["k"], np.int64), np.array([group_salt(g, f) for g, f in zip(c["lang"], c["fold"])], np.uint64)
                codes = np.frombuffer("".join(c["gram"]).encode("utf-32-le"), np.uint32)
                ends = np.cumsum(ks) - 1
                out = salts + ks.astype(np.uint64)
                for j in range(ORDER):
                    on = ks > j
                    out[on] = (out[on] ^ codes[ends[on] - j]) * SPREAD
                yield pa.RecordBatch.from_arrays([pa.array(place, pa.int32()), pa.array(mix(out).view(np.int64)), pa.array(c["value"], pa.int32())], schema=self.SCHEMA)

        rows = table.mapInArrow(run, from_arrow_schema(self.SCHEMA)).toArrow()
        place, hashes, values = (rows[c].to_numpy() for c in ("place", "hash", "value"))
        self.arrays = {p: Hashes(hashes[place == p].view(np.uint64), values[place == p]) for p in range(2 * ORDER + 1)}

    def learnt(self, chars: Chars, salt: int) -> bool:
        return bool(self.arrays[0].find(chars.hashes(chars.ends[:1], 0, salt))[0].all())

    def bits(self, chars: Chars, salt: int) -> tuple[np.ndarray, np.ndarray]:
        """The value of every place of ``chars``, and the places whose n-gram a model in part doesn't know."""
        out, unknown = np.zeros(len(chars.ends), np.int32), []
        for at in range(0, len(out), STEP):
            ends = chars.ends[at : at + STEP]
            rest, k, value = np.arange(len(ends)), ORDER, np.zeros(len(ends), np.int32)
            while len(rest):
                hit, found = self.arrays[2 * k].find(chars.hashes(ends[rest], k, salt))
                value[rest] += found
                rest = rest[~hit]
                if not self.whole:
                    unknown.append(at + rest)
                    break
                if len(rest):
                    value[rest] += self.arrays[2 * (k - 1) + 1].find(chars.hashes(ends[rest] - 1, k - 1, salt))[1]
                k -= 1
            out[at : at + STEP] = value
        return out, np.concatenate(unknown) if unknown else np.zeros(0, np.int64)


def millibits(total: Column, n: Column) -> Column:
    """Thousandths of a bit a character, from a sum of values."""
    return F.call_function("div", -total * 1000, n * (1 << UNIT)).cast("long")


def most_frequent(found: DataFrame, most: int) -> DataFrame:
    """The n-grams of ORDER with the highest counts, by powers of two, at most ``most`` rows, and the empty one of each group."""
    power = F.floor(F.log2("n"))
    rows = {r.power: r.rows for r in found.where(F.col("n").isNotNull()).groupBy(power.alias("power")).agg(F.count("*").alias("rows")).collect()}  # 64 at most
    least, n = 64, 0
    for p in sorted(rows, reverse=True):
        n += rows[p]
        if n > most:
            break
        least = p
    return found.where((F.col("n").isNotNull() & (power >= least)) | ((F.col("kind") == "p") & (F.col("k") == 0)))


def scored(docs: DataFrame, found: Model) -> DataFrame:
    """The columns of SCORED for each row of ``docs`` (doc_id, lang, fold, text); what is of the score is null where the base
    rules fail, and where the other fold taught nothing of the language. Rows with places that the model doesn't know have
    their text's hash."""
    sent = docs.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2000, 2 << 20):
                cols, none = part.to_pydict(), [None] * part.num_rows
                out = {"doc_id": cols["doc_id"], "lang": cols["lang"], "fold": cols["fold"], **base_counts(cols["text"]), **{c: list(none) for c in ("key", "known", "places", "rest")}}
                of: dict[tuple, list[int]] = {}
                for i, key in enumerate(zip(cols["lang"], cols["fold"])):
                    if not out["base_failed"][i]:
                        of.setdefault(key, []).append(i)
                for (lang, fold), rows in of.items():
                    chars, salt = Chars([cols["text"][i] for i in rows]), group_salt(lang, 1 - fold)
                    if not sent.value.learnt(chars, salt):
                        continue
                    bits, unknown = sent.value.bits(chars, salt)
                    begin = np.cumsum(chars.sizes) - chars.sizes
                    sums = np.add.reduceat(bits, begin, dtype=np.int64)
                    cuts = np.searchsorted(unknown, np.append(begin, len(bits)))
                    for j, i in enumerate(rows):
                        out["known"][i], out["places"][i] = int(sums[j]), int(chars.sizes[j])
                        if cuts[j] < cuts[j + 1]:
                            ends = chars.ends[unknown[cuts[j] : cuts[j + 1]]]
                            _, first, n = np.unique(chars.hashes(ends, ORDER, 0), return_index=True, return_counts=True)
                            said = chars.codes[ends[first][:, None] + np.arange(1 - ORDER, 1)].tobytes().decode("utf-32-le")
                            out["rest"][i] = [{"gram": said[k * ORDER : (k + 1) * ORDER], "n": m} for k, m in enumerate(n.tolist())]
                            out["key"][i] = xxhash.xxh3_128_digest(cols["text"][i].encode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in SCORED], schema=SCORED)
        released()

    return docs.select("doc_id", "lang", "fold", "text").mapInArrow(run, from_arrow_schema(SCORED))


def rest_of(rows: DataFrame, found: DataFrame) -> DataFrame:
    """lang, fold, key and the sum ``more`` of the n-grams that the rows ``rest``, a text once: joined to the model, and those
    that it lacks by ever shorter ones. N-grams that very many texts have meet a broadcast side."""
    at = [*GROUP, "gram"]
    texts = rows.where("key is not null").select(*GROUP, "key", "rest").dropDuplicates([*GROUP, "key"])
    rest = written(texts.select("lang", (1 - F.col("fold")).alias("fold"), "key", F.explode("rest").alias("r")).select(*GROUP, "key", "r.gram", "r.n", F.lit(0).alias("so_far")))
    sums = []
    for k in range(ORDER, -1, -1):
        model_rows = found.where((F.col("kind") == "p") & (F.col("k") == k)).select(*at, "value")
        both = written(with_side(rest, model_rows, at, "left"))
        sums.append(both.where("value is not null").groupBy(*GROUP, "key").agg(F.sum(F.col("n") * (F.col("so_far") + F.col("value"))).alias("more")))
        if k:
            weights = found.where((F.col("kind") == "b") & (F.col("k") == k - 1)).select(*GROUP, F.col("gram").alias("context"), F.col("value").alias("weight"))
            left = written(both.where("value is null").withColumn("context", F.substring("gram", 1, k - 1)).drop("value"))
            removed(rest)
            rest = written(with_side(left, weights, [*GROUP, "context"], "left").select("key", *GROUP, F.substring("gram", 2, k - 1).alias("gram"), "n", (F.col("so_far") + F.coalesce("weight", F.lit(0))).alias("so_far")))
            removed(left)
    every = sums[0]
    for other in sums[1:]:
        every = every.unionByName(other)
    return every.groupBy(*GROUP, "key").agg(F.sum("more").alias("more")).withColumn("fold", 1 - F.col("fold"))


def bands(rows: DataFrame, width: float = WIDTH) -> DataFrame:
    """lang, q1, q3, reach: the quartiles of each language's millibits, and how far its band reaches beyond them for long texts.
    Millibits are counted by value first, of which there are few thousand a language."""
    counts = rows.where("millibits is not null").groupBy("lang", "millibits").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("millibits"))
    total = F.sum("n").over(Window.partitionBy("lang"))
    at = counts.withColumns({"upto": upto, "total": total})
    q = at.groupBy("lang").agg(*[F.min(F.when(4 * F.col("upto") >= j * F.col("total"), F.col("millibits"))).alias(f"q{j}") for j in (1, 3)])
    return q.withColumn("reach", width * F.greatest(F.col("q3") - F.col("q1"), F.lit(LEAST_RANGE)))


def quality_rules(docs: DataFrame, model_rows: int = MODEL_ROWS, width: float = WIDTH) -> DataFrame:
    """doc_id, lang, the counts of BASE, base_failed, millibits, lower, upper and kept of each row of ``docs`` (doc_id, lang,
    text).

    A row is kept if it passes the base rules and its bits a character lie within its language's band, ends included, which
    reaches further for texts of few words. Null
    texts are empty, so that they fail; a null lang is ``und``. Where the other fold taught nothing of a language, millibits
    are null and the base rules decide. Texts are read whole, whatever their length; repeated rows give repeated rows with
    equal values, an empty table none; null doc_ids stay null, and other columns aren't read."""
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang"), text.alias("text"), F.pmod(F.xxhash64(text), F.lit(2)).cast("int").alias("fold"))
    found = model(grams(docs))
    whole = found.count() <= model_rows
    rows = written(scored(docs, Model(found if whole else most_frequent(found, model_rows), whole)))
    if not whole:
        more = written(rest_of(rows, found))
        none, one = rows.where("key is null").drop("rest"), rows.where("key is not null").drop("rest")
        rows = written(none.withColumn("more", F.lit(0).cast("long")).unionByName(with_side(one, more, [*GROUP, "key"])))
    removed(found)
    sum_ = F.col("known") + (F.lit(0) if whole else F.col("more"))
    rows = rows.select("doc_id", "lang", *BASE, "base_failed", millibits(sum_, F.col("places")).alias("millibits"))
    reach = F.round(F.col("reach") * (1 + F.sqrt(FEW_WORDS / F.greatest("n_words", F.lit(1))))).cast("long")
    rows = rows.join(small(bands(rows, width), 48), "lang", "left").withColumns({"lower": F.col("q1") - reach, "upper": F.col("q3") + reach})
    inside = F.col("millibits").isNull() | F.col("millibits").between(F.col("lower"), F.col("upper"))
    return rows.drop("q1", "q3", "reach").withColumn("kept", ~F.col("base_failed") & inside)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", *BASE, "base_failed", "kept", "millibits")
