"""Operator 6: benchmark decontamination by pigeonhole edit matching.

A document is contaminated by a test item if some run of its words is within the item's error budget of it: a share of
its words may be replaced, left out or put in. An item is cut into one piece more than its budget; at most ``budget``
edits leave some piece as it is, so every match holds an exact hit of a piece. Hits are looked up by their first two
words; around each, Myers's bit-parallel distance over words decides.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.llm.common import map_batches, table, written

#: Share of an item's words that may differ.
ERROR_RATE = 0.15
#: Items are sent to the executors in blocks of about so many bytes.
BLOCK_BYTES = 32 << 20

#: Scripts without spaces between words, of which every character is a word.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+")

SCHEMA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int64())])


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def nearest(pattern: list[str], text: list[str]) -> tuple[int, int]:
    """The least edit distance of ``pattern`` to a run of ``text``, and where the first such run ends."""
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << i
    ones, top = (1 << m) - 1, 1 << m - 1
    up, down, score = ones, 0, m
    best, end = m, 0
    for at, w in enumerate(text, 1):
        eq = masks.get(w, 0)
        x = eq | down
        flat = ((((eq & up) + up) ^ up) | eq) & ones
        plus = (down | ~(flat | up)) & ones
        minus = up & flat
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = plus << 1 & ones  # a run may begin anywhere, so nothing is carried into the first row
        minus = minus << 1 & ones
        up = (minus | ~(x | plus)) & ones
        down = plus & x
        if score < best:
            best, end = score, at
    return best, end


class Items:
    """Texts of test items by the first two words of their pieces, or by the one word that an item has."""

    def __init__(self, items: list[tuple[int | None, str]], error_rate: float):
        self.items: list[tuple[int | None, list[str], int]] = []
        self.heads: dict[str, dict[str | None, list[tuple[int, int, list[str]]]]] = {}
        for key, text in items:
            w = words(text)
            if not w:
                continue
            # pieces have two words at least, but for an item of one
            budget = max(0, min(math.floor(error_rate * len(w)), len(w) // 2 - 1))
            cuts = [i * len(w) // (budget + 1) for i in range(budget + 2)]
            for a, b in zip(cuts, cuts[1:]):
                self.heads.setdefault(w[a], {}).setdefault(w[a + 1] if b > a + 1 else None, []).append((len(self.items), a, w[a:b]))
            self.items.append((key, w, budget))

    def matches(self, text: str | None) -> Iterator[tuple[int | None, int, int, int]]:
        """item, distance, first word and number of words of each item's best match in a text, the first of equals."""
        w = words(text)
        heads, none, found, tried = self.heads, (), {}, set()
        for at, x in enumerate(w):
            if (by := heads.get(x)) is None:
                continue
            for hits in (by.get(w[at + 1], none) if at + 1 < len(w) else none, by.get(None, none)):
                for number, offset, piece in hits:
                    start = at - offset
                    if w[at : at + len(piece)] != piece or (number, start) in tried:
                        continue
                    tried.add((number, start))
                    key, item, budget = self.items[number]
                    lo, hi = max(0, start - budget), start + len(item) + budget
                    distance, end = nearest(item, w[lo:hi])
                    if distance <= budget:
                        _, length = nearest(item[::-1], w[lo : lo + end][::-1])
                        match = (distance, lo + end - length, length)
                        found[key] = min(found.get(key, match), match)
        for key, match in found.items():
            yield key, *match


def contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for every pair of a document (doc_id, text) and a test item (item_id, text) that it holds: doc_id, item_id,
    the distance, and the place of the nearest run of words, the first of equals.

    Words are runs of letters, digits and underscores, lower-cased; in scripts without spaces every character is one. Of
    a long item a share of ``error_rate`` of its words may differ; a short one must stand there word by word. Null and
    empty texts match nothing. Texts under one item_id, null included, are one item, of which the best match counts.
    Repeated documents give repeated rows; an empty table on either side gives none, and other columns are not read.

    The items are sent to the executors. Where they are more than ``block_bytes``, they go in blocks, one after another:
    each goes over the documents, its matches are written down, and it is freed, so that the driver holds one block.
    """
    items = benchmark.select("item_id", "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(2 * size / block_bytes)) if size > block_bytes else 1
    of = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    out = None
    for block in range(blocks):
        sent = docs.sparkSession.sparkContext.broadcast(Items([tuple(r) for r in items.where(of == block).orderBy("item_id", "text").collect()], error_rate))

        def run(cols: dict[str, list], sent=sent) -> dict[str, list]:
            got = [(d, *m) for d, t in zip(cols["doc_id"], cols["text"]) for m in sent.value.matches(t)]
            return dict(zip(SCHEMA.names, map(list, zip(*got)))) if got else {k: [] for k in SCHEMA.names}

        found = map_batches(docs.select("doc_id", "text"), run, SCHEMA)
        if blocks > 1:
            found = written(found)
            sent.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
