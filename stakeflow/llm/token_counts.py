"""Operator 1: exact token counts of every prefix of a text, by dynamic programming.

The tokens of a text under piece-pair merging are the only sequence of vocabulary pieces in which each piece stands
alone as itself and every two neighbours stay apart when their concatenation is encoded. So the last piece of a
prefix follows from the last pieces of shorter prefixes: it is the one piece that ends there, and goes with the last
piece of the prefix before it. One step to the right costs a few look-ups, and the count of each prefix is one more
than that of the prefix it extends.

No piece spans a change from another character to the word mark, nor a line feed, so that texts fall into units whose
counts add up; units recur, and a worker keeps what it has computed for short ones. What is stored for a document is
one signed byte per character: by how much the count changes when the prefix grows by it. ``count_at`` and
``longest_prefix`` answer truncation and budget questions from these bytes alone.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stakeflow.llm.common import map_batches, table

MARK = "▁"
#: Units of more characters are not kept; at most so many units and pairs are kept per worker.
KEPT_UNIT, KEPT = 48, 400_000

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("prefix_steps", pa.binary())])


class PrefixCounter:
    """Prefix counts under a sentencepiece BPE model whose normaliser is the identity."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        normal = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        normal.sort(key=lambda i: (-sp.get_score(i), i))
        self.rank = {sp.id_to_piece(i): n for n, i in enumerate(normal)}
        pieces = list(self.rank)
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces hold the word mark after other characters")
        alone = "" if any("\n" in p and len(p) > 1 for p in pieces) else "\n"
        self.units = re.compile(f"{MARK}*[^{MARK}{alone}]+|{MARK}+" + (alone and f"|{alone}"))
        self.longest = max(map(len, pieces))
        #: The two parts of a piece's last merge; None for one character. Pieces that are not encoded as themselves go.
        self.parts: dict[str, tuple[str, str] | None] = {}
        self.ends: set[str] = set()
        for p in pieces:
            if len(p) == 1:
                self.parts[p] = None
                self.ends.add(p)
            elif (last := self._last_merge(p)) is not None:
                self.parts[p] = last
                self.ends.add(p)
        self._pairs: dict[tuple[str, str], bool] = {}
        self._known: dict[str, bytes] = {}

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The pair that merges last when ``piece`` is encoded, None if it isn't encoded as itself."""
        got, last = list(piece), None
        while len(got) > 1:
            best = min(((r, i) for i in range(len(got) - 1) if (r := self.rank.get(got[i] + got[i + 1])) is not None), default=None)
            if best is None:
                return None
            last = (got[best[1]], got[best[1] + 1])
            got[best[1] : best[1] + 2] = ["".join(last)]
        return last

    def apart(self, a: str, b: str) -> bool:
        """Whether the pieces a and b stay apart: undo their merges, the latest first, and see that none across wins."""
        ra, rb = self.rank.get(a, -1), self.rank.get(b, -1)
        limit = 1 << 60
        while True:
            across = self.rank.get(a + b)
            if across is not None and across < limit:
                return False
            left, right = self.parts.get(a), self.parts.get(b)
            if left is None and right is None:
                return True
            if right is None or (left is not None and ra > rb):
                limit, a = ra, left[1]  # of equal pairs the left one merges first
                ra = self.rank.get(a, -1)
            else:
                limit, b = rb + 1, right[0]
                rb = self.rank.get(b, -1)

    def _unit(self, unit: str) -> bytes:
        """The steps of a unit's prefix counts."""
        last, count, out = [""], [0], bytearray()
        ends, pairs, longest = self.ends, self._pairs, self.longest
        for i in range(1, len(unit) + 1):
            for j in range(i - 1, max(-1, i - longest - 1), -1):
                piece = unit[j:i]
                if piece in ends:
                    if j == 0:
                        break
                    key = (last[j], piece)
                    ok = pairs.get(key)
                    if ok is None:
                        if len(pairs) >= KEPT:
                            pairs.clear()
                        ok = pairs[key] = self.apart(*key)
                    if ok:
                        break
            else:  # no piece ends here: the character is written as its bytes
                j, piece = i - 1, unit[i - 1]
                count.append(count[j] + len(piece.encode()))
                last.append(piece)
                out.append((count[i] - count[i - 1]) & 255)
                continue
            last.append(piece)
            count.append(count[j] + 1)
            out.append((count[i] - count[i - 1]) & 255)
        return bytes(out)

    def steps(self, text: str | None) -> bytes:
        """A signed byte for the mark before the text and one for each character; empty for an empty text."""
        if not text:
            return b""
        known, out = self._known, []
        for unit in self.units.findall(MARK + text.replace(" ", MARK)):
            got = known.get(unit)
            if got is None:
                got = self._unit(unit)
                if len(unit) <= KEPT_UNIT:
                    if len(known) >= KEPT:
                        known.clear()
                    known[unit] = got
            out.append(got)
        return b"".join(out)


def counts(steps: bytes) -> np.ndarray:
    """The token count of each prefix, by its length in characters from 0 on."""
    if not steps:
        return np.zeros(1, np.int64)
    got = np.frombuffer(steps, np.int8).cumsum(dtype=np.int64)
    got[0] = 0
    return got


def count_at(steps: bytes, n_chars: int) -> int:
    """Tokens of the first ``n_chars`` characters."""
    return int(np.frombuffer(steps, np.int8, n_chars + 1).sum(dtype=np.int64)) if n_chars and steps else 0


def longest_prefix(steps: bytes, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(counts(steps) <= budget)[-1])


@lru_cache(maxsize=4)
def counter(model_file: str) -> PrefixCounter:
    return PrefixCounter(model_file)


def prefix_counts(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens and prefix_steps of every row of ``docs`` (doc_id, text).

    Null texts count as empty: no bytes, no tokens, no steps. Repeated rows give repeated rows; other columns are
    not read. There is no shuffle, and nothing but a bounded table of units is kept between rows.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        c = counter(model_file)
        steps = [c.steps(t) for t in cols["text"]]
        return {
            "doc_id": cols["doc_id"],
            "n_bytes": [len((t or "").encode()) for t in cols["text"]],
            "n_tokens": [int(np.frombuffer(s, np.int8).sum(dtype=np.int64)) for s in steps],
            "prefix_steps": steps,
        }

    return map_batches(docs.select("doc_id", "text"), run, SCHEMA)


def token_budget(docs: DataFrame, model_file: str, budget: int) -> DataFrame:
    """Per row of ``docs`` its counts, whether it is over ``budget`` tokens, and how many of its characters are within; from
    the steps of its prefixes, in the stage that finds them. Rows as in ``prefix_counts``."""
    schema = pa.schema([*SCHEMA][:3] + [("over_limit", pa.bool_()), ("chars_within_limit", pa.int64())])

    def run(cols: dict[str, list]) -> dict[str, list]:
        c = counter(model_file)
        steps = [c.steps(t) for t in cols["text"]]
        n = [count_at(s, max(0, len(s) - 1)) for s in steps]
        over = [x > budget for x in n]
        within = [longest_prefix(s, budget) if o else max(0, len(s) - 1) for o, s in zip(over, steps)]
        return {"doc_id": cols["doc_id"], "n_bytes": [len((t or "").encode()) for t in cols["text"]], "n_tokens": n, "over_limit": over, "chars_within_limit": within}

    return map_batches(docs.select("doc_id", "text"), run, schema)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_budget(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), 4096)
