"""Operator 8: byte-level BPE by tree reduction.

A text is halved until its parts are short; short parts are encoded on their own, and neighbours are joined on the way
up. Between a character that isn't white space and one that is, every scan of the pattern ends a match, whatever
stands before, and what follows depends on nothing before it. So the tokens left of the last such place in the left
part and right of the first such place in the right part stand, and the window between is encoded anew. It is doubled
around the seam until it has such a place on either side. Joining is associative, with the empty text as its unit.
Decoding concatenates the bytes of halves in the same way. That holds for patterns of which no match has white space
after another character.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stakeflow.llm.common import map_batches, table

#: Characters and tokens of the parts that are encoded and decoded at once.
LEAF = 256

SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


class TreeCodec:
    def __init__(self, ranks_file: str, pattern: str, leaf: int = LEAF):
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coder, self.leaf = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), max(1, leaf)

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, lo: int, hi: int) -> list[int]:
        if hi - lo <= self.leaf:
            return self.coder.encode_ordinary(text[lo:hi])
        mid = (lo + hi) // 2
        start, end = _window(text, lo, mid, hi)
        if start == lo and end == hi:  # nothing in it stands whatever is beside it
            return self.coder.encode_ordinary(text[lo:hi])
        if end - start > 4 * self.leaf:  # halves that meet where tokens stand need no window
            start = end = mid = start if start > lo else end
        left, right = self._encode(text, lo, mid), self._encode(text, mid, hi)
        return self._join(text, (start, mid, end), left, right)

    def _join(self, text: str, window: tuple[int, int, int], left: list[int], right: list[int]) -> list[int]:
        """The tokens of two neighbours from their own: those of the window around the seam are encoded anew."""
        start, mid, end = window
        if start == end:
            return left + right
        code = self.coder.encode_ordinary
        drop, skip = len(code(text[start:mid])), len(code(text[mid:end]))
        return left[: len(left) - drop] + code(text[start:end]) + right[skip:]

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= self.leaf:
            return self.coder.decode_bytes(ids)
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


def _window(text: str, lo: int, mid: int, hi: int) -> tuple[int, int]:
    """The window around a seam outside which tokens stand: it is doubled until it has such a place on either side, or
    reaches the ends."""
    start, end, reach = None, None, 8
    while start is None or end is None:
        if start is None:
            at = max(lo, mid - reach)
            start = next((i for i in range(mid - 1, at, -1) if _ends(text, i)), lo if at == lo else None)
        if end is None:
            at = min(hi, mid + reach)
            end = next((i for i in range(mid + 1, at) if _ends(text, i)), hi if at == hi else None)
        reach *= 2
    return start, end


def _ends(text: str, at: int) -> bool:
    """Whether every scan has a match that ends at ``at``."""
    return text[at].isspace() and text[at] not in _UNSURE and not (text[at - 1].isspace() or text[at - 1] in _UNSURE)


#: Characters that Python and the pattern's \s may take differently; no place beside them is relied on.
_UNSURE = frozenset("\x1c\x1d\x1e\x1f\x85\u180e\u200b\ufeff")


@lru_cache(maxsize=4)
def codec(ranks_file: str, pattern: str, leaf: int = LEAF) -> TreeCodec:
    return TreeCodec(ranks_file, pattern, leaf)


def encode_decode(docs: DataFrame, ranks_file: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the bytes they decode to, for every row of ``docs``.

    Null texts count as empty and have no tokens. Repeated rows give repeated rows; columns but doc_id and text are not
    read. Each row is encoded by itself, without a shuffle.
    """

    def run(cols: dict[str, list]) -> dict[str, list]:
        c = codec(ranks_file, pattern, leaf)
        ids = [c.encode(t or "") for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "n_tokens": [len(x) for x in ids], "ids": [np.asarray(x, "<u4").tobytes() for x in ids], "decoded": [c.decode(x) for x in ids]}

    return map_batches(docs.select("doc_id", "text"), run, SCHEMA)


def digests(encoded: DataFrame) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(cols: dict[str, list]) -> dict[str, list]:
        return {k: cols[k] for k in ("doc_id", "n_tokens")} | {f"{k}_sha256": [hashlib.sha256(x).hexdigest() for x in cols[k]] for k in ("ids", "decoded")}

    return map_batches(encoded, run, schema)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))
