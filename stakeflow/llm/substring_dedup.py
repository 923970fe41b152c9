"""Operator 5: repeated substrings by compacting a de Bruijn graph of words.

The graph's nodes are runs of ``window`` - 1 words, its edges the windows, each from its first words to its last. Most
windows occur once, and are left out first: consecutive windows of a document that share their least ``anchor``-word
hash are one row, and only those whose anchor also occurs in another document go on.

Edges that occur in several documents have a source: the place of their first window in the smallest document. Joining
the edges that enter a node to those that leave it gives the nodes with one of either; where these edges also stand side
by side at their sources, they are compacted, so that a nonbranching path is one row of the source's coordinates. What
other documents hold of a path becomes spans, and the words of every span are compared with those at its source, by a
digest that is taken at both places. Edges of spans that differ there, which only colliding hashes can bring, are told
apart again by digests of their words alone.

Copies of a whole text repeat all of it, so that only the first of equal texts takes part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stakeflow.llm.common import map_batches, removed, small, table, with_group, with_side, words_of, written
from stakeflow.llm.hashing import Runs, text_key, word_hashes

WINDOW, ANCHOR = 13, 6
#: Spans are cut at such places of their source, so that one source has few different spans.
CUT = 64
#: Ranges of documents are broadcast up to so many bytes, else shuffled.
BROADCAST_BYTES = 16 << 20


def _gathered(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All words of some texts, how many each has, and where each begins."""
    split = [words_of(t) for t in texts]
    lengths = np.array([len(w) for w in split], np.int64)
    return [w for one in split for w in one], lengths, lengths.cumsum() - lengths


def _anchored(words: list[bytes], lengths: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and number of windows of the runs of windows of one anchor, of documents one after
    another; first windows are counted over all words."""
    n = len(words) - window + 1
    h = Runs(word_hashes(words)[0]).all_of(anchor)
    width = window - anchor + 1
    least = h[:n].copy()
    for k in range(1, width):
        np.minimum(least, h[k : k + n], out=least)
    at = np.empty(n, np.int64)
    places = np.arange(n)
    for k in range(width - 1, -1, -1):  # the leftmost of equal anchors is written last
        same = h[k : k + n] == least
        at[same] = places[same] + k
    # windows that don't reach into the next document
    firsts = lengths.cumsum() - lengths
    inside = np.ones(len(words) + 1, bool)
    for end in (firsts + lengths)[lengths > 0]:
        inside[max(0, end - window + 1) : end] = False
    inside = np.flatnonzero(inside[:n])
    if not len(inside):
        return np.zeros(0, np.int64), inside, inside
    of = at[inside]
    breaks = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    starts = inside[breaks]
    return least[starts].view(np.int64), starts, np.diff(np.append(breaks, len(inside)))


def anchored(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """anchor, doc, at (first window in the high bits, number of windows in the low byte) of ``docs`` (doc_id, text)."""
    schema = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("at", pa.int64())])

    def run(cols: dict[str, list]) -> dict[str, list]:
        words, lengths, firsts = _gathered(cols["text"])
        if len(words) < window:
            return {name: [] for name in schema.names}
        least, at, n = _anchored(words, lengths, window, anchor)
        of = np.searchsorted(firsts, at, side="right") - 1
        return {"anchor": least, "doc": np.array(cols["doc_id"], np.int64)[of], "at": (at - firsts[of]) << 8 | n}

    return map_batches(docs.select("doc_id", "text"), run, schema)


def _ranges(rows: DataFrame) -> DataFrame:
    """The ranges (doc, pos, n) of each document as one row, joined where they touch, as numbers of which the low half is
    n; no more than a document has words. Marked for broadcast while they are few, by their measured size."""
    order = Window.partitionBy("doc").orderBy("pos", "n")
    end = F.max(F.col("pos") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    parts = rows.withColumn("new", F.when(F.col("pos") <= end, 0).otherwise(1)).withColumn("part", F.sum("new").over(order))
    parts = parts.groupBy("doc", "part").agg(F.min("pos").cast("long").alias("pos"), F.max(F.col("pos") + F.col("n")).alias("end"))
    by_doc = parts.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.shiftleft("pos", 32) + F.col("end") - F.col("pos")).alias("ranges"))
    return _sized(written(by_doc), F.size("ranges") * 8 + 32)


def _sized(by_doc: DataFrame, row_bytes) -> DataFrame:
    size = by_doc.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(by_doc) if size <= BROADCAST_BYTES else by_doc


def _unpacked(ranges: list[int]) -> list[tuple[int, int]]:
    return [(r >> 32, r & 0xFFFFFFFF) for r in ranges]


def edges(docs: DataFrame, ranges: DataFrame, window: int = WINDOW, bits: int = 64) -> DataFrame:
    """u, v, doc, pos: the nodes that the windows of ``docs`` within ``ranges`` (doc_id, ranges) go from and to."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("doc", pa.int64()), ("pos", pa.int32())])
    mask = np.uint64((1 << bits) - 1)

    def run(cols: dict[str, list]) -> dict[str, list]:
        words, _, firsts = _gathered(cols["text"])
        at = [np.concatenate([np.arange(p, p + n) for p, n in _unpacked(r)]) for r in cols["ranges"]]
        sizes = [len(x) for x in at]
        pos = np.concatenate(at)
        places = pos + np.repeat(firsts, sizes)
        runs = Runs(word_hashes(words)[0])
        u, v = ((runs.at(places + k, places + k + window - 1) & mask).view(np.int64) for k in (0, 1))
        return {"u": u, "v": v, "doc": np.repeat(np.array(cols["doc_id"], np.int64), sizes), "pos": pos}

    return map_batches(docs.select("doc_id", "text").join(ranges, "doc_id"), run, schema)


def compacted(sources: DataFrame) -> DataFrame:
    """doc, starts: at which places of a document the paths begin that the edges ``sources`` (u, v, doc, pos), at their
    sources, are compacted into. An edge continues the one before it if the node between has no other edge of either
    side, and both stand side by side."""
    place = F.struct("doc", "pos")
    out = sources.groupBy(F.col("u").alias("node")).agg(F.count("*").alias("n_out"), F.min(place).alias("next"))
    into = sources.groupBy(F.col("v").alias("node")).agg(F.count("*").alias("n_in"), F.min(place).alias("last"))
    single = out.join(into, "node").where("n_out = 1 and n_in = 1 and next.doc = last.doc and next.pos = last.pos + 1")
    starts = sources.select("doc", "pos").join(single.select("next.doc", "next.pos"), ["doc", "pos"], "left_anti")
    return starts.groupBy("doc").agg(F.array_sort(F.collect_list("pos")).alias("starts"))  # as many as it has words


def _spans(found: DataFrame) -> DataFrame:
    """doc, pos, n, sdoc, spos: runs of windows of ``found`` that stand side by side in the document and at their source."""
    order = Window.partitionBy("doc").orderBy("pos")
    same = (F.lag("pos").over(order) == F.col("pos") - 1) & (F.lag("sdoc").over(order) == F.col("sdoc")) & (F.lag("spos").over(order) == F.col("spos") - 1)
    runs = found.withColumn("new", F.when(same, 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    return runs.groupBy("doc", "run").agg(F.min("pos").alias("pos"), F.count("*").cast("int").alias("n"), F.min("sdoc").alias("sdoc"), F.min("spos").alias("spos")).drop("run")


def _pieces(spans: DataFrame, paths: DataFrame) -> DataFrame:
    """The spans cut where a path of their source begins, and at every ``CUT``-th place of it."""
    cut = with_side(spans, paths.withColumnRenamed("doc", "sdoc"), ["sdoc"])
    end = F.col("spos") + F.col("n")
    inner = F.filter("starts", lambda s: (s > F.col("spos")) & (s < end))
    regular = F.filter(F.transform(F.sequence(F.floor(F.col("spos") / CUT), F.floor(end / CUT)), lambda k: (k * CUT).cast("int")), lambda s: (s > F.col("spos")) & (s < end))
    starts = F.array_sort(F.array_distinct(F.concat(F.array("spos"), inner, regular)))
    each = cut.select("doc", "pos", "spos", "sdoc", end.alias("end"), F.posexplode(starts).alias("k", "s"), starts.alias("all"))
    nxt = F.coalesce(F.try_element_at("all", F.col("k") + 2), F.col("end"))
    return each.select("doc", (F.col("pos") + F.col("s") - F.col("spos")).alias("pos"), (nxt - F.col("s")).alias("n"), "sdoc", F.col("s").alias("spos"))


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _digests(docs: DataFrame, places: DataFrame, window: int) -> DataFrame:
    """Adds the digest of their words to ``places`` (doc, pos, n, sdoc, spos), a place being n windows of a document."""
    schema = pa.schema([("doc", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()), ("sdoc", pa.int64()), ("spos", pa.int32()), ("digest", pa.binary())])
    by_doc = written(places.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(F.struct("pos", "n", "sdoc", "spos")).alias("places")))

    def run(cols: dict[str, list]) -> dict[str, list]:
        out = []
        for doc, text, some in zip(cols["doc_id"], cols["text"], cols["places"]):
            words = words_of(text)
            out += [(doc, p["pos"], p["n"], p["sdoc"], p["spos"], _digest(words[p["pos"] : p["pos"] + p["n"] + window - 1])) for p in some]
        return dict(zip(schema.names, map(list, zip(*out)))) if out else {k: [] for k in schema.names}

    return map_batches(docs.select("doc_id", "text").join(_sized(by_doc, F.size("places") * 64 + 32), "doc_id"), run, schema)


def repeated(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, bits: int = 64) -> DataFrame:
    """doc, pos, n: windows of ``docs`` (doc_id, text) whose words also start a window in a document of smaller id.

    ``docs`` holds no two documents of equal words. Nodes are told apart by hashes of ``bits`` bits; the result is the
    same for any, as words are compared.
    """
    rows = written(anchored(docs, window, anchor))
    shared = with_group(rows, ["anchor"], {"lo": F.min("doc"), "hi": F.max("doc")}, F.col("lo") < F.col("hi"))
    ranges = _ranges(shared.select("doc", F.shiftright("at", 8).cast("int").alias("pos"), (F.col("at").bitwiseAND(255)).cast("int").alias("n")))
    windows = written(edges(docs, ranges, window, bits))
    removed(rows, ranges)
    source = F.min(F.struct("doc", "pos"))
    known = with_group(windows, ["u", "v"], {"source": source, "last": F.max("doc")}, F.col("source.doc") < F.col("last"))
    known = written(known.select("u", "v", "doc", "pos", F.col("source.doc").alias("sdoc"), F.col("source.pos").alias("spos")))
    removed(windows)
    paths = compacted(known.where("doc = sdoc and pos = spos").select("u", "v", "doc", "pos"))
    spans = written(_spans(known.where("doc > sdoc").select("doc", "pos", "sdoc", "spos")))
    pieces = written(_pieces(spans, paths))
    at_source = pieces.select("sdoc", "spos", "n").distinct().select(F.col("sdoc").alias("doc"), F.col("spos").alias("pos"), "n", "sdoc", "spos")
    seen = _digests(docs, pieces.unionByName(at_source), window)
    differ = written(seen.groupBy("sdoc", "spos", "n").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select("sdoc", "spos", "n"))
    removed(spans)
    if differ.isEmpty():
        removed(known)
        return pieces.select("doc", "pos", "n")
    # hashes collide: the edges of such spans again, by their words
    places = differ.select("sdoc", F.explode(F.sequence("spos", F.col("spos") + F.col("n") - 1)).alias("spos")).distinct()
    colliding = known.join(places, ["sdoc", "spos"]).select("u", "v").distinct()
    again = with_side(known, colliding, ["u", "v"], "left_semi").select("doc", "pos", F.lit(1).alias("n"), F.col("doc").alias("sdoc"), F.col("pos").alias("spos"))
    by_words = written(_digests(docs, again, window).select("digest", "doc", "pos", "n"))
    exact = with_group(by_words, ["digest"], {"lo": F.min("doc")}, F.col("doc") > F.col("lo")).select("doc", "pos", "n")
    return pieces.join(differ, ["sdoc", "spos", "n"], "left_anti").select("doc", "pos", "n").unionByName(exact)


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, bits: int = 64) -> DataFrame:
    """doc_id, n_words, n_removed, kept (its words, joined by a space) of every row of ``docs`` (doc_id, text).

    Words are runs of anything but ASCII white space, unchanged. A word goes if a window that covers it has the words of
    a window of a document of smaller doc_id; what goes elsewhere doesn't matter. Null and empty texts have no words.
    Rows of one doc_id are taken to be copies of one row, and keep the same words. Rows with a null doc_id keep all. An
    empty table gives none; columns but doc_id and text are not read.
    """
    known = docs.where("doc_id is not null").select("doc_id", "text")
    keyed = pa.schema([("doc_id", pa.int64()), ("key", pa.binary())])

    def keys(cols: dict[str, list]) -> dict[str, list]:
        got = [(d, text_key(w)) for d, t in zip(cols["doc_id"], cols["text"]) if len(w := words_of(t)) >= window]
        return {"doc_id": [d for d, _ in got], "key": [k for _, k in got]}

    texts = written(map_batches(known, keys, keyed))
    several = with_group(texts, ["key"], {"first": F.min("doc_id")}, F.col("doc_id") > F.col("first"))
    copies = small(several.select("doc_id").distinct(), 16)
    removed(texts)
    # of rows of one doc_id, one takes part
    once = known.join(copies, "doc_id", "left_anti")
    ranges = _ranges(repeated(once, window, anchor, bits))
    marked = docs.select("doc_id", "text").join(copies.withColumn("copy", F.lit(True)), "doc_id", "left").join(ranges, "doc_id", "left")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(cols: dict[str, list]) -> dict[str, list]:
        n, gone, kept = [], [], []
        for text, copy, some in zip(cols["text"], cols["copy"], cols["ranges"]):
            words = words_of(text)
            n.append(len(words))
            if copy:
                words = []
            elif some:
                change = np.zeros(len(words) + 1, np.int64)
                for p, n_windows in _unpacked(some):
                    change[p] += 1
                    change[p + n_windows - 1 + window] -= 1
                words = [words[i] for i in np.flatnonzero(change.cumsum()[:-1] == 0)]
            gone.append(n[-1] - len(words))
            kept.append(b" ".join(words).decode())
        return {"doc_id": cols["doc_id"], "n_words": n, "n_removed": gone, "kept": kept}

    return map_batches(marked.select("doc_id", "text", "copy", "ranges"), run, schema)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)
), first AS (SELECT g, min(doc_id) AS source FROM g GROUP BY g HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM g JOIN first USING (g), range(0, 13) r(k) WHERE doc_id > source
), kept AS (
  SELECT x.doc_id, x.i, x.word, gone.i IS NOT NULL AS gone
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w) x LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.i = x.i
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w LEFT JOIN (
  SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM kept GROUP BY doc_id
) k ON k.doc_id = w.doc_id
"""
