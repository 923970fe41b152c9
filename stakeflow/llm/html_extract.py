"""Operator 2: main text of pages by the consensus of each host's pages.

Every page scores its containers, and votes: for the tag-class path of its best one, and on each of its paths, with the
text and the heading that stand there. Paths are generalised: classes without digits, and hashed, so that
deep nesting costs nothing. Spark adds up the votes of each host. What a host's pages say of a path decides:

* the path that most of them hold their text at is extracted, and where a page has none, its own best container;
* a path at which pages of different headings show the same text is boilerplate;
* a path whose class, id or role is a boilerplate word, on pages of several headings, is left out of the article if its text
  is mostly links, or if it stands behind all other text of the article on most pages.

A word alone leaves nothing out of an article; it keeps an element from counting when containers are scored. Then every page is extracted again by its host's paths. Hosts' paths are broadcast while their size, which is measured,
is below a bound, and shuffled beyond it.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stakeflow.llm.common import map_batches, table, with_side, written

# Kinds of HTML elements.
CONTAINERS = frozenset("article main section div body td center".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table tr th tbody thead tfoot caption figure figcaption address hr details summary fieldset html".split())
DROPPED = frozenset("head script style noscript template nav footer aside button select textarea iframe object svg canvas dialog menu header title".split())
RAW = frozenset("script style textarea title noscript iframe".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An element of a group closes the last open one of it, unless one of the fence is open within that.
GROUPS = (({"li"}, {"ul", "ol"}), ({"td", "th"}, {"tr", "table"}), ({"tr"}, {"table"}), ({"dt", "dd"}, {"dl"}))
#: Whole classes, ids and roles that hint at what isn't the article, where the host's pages have no heading there.
BOILERPLATE = frozenset(
    "ad ads advert advertisement adverts adsense sponsor sponsored promo promoted banner cookie cookies consent gdpr notice notices alert popup modal overlay sidebar rail menu menubar nav navbar navigation breadcrumb breadcrumbs header masthead footer comment comments reply replies disqus share sharing social follow related recommended newsletter subscribe subscription signup login search widget toolbar pagination pager complementary contentinfo".split()
)
#: A quote opens a value only after an equals sign; elsewhere, and inside a value without quotes, it is a character.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][^\s/>]*)((?>[^>=]|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s\"'>][^\s>]*|(?=>|\Z)))*+)(?:>|\Z)|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"([^\s=/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s]+)))?")
NAMES = frozenset(("class", "id", "role"))
CLOSING = {tag: re.compile(rf"</{tag}\b", re.I) for tag in RAW}

#: Hosts' paths of at most so many bytes are broadcast.
BROADCAST_BYTES = 16 << 20
#: A path needs pages of so many headings, and this share of the host's, for its text to count.
HEADINGS, SHARE = 3, 0.01
#: The share of pages on which a hinted path stands behind the article's text.
BEHIND = 0.9
#: Shares of the page's text that its best container holds: an article, and any other.
ARTICLE_HOLDS, HOLDS = 0.5, 0.9


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))


class Page:
    """The elements of a page and its blocks of text, in order; an element comes after the one that it stands in."""

    def __init__(self, source: str | None):
        self.parent: list[int] = [-1]
        self.path: list[int] = [0]
        self.tag: list[str] = [""]
        self.hinted: list[bool] = [False]
        self.dropped: list[bool] = [False]
        self.blocks: list[tuple[str, int, int]] = []  # text, its characters in links, element
        self.heading = ""
        self._run(source or "")

    def _run(self, source: str) -> None:
        stack = [0]
        open_at: dict[str, list[int]] = defaultdict(list)  # where in the stack each tag is open
        text: list[str] = []
        linked = links = 0
        raw = ""

        def flush() -> None:
            nonlocal linked
            if text:
                joined = " ".join("".join(text).split())
                if joined:
                    self.blocks.append((joined, min(linked, len(joined)), stack[-1]))
                    if self.tag[stack[-1]] == "h1" and not self.heading:
                        self.heading = joined
                text.clear()
            linked = 0

        def pop() -> None:
            open_at[self.tag[stack.pop()]].pop()

        at, n = 0, len(source)
        while at < n:
            if raw:
                end = CLOSING[raw].search(source, at)
                at, raw = end.start() if end else n, ""
                continue
            m = TOKEN.match(source, at)
            at = m.end()
            tag = m[1]
            if tag is None:
                if not self.dropped[stack[-1]] and (s := m[0])[:2] not in ("<!", "<?"):
                    s = html.unescape(s)
                    text.append(s)
                    linked += len(s) if links else 0
                continue
            if source[at - 1] != ">":
                break  # the page ends inside a tag
            tag = tag.lower()
            closing = source[m.start() + 1] == "/"
            if tag == "br":
                text.append(" ")
                continue
            if tag == "a":
                links = not closing
                continue
            known = tag in BLOCKS or tag in DROPPED or tag == "form"
            if closing:
                if open_at[tag]:
                    if known:
                        flush()
                    while self.tag[stack[-1]] != tag:
                        pop()
                    pop()
                continue
            names = [(k.lower(), c) for k, a, b, d in ATTRIBUTE.findall(m[2]) if k.lower() in NAMES for c in (a or b or d).lower().split()] if m[2] else []
            hinted = any(c in BOILERPLATE for _, c in names)
            if not known and not hinted:
                continue
            flush()
            if tag in VOID:
                continue
            while tag in BLOCKS and self.tag[stack[-1]] in PARAGRAPHS:
                pop()
            for group, fence in GROUPS:
                if tag in group:
                    last = max((open_at[t][-1] for t in group | fence if open_at[t]), default=0)
                    if last and self.tag[stack[last]] in group:
                        while len(stack) > last:
                            pop()
            inside = open_at["article"] or open_at["main"]
            up = stack[-1]
            classes = ".".join(sorted(re.sub(r"\d+", "#", c) for k, c in names if k == "class"))
            self.parent.append(up)
            self.path.append(_hash(f"{self.path[up]}/{tag}.{classes}"))
            self.tag.append(tag)
            self.hinted.append(hinted and tag not in ("html", "body", "article", "main"))
            self.dropped.append(self.dropped[up] or tag in DROPPED and not (tag == "header" and inside))
            open_at[tag].append(len(stack))
            stack.append(len(self.path) - 1)
            if tag in RAW:
                raw = tag
        flush()
        if "form" in self.tag:
            self._forms()

    def _forms(self) -> None:
        """Drops forms, but for those around the page's heading or article, or half of the text of a page without either."""
        sums = self.sums(self.dropped)
        holds = [t in ("h1", "article", "main") and not d and n > 0 for t, d, n in zip(self.tag, self.dropped, sums)]
        most = 2.0 if any(holds) else 0.5
        for e in range(len(holds) - 1, 0, -1):
            holds[self.parent[e]] |= holds[e]
        for e in range(1, len(holds)):
            self.dropped[e] |= self.dropped[self.parent[e]] or self.tag[e] == "form" and not holds[e] and sums[e] < max(most * sums[0], 1)
        self.blocks = [b for b in self.blocks if not self.dropped[b[2]]]

    def off(self, drop: frozenset = frozenset(), keep: frozenset = frozenset()) -> list[bool]:
        """Which elements are left out: hinted ones without the page's heading, but for the paths ``keep``, and ``drop``."""
        headed = [False] * len(self.path)
        for _, _, e in self.blocks:
            if self.tag[e] == "h1":
                while e >= 0 and not headed[e]:
                    headed[e] = True
                    e = self.parent[e]
        out = self.dropped.copy()
        for e in range(1, len(out)):
            out[e] = out[e] or out[self.parent[e]] or self.path[e] in drop or self.hinted[e] and not headed[e] and self.path[e] not in keep
        return out

    def sums(self, off: list[bool]) -> list[float]:
        """The characters outside links of each element."""
        out = [0.0] * len(self.path)
        for text, linked, e in self.blocks:
            if not off[e]:
                out[e] += len(text) - linked
        for e in range(len(out) - 1, 0, -1):
            out[self.parent[e]] += out[e]
        return out

    def best(self, off: list[bool]) -> tuple[int, float] | None:
        """The best container and its share of the text: an article or main element that holds half of it, else the
        innermost container that holds nine tenths; None for a page without text there."""
        sums = self.sums(off)
        if not sums[0]:
            return None
        for kinds, share in ((("article", "main"), ARTICLE_HOLDS), (CONTAINERS, HOLDS)):
            found = [e for e, tag in enumerate(self.tag) if tag in kinds and sums[e] >= share * sums[0]]
            if found:
                e = max(found, key=lambda e: (e if share == HOLDS else sums[e], e))
                return e, sums[e] / sums[0]
        return None

    def votes(self) -> list[tuple[int, float, int, int, bool, bool, int, int, bool]]:
        """For each path with text: weight as the page's best, hashes of heading and text, whether it is hinted, whether the
        heading stands there, its characters, those in links, and whether it stands behind all text that isn't hinted of
        the page's best container."""
        off = self.off()
        best = self.best(off)
        size = len(self.path)
        chars, linked, texts, headed, first = [0] * size, [0] * size, [0] * size, [False] * size, [len(self.blocks)] * size
        within = [best is not None and e == best[0] for e in range(size)]
        for e in range(1, size):
            within[e] = within[e] or within[self.parent[e]]
        last = -1
        for i, (text, links, e) in enumerate(self.blocks):
            chars[e] += len(text)
            linked[e] += links
            texts[e] += _hash(text)
            headed[e] |= self.tag[e] == "h1"
            first[e] = min(first[e], i)
            if within[e] and not off[e]:
                last = i
        for e in range(size - 1, 0, -1):
            up = self.parent[e]
            chars[up] += chars[e]
            linked[up] += linked[e]
            texts[up] += texts[e]
            headed[up] |= headed[e]
            first[up] = min(first[up], first[e])
        heading = _hash(self.heading) if self.heading else texts[0]
        by: dict[int, list] = {}
        for e in range(1, size):
            if not self.dropped[e] and chars[e]:
                row = by.setdefault(self.path[e], [0.0, 0, False, False, 0, 0, True])
                row[1] += texts[e]
                row[2] |= self.hinted[e]
                row[3] |= headed[e]
                row[4] += chars[e]
                row[5] += linked[e]
                row[6] &= within[e] and first[e] > last
        if best and self.path[best[0]] in by:
            by[self.path[best[0]]][0] = best[1]
        return [(_signed(p), w, _signed(heading & _MASK), _signed(t & _MASK), *rest) for p, (w, t, *rest) in by.items()]

    def text(self, winner: int | None, drop: frozenset = frozenset(), keep: frozenset = frozenset()) -> str:
        """The blocks at the path ``winner``, else those of the page's best container, without the paths ``drop``; where a page
        has no container, all blocks but hinted ones. Hints count as long as some text has none."""
        off = self.off(drop, keep)
        at = [p == winner for p in self.path]
        if not any(at[e] and not off[e] for e in range(1, len(at))):
            if best := self.best(off):
                at[best[0]] = True
            elif best := self.best(self.dropped):  # all of the text is hinted
                at[best[0]], off = True, self.dropped
        out = self.dropped.copy()
        for e in range(1, len(at)):
            at[e] = at[e] and not off[e] or at[self.parent[e]]
            out[e] = out[e] or out[self.parent[e]] and at[self.parent[e]] or self.path[e] in drop
        found = [t for t, _, e in self.blocks if at[e] and not out[e]]
        return "\n".join(found or [t for t, _, e in self.blocks if not off[e]])


_MASK = (1 << 64) - 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def host(url: Column) -> Column:
    """The host of a URL, lower-cased, without user and port; empty if there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def votes(pages: DataFrame) -> DataFrame:
    """host and what each page says of each of its paths."""
    schema = pa.schema([("host", pa.string()), ("path", pa.int64()), ("weight", pa.float64()), ("heading", pa.int64()), ("text", pa.int64()), ("hinted", pa.bool_()), ("headed", pa.bool_()), ("chars", pa.int64()), ("linked", pa.int64()), ("behind", pa.bool_())])

    def run(cols: dict[str, list]) -> dict[str, list]:
        got = [(h, *v) for h, source in zip(cols["host"], cols["html"]) for v in Page(source).votes()]
        return dict(zip(schema.names, map(list, zip(*got)))) if got else {k: [] for k in schema.names}

    return map_batches(pages.select(host(F.col("url")).alias("host"), "html"), run, schema)


def consensus(votes: DataFrame) -> DataFrame:
    """host, winner, drop and keep: the path that its pages extract, and the paths that they leave out or keep.

    Only paths of ``SHARE`` of the host's headings are listed, so that a host's lists stay short. Equal votes go to the
    lesser path. Headings and texts are counted exactly.
    """
    by = votes.groupBy("host", "path").agg(
        F.sum("weight").alias("weight"), F.count_distinct("heading").alias("headings"), F.count_distinct("text").alias("texts"),
        F.bool_or("hinted").alias("hinted"), F.avg(F.col("headed").cast("double")).alias("headed"),
        F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.avg(F.col("behind").cast("double")).alias("behind"),
    )
    by = written(by)
    whole = by.groupBy("host").agg(F.max("headings").alias("most"), F.max(F.struct(F.round("weight", 6).alias("weight"), F.bitwise_not("path").alias("less"))).alias("w"))
    seen = (F.col("headings") >= HEADINGS) & (F.col("headings") >= SHARE * F.col("most"))
    same = F.col("texts") * 2 <= F.col("headings")
    wins = F.bitwise_not("path") == F.col("w.less")
    beside = F.col("hinted") & ((2 * F.col("linked") >= F.col("chars")) | (F.col("behind") >= BEHIND))
    drop = F.when(seen & (same | beside) & (F.col("headed") < 0.5) & ~wins, F.col("path"))
    keep = F.when(F.col("hinted") & (F.col("headed") >= 0.5) & (F.col("headings") >= SHARE * F.col("most")), F.col("path"))
    listed = by.join(whole, "host").select("host", F.col("w"), drop.alias("drop"), keep.alias("keep")).where("drop is not null or keep is not null")
    lists = listed.groupBy("host").agg(F.collect_list("drop").alias("drop"), F.collect_list("keep").alias("keep"))
    return whole.select("host", F.when(F.col("w.weight") > 0, F.bitwise_not("w.less")).alias("winner")).join(lists, "host", "left")


def extract(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html).

    A null or empty html, and a page without text outside boilerplate, gives an empty text. Pages without a host vote
    together. Repeated rows give repeated rows, and vote as often for the winner; an empty table gives none, and other
    columns are not read. Unclosed and cut tags are allowed. Work and memory are in proportion to the page's length.
    """
    said = written(consensus(votes(pages)))
    size = said.agg(F.sum(F.octet_length("host") + 8 * (F.coalesce(F.size("drop"), F.lit(0)) + F.coalesce(F.size("keep"), F.lit(0))) + 64)).first()[0] or 0
    keyed = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    joined = keyed.join(F.broadcast(said), "host", "left") if size <= broadcast_bytes else with_side(keyed, said, ["host"], "left")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(cols: dict[str, list]) -> dict[str, list]:
        unsigned = lambda xs: frozenset(x & _MASK for x in xs or ())
        texts = [Page(source).text(None if w is None else w & _MASK, unsigned(d), unsigned(k)) for source, w, d, k in zip(cols["html"], cols["winner"], cols["drop"], cols["keep"])]
        return {"page_id": cols["page_id"], "url": cols["url"], "text": texts, "n_chars": list(map(len, texts))}

    return map_batches(joined.select("page_id", "url", "html", "winner", "drop", "keep"), run, schema)


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
