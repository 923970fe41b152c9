"""The training-data operators against brute force, and on nulls, empty and long texts, ties, repeats and clashing names."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from stakeflow.llm import byte_bpe, chat_format, components, decontaminate, embedding_dedup, html_extract, language_id, near_dedup, quality_crf, substring_dedup, token_counts
from stakeflow.llm.common import words_of

ODD = "doc_id long, text string, key string, bands int, kept string, rep long, n long, lang string"
PIECES = ["a", "  ", "▁", "the ", "日本", "𠮷", "\n", "\t", "é", "\r", "Ⅷ", "ing", "tion", "12", "<s>", "%%%", "zzz", "aaaa", "\x00", "“", "של", "'", "re", "..."]


def some(seed, n, most):
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, most))) for _ in range(n)]


def odd_docs(spark, texts):
    return spark.createDataFrame([(i, t, "k", 1, "x", i, 2, "en") for i, t in enumerate(texts)], ODD)


def empty(spark):
    return spark.createDataFrame([], ODD)


EDGE = [None, "", " \n", "a", "word " * 30_000, "word " * 30_000, "x" * 200_000]


def test_words_split_at_ascii_white_space_only():
    assert [w.decode() for w in words_of("a\x1cb\u00a0c\x85d \t e\n\x0b\x0cf\r")] == ["a\x1cb\u00a0c\x85d", "e", "f"]
    assert words_of(None) == words_of(" ") == []


def test_prefix_counts_are_those_of_the_library_at_every_prefix():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, c = sentencepiece.SentencePieceProcessor(model_file=path), token_counts.counter(path)
    for s in some(1, 200, 12):
        steps = c.steps(s)
        want = [len(sp.encode(s[:i])) for i in range(len(s) + 1)]
        assert list(token_counts.counts(steps)) == want
        assert [token_counts.count_at(steps, i) for i in range(len(s) + 1)] == want
        for budget in (0, 3, 10):
            assert token_counts.longest_prefix(steps, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_token_counts_of_edges(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = {r.doc_id: r for r in token_counts.token_budget(odd_docs(spark, EDGE), path, 10).collect()}
    assert [rows[i].n_tokens for i in range(4)] == [0, 0, 2, 1] and rows[0].n_bytes == 0
    assert rows[4].n_tokens == rows[5].n_tokens and rows[4].over_limit and 0 < rows[4].chars_within_limit < 100
    assert token_counts.prefix_counts(empty(spark), path).count() == 0


@pytest.mark.parametrize("leaf", [1, 2, 7])
def test_tree_encoding_is_the_library_s(leaf):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    c = byte_bpe.codec(path, public_tokenizers.PATTERN, leaf)
    for s in some(leaf, 300, 25):
        ids = c.encode(s)
        assert ids == c.coder.encode_ordinary(s) and c.decode(ids) == s.encode()


def test_most_texts_are_joined_from_parts():
    import duckdb

    c = byte_bpe.codec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = [t for (t,) in duckdb.sql("SELECT text FROM '/root/testdata/sf0.001/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    assert sum(len(t) > c.leaf for t in texts) > len(texts) / 2
    for t in texts:
        ids = c.encode(t)
        assert ids == c.coder.encode_ordinary(t) and c.decode(ids) == t.encode()
    for t in ("x" * 100_000, "ab " * 10 + "語" * 50_000 + " z", " " * 50_000 + "a"):
        assert c.encode(t) == c.coder.encode_ordinary(t)


def test_byte_bpe_of_edges(spark):
    coded = byte_bpe.encode_decode(odd_docs(spark, EDGE), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    for r in coded.collect():
        assert bytes(r.decoded).decode() == (EDGE[r.doc_id] or "") and len(r.ids) == 4 * r.n_tokens
    assert byte_bpe.digests(coded).count() == len(EDGE)


def test_extraction_drops_boilerplate_and_follows_the_host(spark):
    page = '<html><head><title>t</title></head><body><nav><li>menu</nav><div class="ad">buy</div><div class="post-{0}"><h1>Head &amp; tail</h1><p><b>One<br>two<p>thr ee <a href=x>link</a><script>x("</p>")</script></div><div class="comments"><p>{1}</p></div><footer>end</footer></body></html>'
    rows = [(i, "http://h.example/a", page.format(i, "talk " * 200)) for i in range(5)]
    rows += [(10, None, None), (11, "http://h.example/b", ""), (12, "nonsense", "plain text"), (13, "http://z.example", "<p>cut <b"), (14, "http://h.example/c", "<p>no container of that path</p>")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, winner string")
    got = {r.page_id: r for r in html_extract.extract(df).collect()}
    assert all(got[i].text == "Head & tail\nOne two\nthr ee link" for i in range(5))
    assert [got[i].text for i in (10, 11, 12, 13, 14)] == ["", "", "plain text", "cut", "no container of that path"]
    assert got[0].n_chars == len(got[0].text)
    shuffled = {r.page_id: r.text for r in html_extract.extract(df, broadcast_bytes=-1).collect()}
    assert shuffled == {k: r.text for k, r in got.items()}
    assert html_extract.extract(df.limit(0)).count() == 0


def test_hosts_votes_change_the_text(spark):
    """Against a count of every page's paths: what recurs under other headings goes, a hinted box with the headings stays."""
    page = '<body><article><div class="header"><h1>{0}</h1></div><p>{1}</p><div class="x{2}">Our app is new</div><p class="sig">{3}</p></article></body>'
    rows = [(i, f"http://a.example/{i}", page.format(f"Head {i}", f"text {i} " * 9, i, "same" if i % 2 else f"by {i}")) for i in range(8)]
    rows += [(20, "http://a.example/20", '<body><article><div class="header">No h1 here</div><p>other text</p></article></body>')]
    rows += [(30 + i, f"http://b.example/{i}", page.format("One head", "one text", 1, "same")) for i in range(4)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(8):  # the box's text is one under eight headings; the signature's are five under eight
        assert got[i] == f"Head {i}\n{('text %d ' % i * 9).strip()}\n" + ("same" if i % 2 else f"by {i}")
        assert "Our app" in html_extract.Page(rows[i][2]).text(None)  # a page alone doesn't know
    assert got[20] == "No h1 here\nother text"
    assert got[30] == "One head\none text\nOur app is new\nsame"  # copies of one page say nothing


def test_words_alone_and_quotes_drop_nothing():
    page = lambda x: html_extract.Page(x).text(None)
    assert page("<article><p>one <a href=/it's>two</a> three</p><p>more text</p><p>don't stop</p></article>") == "one two three\nmore text\ndon't stop"
    assert page("<html><body><form id=f action='/x?a=b'><input name=q><h1>T</h1><p>text of the page</p><button>go</button></form></body></html>") == "T\ntext of the page"
    assert page('<body><form><p>all of the text is in here</p></form><p>few</p></body>') == "all of the text is in here\nfew"
    assert page("<article><p>z</p></article><form><p>log in with a long text</p></form>") == "z"
    assert page("<article><p class='search'>a b c</p><p class=\"social notice\">d e f</p><section class=\"menu\">g h</section></article>") == "a b c\nd e f\ng h"
    assert page("<article><h1>q</h1><p class='search'>a b c</p><p class=\"social notice\">d e f</p><section class=\"menu\">g h</section></article>") == "q\na b c\nd e f\ng h"
    assert page("<p title='x class=ad>y' id=q>z</p><p a==b>x</p><p a=>y</p><p 'q\">w</p><p b='") == "z\nx\ny\nw"


def test_consensus_is_a_plain_count_of_votes(spark):
    """Headings, texts, links and places of every path of a host, counted in sets."""
    r = random.Random(6)
    box = lambda c, x: f'<div class="{c}">{x}</div>'
    rows = []
    for i in range(120):
        parts = [f"<h1>Head {i % 50}</h1>", f"<p>{'text %d ' % i * 8}</p>"]
        parts += [box("share", "".join(f"<a href=/{k}>link {i} {k}</a>" for k in range(3)))] if r.random() < 0.8 else []
        parts += [box("notice", f"a notice of the article {i}")] if r.random() < 0.6 else []
        parts += [box("x", r.choice(["Our app", f"mine {i}"]))] if r.random() < 0.2 else []
        parts += [f"<p>more {i}</p>"]
        parts += [box("comments", f"<p>talk {i}</p>" * r.randint(1, 4))] if r.random() < 0.8 else []
        rows.append((i, f"http://{r.choice('aab')}.example/{i}", f"<body><article>{''.join(parts)}</article></body>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    by = {}
    for _, url, source in rows:
        for path, weight, heading, text, hinted, headed, chars, linked, behind in html_extract.Page(source).votes():
            row = by.setdefault((url[7], path), [0.0, set(), set(), False, [], 0, 0, []])
            row[0] += weight
            row[1].add(heading), row[2].add(text), row[4].append(headed), row[7].append(behind)
            row[3] |= hinted
            row[5] += chars
            row[6] += linked
    want = {}
    for h in "ab":
        paths = {p: v for (x, p), v in by.items() if x == h}
        most = max(len(v[1]) for v in paths.values())
        winner = max((round(v[0], 6), ~p) for p, v in paths.items())[1]
        drop = set()
        for p, (_, heads, texts, hinted, headed, chars, linked, behind) in paths.items():
            beside = hinted and (2 * linked >= chars or sum(behind) / len(behind) >= 0.9)
            if len(heads) >= max(3, 0.01 * most) and (2 * len(texts) <= len(heads) or beside) and sum(headed) / len(headed) < 0.5 and ~p != winner:
                drop.add(p)
        want[h] = (~winner, drop)
    got = {x.host[0]: (x.winner, set(x.drop or ())) for x in html_extract.consensus(html_extract.votes(df)).collect()}
    assert got == want and all(len(d) >= 2 for _, d in got.values())  # links and comments at least
    for x in html_extract.extract(df).collect():
        assert x.text.startswith(f"Head {x.page_id % 50}\ntext") and f"more {x.page_id}" in x.text and "link" not in x.text and "talk" not in x.text
        assert ("a notice of" in x.text) == ("notice" in rows[x.page_id][2])


def test_extraction_of_words_within_classes_and_deep_or_broken_pages():
    import time

    texts = [html_extract.Page(x).text(None) for x in (
        '<body><article><h1 class="headline-header">Title kept</h1><p>one</p></article></body>',
        '<article><p>x</p><p class="notice-period">ab</p><div class="post-follow-up">cd</div></article>',
        '<body><div class="content has-sidebar"><p>text</p></div><div class="sidebar">no</div></body>',
    )]
    assert texts == ["Title kept\none", "x\nab\ncd", "text"]
    began = time.process_time()
    for source in ("<div>" * 200_000 + "x", "x" * 1_000_000, '<a title="' * 20_000, "<ul><li>" + "<div>" * 20_000 + "<li>x" * 5_000):
        page = html_extract.Page(source)
        page.votes(), page.text(None)
    assert time.process_time() - began < 15


def test_forward_backward_is_brute_force():
    import itertools

    r = np.random.RandomState(0)
    unary, tie = r.randn(2, 5), 0.7
    z, good, equal = quality_crf.forward_backward(unary, np.array([5, 3]), tie)
    for row, n in ((0, 5), (1, 3)):
        w = {y: np.exp(sum(unary[row, i] * y[i] for i in range(n)) + tie * sum(a == b for a, b in zip(y, y[1:]))) for y in itertools.product((0, 1), repeat=n)}
        total = sum(w.values())
        assert np.isclose(z[row], np.log(total))
        assert np.allclose(good[row, :n], [sum(v for y, v in w.items() if y[i]) / total for i in range(n)])
        assert np.isclose(equal[row], sum(v * sum(a == b for a, b in zip(y, y[1:])) for y, v in w.items()) / total)


def test_quality_learns_shouting_and_scores_edges(spark):
    r = random.Random(3)
    clean = lambda: ". ".join(" ".join(r.choice(["the", "house", "was", "large", "and", "old"]) for _ in range(8)).capitalize() for _ in range(5))
    texts = [clean() if i % 3 else clean().upper().replace(" ", "!! ") for i in range(120)]
    docs = odd_docs(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(100)] + [(5000, 1), (None, 0)], "doc_id long, quality int")
    chain = quality_crf.learn(docs, labels)
    got = {x.doc_id: x for x in quality_crf.score(docs, chain).collect()}
    assert all(got[i].predicted == int(i % 3 > 0) for i in range(100, 120))
    edges = quality_crf.score(odd_docs(spark, EDGE), chain).collect()
    assert len(edges) == len(EDGE) and all(0 <= x.score <= 1 for x in edges)
    none = quality_crf.learn(docs.limit(0), labels)
    assert quality_crf.score(odd_docs(spark, EDGE), none).count() == len(EDGE)


def test_language_model_is_held_out_right(spark):
    r = random.Random(5)
    langs = {"aa": "la le li lo re".split(), "bb": "zu zk xo kx uz".split()}
    rows = [(i, " ".join("".join(r.choice(langs[k]) for _ in range(3)) for _ in range(20)), k) for i in range(60) for k in [("aa", "bb")[i % 2]]]
    docs = spark.createDataFrame([(*x, 0.0) for x in rows], "doc_id long, text string, lang string, score double")
    model = language_id.learn(docs.where("doc_id < 40"))
    assert (model.table == 0).mean() > 0.5  # the elastic net leaves most weights zero
    got = {x.doc_id: x.lang_pred for x in language_id.identify(docs, model).collect()}
    assert all(got[i] == k for i, _, k in rows if i >= 40)
    edges = {x.doc_id: x for x in language_id.identify(odd_docs(spark, [*EDGE[:3], "123 %%", "zuzk"]), model).collect()}
    assert [edges[i].lang_pred for i in range(5)] == ["und"] * 4 + ["bb"]
    assert language_id.learn(empty(spark)) is None
    assert [x.lang_pred for x in language_id.identify(odd_docs(spark, ["abc"]), None).collect()] == ["und"]


def test_dart_signatures_agree_as_weighted_jaccard():
    r = np.random.RandomState(1)
    for n, share in ((4, 0.5), (300, 0.7)):
        agree, truth = [], []
        for _ in range(60):
            common = int(2 * n * share / (1 + share))
            x = r.randint(0, 2**62, 2 * n - common).astype(np.uint64)
            w = r.randint(1, 4, len(x))
            wa, wb = w.copy(), w.copy()
            a, b = slice(0, n), slice(n - common, None)
            agree.append((near_dedup.dart_signature(x[a], wa[a]) == near_dedup.dart_signature(x[b], wb[b])).mean())
            truth.append(w[n - common : n].sum() / w.sum())
        assert abs(np.mean(agree) - np.mean(truth)) < 0.03


def near_truth(rows):
    sets = {}
    for i, t in rows:
        w = words_of(t)
        sets[i] = Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else None
    of = {i: i for i, _ in rows}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    ids = [i for i in sets if sets[i]]
    for x in ids:
        for y in ids:
            if x < y and (sets[x] & sets[y]).total() >= 0.8 * (sets[x] | sets[y]).total():
                a, b = sorted((root(x), root(y)))
                of[b] = a
    return {i: root(i) for i, _ in rows}


@pytest.mark.parametrize("hot, block", [(64, 512), (2, 4)])
def test_near_duplicates_are_brute_force_classes(spark, hot, block):
    r = random.Random(7)
    rows = []
    for g in range(12):
        base = [r.choice("abcdefgh") * r.randint(1, 3) + str(r.randint(0, 50)) for _ in range(r.choice([3, 40, 120]))]
        for k in range(r.choice([1, 3, 9])):
            w = list(base)
            for _ in range(r.randint(0, len(w) // 24)):
                w[r.randrange(len(w))] = f"x{r.random()}"
            rows.append((len(rows) * 3 % 101 + 200 * g, "\n ".join(w)))
    rows += [(9001, None), (9002, ""), (9003, "  "), (9004, rows[0][1])]
    # equal sets of shingles of different weights are not similar
    rows += [(9010 + k, "one line that comes again and again " * k) for k in (2, 9, 10)]
    df = spark.createDataFrame([(*x, "k", [1]) for x in rows] + [(*rows[0], "k", [1])], "doc_id long, text string, key string, bands array<int>")
    got = near_dedup.near_duplicate_classes(df, hot=hot, block=block).collect()
    assert len(got) == len(rows) + 1
    assert {x.doc_id: x.class_id for x in got} == near_truth(rows)
    assert near_dedup.near_duplicate_classes(df.limit(0)).count() == 0


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    of = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(200):
        for a, b in edges:
            if a != b:
                of[a] = of[b] = min(of[a], of[b])
    got = {x.id: x.component for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == of


@pytest.mark.parametrize("bits", [64, 4])
def test_substrings_are_brute_force(spark, bits):
    """Also where almost all nodes collide."""
    r = random.Random(11)
    rows = [(i, " ".join(r.choice("ab") for _ in range(r.choice([0, 5, 13, 14, 20, 60])))) for i in range(80)]
    rows += [(100 + i, t) for i, t in rows if r.random() < 0.3] + [(500, None), (501, ""), (502, "w " * 5000)]
    first = {}
    for i, t in sorted((i, words_of(t)) for i, t in rows):
        for k in range(len(t) - 12):
            first.setdefault(tuple(t[k : k + 13]), i)
    df = spark.createDataFrame([(*x, "k", "y") for x in rows], "doc_id long, text string, key string, kept string")
    got = {x.doc_id: x for x in substring_dedup.remove_repeats(df, bits=bits).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        w = words_of(t)
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(k, k + 13)}
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == (len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode())
    assert substring_dedup.remove_repeats(df.limit(0)).count() == 0


def distance(p, t):
    prev = [0] * (len(t) + 1)
    for i, x in enumerate(p, 1):
        cur = [i]
        for j, y in enumerate(t, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return min(prev)


def test_decontamination_is_brute_force(spark):
    r = random.Random(13)
    for _ in range(300):
        p, t = [[r.choice("abc") for _ in range(r.randint(1, 12))] for _ in range(2)]
        assert decontaminate.nearest(p, t)[0] == distance(p, t)
    vocab = [f"w{i}" for i in range(12)]
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(2, 30)))) for i in range(12)] + [(90, None), (91, "short one"), (92, ""), (93, "alone"), (94, "短い文です"), (None, "no id here"), (95, "two texts under"), (95, "one id")]
    docs = []
    for d in range(60):
        w = [r.choice(vocab) for _ in range(r.randint(0, 60))]
        if d % 2:
            x = items[r.randrange(12)][1].split()
            for _ in range(r.randint(0, 5)):
                x[r.randrange(len(x))] = "other"
            w[5:5] = x
        docs.append((d, ", ".join(w).upper()))
    docs += [(100, None), (101, ""), (102, "a short one"), (103, "Alone!"), (104, "これは短い文ですね"), (105, "no id here"), (106, "one id; two texts under"), (107, "short")]
    df = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    size = lambda x: len(decontaminate.words(x))
    want = {(d, i) for d, t in docs if t for i, x in items if x and distance(decontaminate.words(x), decontaminate.words(t)) <= max(0, min(int(0.15 * size(x)), size(x) // 2 - 1))}
    assert {(102, 91), (103, 93), (104, 94), (105, None), (106, 95)} <= want
    for block in (1 << 20, 64):
        got = decontaminate.contaminated(df, bench, block_bytes=block).collect()
        assert {(x.doc_id, x.item_id) for x in got} == want and len(got) == len(want)
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0


def test_chat_round_trip_parts_and_mask(spark):
    nasty = ["<|im_end|>", "<\\|", "<<|", "\\", "<|im_start|>user<|im_sep|>", "", None, "\n<", "<|image|>"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)] + [(2, 0, None, "x"), (2, 0, None, "x"), (None, 1, "us<|er", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = chat_format.format_conversations(df.withColumn("parts", chat_format.text_parts(df["text"])))
    out = chats.select("conv_id", "n_turns", chat_format.read_turns(chats["formatted"]).alias("turns"), chat_format.read_loss(chats["formatted"], chats["loss_spans"]).alias("loss")).collect()
    by = {x.conv_id: x for x in out}
    assert [(t.role, t.text) for t in by[1].turns] == [(r, t or "") for _, _, r, t in rows[:9]]
    assert by[1].loss == "".join(t or "" for i, t in enumerate(nasty) if i % 2)
    assert by[2].n_turns == 2 and by[None].turns[0].role == "us<|er"
    parts = [("text", "see ", None, None), ("image", None, "s3/a", 2), ("audio", None, "b", None), ("video", None, "c", 9), ("text", "<|", None, None)]
    df = spark.createDataFrame([(7, 0, "user", parts), (7, 1, "assistant", None)], f"conv_id long, turn long, role string, parts {chat_format.PARTS}")
    x = chat_format.format_conversations(df).first()
    assert x.formatted == "<|im_start|>user<|im_sep|>see <|image|><|audio|><|part|><\\|<|im_end|><|im_start|>assistant<|im_sep|><|im_end|>"
    assert [(a.ordinal, a.kind, a.ref, a.tokens) for a in x.attachments] == [(1, "image", "s3/a", 512), (2, "audio", "b", 25), (3, "video", "c", 0)]
    assert x.expanded_tokens == 537 and all(x.formatted[a.start :].startswith("<|") for a in x.attachments)
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_embedding_links_are_brute_force(spark):
    r = np.random.RandomState(4)
    base = r.randn(6, 16)
    v = [list(map(float, base[i % 6] + r.randn(16) * [0.05, 0.3, 1.0][i % 3])) for i in range(90)]
    rows = list(enumerate(v)) + [(200, v[0]), (201, None), (202, [0.0] * 16), (203, [float("nan")] + v[0][1:]), (204, [None] + v[0][1:]), (205, v[1][:8]), (206, [x * 1e200 for x in v[0]]), (207, [])]
    df = spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, embedding array<double>, copies int")
    good = {i: np.array(x) / np.abs(x).max() for i, x in rows if x and None not in x and np.isfinite(x).all() and any(x)}
    cos = lambda a, b: len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9
    links = {i: {j for j in good if j != i and cos(good[i], good[j])} for i in good}
    of = {i: i for i, _ in rows}
    for _ in rows:
        for i, js in links.items():
            for j in js:
                of[i] = of[j] = min(of[i], of[j])
    for block, blocks in ((16_384, 8), (20, 3)):
        got = embedding_dedup.near_duplicates(df, block=block, blocks=blocks).collect()
        assert len(got) == len(rows)
        assert {x.vec_id: (x.n_links, x.component_id) for x in got} == {i: (len(links.get(i, ())), of[i]) for i, _ in rows}
        assert all(x.kept == (x.vec_id == x.component_id) for x in got)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_quantised_bounds_hold():
    r = np.random.RandomState(0)
    q = embedding_dedup.Quantised(r.randn(200, 33) * r.lognormal(0, 3, (200, 1)))
    near = q.products(slice(0, 200), q, slice(0, 200)) * q.scale[:, None] * q.scale[None, :]
    off = q.length[:, None] * q.lost[None, :] + q.lost[:, None] * (q.length + q.lost)[None, :]
    assert (np.abs(q.unit @ q.unit.T - near) <= off).all()


def test_pipeline_on_a_small_corpus(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(17)
    word = lambda: "".join(r.choice(["la", "re", "mi", "to", "ne", "su"]) for _ in range(3))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, item = text(60), text(30)
    near = text(200).split()
    rows = [(i, text(80), "aa", "s", 0) for i in range(40)]
    rows += [(50, " ".join(near), "aa", "s", 0), (51, " ".join(near[:150] + ["other"] + near[151:]), "aa", "s", 0), (52, " ".join(near), "aa", "s", 0)]
    rows += [(60, text(50) + " " + passage, "aa", "s", 0), (61, text(50) + " " + passage, "aa", "s", 0), (70, text(20) + " " + item + " " + text(20), "aa", "s", 0), (80, None, "aa", "s", 0), (81, "123", "aa", "s", 0)]
    for name, data, schema in (("documents", rows, "doc_id long, text string, lang string, source string, n_chars long"), ("benchmark", [(1, item)], "item_id long, text string")):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {x.doc_id: x for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) == {*range(40), 50, 60, 61}
    assert got[0].text == rows[0][1] and got[61].text == " ".join(rows[44][1].split()[:50]) and got[61].n_tokens > 0


def test_stages_of_the_pipeline_on_odd_tables(spark, tmp_path):
    """Nulls, repeated rows, columns that clash with the stages' own, and no rows."""
    import corpus_pipeline

    spark.createDataFrame([(1, "a passage that nobody has")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long, __kept int, count int, lang_pred int, component int"
    text = " ".join(f"wort{i}" for i in range(40))
    rows = [(1, text, "aa", "s", 0, 1, 2, 3, 4), (1, text, "aa", "s", 0, 1, 2, 3, 4), (2, text, "aa", None, None, None, None, None, None), (None, "noch etwas anderes", None, None, 0, 1, 2, 3, 4), (3, None, None, None, None, 1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, schema)
    kept = {name: stage(spark, docs, str(tmp_path)) for name, stage in corpus_pipeline.STAGES[:-1]}
    assert all(df.columns == docs.columns for df in kept.values())
    ids = {name: sorted((r.doc_id or -1) for r in df.collect()) for name, df in kept.items()}
    assert ids == {"language_id": [-1, 1, 1, 2], "near_dedup": [-1, 1, 3], "substring_dedup": [-1, 1, 1, 3], "decontaminate": [-1, 1, 1, 2, 3]}
    none = docs.limit(0)
    assert all(stage(spark, none, str(tmp_path)).count() == 0 for _, stage in corpus_pipeline.STAGES)


def test_language_and_quality_samples_are_the_smallest_hashes(spark):
    from stakeflow.llm.common import sampled_ids

    df = spark.range(5000).selectExpr("id AS doc_id", "CASE WHEN id % 10 = 0 THEN 'b' WHEN id % 10 < 9 THEN 'a' END AS lang", "xxhash64(id) AS h")
    rows = [(r.lang, r.h & ((1 << 40) - 1), r.doc_id) for r in df.collect() if r.lang]
    for k in (7, 700):
        want = {g: [sum(x[0] == g for x in rows), *[i for *_, i in sorted(x for x in rows if x[0] == g)[:k]]] for g in "ab"}
        assert sampled_ids(df, "lang", k) == want
    assert sampled_ids(df.limit(0), "lang", 5) == {}


def test_embeddings_of_exact_ties_at_the_threshold(spark):
    rows = [(i, [3.0, 4.0] if i % 2 else [4.0, 3.0]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for threshold, linked in ((0.6 * 0.8 + 0.8 * 0.6, True), (0.9600001, False)):
        got = embedding_dedup.near_duplicates(df, threshold).collect()
        assert {r.n_links for r in got} == {199 if linked else 99} and {r.component_id for r in got} == ({0} if linked else {0, 1})


def test_chat_of_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "user", "x", 5, 6, 7)], "conv_id long, turn long, role string, text string, no int, seg int, start int")
    out = chat_format.format_conversations(df.withColumn("parts", chat_format.text_parts(df["text"]))).first()
    assert out.formatted == "<|im_start|>user<|im_sep|>x<|im_end|>" and out.n_turns == 1


def test_sql_oracles_are_registered():
    from stakeflow.llm import registry

    assert set(registry.ORACLES) <= set(registry.QUERIES) and len(registry.QUERIES) == 13
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
