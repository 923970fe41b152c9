"""Operator 13 against plain counts, over odd texts, chunks of any size and streams of any number of ranges."""

import random
import re
from collections import Counter
from fractions import Fraction
from math import floor

import pytest

from stakeflow.llm import phrases
from tests.llm.test_llm_operators import EDGE, ODD, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, fewest, longest, top):
    """Counts in a dictionary a language, and each candidate compared with each."""
    f, n = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= fewest}
        found = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, cut = min((floor(Fraction(1000 * a * n[lang], counts[p[:k]] * counts[p[k:]])), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), counts[p[:cut]], counts[p[cut:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed, n):
    r = random.Random(seed)
    words = ["a", "A", "É", "é", "x\x01", "the", "of", "日本", "b c", "-", "#", "word" * 5, "\x85"]
    seps = [" ", " ", " ", "  ", "\t", " \t ", ".", ", ", "\n", "! ", "\x0b"]
    fixed = "the of a the of a b of "
    return [("" if r.random() < 0.1 else fixed if r.random() < 0.3 else "").join(r.choice(words) + r.choice(seps) for _ in range(r.randint(0, 60))) for _ in range(n)]


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize(("chunk", "most_bits"), [(4 << 20, 1 << 27), (40, 64)])
def test_phrases_are_those_of_plain_counts(spark, monkeypatch, chunk, most_bits):
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    monkeypatch.setattr(phrases, "MOST_BITS", most_bits)  # a filter that lets nearly everything through
    r = random.Random(1)
    given = [(r.choice(["en", "fr", None]), t) for t in [*texts(4, 150), *EDGE, *EDGE[3:4] * 9]]
    docs = spark.createDataFrame([(i, t, "k", 1, "x", i, 2, g) for i, (g, t) in enumerate(given)], ODD)
    assert rows(phrases.collocations(docs, 6, 5, 25)) == plain(given, 6, 5, 25)


def test_hashes_are_of_words_not_of_places():
    w = phrases.Words(b"abcdefghijklmnopq x abcdefghijklmnopq  x abcdefghijklmnopr x a aa aaaaaaaa aaaaaaaaa")
    assert [h == w.hashes[0] for h in w.hashes[:5:2]] == [True, True, False] and len(set(w.hashes.tolist())) == 7
    assert w.runs(2, "en")[0] == w.runs(2, "en")[2] != w.runs(2, "fr")[0]
    got, order = w.texts(phrases.np.array([2, 0]), 2)
    assert got.to_pylist() == ["abcdefghijklmnopq x"] * 2 and order.tolist() == [1, 0]


def test_products_beyond_64_bits(spark):
    counts = spark.createDataFrame([("en", ["p"], 10**13), ("en", ["q"], 3 * 10**12), ("en", ["p", "q"], 2 * 10**12)], "lang string, words array<string>, f long")
    both = phrases.streamed(phrases.streamed(counts, phrases.F.col("words"), "left", 5), phrases.F.reverse("words"), "right", 5)
    got = {tuple(r.words): (r.left, r.right) for r in both.collect()}
    assert got["p", "q"][0][:2] == [10**13, 2 * 10**12] and got["p", "q"][1][:2] == [3 * 10**12, 2 * 10**12]


def test_no_rows(spark):
    assert phrases.collocations(empty(spark)).count() == 0


def test_streams_are_cut_anywhere(spark):
    """Sixty phrases of one first and one last word, over ranges of a few rows."""
    r = random.Random(2)
    given = [("en", "h a b h c. h a b. h d h. h a. " * 3 + " ".join(r.choice("habcd") for _ in range(400)))]
    docs = spark.createDataFrame([(i, t, "k", 1, "x", i, 2, g) for i, (g, t) in enumerate(given)], ODD)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", 29)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows(phrases.collocations(docs, 4, 5, 1000)) == plain(given, 4, 5, 1000)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
