"""Operator 11 against a model in plain Python, and its base rules against plain counts."""

import random
import re
from collections import Counter, defaultdict
from math import log2

import pytest
import xxhash

from stakeflow.llm import quality_rules
from tests.llm.test_llm_operators import EDGE, ODD, empty

LANGS = ["en", "fr", None]
O = quality_rules.ORDER


def plain_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), failed


def normal(text):
    return "\n" * (O - 1) + " ".join(re.findall(r"[^\x20\x09-\x0D]+", text)) + "\n"


def ends(said):
    return [i for i in range(O - 1, len(said)) if said[i] != "\n" or said[i - 1] != "\n"]


class Plain:
    """Modified Kneser-Ney by definition: probabilities of every order by recursion."""

    def __init__(self, texts):
        self.n = [None] * (O + 1)
        self.n[O] = Counter(normal(t)[i - O + 1 : i + 1] for t in texts for i in ends(normal(t)))
        for k in range(O - 1, 0, -1):
            self.n[k] = Counter(g[1:] for g in self.n[k + 1])
        self.d, self.followers = [None] * (O + 1), [None] * (O + 1)
        for k in range(1, O + 1):
            of = [sum(v == j for v in self.n[k].values()) for j in range(5)]
            y = of[1] / (of[1] + 2 * of[2]) if of[1] + 2 * of[2] else 0.5
            self.d[k] = [0, *[max(0.1, min(j, j - (j + 1) * y * of[j + 1] / of[j] if of[j] else j / 2)) for j in (1, 2, 3)]]
            self.followers[k] = defaultdict(list)
            for g, v in self.n[k].items():
                self.followers[k][g[:-1]].append(v)

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / (len(self.n[1]) + 1)
        after = self.followers[k].get(gram[:-1])
        if not after:
            return self.p(gram[1:])
        v, d = self.n[k].get(gram, 0), self.d[k]
        return max(v - d[min(v, 3)], 0) / sum(after) + sum(d[min(x, 3)] for x in after) / sum(after) * self.p(gram[1:])


def texts(seed, n):
    r = random.Random(seed)
    words = [*["the", "of", "and", "ing", "thing", "日本", "x\x00", "𠮷", "\x85a", "zz"] * 4, "é#", "$|", "THING", "AND"]
    loud = ["THING", "AND", "the", "#"]
    seps = [" "] * 8 + ["\n", "\t", "  ", "\r\n", "\x0b"]
    lines = ["one line that comes again\n", "the of and ing thing\n"]
    made = lambda words: "".join(r.choice(lines) if r.random() < 0.03 else r.choice(words) + r.choice(seps) for _ in range(r.randint(0, 50)))
    return [made(loud if r.random() < 0.1 else words) for _ in range(n)]


def docs_of(spark, given):
    return spark.createDataFrame([(i, t, "k", 1, "x", i, 2, g) for i, (g, t) in enumerate(given)], ODD)


def test_base_rules_are_plain_counts():
    given = [t or "" for t in [*texts(1, 300), *EDGE, "a b c d e " * 3, "a b c d e a b c d e f g h i j k l m n o p q r s t u v w x y z 1 2 3 4 5 6 7 8 9 0 11 12 13 14 15"]]
    got = quality_rules.base_counts(given)
    assert list(zip(*[got[c] for c in [*quality_rules.BASE, "base_failed"]])) == [plain_base(t) for t in given]


@pytest.mark.parametrize("model_rows", [10**9, 0, 900])
def test_scores_are_those_of_the_plain_model(spark, monkeypatch, model_rows):
    monkeypatch.setattr(quality_rules, "STEP", 64)
    monkeypatch.setattr(quality_rules, "HELD", 200)
    r = random.Random(7)
    some = [*texts(2, 240), *EDGE[:4]]
    given = [(r.choice(LANGS), t) for t in some] + [("xx", some[8])]  # a language that the other fold knows nothing of
    given += given[:30]
    docs = docs_of(spark, given)
    fold = {x.doc_id: x.f for x in docs.selectExpr("doc_id", "cast(pmod(xxhash64(coalesce(text, '')), 2) as int) f").collect()}
    want, taught = {}, defaultdict(list)
    for i, (lang, text) in enumerate(given):
        n, _, symbols, *_, failed = plain_base(text or "")
        if not failed and 10 * symbols <= n and 4 * len(re.findall("[A-Z]", text)) <= len(text.encode()):
            taught[lang or "und", fold[i]].append(text)
    models = {key: Plain(ts) for key, ts in taught.items()}
    for i, (lang, text) in enumerate(given):
        m = models.get((lang or "und", 1 - fold[i]))
        said = normal(text or "")
        want[i] = None if m is None or plain_base(text or "")[-1] else -sum(log2(m.p(said[e - O + 1 : e + 1])) for e in ends(said)) / len(ends(said)) * 1000
    rows = {x.doc_id: x for x in quality_rules.quality_rules(docs, model_rows).collect()}
    assert len(rows) == len(given) and sum(x is not None for x in want.values()) > 150
    for i, (lang, text) in enumerate(given):
        x = rows[i]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed) == plain_base(text or "")
        assert (x.millibits is None) == (want[i] is None), (i, x, want[i])
        if want[i] is not None:
            assert abs(x.millibits - want[i]) <= 1 + 1000 / 2**quality_rules.UNIT, (i, x.millibits, want[i])
    for lang in ("en", "fr", "und"):
        known = sorted(x.millibits for x in rows.values() if x.lang == lang and x.millibits is not None)
        q1, q3 = known[-(-len(known) // 4) - 1], known[-(-3 * len(known) // 4) - 1]
        for x in rows.values():
            if x.lang == lang and not x.base_failed:
                reach = round(3 * max(q3 - q1, 100) * (1 + (64 / x.n_words) ** 0.5))
                assert abs(x.lower - (q1 - reach)) <= 1 and abs(x.upper - (q3 + reach)) <= 1
                assert x.kept == (x.lower <= x.millibits <= x.upper)
    assert not any(x.kept for x in rows.values() if x.base_failed)
    assert 0 < sum(map(len, taught.values())) < sum(not x.base_failed for x in rows.values())


def test_strange_text_is_rejected_and_clean_text_kept(spark):
    r = random.Random(5)
    clean = [" ".join("".join(r.choice(["the", "re", "ing", "and", "on"]) for _ in range(r.randint(1, 3))) for _ in range(60)) for _ in range(120)]
    junk = ["".join(chr(r.randint(33, 0x4000)) + (" " if r.random() < 0.2 else "") for _ in range(300)) for _ in range(6)]
    got = {x.doc_id: x.kept for x in quality_rules.quality_rules(docs_of(spark, [("en", t) for t in clean + junk])).collect()}
    assert all(got[i] for i in range(120)) and not any(got[i] for i in range(120, 126))


def test_hashes_are_found():
    r = quality_rules.np.random.default_rng(1)
    h = r.integers(0, 2**63, 5000).astype("uint64") * 2
    known = quality_rules.Hashes(h[:3000], quality_rules.np.arange(3000))
    hit, value = known.find(h)
    assert hit.tolist() == [True] * 3000 + [False] * 2000 and value[:3000].tolist() == list(range(3000))
    assert not quality_rules.Hashes(h[:0], h[:0]).find(h)[0].any()


def test_no_rows_and_odd_ones(spark):
    assert quality_rules.quality_rules(empty(spark)).count() == 0
    got = quality_rules.quality_rules(docs_of(spark, [(None, t) for t in EDGE])).collect()
    assert len(got) == len(EDGE) and not any(x.kept for x in got) and {x.lang for x in got} == {"und"}
    assert xxhash.xxh3_64_intdigest(b"0 en") >> 8 == quality_rules.group_salt("en", 0)
