"""Null ids, repeated rows and columns of clashing names in each operator that scores rows by themselves."""

import public_tokenizers

from stakeflow.llm import byte_bpe, decontaminate, embedding_dedup, html_extract, language_id, quality_crf, token_counts

ROWS = "doc_id long, text string, lang string, source string, score double, predicted int, lang_pred string"
TEXTS = [(None, "the house was large and old"), (1, "the house was large and old"), (1, "the house was large and old"), (2, None), (2, None), (3, "das haus war groß und alt"), (None, "")]


def docs(spark):
    return spark.createDataFrame([(i, t, "en", "s", 9.0, 9, "zz") for i, t in TEXTS], ROWS)


def same_for_same(rows, columns):
    """Each row is there, and equal texts have equal values whatever their id."""
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((i is None, i or 0) for i, _ in TEXTS)
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, set()).add(tuple(r[c] for c in columns))
    assert len(of[1]) == len(of[2]) == 1 and next(iter(of[1])) in of[None]
    return of


def test_token_counts(spark):
    same_for_same(token_counts.token_budget(docs(spark), public_tokenizers.path("piece_bpe_32k.model"), 3).collect(), ["n_bytes", "n_tokens", "over_limit"])


def test_byte_bpe(spark):
    coded = byte_bpe.encode_decode(docs(spark), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    of = same_for_same(coded.collect(), ["n_tokens", "ids", "decoded"])
    assert next(iter(of[2]))[0] == 0


def test_quality(spark):
    """Of several labels of one id the greater one counts, in whatever order they come; texts of one label only score alike."""
    labels = spark.createDataFrame([(1, 0), (1, 1), (3, 0), (3, 0), (None, 1), (7, 1), (2, None)], "doc_id long, quality int")
    chain = quality_crf.learn(docs(spark), labels)
    again = quality_crf.learn(docs(spark), labels.orderBy("quality"))
    assert (chain.weights if hasattr(chain, "weights") else chain[0]).tolist() == (again.weights if hasattr(again, "weights") else again[0]).tolist()
    rows = quality_crf.score(docs(spark), chain).collect()
    of = same_for_same(rows, ["score", "predicted"])
    assert all(0 <= s <= 1 and s != 9.0 for r in of.values() for s, _ in r)


def test_language(spark):
    """Languages of equal texts tie the same way over any partitioning, and a text of no letters is unknown."""
    taught = spark.createDataFrame([(i, t, g, "s", 9.0, 9, "zz") for i in range(40) for t, g in ((f"the house was old {i}", "en"), (f"das haus war alt {i}", "de"))], ROWS)
    model = language_id.learn(taught)
    rows = language_id.identify(docs(spark).drop("lang"), model).collect()
    of = same_for_same(rows, ["lang_pred", "score"])
    assert next(iter(of[1]))[0] == "en" and next(iter(of[3]))[0] == "de" and next(iter(of[2]))[0] == language_id.UNKNOWN
    tied = spark.createDataFrame([(i, "aaa bbb", "ba"[i % 2], "s", 9.0, 9, "zz") for i in range(40)], ROWS)
    got = {r.lang_pred for n in (1, 3) for r in language_id.identify(docs(spark), language_id.learn(tied.repartition(n))).where("doc_id = 1").collect()}
    assert len(got) == 1 and got <= {"a", "b"}
    long = spark.createDataFrame([(1, "das haus war alt " * 20_000, "", "", 0.0, 0, "")], ROWS)
    assert language_id.identify(long, model).first().lang_pred == "de"


def test_decontamination(spark):
    """Repeated documents give repeated rows, a null id its own; of equal places the first counts, in very long texts too."""
    item = "one two three four five six seven eight nine ten eleven twelve"
    bench = spark.createDataFrame([(5, item, "x"), (5, item, "x"), (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "y")], "item_id long, text string, doc_id string")
    rows = [(None, f"a {item} b {item}"), (1, item), (1, item), (2, None), (3, "word " * 100_000 + item), (4, "alpha beta gamma delta epsilon zeta eta theta iota kappa")]
    found = decontaminate.contaminated(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, item_id int"), bench).collect()
    assert sorted((r.doc_id or 0, r.item_id or 0) for r in found) == [(0, 5), (1, 5), (1, 5), (3, 5), (4, 0)]


def test_pages(spark):
    page = "<body><article><h1>H</h1><p>text of it</p></article></body>"
    rows = [(None, "http://a.example/1", page), (1, "http://a.example/1", page), (1, "http://a.example/1", page), (2, None, None)]
    got = html_extract.extract(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == [(0, "H\ntext of it"), (1, "H\ntext of it"), (1, "H\ntext of it"), (2, "")]


def test_embeddings(spark):
    rows = [(None, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0])]
    got = embedding_dedup.near_duplicates(spark.createDataFrame([(i, v, 7, True) for i, v in rows], "vec_id long, embedding array<float>, n_links int, kept boolean")).collect()
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert len(got) == len(rows) and by[1] == (1, 1, True) and by[2] == (1, 1, False)
    assert all(by[i] == (0, i, True) for i in (3, 4, 5, 6)) and by[None][0] == 0
