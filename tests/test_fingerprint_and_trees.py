"""Ordered fingerprints over any partitioning, and the three ways to screen columns against plain ones."""

import hashlib
import random

import numpy as np
import pytest

from stakeflow.operators import audit


def test_fingerprint_is_of_the_order_and_not_of_the_partitions(spark):
    r = random.Random(5)
    rows = [(r.choice([None, *range(40)]), i, r.choice([None, "", "x"]), r.random() < 0.5) for i in range(300)] + [(1, 1, "twice", True)] * 2
    schema = "us long, bet_id long, t string, flag boolean"
    of = lambda rows, n, chunk: tuple(audit.ordered_fingerprint(spark.createDataFrame(rows, schema).repartition(n), ["us", "bet_id"], chunk=chunk).first())
    for chunk in (7, 4096):
        assert of(rows, 1, chunk) == of(r.sample(rows, len(rows)), 13, chunk)
        digest = lambda x: hashlib.sha256("\x1f".join(f"{c}=" + ("n" if v is None else f"v{str(v).lower() if isinstance(v, bool) else v}") for c, v in sorted(zip(("us", "bet_id", "t", "flag"), x))).encode()).hexdigest()
        level = [digest(x) for x in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1], digest(x)))]
        while True:
            level = [hashlib.sha256("".join(level[i : i + chunk]).encode()).hexdigest() for i in range(0, len(level), chunk)]
            if len(level) == 1:
                break
        assert of(rows, 3, chunk) == (302, level[0])
    a, b = 0, next(i for i in range(1, 300) if rows[i][0] != rows[0][0])
    swapped = rows.copy()
    swapped[a], swapped[b] = (rows[b][0], *rows[a][1:]), (rows[a][0], *rows[b][1:])  # two rows change places
    assert of(swapped, 3, 7) != of(rows, 3, 7)
    assert of([(None, 1, None, None)], 1, 7) != of([(None, 1, "", None)], 1, 7)
    assert of([], 1, 7) == (0, hashlib.sha256(b"").hexdigest())


def plain_gains(x, y, bins, trees, depth, rate):
    """Boosting by trying every split of every node on the rows themselves."""
    edges = [sorted(set(np.quantile(c, [i / bins for i in range(1, bins)]))) for c in x.T]
    b = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], axis=1)
    margin, gains = np.zeros(len(y)), np.zeros(x.shape[1])
    part = lambda s, g, h: g[s].sum() ** 2 / (h[s].sum() + 1)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.round((p - y) * audit.PARTS) / audit.PARTS, np.round(p * (1 - p) * audit.PARTS) / audit.PARTS
        nodes = [np.ones(len(y), bool)]
        done = []
        for _ in range(depth):
            nxt = []
            for s in nodes:
                best = max(((part(s & (b[:, j] <= k), g, h) + part(s & (b[:, j] > k), g, h) - part(s, g, h), -j, -k) for j in range(x.shape[1]) for k in range(bins - 1)), default=(0, 0, 0))
                if best[0] <= 1e-9:
                    done.append(s)
                    continue
                gains[-best[1]] += best[0]
                nxt += [s & (b[:, -best[1]] <= -best[2]), s & (b[:, -best[1]] > -best[2])]
            nodes = nxt
        for s in nodes + done:
            if s.any():
                margin[s] -= rate * g[s].sum() / (h[s].sum() + 1)
    return gains


def made(spark):
    r = np.random.RandomState(3)
    x = np.round(r.randn(400, 4), 2)
    x[:, 3] = np.round(x[:, 0] * 2 + r.randn(400) * 0.01, 4)  # tells what the first does
    y = ((x[:, 0] > 0.3) ^ (r.rand(400) < 0.1)) | (x[:, 1] > 1.2)
    rows = [(*map(float, a), 1.0, int(b)) for a, b in zip(x, y)]
    return x, y.astype(float), spark.createDataFrame(rows, "a double, b double, c double, d double, same double, label int")


def test_tree_gains_are_those_of_every_split(spark):
    x, y, df = made(spark)
    got = {r.feature_name: r.gain for r in audit.tree_gains(df.repartition(5), ["a", "b", "c"], bins=8, trees=3, depth=2).collect()}
    want = plain_gains(x[:, :3], y, 8, 3, 2, audit.RATE)
    assert np.allclose([got[c] for c in "abc"], want, rtol=1e-6) and got["a"] > got["b"] > got["c"]
    again = {r.feature_name: r.gain for r in audit.tree_gains(df.coalesce(1), ["a", "b", "c"], bins=8, trees=3, depth=2).collect()}
    assert again == got


def test_three_methods(spark):
    x, y, df = made(spark)
    columns = ["a", "b", "c", "d", "same"]
    info = {r.feature_name: r.information for r in audit.mutual_information(df, columns[:4]).collect()}
    by = lambda method, k=None: [r.feature_name for r in audit.screened(df, columns, method=method, k=k, bins=8, trees=3, depth=2).orderBy("rank").collect()]
    first = max("ad", key=lambda c: (info[c], c == "a"))
    kept = [c for c in sorted(info, key=lambda c: -info[c]) if c not in "ad" or c == first]
    assert by("information") == kept and by("information", 2) == kept[:2]
    gains = dict(zip("abc", plain_gains(x[:, :3], y, 8, 3, 2, audit.RATE)))
    assert by("trees") == sorted("abc", key=lambda c: -gains[c])  # d goes, as a was named before
    order = [c for c in kept]
    gains = dict(zip(order, plain_gains(x[:, ["abcd".index(c) for c in order]], y, 8, 3, 2, audit.RATE)))
    assert by("information_then_trees") == sorted(order, key=lambda c: -gains[c])
    with pytest.raises(ValueError):
        audit.screened(df, columns, method="forest")
    with pytest.raises(ValueError):
        audit.screened(df, columns, k=0)
    assert audit.screened(df, ["same"]).count() == 0


def test_passes_of_trees_read_a_row_a_kind_of_row(spark, monkeypatch):
    """50 copies of the rows are as many rows to read as one, with 50 times the gain but for what a side starts with."""
    _, _, df = made(spark)
    sizes, plain = [], audit.materialised
    monkeypatch.setattr(audit, "materialised", lambda rows: sizes.append((out := plain(rows)).count()) or out)
    many = df.crossJoin(spark.range(50))
    got = [{r.feature_name: r.gain for r in audit.tree_gains(x, ["a", "b"], bins=8, trees=2, depth=2).collect()} for x in (df, many)]
    assert sizes[0] == sizes[1] <= 2 * 8 * 8
    assert all(45 * got[0][c] < got[1][c] < 60 * got[0][c] for c in "ab"), got
