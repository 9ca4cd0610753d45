"""Weights against a direct solution, and the realised passes."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfcast.llm import mixing


def weights(tokens, a):
    z = sum((t / sum(tokens.values())) ** a for t in tokens.values())
    return {s: (t / sum(tokens.values())) ** a / z for s, t in tokens.items()}


def rows(sizes, width=7):
    out, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            out.append((i, s, " ".join(["w"] * (1 + i % width))))
            i += 1
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows({"big": 900, "mid": 300, "small": 100, None: 50}), "doc_id long, source string, text string")


def totals(docs):
    return {r[0]: r[1] for r in docs.groupBy("source").agg(F.sum(mixing.words(F.col("text")))).collect()}


def by_source(out):
    return {r[0]: (r[1], r[2]) for r in out.groupBy("source").agg(F.sum("n_tokens"), F.max("weight")).collect()}


def test_repetition_limit(docs):
    out = mixing.mix(docs).cache()
    t = totals(docs)
    # 2 = (largest / smallest share) ** (1 - a)
    a = 1 - math.log(2) / math.log(max(t.values()) / min(t.values()))
    want = weights(t, a)
    got = by_source(out)
    for s, w in want.items():
        assert got[s][1] == pytest.approx(w, rel=1e-6)
        budget = max(t[x] / want[x] for x in t) * w
        assert budget - 8 <= got[s][0] <= budget + 1           # the last row may not fit
    seen = Counter(r[0] for r in out.select("doc_id").collect())
    assert set(seen) == set(range(1350)) and max(seen.values()) == 2
    place = [r[0] for r in out.select("position").collect()]
    assert 0 < min(place) and max(place) < 1
    early = by_source(out.where("position < 0.5"))
    for s in t:                                                # at the weights throughout
        assert early[s][0] / got[s][0] == pytest.approx(0.5, abs=0.15)


def test_entropy(docs):
    t = totals(docs)
    target = 0.9 * math.log(4)
    out = by_source(mixing.mix(docs, entropy=target))
    assert -sum(w * math.log(w) for _, w in out.values()) == pytest.approx(target, abs=1e-6)


def test_budget_samples(docs):
    t = totals(docs)
    out = mixing.mix(docs, repetition=0.5, budget=sum(t.values()) // 2)
    got = by_source(out)
    assert sum(n for n, _ in got.values()) <= sum(t.values()) // 2
    assert all(n <= 0.5 * t[s] + 1 for s, (n, _) in got.items())
    assert out.count() == out.select("doc_id").distinct().count()


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, "a", None, 1.0), (1, "a", None, 1.0), (None, None, "", 2.0), (2, "b", "x y", 3.0),
                                (3, "b", "z " * 50_000, 4.0)], "doc_id long, source string, text string, weight double")
    out = mixing.mix(df)
    assert out.columns == ["doc_id", "source", "text", "n_tokens", "weight", "epoch", "block", "position"]
    assert sorted(r[0] or 0 for r in out.select("doc_id").collect()) == [0, 1, 1, 2, 3]
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df.where("text is null")).count() == 2
