"""Content sort against a grouping in Python."""

from __future__ import annotations

import hashlib

import pytest

from shelfcast.llm.exactdedup import content_sort, dedup


def norm(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def expected(rows, keep):
    best = max if keep == "largest" else min
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    return {(i, best(groups[norm(t)]), len(groups[norm(t)]), i == best(groups[norm(t)]),
             hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in rows}


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_groups(spark, keep):
    rows = [(1, "Hello World"), (2, "hello world"), (3, "ÉTÉ"), (4, "été"), (5, "ÉtÉ"), (6, None), (7, ""),
            (8, "x" * 300_000), (9, "X" * 300_000), (10, "x" * 299_999 + "y"), (11, " hello world")]
    rows += [(100 + i, "Hot Copy") for i in range(700)]          # cut into pieces
    rows += [(900 + i, f"hot copy {i}") for i in range(50)]      # share the leading bytes
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = content_sort(df, keep=keep).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert len(got) == len(rows)
    assert {tuple(r) for r in got} == expected(rows, keep)


def test_dedup_keeps_columns_and_one_of_repeated_rows(spark):
    rows = [(1, "a", "s"), (1, "A", "s"), (None, "a", "t"), (2, "b", None), (None, "c", "u"), (None, "c", "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = [tuple(r) for r in dedup(df).collect()]
    assert len(got) == 3 and {(i, t.lower(), k) for i, t, k in got} == {(1, "a", "s"), (2, "b", None), (None, "c", "u")}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert content_sort(df).count() == 0 and dedup(df).columns == ["doc_id", "text"]


def test_native_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = content_sort(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
