"""Sketches against the same hashes in Python, and the order of documents."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from shelfcast.llm import fingerprint as fp


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    hashed = [0] * 4 + [signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in words] + [0] * 4
    out = set()
    for i in range(len(hashed) - 4) if words else ():
        seed = 42
        for h in hashed[i:i + 5]:
            seed = xxhash.xxh64(struct.pack("<q", h), seed=seed).intdigest()
        out.add(signed(seed))
    return out


def sketch(text):
    return sorted(shingles(text))[:fp.K]


def likeness(a, b):
    union = sorted(set(a) | set(b))[:fp.K]
    return 1.0 if not union else len(set(union) & set(a) & set(b)) / len(union)


def test_query_on_a_fixture(spark, tmp_path):
    rng = random.Random(4)
    texts = {}
    for i in rng.sample(range(5000), 40):
        texts[i] = " ".join(rng.choice(["ab", "Été", "x", "longer", "😀"]) + str(rng.randrange(30)) for _ in range(rng.choice([0, 1, 3, 9, 80, 400])))
    texts[7], texts[9] = None, " \n "
    spark.createDataFrame([(i, t, "de") for i, t in texts.items()], "doc_id long, text string, lang string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in fp.op7_bottom_k_fingerprints(spark, str(tmp_path)).collect()}
    order = sorted(texts, reverse=True)
    assert set(got) == set(order)
    for at, i in enumerate(order):
        text, after = texts[i] or "", texts[order[(at + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        pack = lambda s: base64.b64encode(struct.pack(f">{len(s)}q", *s)).decode()
        assert r.fingerprint.replace("\r\n", "") == pack(sketch(text))
        assert r.edited_fingerprint.replace("\r\n", "") == pack(sketch(edited))
        assert r.near_edited == pytest.approx(likeness(sketch(text), sketch(edited)))
        assert r.near_next == pytest.approx(likeness(sketch(text), sketch(after)))


def test_estimates_and_merging(spark):
    rng = random.Random(8)
    a = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    rows = [(0, " ".join(a)), (1, " ".join(a[1000:])), (2, " ".join(a[:1500])), (3, " ".join(a[1496:]))]
    df = spark.createDataFrame(rows, "g long, text string").withColumn("s", fp.sketch(F.col("text")))
    whole, part = (df.where(f"g = {i}").select(F.col("s").alias(n)) for i, n in ((0, "a"), (1, "b")))
    r = whole.join(part).select(fp.resemblance(F.col("a"), F.col("b")), fp.containment(F.col("b"), F.col("a")),
                                fp.containment(F.col("a"), F.col("b")), fp.distinct_shingles(F.col("a")),
                                fp.parsed(fp.printed(F.col("a"))) == F.col("a")).first()
    assert r[0] == pytest.approx(2 / 3, abs=0.15) and r[1] == pytest.approx(1, abs=0.15)
    assert r[2] == pytest.approx(2 / 3, abs=0.15) and r[3] == pytest.approx(3004, rel=0.25) and r[4]
    parts = fp.union_sketch(df.where("g >= 2").withColumn("k", F.lit(1)), ["k"], "s").first()
    both = sorted(shingles(rows[2][1]) | shingles(rows[3][1]))[:fp.K]
    assert parts.s == both


def test_odd_tables(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a b", 1), (5, "c", 2), (5, "c", 2)], "doc_id long, text string, fingerprint int")
    docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    assert fp.op7_bottom_k_fingerprints(spark, f"{tmp_path}/a").count() == 3
    docs.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert fp.op7_bottom_k_fingerprints(spark, f"{tmp_path}/b").count() == 0
    docs.where("doc_id is null").write.parquet(f"{tmp_path}/c/documents.parquet")
    r = fp.op7_bottom_k_fingerprints(spark, f"{tmp_path}/c").first()
    assert r.near_next == 1.0
    plan = fp.op7_bottom_k_fingerprints(spark, f"{tmp_path}/a")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("step", [2, 64])
def test_next_row_of_any_identifiers(spark, monkeypatch, step):
    """Texts as identifiers, one outlier, repeated identifiers, more ranges than a step holds."""
    monkeypatch.setattr(fp, "STEP", step)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        ids = [*range(300), 10**15]
        for kind in ("long", "string"):
            own = ids if kind == "long" else [f"doc-{i}" for i in ids]
            df = spark.createDataFrame([(i, f"text of {i}") for i in own], f"key {kind}, text string")
            got = {r.key: r for r in fp.with_next(df, "key", ["text"], {"long": F.upper("text")}).collect()}
            order = sorted(own, reverse=True)
            assert len(got) == len(own)
            for at, i in enumerate(order):
                after = f"text of {order[(at + 1) % len(order)]}"
                assert (got[i].next_text, got[i].next_long, got[i].long) == (after, after.upper(), f"text of {i}".upper())
        twice = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "c"), (None, "d")], "key int, text string")
        rows = fp.with_next(twice, "key", ["text"]).collect()
        assert sorted(r.next_text for r in rows) == ["a", "b", "b", "c", "d"]
        assert {r.text: r.next_text for r in rows}["d"] == "c"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_one_outlier_does_not_fill_one_range(spark):
    df = spark.createDataFrame([(i, "t") for i in [*range(4000), 10**15]], "key long, text string")
    keyed = df.select(F.struct(F.col("key").alias("id"), F.lit(0).cast("long").alias("tie")).alias("_nx_key"))
    sizes = fp._in_ranges(keyed, fp._bounds(keyed)).groupBy("_nx_bucket").count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2400
