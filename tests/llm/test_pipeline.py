"""The pipeline against a plain version of each stage, and the registration."""

from __future__ import annotations

import base64
from collections import Counter

import duckdb
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from shelfcast.llm import bpe, mixing, toxicity
from test_neardup import brute

SF = "/root/testdata/sf0.001"


def test_run_against_plain_stages(spark):
    docs = {r[0]: r for r in duckdb.connect().execute(
        f"select doc_id, text, lang, source, n_chars from read_parquet('{SF}/documents.parquet')").fetchall()}
    # the scores are the model's; what they decide is checked here
    scored = toxicity.op10_subword_toxicity(spark, SF).collect()
    left = {r.doc_id for r in scored if r.score < 0.5}
    assert 0 < len(left) < len(docs)
    norm = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    first = {}
    for i in sorted(left):
        first.setdefault(norm(docs[i][1]), i)
    left = set(first.values())
    left = {i for i, _, _, kept in brute([(i, docs[i][1]) for i in sorted(left)]) if kept}

    out = corpus_pipeline.run(spark, SF).collect()
    seen = Counter(r.doc_id for r in out)
    assert set(seen) == left and set(seen.values()) <= {1, 2}
    tokens = Counter()
    for i in left:
        tokens[docs[i][3]] += len((docs[i][1] or "").split())
    passed = Counter()
    for i, n in seen.items():
        passed[docs[i][3]] += n * len((docs[i][1] or "").split())
    ratio = {s: passed[s] / tokens[s] for s in tokens if tokens[s]}
    assert min(ratio.values()) == 1.0 and max(ratio.values()) <= mixing.REPETITION_LIMIT
    assert ratio[max(tokens, key=tokens.get)] == 1.0           # the largest source isn't repeated
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(bpe.VOCABULARY), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in out:
        assert r.ids == library.encode_ordinary(docs[r.doc_id][1] or "") and r.n_tokens == len(r.ids)


def test_stages_keep_columns_and_take_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, None, None, 0, "x"), (2, "", "en", "a", 0, "x"), (3, "Some words", "en", "a", 10, "x"),
                                  (3, "Some words", "en", "a", 10, "x"), (None, "other words", "en", "b", 11, "x")],
                                 "doc_id long, text string, lang string, source string, n_chars long, kept string")
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, SF)
            if name != "bpe":
                assert out.columns == docs.columns, name
            assert out.count() <= (2 if name == "mixing" else 1) * table.count()


def test_mixing_keeps_order_and_clashing_columns(spark):
    rows = [(i, "some words " * (1 + i % 3), "en", "ab"[i % 4 == 0], 10, 7.5 + i, 100 + i, "p") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, weight double, epoch int, position string")
    out = corpus_pipeline.mixed(spark, docs, SF)
    assert out.columns == docs.columns
    got = out.collect()
    assert all((r.weight, r.epoch, r.position) == (7.5 + r.doc_id, 100 + r.doc_id, "p") for r in got)
    places = {}
    for r in mixing.mix(docs.drop("weight", "epoch", "position")).collect():
        places.setdefault(r.doc_id, []).append(r.position)
    by_part = {}
    for r in out.select("doc_id", F.spark_partition_id().alias("part")).collect():
        by_part.setdefault(r.part, []).append(r.doc_id)
    assert sorted(r.doc_id for r in got) == sorted(i for i, ps in places.items() for _ in ps)
    for ids in by_part.values():
        once = [places[i][0] for i in ids if len(places[i]) == 1]
        assert once == sorted(once)


def test_all_queries_are_registered():
    names = list(__spark_entry__.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "mixing", "bpe"]
