"""Held-out accuracy, misspellings, odd rows."""

from __future__ import annotations

import math
import tracemalloc
import unicodedata

import numpy as np
import pytest

from shelfcast.llm import toxicity


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(0)
    calm = ["river", "stone", "meadow", "garden", "window", "paper", "silver", "morning", "bread", "winter", "idea", "stupendous"]
    bad = ["idiot", "moron", "worthless", "stupid"]
    texts, label = [], []
    for i in range(600):
        t = list(rng.choice(calm, rng.integers(3, 200)))
        if i % 3 == 0:
            for _ in range(rng.integers(1, 4)):
                t.insert(int(rng.integers(0, len(t) + 1)), str(rng.choice(bad)))
        texts.append(" ".join(t))
        label.append(int(i % 3 == 0))
    return toxicity.fit(texts, np.array(label), 0.33), texts, np.array(label)


def scores(model, texts):
    return model.probability(toxicity.grams_of(texts).best(model.of_bucket()))


def test_one_word_in_a_long_text(model):
    own, texts, label = model
    assert ((scores(own, texts) >= 0.5) == (label == 1)).mean() > 0.98
    calm = "river stone meadow garden " * 3000
    a, b = scores(own, [calm, calm[:30000] + " idiot " + calm[30000:]])
    assert a < 0.5 <= b


def test_misspelling_shares_ngrams(model):
    own, *_ = model
    miss, other = scores(own, ["river stone worthlesss garden", "river stone wanderings garden"])
    assert miss > 0.5 > other


def test_texts_do_not_depend_on_their_batch(model):
    own, texts, _ = model
    together = scores(own, texts[:20] + ["", "!!", "ÉTÉ 漢字"])
    alone = np.concatenate([scores(own, [t]) for t in texts[:20] + ["", "!!", "ÉTÉ 漢字"]])
    assert np.allclose(together, alone)


def test_frames(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fitted, share = toxicity.fit_rows(docs, labels)
    assert 0.05 < share < 0.3
    extra = spark.createDataFrame([(1, None, 5), (None, "", 6), (2, "x " * 200_000, 7), (2, "x " * 200_000, 7)],
                                  "doc_id long, text string, score int")
    out = toxicity.score(extra, fitted)
    assert out.columns == ["doc_id", "score"] and out.where("score between 0 and 1").count() == 4
    assert toxicity.drop_toxic(extra, labels.limit(0)).columns == ["doc_id", "text", "score"]
    assert toxicity.drop_toxic(extra, labels.limit(0)).count() == 4
    assert toxicity.score(extra.limit(0), fitted).count() == 0


def test_held_out_accuracy(spark):
    from shelfcast.llm.toxicity import op10_subword_toxicity
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = op10_subword_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").collect()
    y, s = np.array([r.toxic for r in rows]), np.array([r.score for r in rows])
    auc = (s[y == 1][:, None] > s[y == 0][None, :]).mean()
    assert auc > 0.9
    assert np.mean((s >= 0.5)[y == 0]) < 0.03


def test_long_texts_train_and_calibrate(spark):
    rng = np.random.default_rng(5)
    words = np.array([f"w{a}{b}ord" for a in "abcdefgh" for b in "ijklmnop"])
    docs, labels = [], []
    for i in range(160):
        text = list(rng.choice(words, 1200))
        if i % 2:
            text[int(rng.integers(0, 1200))] = "hatefulness"
        docs.append((i, " ".join(text)))
        labels.append((i, i % 2))
    assert min(len(t) for _, t in docs) > 6_000
    df = spark.createDataFrame(docs, "doc_id long, text string")
    model, share = toxicity.fit_rows(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert all((got[i] >= 0.5) == (i % 2 == 1) for i in range(160))


def plain_score(model, text):
    """The score by loops over words, n-grams and windows."""
    values, factors = model.of_bucket().astype(float), [int(f) for f in toxicity._FACTORS]
    words = "".join(c if unicodedata.category(c)[0] in "LMN" else " " for c in (text or "").lower()).split()
    logits = []
    for w in words:
        marked, held = [32, *map(ord, w), 32], []
        for n in toxicity.NGRAMS:
            for i in range(len(marked) - n + 1):
                h = sum(c * f for c, f in zip(marked[i:i + n], factors)) % 2**32
                held.append(values[(((h ^ (h >> 15)) * 2654435769 + n) % 2**32) >> 14])
        logits.append(sum(held) / len(held))
    k = toxicity.WINDOW_WORDS
    best = max((sum(logits[max(0, i - k + 1):i + 1]) / k for i in range(len(logits))), default=0.0)
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, model.slope * best + model.offset))))


def test_scores_against_a_plain_version(spark, model):
    own, texts, _ = model
    odd = [None, "", " ", "!?", "a", "Ça  va\u0301 IDIOT!", "漢字 morons 12 😀 x-y_z", "ΟΔΟΣ ΣΑΣ", "river " * 30 + "stupidd " + "stone " * 30]
    rows = list(enumerate(odd + texts[:120]))
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), own).collect()}
    for i, text in rows:
        assert got[i] == pytest.approx(plain_score(own, text), abs=1e-5)


def test_query_rows_against_a_plain_version(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    fitted, _ = toxicity.fit_rows(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    got = {r.doc_id: r for r in toxicity.op10_subword_toxicity(spark, folder).collect()}
    texts = docs.collect()
    assert len(got) == len(texts)
    for r in texts:
        assert got[r.doc_id].score == pytest.approx(plain_score(fitted, r.text), abs=1e-5)
        assert got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.5)


def test_grams_are_held_once():
    """The n-grams of the training texts are the driver's largest table: no second copy is made to join the runs."""
    texts = [f"some words of text {i} and {'more ' * (i % 200)}İstanbul" for i in range(4000)]
    toxicity.grams_of(texts[:2])                    # tables that are kept
    tracemalloc.start()
    grams, starts, cuts = toxicity._by_word(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.8 * grams.nbytes + 3 * (starts.nbytes + cuts.nbytes)
    parts = [toxicity.grams_of(texts[a:a + 64]) for a in range(0, len(texts), 64)]
    assert np.array_equal(grams, np.concatenate([p.buckets[np.argsort(p.words, kind="stable")] for p in parts]))
    assert starts[-1] == len(grams) and len(starts) - 1 == cuts[-1] == sum(int(p.cuts[-1]) for p in parts)
