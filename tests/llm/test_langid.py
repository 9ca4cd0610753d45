"""Profiles and distances against a plain version; held-out accuracy."""

from __future__ import annotations

import unicodedata
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from shelfcast.llm import langid


def plain_grams(text):
    words, word = [], ""
    for c in text.lower() + " ":
        if unicodedata.category(c)[0] == "L":
            word += c
        elif word:
            words.append(word)
            word = ""
    out = Counter()
    for w in words:
        out.update(w)
        marked = f"\x01{w}\x01"
        for n in (2, 3):
            # an n-gram has letters throughout, or a mark at an end
            out.update(g for g in (marked[i:i + n] for i in range(len(marked) - n + 1)))
    return out


def key(g):
    k = 0
    for c in g:
        k = (k << 21) | ord(c)
    return k


def test_grams():
    for text in ["Hello, world!", "a b", "ÉTÉ... 漢字 x1y", "", "!!", "one", "  two  words "]:
        keys, counts = langid.grams(text)
        assert dict(zip(keys.tolist(), counts.tolist())) == {key(g): n for g, n in plain_grams(text).items()}, text


def test_windows(monkeypatch):
    text = "some words of a text " * 40
    whole = dict(zip(*map(np.ndarray.tolist, langid.grams(text))))
    monkeypatch.setattr(langid, "WINDOW", 21)
    assert dict(zip(*map(np.ndarray.tolist, langid.grams(text)))) == whole


def test_learning_and_distance(spark):
    rows = [("the cat and the dog", "en"), ("the house", "en"), ("der hund und die katze", "de"), ("das haus", "de"),
            ("ignored", None), (None, "fr"), ("", "fr")]
    profiles = langid.learn(spark.createDataFrame(rows, "text string, lang string"))
    for lang in ("en", "de"):
        total = Counter()
        for t, own in rows:
            if own == lang:
                total.update(plain_grams(t))
        want = sorted((-n, key(g)) for g, n in total.items())[:langid.PROFILE]
        assert profiles[lang].tolist() == [k for _, k in want]
    own = langid.Profiles(profiles)
    ranked = langid.ranked(*langid.grams("the cat"))
    for name, d in zip(own.names, own.distances(ranked)):
        place = {k: i for i, k in enumerate(profiles[name].tolist())}
        want = sum(abs(place[k] - i) if k in place else langid.PROFILE for i, k in enumerate(ranked.tolist()))
        assert d == want / (langid.PROFILE * len(ranked))
    assert own.name("the dog")[0] == "en" and own.name("der hund")[0] == "de"


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "p"), (2, " 12 ", "q"), (None, "hund", "r"), (3, "cat " * 400_000, "s")],
                               "doc_id long, text string, score string")
    profiles = {"de": langid.ranked(*langid.grams("hund")), "en": langid.ranked(*langid.grams("cat"))}
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(df, profiles).collect()}
    assert got[1] == got[2] == ("und", 0.0) and got[None][0] == "de" and got[3][0] == "en"
    assert all(0 <= s <= 1 for _, s in got.values())
    assert langid.predict(df, {}).where("lang_pred = 'und'").count() == 4
    assert langid.predict(df.limit(0), profiles).count() == 0
    assert langid.learn(spark.createDataFrame([], "text string, lang string")) == {}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = langid.op5_rank_order_langid(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 150 and right > 0.93


def test_windows_change_nothing(monkeypatch):
    text = "Ein Text — mit einigen Wörtern, 12 Zahlen und sehrlangenwörternohneende" * 3
    whole = [x.tolist() for x in langid.grams(text)]
    for size in (1, 2, 7, 10, 33):
        monkeypatch.setattr(langid, "WINDOW", size)
        assert "".join(langid.windows(text)) == text
        assert [x.tolist() for x in langid.grams(text)] == whole
