"""Suffix sorting against plain sorting, and removal against a set of strings."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from shelfcast.llm import suffixdup as sd

LENGTH = 100


def plain(texts):
    """(id, text) in order -> (n_bytes, n_removed, n_spans, kept)."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - LENGTH + 1):
            if data[i:i + LENGTH] in seen:
                gone[i:i + LENGTH] = b"\1" * LENGTH
            seen.add(data[i:i + LENGTH])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(gone)))
        out.append((len(data), len(data) - len(kept), spans, kept))
    return out


def made(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé😀") for _ in range(rng.randrange(1, 9)))
    text = lambda k: " ".join(word() for _ in range(k))
    passages = [text(rng.choice([18, 30, 60])) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [rng.choice([text(rng.choice([1, 10, 80])), rng.choice(passages)]) for _ in range(rng.randrange(0, 5))]
        texts.append(" ".join(parts))
    for _ in range(n // 4):                                  # copies, near copies, repeats within
        t = rng.choice(texts)
        at = rng.randrange(len(t) + 1)
        texts.append(rng.choice([t, t[:at] + "X" + t[at:], t + t, t[at:]]))
    return [*texts, "a" * 700, "a" * 650, "ab" * 200, "x" + "ab" * 150, "", None, "a" * 99, "a" * 100]


@pytest.mark.parametrize("spill", [1 << 20, 40])
def test_suffixes_and_common_prefixes(monkeypatch, spill):
    monkeypatch.setattr(sd, "LENGTH", 6)
    monkeypatch.setattr(sd, "RUN", 1 << 18 if spill > 40 else 16)     # S* runs merged from disk, too
    rng = np.random.default_rng(0)
    for trial in range(120):
        text = rng.integers(1, 1 + rng.integers(1, 5), rng.integers(1, 300)).astype(np.uint8)
        if trial % 3 == 0:
            text = np.tile(text[:1 + len(text) // 3], 3)
        blocks = list(sd.descending(text, spill))
        places, common = (np.concatenate([b[k] for b in blocks]).tolist() for k in (0, 1))
        whole = text.tobytes()
        assert sorted(places) == list(range(len(text)))
        heads = [whole[p:p + 6] for p in places]
        assert heads == sorted(heads, reverse=True)
        for a, b, c in zip(heads, heads[1:], common[1:]):
            assert c == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_repeats_in_contexts(monkeypatch):
    monkeypatch.setattr(sd, "LENGTH", 6)
    rng = np.random.default_rng(1)
    for trial in range(200):
        top = int(rng.integers(1, 4))
        base = rng.integers(0, top + 1, 200).astype(np.uint8).tobytes()
        contexts = []
        for _ in range(int(rng.integers(1, 12))):
            at = int(rng.integers(0, 150))
            contexts.append(base[at:at + int(rng.integers(6, 50))] if trial % 2 else
                            rng.integers(0, top + 1, int(rng.integers(6, 30))).astype(np.uint8).tobytes())
        starts = np.array([int(rng.integers(1, len(c) - 4)) for c in contexts])
        seen, want = set(), []
        for c, n in zip(contexts, starts):
            row = []
            for i in range(n):
                row.append(c[i:i + 6] in seen)
                seen.add(c[i:i + 6])
            want.append(row)
        assert [g.tolist() for g in sd.repeats(contexts, starts)] == want


def test_equal_strings_have_equal_anchors():
    rng = random.Random(2)
    common = bytes(rng.randrange(97, 101) for _ in range(LENGTH))
    texts = [bytes(rng.randrange(97, 101) for _ in range(rng.randrange(0, 300))) + common
             + bytes(rng.randrange(97, 101) for _ in range(rng.randrange(0, 300))) for _ in range(20)]
    cuts = np.cumsum([0] + [len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    every = np.unique(sd.anchored(data, cuts)[0])
    for mixed in (None, every):                              # cut contexts, too
        _, key, _, text, first, count = sd.anchored(data, cuts, mixed)
        assert count.sum() == sum(len(t) - LENGTH + 1 for t in texts)
        assert mixed is None or count.max() <= sd.STEP
        holds = set()
        for i, t in enumerate(texts):
            at = t.index(common)
            holds.add(key[(text == i) & (first <= at) & (at < first + count)].item())
        assert len(holds) == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_query_on_a_fixture(spark, tmp_path, monkeypatch, seed):
    if seed == 3:                                            # every anchor is dealt in pieces, many are cut
        monkeypatch.setattr(sd, "SAMPLE", 1.0)
        monkeypatch.setattr(sd, "LEAST_SAMPLED", 1)
        monkeypatch.setattr(sd, "HOT_PER_PARTITION", 1000)
    texts = made(seed)
    spark.createDataFrame([(3 * i - 50, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(
        4).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, sd.op11_suffix_dedup(spark, str(tmp_path)).collect()))
    want = [(3 * i - 50, *r[:3], hashlib.sha256(r[3]).hexdigest()) for i, r in enumerate(plain(texts))]
    assert got == want


def test_repeated_and_null_identifiers_and_other_columns(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [("b", long, 1.5, "x"), ("b", long, 1.5, "x"), (None, long + " end", 2.5, "y"), ("a", "short", None, None), ("b", None, 0.0, "")]
    frame = spark.createDataFrame(rows, "key string, text string, n_removed double, _note string")
    got = sd.deduplicated(frame, ident="key", texts=True).collect()
    assert sorted(((r.key, r._note, r.n_removed, bytes(r.kept).decode()) for r in got), key=str) == sorted([
        ("b", "x", len(long), ""), ("b", "x", len(long), ""), (None, "y", 0, long + " end"), ("a", None, 0, "short"), ("b", "", 0, "")], key=str)
    assert sd.deduplicated(frame.limit(0), ident="key").count() == 0


def test_given_documents(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = sorted(map(tuple, frame.collect()))
    got = sorted(map(tuple, sd.deduplicated(frame).collect()))
    assert got == [(i, *r[:3], hashlib.sha256(r[3]).hexdigest()) for (i, _), r in zip(rows, plain([t for _, t in rows]))]
