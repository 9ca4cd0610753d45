"""The alignment against the two libraries on whole texts and a plain merge."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfcast.llm import alignment as al


@pytest.fixture(scope="module")
def own():
    return al.pair(al.A_FILE, al.B_FILE)


def hard_texts():
    rng = random.Random(1)
    fixed = ["", "a", " ", "  ", "a ", "a  b", " a", "\n", "a\n b", "a \n  b", "x▁y", "<0x41> <s> </s> <unk> <|endoftext|>",
             "日本語 テスト 文", "😀😀 a", "don't we'll I'VE", "a\x00b \x00", "tab\tb \t c", "a" * 500, "   ", "12 345  6,7",
             "\x1c a\x1c b", "\x85 a \x85", "　 a b　 c"]
    return fixed + ["".join(rng.choice("ab \n\t'é日😀.1▁ ") for _ in range(rng.randrange(40))) for _ in range(500)]


def plain(own, text):
    """Ids, groups and links by the libraries and a scan over all tokens."""
    if not text:
        return [], [], [], []
    a = own.a.encode(" " + text, add_special_tokens=False).ids
    b = own.b.encode(text)
    if not b"".join(own.a_bytes[i] for i in a) == (" " + text).encode() == b"".join(own.b_bytes[i] for i in b):
        return [], [], [], []

    def spans(ids, spelt):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(spelt[i])))
            at += len(spelt[i])
        return out

    sa, sb = spans(a, own.a_bytes), spans(b, own.b_bytes)
    groups, start = [], 0
    for end in sorted({y for _, y in sa} & {y for _, y in sb}):
        inside = lambda s: start <= s[0] and s[1] <= end  # noqa: E731, B023
        groups.append(([i for i, s in zip(a, sa) if inside(s)], [i for i, s in zip(b, sb) if inside(s)]))
        start = end
    links = [(i, j) for i, s in zip(a, sa) for j, t in zip(b, sb) if max(s[0], t[0]) < min(s[1], t[1])]
    return a, b, groups, links


def printed(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def test_tokens_groups_and_links(own):
    texts = hard_texts()
    tokens = al.tokens_of(own, texts)
    (x,) = al.alignments(own, *tokens)
    shown, pairs = x.printed(), x.pairs()
    for k, text in enumerate(texts):
        a, b, groups, links = plain(own, text)
        assert tokens[0][x.a_cuts[k]:x.a_cuts[k + 1]].tolist() == a, text
        assert tokens[1][x.b_cuts[k]:x.b_cuts[k + 1]].tolist() == b, text
        assert shown[k][:-1].decode() == printed(groups)
        assert sorted(pairs[x.link_cuts[k]:x.link_cuts[k + 1]].tolist()) == sorted(i * len(own.b_bytes) + j for i, j in links)


def test_any_size_of_piece_gives_the_same():
    rng = np.random.default_rng(3)
    for _ in range(30):
        end = int(rng.integers(1, 400))
        a, b = (np.unique(np.append(rng.integers(1, end + 1, rng.integers(1, 200)), end)) for _ in range(2))
        want = [x.tolist() for x in al.merge(a, b, 10_000)]
        starts_a, starts_b = np.append(0, a[:-1]), np.append(0, b[:-1])
        assert list(zip(*want[:2])) == [(i, j) for i in range(len(a)) for j in range(len(b))
                                        if max(starts_a[i], starts_b[j]) < min(a[i], b[j])]
        assert a[want[2]].tolist() == b[want[3]].tolist() == np.intersect1d(a, b).tolist()
        for piece in (1, 2, 7, 64):
            assert [x.tolist() for x in al.merge(a, b, piece)] == want


def test_long_text_in_windows(own, monkeypatch):
    text = " ".join(t for t in hard_texts() if "▁" not in t)
    whole_tokens = al.tokens_of(own, [text])
    (whole,) = al.alignments(own, *whole_tokens)
    monkeypatch.setattr(al, "WINDOW", 64)
    tokens = al.tokens_of(own, [text])
    assert [x.tolist() for x in tokens[:2]] == [x.tolist() for x in whole_tokens[:2]] == list(plain(own, text)[:2])
    parts = list(al.alignments(own, *tokens))
    assert len(parts) > 20
    assert b"".join(p.printed()[0] for p in parts) == whole.printed()[0]
    assert np.concatenate([p.pairs() for p in parts]).tolist() == whole.pairs().tolist()
    assert [len(x) for x in al.tokens_of(own, [text + " ▁ x"])[:2]] == [0, 0]


@pytest.mark.parametrize("room", [None, 40])
def test_query_on_a_fixture(spark, tmp_path, own, monkeypatch, room):
    if room:
        monkeypatch.setattr(al, "SLICE", room)      # counts in many slices
    rng = random.Random(5)
    words = ["the", "thé", "token", "tokens", "under", "standing", "x▁", "a,", "12", "日本", "un", "it's"]
    texts = [" ".join(rng.choice(words[:i % 12 + 1]) for _ in range(rng.choice([0, 1, 3, 12, 60]))) for i in range(25)]
    texts += [None, "", texts[3], "the  end", "<s>"]
    texts = texts if room is None else texts[8:]
    spark.createDataFrame([(i, t, 9, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_a int, pair int").write.parquet(
        f"{tmp_path}/documents.parquet")
    found = [plain(own, t or "") for t in texts]
    counts = Counter(p for f in found for p in set(f[3]))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    got = {r.doc_id: r for r in al.op12_merge_path_alignment(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, (a, b, groups, links) in enumerate(found):
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(a), len(b), len(groups), len(links))
        assert r.n_best == sum(counts[p] == most[p[0]] for p in links)
        assert r.count_sum == sum(counts[p] for p in links)
        assert r.groups_sha256 == (hashlib.sha256(printed(groups).encode()).hexdigest() if a else "")


def test_other_columns_and_an_empty_table(spark):
    rows = spark.createDataFrame([(1, "a b", "x", 7), (1, "a b", "x", 7), (None, None, None, None)],
                                 "doc_id long, text string, n_a string, pair long")
    got = al.align(rows).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_a, r.pair) for r in got] == [(None, 0, None), (1, 2, 7), (1, 2, 7)]
    assert [r.count_sum for r in got] == [0, 4, 4]
    assert al.align(rows.limit(0)).count() == 0
