"""Near-duplicate components against all pairs in Python."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest

from shelfcast.llm import neardup, shingles
from shelfcast.llm.common import HOT_KEYS, join_one
from shelfcast.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORDS.findall(low)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """Component of each row by comparing all pairs."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    by = {}
    for i, s in sets:
        for x in s:
            by.setdefault(x, []).append((i, s))
    for i, s in sets:
        seen = {j: o for x in s for j, o in by[x] if j < i}
        for j, o in seen.items():
            both = len(s & o)
            if 100 * both >= 75 * (len(s) + len(o) - both):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {(i, len(s), root(i), root(i) == i) for i, s in sets}


def found(df):
    return {tuple(r) for r in neardup.near_duplicates(df).select("doc_id", "n_shingles", "component_id", "kept").collect()}


def corpus(seed, families=12, copies=40):
    """Families of edited copies: light and heavy edits, chains, cuts, a shared
    passage, sets nested in larger ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    shared = [word() for _ in range(60)]
    rows = []
    for f in range(families):
        base = [word() for _ in range(rng.choice([3, 6, 12, 40, 120, 300]))]
        last = base
        for c in range(copies if f == 0 else rng.randrange(1, 9)):
            source = last if rng.random() < 0.4 else base
            text = list(source)
            for _ in range(rng.choice([0, 0, 1, 2, 3, len(text) // 30, len(text) // 20, len(text) // 12])):
                text[rng.randrange(len(text))] = word()
            if rng.random() < 0.15:
                text = text[:max(1, int(len(text) * rng.choice([0.5, 0.76, 0.8, 0.9])))]
            if rng.random() < 0.15:
                text = text + shared[:rng.randrange(60)]
            last = text
            rows.append(" ".join(w.upper() if rng.random() < 0.1 else w for w in text))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_families(spark, seed):
    rows = corpus(seed)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_many_heavy_edits_around_one_text(spark):
    """Copies that are near the base but not near each other."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(150)]
    rows = []
    for i in range(300):
        text = list(base)
        for k in rng.sample(range(150), rng.randrange(0, 14)):
            text[k] = word()
        rows.append((i * 3, " ".join(text)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_given_table(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    rows = duckdb.connect().execute(f"select doc_id, text from read_parquet('{path}')").fetchall()
    assert found(spark.read.parquet(path)) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, "p"), (2, "", "q"), (3, " \t\n", "r"), (4, "one two", "s"), (5, "ONE  two", "t"), (6, "two one", "u"),
            (None, "one two", "v"), (7, "a b c d e", "w"), (7, "a b c d e", "w"), (8, "x " * 5000, "y"), (9, "x " * 90, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()}
    assert got == {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True),
                   (None, 1, None, True), (7, 1, 7, True), (8, 1, 8, True), (9, 1, 8, False)}
    kept = neardup.drop_near_duplicates(df)
    assert kept.columns == ["doc_id", "text", "kept"] and kept.count() == len(rows) - 2
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_shingles_equal_definition():
    texts = ["The quick  brown\tfox jumps over the lazy dog", "THE QUICK brown fox jumps", "é É e", "", "a b c d", "\n"]
    data = "".join(texts).encode()
    cuts = np.cumsum([0] + [len(t.encode()) for t in texts])
    sets = shingles.shingle_sets(np.frombuffer(data, dtype=np.uint8), cuts)
    assert [len(s) for s in sets] == [len(shingle_set(t)) for t in texts]
    assert set(sets[1].tolist()) <= set(sets[0].tolist())


def test_signatures_estimate_resemblance():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 1 << 63, 1400, dtype=np.uint64)
    a, b = np.unique(pool[:1200]), np.unique(pool[200:])
    share = np.mean([np.mean(np.equal(*shingles.signatures([np.unique(pool[k:k + 700]), np.unique(pool[k + 100:k + 800])], 256)))
                     for k in range(0, 600, 50)])
    assert abs(share - 600 / 800) < 0.04
    assert abs(np.mean(np.equal(*shingles.signatures([a, b], 512))) - 1000 / 1400) < 0.08


def test_components(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(0, 90)] + [(200, 300), (300, 200), (500, 500)] + [(1000, 1000 + i) for i in range(50)]
    rng.shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(91)}, 200: 200, 300: 200, **{1000 + i: 1000 for i in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def family(word, n=60):
    return " ".join(f"{word}{i}" for i in range(n))


def test_rows_that_share_an_identifier_share_a_component(spark):
    a, b = family("a"), family("b")
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, family("c")), (None, a), (5, ""), (5, a)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    component = {}
    for r in got:
        component.setdefault(r.doc_id, set()).add(r.component_id)
    assert len(got) == len(rows)
    assert component == {1: {1}, 2: {1}, 3: {1}, 4: {4}, None: {None}, 5: {1, 5}}   # 5: an empty text and a's


def test_text_identifiers(spark):
    rows = [("x9", family("a")), ("x10", family("a") + " more"), ("b", family("b")), ("ab", family("b")), ("c", "one two")]
    got = {r.key: (r.component_id, r.kept) for r in neardup.near_duplicates(
        spark.createDataFrame(rows, "key string, text string"), ident="key").collect()}
    assert got == {"x9": ("x10", False), "x10": ("x10", True), "b": ("ab", False), "ab": ("ab", True), "c": ("c", True)}


def test_rows_of_frequent_keys_stay_where_they_are(spark):
    """A key with a third of all rows is broadcast, the others are dealt: the same
    rows as a plain join, and keys that ``one`` doesn't have drop out."""
    rows = spark.range(6 * HOT_KEYS).selectExpr("id", "if(id % 3 = 0, -1, id div 2) as key")
    one = rows.groupBy("key").count().where("key % 5 <> 0").selectExpr("key", "count as freq", "key * 7 as what")
    got = join_one(rows, one, "key", rows.count()).select("id", "key", "what").collect()
    want = rows.join(one, "key").select("id", "key", "what").collect()
    assert len(got) == len(want) > 4 * HOT_KEYS and set(got) == set(want)
    assert sum(r.key == -1 for r in got) == 2 * HOT_KEYS


def test_pieces_of_a_list_meet_each_other(spark):
    """Lists with many components, one with most of the rows (so it is cut): the
    pairs are those of all pairs of different components of each list."""
    rng = random.Random(3)
    rows = [(0, node, rng.choice([40, 45, 50, 70]), rng.randrange(100), node // 3, rng.randrange(8)) for node in range(90)]
    rows += [(1 + node // 4, node, 50, 1, node // 2, 1) for node in range(90, 130)]
    lists = spark.createDataFrame(rows, "list long, node long, n long, central long, component long, place long")
    got = neardup._across(lists, len(rows))
    want = set()
    for a in rows:
        for b in rows:
            most = 1 + min(a[2] - a[5], b[2] - b[5])
            if (a[0] == b[0] and a[4] < b[4] and 100 * min(a[2], b[2]) >= 75 * max(a[2], b[2])
                    and 175 * most >= 75 * (a[2] + b[2])):
                want.add((b[1], b[2], a[1], a[2]))
    found_pairs = [tuple(r) for r in got.select("hub", "hub_n", "node", "n").collect()]
    assert len(found_pairs) == len(want) and set(found_pairs) == want and len(want) > 1000


def test_no_plan_holds_the_making_of_components(spark, monkeypatch):
    """What link_components returns is a table that was written, so its readers only scan it."""
    got, whole = [], neardup.link_components
    monkeypatch.setattr(neardup, "link_components", lambda *a: got.append(whole(*a)) or got[-1])
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words, f"end{i % 3}"])) for i in range(6)] + [(9, "alone")]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in found if r.doc_id < 6} == {0} and len(found) == 7
    plan = got[0]._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan and "Aggregate" not in plan and "Exchange" not in plan
