"""The trie against one built turn by turn in Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from shelfcast.llm import prefixtrie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth int"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(turns.get(c - c % 100, [])[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    for node, convs in members.items():
        below, todo = [], [node]
        while todo:
            below.append(todo.pop())
            todo += children[below[-1]]
        out.append((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), len(children[node]),
                    sum(not children[n] for n in below), sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                    hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def made(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    starts = [("system", "you are né"), (None, "hi"), ("user", None), ("user", "hi")]
    for c in convs:
        n = rng.choice([1, 1, 2, 3, 5, longest])
        for t in range(n):
            who, what = rng.choice(starts[:2 if t < 3 else 4])
            if c % 7 == 3:                                   # copies of one long conversation
                who, what = "user", f"line {t % 3}"
            rows.append((c, None if t == 0 and c % 5 == 0 else t * 10, who, what, 99))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,convs,longest", [(1, [*range(0, 40), 100, 105, 130, 250, 251], 9),
                                                 (2, [*range(95, 110), *range(1000, 1030)], 40)])
def test_query_on_a_fixture(spark, tmp_path, seed, convs, longest):
    rows = made(seed, convs, longest)
    rows += [(None, 1, "user", "nobody's", 1), (3, None, None, None, 1), (3, 5, "a", "tie 2", 1), (3, 5, "a", "tie 2", 1)]
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = pt.op13_conversation_trie(spark, str(tmp_path))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == plain(rows)


def test_turnless_conversations_only_have_a_root(spark):
    # 1500's own turn is replaced by those of 1500 (itself); an absent base leaves nothing
    gone = next(c for c in range(10_001, 10_100) if zlib.crc32(str(c).encode()) % 6 > 0)
    got = pt.trie(spark.createDataFrame([(gone, 1, "user", "a", 0)], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(gone).encode()).hexdigest())]


def test_empty_table(spark):
    assert pt.trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_conversation_over_several_pieces(spark):
    """One conversation holds most rows: it is spread over the range partitions."""
    rows = [(7, t, "u", f"x{t % 4}", 0) for t in range(300)] + [(8, t, "u", f"x{t % 4}", 0) for t in range(250)]
    pieces = pt.written(pt.turns(spark.createDataFrame(rows, SCHEMA)), "t")
    assert sorted(r.pos for r in pieces.where("conv = 7").collect()) == list(range(1, 301))
    assert sorted(map(tuple, pt.trie(spark.createDataFrame(rows, SCHEMA)).collect()), key=lambda r: r[:2]) == plain(rows)


def test_given_conversations(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text, 0) for r in frame.collect()]
    assert sorted(map(tuple, pt.trie(frame).collect()), key=lambda r: r[:2]) == plain(rows)
