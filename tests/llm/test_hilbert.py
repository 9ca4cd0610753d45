"""The curve, the law of rows, and pruning."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfcast.llm import hilbert


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_curve_visits_each_cell_once_by_unit_steps(dims, bits):
    side = 1 << bits
    cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = hilbert.hilbert_index(cells, bits)
    assert sorted(index.tolist()) == list(range(side ** dims))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_law_of_rows(spark, tmp_path):
    rows = [(i * 7, None if i % 50 == 0 else "é" * (i % 90), "src0" if i % 3 else f"src{i % 19}", ["en", "de", None][i % 3])
            for i in range(1003)] + [(5, "same", "s", "en")] * 2
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = hilbert.op8_hilbert_shards(spark, str(tmp_path)).collect()
    assert len(got) == 1005
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert sorted(slots) == list(range(24))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    along = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.hilbert for r in along] == sorted(r.hilbert for r in got)
    text = dict((i, t or "") for i, t, *_ in rows)
    for r in got:
        b = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(b) + 8, zlib.crc32(b), "rows", None)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(1, 2.0, "x"), (None, None, None)], "doc_id long, a double, shard string")
    out = hilbert.shard(df, {"a": F.col("a")}, "doc_id")
    assert out.columns == ["doc_id", "a", "hilbert", "shard", "slot"]
    assert {(r.shard, r.slot) for r in out.collect()} == {(0, 0), (12, 0)}
    assert hilbert.shard(df.limit(0), {"a": F.col("a")}, "doc_id").count() == 0


def test_pruning(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, float(rng.integers(0, 1000)), float(rng.integers(0, 1000))) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, a double, b double")
    out = hilbert.shard(df, {"a": F.col("a"), "b": F.col("b")}, "doc_id", shards=64)
    hilbert.write(out, f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == 4000
    zones = hilbert.zones(back, ["a", "b"])
    for window in ({"a": (100.0, 150.0)}, {"b": (800.0, 840.0)}, {"a": (10.0, 90.0), "b": (500.0, 600.0)}):
        need = {r.shard for r in hilbert.needed(zones, **window).collect()}
        inside = back
        for c, (lo, hi) in window.items():
            inside = inside.where(F.col(c).between(lo, hi))
        assert {r.shard for r in inside.select("shard").distinct().collect()} <= need
        assert len(need) <= 24


def test_texts_with_a_common_start_are_told_apart(spark):
    names = [f"commoncrawl-2023-{i:02}" for i in range(8)]
    rows = [(i, names[i % 8], i // 8) for i in range(800)] + [(900, None, 1), (901, "", 2)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    dims = {"source": F.col("source"), "size": F.col("size")}
    cuts = hilbert._cuts(df, dims, 5)[0]
    # the last value needs no bound
    assert cuts == [n.encode() for n in names[:-1]] or cuts == [n.encode() for n in names]
    out = hilbert.shard(df, dims, "doc_id", shards=64)
    zones = hilbert.zones(out, ["source"])
    for name in names:
        assert hilbert.needed(zones, source=(name, name)).count() <= 24
    assert out.count() == 802


def plain_index(point, bits):
    """The curve's index of one point, bit by bit."""
    x, n = list(point), len(point)
    for level in reversed(range(1, bits)):
        low = (1 << level) - 1
        for d in range(n):
            if x[d] >> level & 1:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[d]) & low
                x[0], x[d] = x[0] ^ swap, x[d] ^ swap
    for d in range(1, n):
        x[d] ^= x[d - 1]
    flip = 0
    for level in range(1, bits):
        if x[-1] >> level & 1:
            flip ^= (1 << level) - 1
    return int("".join(str((v ^ flip) >> b & 1) for b in reversed(range(bits)) for v in x), 2)


def plain_cells(values, bits, text):
    """Cells by exact quantiles: bounds are the values at each ``2 ** bits``-th part."""
    known, cells = sorted(v for v in values if v is not None), 1 << bits
    if text:
        bounds = set()
        for v in set(known):
            upto = sum(w <= v for w in known)
            if min(upto * cells // len(known), cells - 1) > (upto - known.count(v)) * cells // len(known):
                bounds.add(v)
    else:
        bounds = {known[max(0, -(-len(known) * i // cells) - 1)] for i in range(1, cells)}
    return [0 if v is None else sum(b < v for b in bounds) for v in values]


def test_assignment_against_a_plain_version(spark, tmp_path):
    rng = np.random.default_rng(17)
    rows = [(int(i) * 3 + 1, "é" * int(rng.integers(0, 200)) if i % 40 else None,
             None if i % 31 == 0 else f"src{int(rng.integers(0, 9)) ** 2 % 23}", ["en", "de", "fr", None][int(rng.integers(0, 4))])
            for i in range(700)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.hilbert, r.shard, r.slot) for r in hilbert.op8_hilbert_shards(spark, str(tmp_path)).collect()}
    sizes = [len((t or "").encode()) + 8 for _, t, _, _ in rows]
    cells = list(zip(plain_cells([s and s.encode() for _, _, s, _ in rows], hilbert.BITS, True),
                     plain_cells([g and g.encode() for *_, g in rows], hilbert.BITS, True),
                     plain_cells(sizes, hilbert.BITS, False)))

    def signed_hash(i):
        h = xxhash.xxh64(i.to_bytes(8, "little"), seed=42).intdigest()
        return h - (1 << 64) if h >> 63 else h

    order = sorted((plain_index(c, hilbert.BITS), signed_hash(r[0]), r[0]) for c, r in zip(cells, rows))
    n, taken = len(order), {}
    for rank, (index, _, i) in enumerate(order):
        shard = rank * hilbert.SHARDS // n
        slot = taken[shard] = taken.get(shard, -1) + 1
        assert got[i] == (index, shard, slot)
