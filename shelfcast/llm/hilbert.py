"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised into ``2 ** BITS`` cells, numbers by
their approximate quantiles, texts by exact ones of the whole values in the order
of their bytes; the cells' Hilbert index is computed in numpy, and the rows are
sorted by it: rows near each other in all dimensions come to lie near each
other. Equal indices are ordered by a hash of the identifier, so a frequent cell
is spread over sort partitions like anything else. The sorted order is cut into
runs of equal numbers of rows (at most one apart), each a shard with gapless
slots. A shard covers a small box of every dimension: its smallest and largest
values (``zones``) tell a reader which shards a filter on any of the dimensions
needs (``needed``).

The global rank is the rank in the sort partition plus the rows of the
partitions before; only one count a partition is put together.

Defined cases: null values come before all others of their dimension; a null
text has 0 bytes; rows with equal identifiers are told apart by their other
columns' hash, and fully equal rows are interchangeable; fewer rows than shards
leave shards empty; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import map_arrow, partitions, table, written

BITS = 5
SHARDS = 24
ACCURACY = 2000          # of the quantiles: one part in so many


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the curve of points with coordinates ``cells[row, dimension]``
    below ``2 ** bits`` (Skilling's transform, all rows at once)."""
    x = [cells[:, d].astype(np.int64) for d in range(cells.shape[1])]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for d in range(n):
            on = (x[d] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[d]) & (q - 1))
            x[0] = np.where(on, x[0] ^ (q - 1), x[0] ^ swap)
            x[d] = x[d] if d == 0 else x[d] ^ swap
        q >>= 1
    for d in range(1, n):
        x[d] = x[d] ^ x[d - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(n):
            index = (index << 1) | (((x[d] ^ t) >> b) & 1)
    return index


def _text_cuts(df: DataFrame, c: Column, bits: int) -> list[bytes]:
    """Upper bounds of cells among a text's values: each that passes another
    ``2 ** bits``-th of the rows. Values are counted and sorted by ranges; a sum
    a range is put together, and the bounds come to the driver."""
    cells = 1 << bits
    counts = df.select(c.cast("binary").alias("v")).where(F.col("v").isNotNull()).groupBy("v").agg(F.count("*").alias("n"))
    ranges = written(counts.repartitionByRange(partitions(df.sparkSession), "v").withColumn("part", F.spark_partition_id()),
                     "hilbert-texts", per_core=2)
    sums = ranges.groupBy("part").agg(F.sum("n").alias("rows"))
    before = sums.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"),
                         F.sum("rows").over(Window.partitionBy()).alias("total"))
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("v")) + F.col("before")
    share = lambda rows: F.floor(rows * F.lit(cells) / F.col("total"))
    passed = ranges.join(F.broadcast(before), "part").withColumn("upto", upto).where(
        F.least(share(F.col("upto")), F.lit(cells - 1)) > share(F.col("upto") - F.col("n")))
    return sorted(bytes(r.v) for r in passed.select("v").collect())


def _cuts(df: DataFrame, dims: dict[str, Column], bits: int) -> list[np.ndarray | list[bytes]]:
    """Up to ``2 ** bits - 1`` distinct upper bounds of cells a dimension."""
    points = [i / (1 << bits) for i in range(1, 1 << bits)]
    texts = _texts(df, dims)
    numbers = [F.percentile_approx(c.cast("double"), F.array(*map(F.lit, points)), F.lit(ACCURACY)).alias(d)
               for d, c in dims.items() if d not in texts]
    row = df.agg(*numbers).first() if numbers else {}
    return [_text_cuts(df, c, bits) if d in texts else np.unique(np.array(row[d] or [], dtype=np.float64))
            for d, c in dims.items()]


def _texts(df: DataFrame, dims: dict[str, Column]) -> set[str]:
    """The dimensions that are texts."""
    kinds = df.select(*[c.alias(d) for d, c in dims.items()]).schema
    return {f.name for f in kinds if isinstance(f.dataType, (T.StringType, T.BinaryType))}


def _text_cells(column: pa.Array, cuts: list[bytes]) -> np.ndarray:
    coded = column.dictionary_encode()
    cells = np.array([0, *[bisect_left(cuts, v) for v in coded.dictionary.to_pylist()]], dtype=np.int64)
    return cells[coded.indices.fill_null(-1).to_numpy(zero_copy_only=False) + 1]


def shard(df: DataFrame, dims: dict[str, Column], ident: str, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """``df`` with ``hilbert`` (the index), ``shard`` and ``slot`` (replacing
    columns of these names). ``dims``: a numeric or text column for each dimension."""
    if bits * len(dims) > 62:
        raise ValueError("at most 62 bits in all")
    keep = [c for c in df.columns if c not in ("hilbert", "shard", "slot")]
    cuts, texts = _cuts(df, dims, bits), _texts(df, dims)
    names = [f"_hb_{i}" for i in range(len(dims))]
    schema = T.StructType([df.schema[c] for c in keep]).add("hilbert", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros((batch.num_rows, len(names)), dtype=np.int64)
            for d, name in enumerate(names):
                column = batch.column(batch.schema.get_field_index(name))
                if isinstance(cuts[d], list):
                    cells[:, d] = _text_cells(column, cuts[d])
                    continue
                values = np.nan_to_num(column.to_numpy(zero_copy_only=False).astype(np.float64), nan=-np.inf)
                cells[:, d] = np.searchsorted(cuts[d], values)
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(hilbert_index(cells, bits))], names=[*keep, "hilbert"])

    placed = df.select(*keep, *[c.cast("binary" if d in texts else "double").alias(n)
                                for n, (d, c) in zip(names, dims.items())])
    order = ["hilbert", F.xxhash64(ident), F.col(ident), F.xxhash64(*keep)]
    # the number of a row within its sort partition, and the partition's, in one
    sorted_rows = written(map_arrow(placed, run, schema)
                          .repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
                          .withColumn("_hb_at", F.monotonically_increasing_id())
                          .withColumn("_hb_part", F.shiftright("_hb_at", 33))
                          .withColumn("_hb_at", F.col("_hb_at").bitwiseAND(F.lit((1 << 33) - 1))), "hilbert")
    counts = sorted_rows.groupBy("_hb_part").agg(F.count("*").alias("_hb_rows"))
    before = counts.select("_hb_part", (F.sum("_hb_rows").over(Window.orderBy("_hb_part")) - F.col("_hb_rows")).alias("_hb_before"),
                           F.sum("_hb_rows").over(Window.partitionBy()).alias("_hb_all"))
    rank = F.col("_hb_at") + F.col("_hb_before")
    # one row a sort partition: as many as the session's shuffle partitions at most
    return (sorted_rows.join(F.broadcast(before), "_hb_part")
            .withColumn("shard", F.expr(f"(_hb_at + _hb_before) * {shards} div _hb_all").cast("int"))
            .withColumn("slot", rank - F.expr(f"(shard * _hb_all + {shards - 1}) div {shards}"))
            .select(*keep, "hilbert", "shard", "slot"))


def write(sharded: DataFrame, path: str) -> None:
    """One folder of files a shard, rows in the order of their slots."""
    (sharded.repartition(F.col("shard")).sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").mode("errorifexists").parquet(path))


def zones(sharded: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, and the smallest and largest value of each column, by shard."""
    aggs = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(F.count("*").alias("n_rows"), *aggs)


def needed(zone_map: DataFrame, **ranges: tuple) -> DataFrame:
    """Shards that may hold rows with every column in its range ``(low, high)``."""
    for c, (low, high) in ranges.items():
        zone_map = zone_map.where((F.col(f"max_{c}") >= F.lit(low)) & (F.col(f"min_{c}") <= F.lit(high)))
    return zone_map.select("shard")


def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard and slot along the curve over source,
    language and length."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    dims = {"source": F.col("source"), "lang": F.col("lang"), "size": F.col("size")}
    return shard(docs, dims, "doc_id").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert")
