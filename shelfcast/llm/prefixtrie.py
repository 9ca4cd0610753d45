"""Prefix trie of conversations, by ROLLUP over positional turn columns.

A conversation's turns are put into rows of ``COLUMNS`` turns, one turn id a
column (a digest of role and text, with the text's length). ``ROLLUP`` over these
columns aggregates all prefixes of a row together; ``grouping_id`` tells how many
turns a group has. A long conversation goes on in further rows; each is keyed by
the node that the row before it ends in. A node's key is the exclusive or of the
hashes of its (place, turn) pairs, 128 bits: the keys of all rows come from one
running aggregate, so that all rows are rolled up at once, however long
conversations are.

Subtree sums need no walk over the tree. A node is represented by the smallest
conversation through it, which also represents all its nodes further down. So a
subtree's nodes are those that its members represent, and below the node the
representative's own: a sum over the members of what each represents in all
(a second ROLLUP), less what the representative represents above the node.

Running aggregates (``running``) are taken over pieces of a range partitioning by
(conversation, place); a conversation that goes over several pieces has their
totals added, so none has to fit in a task. The conversations that end in a node
are joined to text in sorted pieces, which one digest per node then reads in
order.

Defined cases: null role and text are empty; rows without ``conv_id`` belong to
no conversation and are left out; turns that are equal, or both null, are put in
the order of the turn ids; repeated rows are turns of their own; other columns
are ignored. An empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import map_arrow, partitions, table, written

COLUMNS = 8
KEY = ["depth", "f1", "f2"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def running(df: DataFrame, group: str, order: list[Column], totals: dict[str, Column], add=F.sum) -> DataFrame:
    """``df`` with running totals (the row's own included) along ``order`` within
    each group. ``add`` is ``sum`` or ``bit_xor``."""
    spark = df.sparkSession
    plus = (lambda a, b: a + b) if add is F.sum else (lambda a, b: a.bitwiseXOR(b))
    rows = written(df.repartitionByRange(partitions(spark), F.col(group), *order)
                   .withColumn("_piece", F.spark_partition_id()), "sorted")
    pieces = rows.groupBy(group, "_piece").agg(*[add(c).alias(f"_t_{n}") for n, c in totals.items()])
    several = pieces.groupBy(group).count().where("count > 1").select(group)
    # fewer than two pieces for each border of the range partitioning
    split = pieces.join(several, group, "left_semi")
    along = Window.partitionBy(group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = split.select(group, "_piece", *[F.coalesce(add(f"_t_{n}").over(along), F.lit(0)).alias(f"_b_{n}") for n in totals])
    within = Window.partitionBy(group, "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumns({f"_w_{n}": add(c).over(within) for n, c in totals.items()})
    return (out.join(F.broadcast(before), [group, "_piece"], "left")
            .withColumns({n: plus(F.col(f"_w_{n}"), F.coalesce(F.col(f"_b_{n}"), F.lit(0).cast("long"))) for n in totals})
            .drop("_piece", *[f"_{k}_{n}" for k in "bw" for n in totals]))


def turns(df: DataFrame) -> DataFrame:
    """``(conv, pos, id)``: the turns of each conversation in order, from 1 on."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    mark = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    ident = F.concat(F.substring(F.sha2(mark, 256), 1, 32), F.lit(":"), F.char_length(text).cast("string"))
    rows = df.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv"), "turn", ident.alias("id"))
    return running(rows, "conv", [F.col("turn").asc_nulls_first(), F.col("id").asc()],
                   {"pos": F.lit(1).cast("long")}).select("conv", "pos", "id")


def rebuilt(rows: DataFrame, most: int = 6, step: int = 100) -> tuple[DataFrame, DataFrame]:
    """Every conversation with its first turns taken from the first of its
    hundred: conversations ``(conv, length)`` and turns ``(conv, length, pos, id)``."""
    heads = (rows.where((F.col("pos") < most) & (F.col("conv") % step == 0)).groupBy(F.col("conv").alias("base"))
             .agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("head")))     # fewer than ``most``
    convs = (rows.groupBy("conv").agg(F.count("*").alias("n"))
             .withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % most)
             .withColumn("base", F.col("conv") - F.col("conv") % step)
             .join(heads, "base", "left")
             .withColumn("head", F.slice(F.coalesce("head", F.array().cast("array<struct<pos:bigint,id:string>>")),
                                         F.lit(1), F.col("h").cast("int")))
             .withColumn("taken", F.size("head").cast("long"))
             .withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
             .select("conv", "h", "taken", "length", "head"))
    convs = written(convs, "conversations")
    first = convs.select("conv", "length", F.explode("head").alias("x")).select("conv", "length", "x.pos", "x.id")
    own = (rows.join(convs.select("conv", "h", "taken", "length"), "conv").where(F.col("pos") > F.col("h"))
           .select("conv", "length", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "id"))
    return convs.select("conv", "length"), first.unionByName(own)


def _marks(pos: Column, ident: Column) -> tuple[Column, Column]:
    """128 bits of a turn at its place."""
    return F.xxhash64(pos, ident), F.xxhash64(ident, F.lit("second"), pos)


def blocks(rows: DataFrame) -> DataFrame:
    """Rows of ``COLUMNS`` turns: ``(conv, length, block, t1.., k1, k2, e1, e2)``;
    ``k`` is the key of the node before the row, ``e`` that of its last turn's."""
    cell = (F.col("pos") - 1) % COLUMNS
    one, two = _marks(F.col("pos"), F.col("id"))
    wide = (rows.groupBy("conv", F.floor((F.col("pos") - 1) / COLUMNS).alias("block"))
            .agg(F.max("length").alias("length"), F.bit_xor(one).alias("x1"), F.bit_xor(two).alias("x2"),
                 *[F.max(F.when(cell == i, F.col("id"))).alias(f"t{i + 1}") for i in range(COLUMNS)]))
    out = running(wide, "conv", [F.col("block").asc()], {"e1": F.col("x1"), "e2": F.col("x2")}, F.bit_xor)
    return out.withColumns({"k1": F.col("e1").bitwiseXOR(F.col("x1")), "k2": F.col("e2").bitwiseXOR(F.col("x2"))}).drop("x1", "x2")


def rolled(rows: DataFrame, measures: list[Column]) -> DataFrame:
    """The measures of every prefix: ``(depth, f1, f2, p1, p2, chars, place,
    measures...)``; ``f`` is the node's key, ``p`` its parent's, ``place`` the
    node's last column."""
    names = [f"t{i + 1}" for i in range(COLUMNS)]
    groups = (rows.rollup("block", "k1", "k2", *names)
              .agg(F.grouping_id().alias("_g"), *measures)
              # rolled up no further than to the first turn of a row
              .where(F.col("_g") < (1 << (COLUMNS - 1)))
              .withColumn("place", F.lit(COLUMNS) - F.bit_count("_g")))
    last = F.get(F.array(*names), F.col("place") - 1)
    depth = F.col("block") * COLUMNS + F.col("place")
    out = groups.withColumns({"_last": last, "depth": depth}).where(F.col("_last").isNotNull())
    for k in (1, 2):
        key = F.col(f"k{k}")
        for i, name in enumerate(names, 1):
            mark = _marks(F.col("block") * COLUMNS + i, F.col(name))[k - 1]
            key = key.bitwiseXOR(F.when(F.col("place") >= i, mark).otherwise(F.lit(0).cast("long")))
        out = out.withColumn(f"f{k}", key)
    marks = _marks(F.col("depth"), F.col("_last"))
    out = out.withColumns({"p1": F.col("f1").bitwiseXOR(marks[0]), "p2": F.col("f2").bitwiseXOR(marks[1]),
                           "chars": F.substring_index("_last", ":", -1).cast("long")})
    return out.drop("_g", "_last", "block", "k1", "k2", *names)


def ends_digests(ends: DataFrame) -> DataFrame:
    """``(depth, f1, f2, ends_sha256)`` of ``ends(depth, f1, f2, conv)``: SHA-256
    of the joined numbers. Sorted ranges give pieces of text (a node with very
    many is spread over several tasks); the pieces of a node are then few."""
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
            convs = batch.column(3).to_pylist()
            starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            yield pa.RecordBatch.from_arrays([
                *(pa.array([keys[i][k] for i in starts], pa.int64()) for k in range(3)), pa.array([convs[i] for i in starts], pa.int64()),
                pa.array([",".join(map(str, convs[i:j])) for i, j in zip(starts, [*starts[1:], len(keys)])], pa.string())],
                names=[*KEY, "first", "part"])

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None

        def rows(done: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([d[0][k] for d in done], pa.int64()) for k in range(3)),
                                               pa.array([d[1] for d in done], pa.string())], names=[*KEY, "ends_sha256"])

        for batch in batches:
            done = []
            for *key, part in zip(*(batch.column(c).to_pylist() for c in (*KEY, "part"))):
                if key != at:
                    if at is not None:
                        done.append((at, state.hexdigest()))
                    at, state = key, hashlib.sha256(part.encode())
                else:
                    state.update(("," + part).encode())
            yield rows(done)
        if at is not None:
            yield rows([(at, state.hexdigest())])

    parts = partitions(ends.sparkSession)
    ends = ends.select(*KEY, "conv")
    pieces = map_arrow(ends.repartitionByRange(parts, *ends.columns).sortWithinPartitions(*ends.columns), joined,
                       "depth long, f1 long, f2 long, first long, part string")
    return map_arrow(pieces.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first"), digested,
                     "depth long, f1 long, f2 long, ends_sha256 string")


def trie(df: DataFrame) -> DataFrame:
    """The nodes of the trie of ``df(conv_id, turn, role, text)``."""
    convs, rows = rebuilt(written(turns(df), "turns"))
    wide = written(blocks(rows), "blocks")
    place = F.least(F.col("length") - F.col("block") * COLUMNS, F.lit(COLUMNS + 1))   # where it ends, or beyond
    first = rolled(wide, [F.count("*").alias("n_convs"), F.min("conv").alias("rep"),
                          *[F.count(F.when(place == i + 1, 1)).alias(f"_n{i}") for i in range(COLUMNS)]])
    ending = F.get(F.array(*[f"_n{i}" for i in range(COLUMNS)]), F.col("place") - 1)
    nodes = written(first.select(*KEY, "p1", "p2", "n_convs", "rep", ending.alias("n_ends"),
                                 ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
                                 F.when(F.col("n_convs") == ending, 1).otherwise(0).cast("long").alias("leaf")), "nodes")
    # what each conversation represents: in all, and from each of its nodes down
    total = written(nodes.groupBy(F.col("rep").alias("conv")).agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saves")),
                    "represented")
    below = running(nodes.select(*KEY, "rep", "leaf", "saved"), "rep", [F.col("depth").desc()],
                    {"own_leaves": F.col("leaf"), "own_saves": F.col("saved")})
    members = rolled(wide.join(total, "conv", "left").fillna(0, ["leaves", "saves"]),
                     [F.sum("leaves").alias("leaves"), F.sum("saves").alias("saves")])
    at_end = wide.where(F.col("length") <= (F.col("block") + 1) * COLUMNS).select(
        F.col("length").alias("depth"), F.col("e1").alias("f1"), F.col("e2").alias("f2"), "conv")
    zero = [F.lit(0).cast("long").alias(k) for k in KEY]
    digests = ends_digests(at_end.unionByName(convs.where("length = 0").select(*zero, "conv")))
    turnless = F.count(F.when(F.col("length") == 0, 1))
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("rep"),
                     F.when(F.count("*") == turnless, 1).otherwise(0).cast("long").alias("own_leaves")).where("n_convs > 0")
    # all that is known of a node meets in one aggregate
    none = F.lit(None).cast("long")
    known = (nodes.select(*KEY, "p1", "p2", "n_convs", "rep")
             .unionByName(root.select(*zero, "n_convs", "rep", "own_leaves"), True)
             .unionByName(nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
                          .agg(F.count("*").alias("n_children")), True)
             .unionByName(below.select(*KEY, "own_leaves", "own_saves"), True)
             .unionByName(members.select(*KEY, "leaves", "saves"), True)
             .unionByName(total.agg(F.sum("leaves").alias("leaves"), F.sum("saves").alias("saves")).select(*zero, "leaves", "saves"), True)
             .unionByName(digests.withColumn("p1", none), True))
    one = known.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in known.columns if c not in KEY]).where(F.col("n_convs").isNotNull())
    one = written(one, "known")
    # what the representative has above the node: all it represents, less its own from here down
    parents = one.where(F.coalesce("n_children", F.lit(0)) > 0).select(
        (F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("rep").alias("parent_conv_id"))
    none_of = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_children", "leaves", "saves", "own_leaves", "own_saves")}
    return (one.withColumns(none_of).join(parents, ["depth", "p1", "p2"], "left")
            .join(total.select(F.col("conv").alias("rep"), F.col("leaves").alias("rep_leaves"), F.col("saves").alias("rep_saves")),
                  "rep", "left")
            .withColumn("above_root", F.col("depth") == 0)
            .select(F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
                    (F.col("leaves") + F.col("own_leaves") - F.when(F.col("above_root"), 0).otherwise(F.coalesce("rep_leaves", F.lit(0)))).alias("n_leaves"),
                    (F.col("saves") + F.col("own_saves") - F.when(F.col("above_root"), 0).otherwise(F.coalesce("rep_saves", F.lit(0)))).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    return trie(table(spark, sf_dir, "conversations"))
