"""MinHash near-dedup by an inverted join over signature coordinates.

Texts with equal shingle sets form one class, a node with a number of its own;
everything below is on nodes. Identifiers are put back at the end.

* Post: every representative is posted under each (coordinate, value) pair of
  its signature. A pair of similar sets shares at least ``MATCHES`` of the
  ``COORDINATES`` pairs (at a resemblance of 0.75 all but about two in a million
  do), so it shares one among its ``COORDINATES - MATCHES + 1`` rarest: only that
  prefix is merged, in the order of rarity, and pairs held by one set only drop
  out. The frequent lists beyond the prefix are skipped in the merge and probed
  by comparing the two signatures, which counts all collisions. Pairs above the
  threshold go on.
* Sizes: sets are posted with their size class (a step of 4/3) and the next, so
  that a list never holds sizes that can't be similar.
* Merge: a list of g sets isn't expanded into all pairs. Its most central set
  is the hub, and each other set meets only the hub: full sets are compared.
  Linked sets fall into one component; a list whose sets are all in one is done.
* The rest, exactly: the sets of the lists that aren't done are posted anew
  under their own rarest shingles (rare among these sets), as many as the
  smallest partner in their lists calls for, so that a set with many shingles of
  its own drops out. The new lists meet their hubs in turn; of those that still
  hold several components, the pairs across components whose sizes and places in
  the prefix allow the similarity are joined and compared in full.

No list is capped, no partner dropped, and no group is gathered in one task.

Defined cases: null and empty texts, or texts of white space, have no shingles
and are linked with nothing. Equal sets are linked. Other rows that share an
identifier share a component, whatever their texts; identifiers may be of any
type that has an order. A null identifier gets a null component and is kept, and
links nothing. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm import shingles
from shelfcast.llm.common import join_one, map_arrow, table, written
from shelfcast.llm.components import components

SIMILARITY = 75          # per cent
COORDINATES = 64
MATCHES = 32
PREFIX = COORDINATES - MATCHES + 1
SPLIT = 48               # lists of more than this share of all postings are joined in pieces


def _summaries(df: DataFrame, text: str, ident: str) -> DataFrame:
    """Identifier, size and key of the shingle set, and its signature."""
    schema = f"{ident} {df.schema[ident].dataType.simpleString()}, n_shingles long, set_key binary, signature array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, sets in shingles.sets_of(batch.column(1)):
                marks = shingles.signatures(sets, COORDINATES).view(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, marks.size + 1, COORDINATES), pa.int32()),
                                                pa.array(marks.reshape(-1)))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([shingles.set_key(s) for s in sets], pa.binary()), flat],
                    names=[ident, "n_shingles", "set_key", "signature"])

    return map_arrow(df.select(ident, text), run, schema)


def _full_sets(df: DataFrame, text: str) -> DataFrame:
    """``(set_key, shingles)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, sets in shingles.sets_of(batch.column(0)):
                yield pa.RecordBatch.from_arrays([
                    pa.array([shingles.set_key(s) for s in sets], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["set_key", "shingles"])

    return map_arrow(df.select(text), run, "set_key binary, shingles array<long>")


def similar(inter: Column, n: Column, m: Column) -> Column:
    return F.lit(100) * inter >= F.lit(SIMILARITY) * (n + m - inter)


def prefix_postings(sets: DataFrame) -> DataFrame:
    """``(list, node, n, central)``: every set under the rare prefix of its
    (coordinate, value) pairs, in its own size class and the next. ``central``
    is how often its pairs occur in all."""
    posted = sets.select("node", F.posexplode("signature").alias("k", "v")).select(
        "node", F.shiftleft(F.col("k").cast("long"), 32).bitwiseOR(
            F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("pair"))
    shared = posted.groupBy("pair").agg(F.count("*").alias("freq")).where("freq > 1")
    ranked = (posted.join(shared, "pair").groupBy("node")
              .agg(F.sort_array(F.collect_list(F.struct("freq", "pair"))).alias("pairs"),  # at most COORDINATES
                   F.sum("freq").alias("central")).join(sets.select("node", "n"), "node"))
    room = F.lit(PREFIX - COORDINATES) + F.size("pairs")
    size_class = F.floor(F.log("n") / F.log(F.lit(4 / 3)) + 1e-9).cast("int")
    return (ranked.where(room > 0)
            .select("node", "n", "central", F.explode(F.slice("pairs", F.lit(1), room)).alias("p"),
                    size_class.alias("c"))
            .select("node", "n", "central", "p.pair", F.explode(F.array("c", F.col("c") + 1)).alias("c"))
            .select(F.xxhash64("pair", "c").alias("list"), "node", "n", "central"))


def _open_lists(lists: DataFrame) -> DataFrame:
    """Lists that hold several components, with their numbers of sets. Written, as
    it is read several times."""
    return written(lists.groupBy("list").agg(F.min("component").alias("c0"), F.max("component").alias("c1"),
                                             F.min("n").alias("least_n"), F.count("*").alias("freq"),
                                             F.max(F.struct("central", -F.col("node"), "n", "node")).alias("h"))
                   .where("c0 <> c1"), "open-lists")


def _hub_pairs(lists: DataFrame, total: int) -> DataFrame:
    """``(hub, hub_n, node, n)``: each set with the most central set of each of
    its open lists, once. A hub is paired with itself, too. ``total``: rows of
    ``lists``; those of a frequent list stay where they are."""
    hubs = _open_lists(lists).select("list", "freq", F.col("h.node").alias("hub"), F.col("h.n").alias("hub_n"))
    return join_one(lists, hubs, "list", total).select("hub", "hub_n", "node", "n").distinct()


def _fits() -> Column:
    return F.lit(100) * F.least("n", "hub_n") >= F.lit(SIMILARITY) * F.greatest("n", "hub_n")


def _collisions(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of sets whose signatures agree in at least ``MATCHES`` coordinates."""
    own = sets.select("node", "signature")
    hub = sets.select(F.col("node").alias("hub"), F.col("signature").alias("hub_signature"))
    count = F.aggregate(F.zip_with("signature", "hub_signature", lambda a, b: (a == b).cast("int")),
                        F.lit(0), lambda a, b: a + b)
    return (pairs.join(own, "node").join(hub, "hub").where(count >= MATCHES)
            .select("hub", "hub_n", "node", "n"))


def _links(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """``(a, b)`` of the pairs whose full sets are similar."""
    hub_sets = full.select(F.col("node").alias("hub"), F.col("shingles").alias("hub_set"))
    inter = F.size(F.array_intersect("shingles", "hub_set")).cast("long")
    return (pairs.where(_fits()).join(hub_sets, "hub").join(full, "node")
            .where(similar(inter, F.col("n"), F.col("hub_n")))
            .select(F.col("hub").alias("a"), F.col("node").alias("b")))


def _labelled(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """Rows with the component of their set (itself if it has no link)."""
    return rows.drop("component").join(comps, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def _rarest_shingles(lists: DataFrame, full: DataFrame, total: int) -> DataFrame:
    """The sets of open lists under the shingles of which two similar sets share
    at least one: with ``need`` the least overlap that a partner of the smallest
    size in question calls for, the ``n - need + 1`` rarest. Shingles of one
    set only come first in the order and don't make lists."""
    opened = _open_lists(lists).select("list", "freq", "least_n")
    rest = (join_one(lists, opened, "list", total).groupBy("node", "n", "central").agg(F.min("least_n").alias("least_n"))
            .withColumn("least_n", F.greatest("least_n", F.ceil(F.col("n") * SIMILARITY / 100))))
    need = F.ceil(SIMILARITY * (F.col("n") + F.col("least_n")) / (100 + SIMILARITY) - 1e-9)
    held = rest.withColumn("length", F.col("n") - need + 1).join(full, "node").select(
        "node", "n", "central", "length", F.explode("shingles").alias("list"))
    shared = held.groupBy("list").agg(F.count("*").alias("freq")).where("freq > 1")
    own = Window.partitionBy("node")
    return (held.join(shared, "list")
            .withColumn("place", F.row_number().over(own.orderBy("freq", "list")) + F.col("n") - F.count("*").over(own))
            .where("place <= length").select("list", "node", "n", "central", "place"))


def _across(lists: DataFrame, total: int) -> DataFrame:
    """Pairs of different components that share an open list and can be similar
    by their sizes and their places in it. A list of more than a ``SPLIT``-th of
    all postings is cut in pieces by a hash of the sets, and each two of its
    pieces meet in a group of their own."""
    opened = _open_lists(lists).select("list", "freq", F.greatest(
        F.lit(1), F.ceil(F.col("freq") * SPLIT / F.lit(max(total, 1)))).cast("int").alias("pieces"))
    rows = join_one(lists, opened, "list", total).withColumn(
        "own", F.pmod(F.xxhash64("node", F.lit(11)), F.col("pieces")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    these = rows.select("list", "node", "n", "component", "place", F.col("own").alias("left"), every.alias("right"))
    other = rows.select("list", F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("component").alias("its"),
                        F.col("place").alias("hub_place"), every.alias("left"), F.col("own").alias("right"))
    most = 1 + F.least(F.col("n") - F.col("place"), F.col("hub_n") - F.col("hub_place"))
    return (these.join(other, ["list", "left", "right"])
            .where((F.col("component") < F.col("its")) & _fits()
                   & (F.lit(100 + SIMILARITY) * most >= F.lit(SIMILARITY) * (F.col("n") + F.col("hub_n"))))
            .select("hub", "hub_n", "node", "n").distinct())


def link_components(classes: DataFrame, texts: DataFrame, text: str, ident: str) -> DataFrame:
    """``(node, component)`` of all classes that are linked with another one;
    ``classes(set_key, node, rep, n, signature)``, ``rep`` one of its identifiers."""
    sets = classes.select("node", "n", "signature")
    lists = written(prefix_postings(sets).withColumn("component", F.col("node")), "lists")
    total = lists.count()
    members = written(_hub_pairs(lists, total), "hub-pairs")
    wanted = members.select("node").distinct().join(classes.select("node", "set_key", "rep"), "node")
    # the join is dealt alike at every size, not broadcast while the list is short
    needed = texts.select(F.col(ident).alias("rep"), text).join(
        wanted.select("rep").distinct().hint("merge"), "rep", "left_semi")
    full = written(_full_sets(needed, text).join(wanted.select("set_key", "node").hint("merge"), "set_key")
                   .dropDuplicates(["node"]).select("node", "shingles"), "sets")
    # count collisions before the full sets are compared
    first = _collisions(members.where("hub <> node").where(_fits()), sets)
    comps = written(components(_links(first, full)), "found", per_core=1)

    lists = written(_rarest_shingles(_labelled(lists, comps), full, total), "rare-lists")
    total = lists.count()
    for pairs_of in (_hub_pairs, _across):
        more = _links(pairs_of(_labelled(lists, comps), total).where("hub <> node"), full)
        known = comps.select(F.col("node").alias("a"), F.col("component").alias("b"))
        # read by every use of the components, so that no plan holds their making
        comps = written(components(known.unionByName(more)), "found", per_core=1)
    return comps


def near_duplicates(df: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Per row: identifier, ``n_shingles``, ``component_id`` and ``kept``."""
    rows = written(_summaries(df, text, ident), "summaries")
    usable = rows.where(F.col(ident).isNotNull() & (F.col("n_shingles") > 0))
    # a signature follows from the set, so any of a class will do; numbered as they are written
    classes = written(usable.groupBy("set_key").agg(
        F.min(ident).alias("rep"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    comps = link_components(classes, df, text, ident)
    placed = usable.select(ident, "n_shingles", "set_key").join(classes.select("set_key", "node"), "set_key")
    # identifiers with several texts link their classes
    several = placed.groupBy(ident).agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    several = written(placed.join(several.select(ident, "a"), ident).select("a", F.col("node").alias("b")).where("a <> b"),
                      "shared-identifiers", per_core=1)
    if not several.isEmpty():
        known = comps.select(F.col("node").alias("a"), F.col("component").alias("b"))
        comps = components(known.unionByName(several))
    named = written(_labelled(classes.select("set_key", "node", "rep"), comps), "components")
    # only components of several classes need the least identifier of all
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("classes")).where("classes > 1")
    named = named.join(least.drop("classes"), "component", "left").select(
        "set_key", F.coalesce("component_id", "rep").alias("component_id"))
    empty = rows.where(F.col(ident).isNull() | (F.col("n_shingles") == 0)).select(
        ident, "n_shingles", "set_key").withColumn("component_id", F.col(ident)).drop("set_key")
    out = usable.select(ident, "n_shingles", "set_key").join(named, "set_key").select(
        ident, "n_shingles", "component_id").unionByName(empty)
    return out.withColumn("kept", F.coalesce(F.col(ident) == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(df: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """One document of each component (the smallest identifier), columns of
    ``df``; rows with a null identifier stay."""
    found = near_duplicates(df, text, ident).where(~F.col("kept")).select(ident).distinct()
    return df.join(found, ident, "left_anti").select(*df.columns)


def op3_minhash_inverted_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its number of shingles, its component, and whether
    it is the one that stays."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
