"""Document fingerprints: bottom-k sketches of shingle hashes.

A text's words (runs between white space, lower-cased) are framed by four empty
words on either side, so that short texts have shingles of their beginnings and
ends, too; every five consecutive words are a shingle, hashed to 64 bits. The
sketch is the ``K`` smallest distinct hashes in ascending order, or all if there
are fewer. The sketch of a union is the ``K`` smallest of both sketches: parts
sketched apart merge without loss. All of it is built-in functions.

Defined cases: null and empty texts, and texts of white space, have an empty
sketch; two empty sketches are alike (1), an empty and another one are not (0).
Equal texts have equal sketches. Repeated rows are rows; an empty table gives
an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.common import partitions, table, written

WIDTH = 5
K = 128
STEP = 64


def sketch(text: Column) -> Column:
    """The bottom-k sketch of a text, an ascending array of longs."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    frame = F.array_repeat(F.lit(0).cast("long"), WIDTH - 1)
    hashed = F.concat(frame, F.transform(words, lambda w: F.xxhash64(w)), frame)
    # hashes of words are bound once, not once a shingle
    shingles = F.transform(F.array(hashed), lambda h: F.when(
        F.size(h) > 2 * (WIDTH - 1),
        F.transform(F.sequence(F.lit(0), F.size(h) - WIDTH),
                    lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(WIDTH)])))
        .otherwise(F.array().cast("array<long>")))
    return F.slice(F.sort_array(F.array_distinct(F.get(shingles, F.lit(0)))), 1, K)


def merged(a: Column, b: Column) -> Column:
    """Sketch of the union."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, K)


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of common shingles: of the union's sketch, the part that
    is in both."""
    both, either = F.array_intersect(a, b), merged(a, b)
    return F.when(F.size(either) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(either, both)) / F.size(either))


def distinct_shingles(a: Column) -> Column:
    """Estimated number of distinct shingles (exact below ``K``): the k-th
    smallest of n uniform hashes lies near k / n of the range."""
    place = F.get(a, F.lit(K - 1)) / F.lit(2.0 ** 64) + F.lit(0.5)
    return F.when(F.size(a) < K, F.size(a).cast("double")).otherwise(F.lit(K - 1.0) / place)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has."""
    common = resemblance(a, b) * distinct_shingles(merged(a, b))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a)))


def union_sketch(df: DataFrame, by: list[str], of: str) -> DataFrame:
    """Sketch of the union over groups: the ``K`` smallest of all the sketches'
    hashes, ranked after a partial limit, so no group is gathered whole."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("_fp_hash"))
    return (df.select(*by, F.explode(of).alias("_fp_hash")).distinct().withColumn("_fp_rank", rank)
            .where(F.col("_fp_rank") <= K).groupBy(*by).agg(F.sort_array(F.collect_list("_fp_hash")).alias(of)))


def printed(a: Column) -> Column:
    """A sketch as text: base64 of its hashes, eight bytes each."""
    return F.base64(F.unhex(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")))


def parsed(text: Column) -> Column:
    """The sketch of a printed one (high and low halves are put together, as
    ``conv`` is unsigned)."""
    raw = F.hex(F.unbase64(text))
    half = lambda at: F.conv(F.substring(raw, at, F.lit(8)), 16, 10).cast("long")
    return F.when(F.length(raw) == 0, F.array().cast("array<long>")).otherwise(F.transform(
        F.sequence(F.lit(0), (F.length(raw) / 16).cast("int") - 1),
        lambda i: F.shiftleft(half(i * 16 + 1), 32).bitwiseOR(half(i * 16 + 9))))


def _bounds(keys: DataFrame) -> DataFrame:
    """One row: the smallest keys of as many ranges as a shuffle has partitions,
    ascending (``bounds``), and every ``STEP``-th of them (``steps``). Spark's range
    partitioning samples the keys; what it found is written, so all readers see
    the same ranges."""
    parts = partitions(keys.sparkSession)
    lows = keys.repartitionByRange(parts, "_nx_key").groupBy(F.spark_partition_id()).agg(F.min("_nx_key").alias("low"))
    bounds = lows.agg(F.sort_array(F.collect_list("low")).alias("bounds"))       # one a partition at most
    return written(bounds.withColumn("steps", F.expr(f"filter(bounds, (b, i) -> i % {STEP} = 0)")), "ranges", per_core=1)


def _in_ranges(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with ``_nx_bucket``, the number of the range that ``_nx_key`` lies
    in: among every ``STEP``-th bound first, then among the ``STEP`` that follow."""
    key = F.col("_nx_key")
    held = rows.withColumns({f"_nx_{c}": found.select(c).scalar() for c in ("bounds", "steps")})
    held = held.withColumn("_nx_base", (F.size(F.filter("_nx_steps", lambda b: b <= key)) - 1) * STEP)
    within = F.filter(F.slice("_nx_bounds", F.col("_nx_base") + 1, F.lit(STEP)), lambda b: b <= key)
    return held.withColumn("_nx_bucket", F.col("_nx_base") + F.size(within)).drop("_nx_bounds", "_nx_steps", "_nx_base")


def with_next(df: DataFrame, ident: str, columns: list[str], derived: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with ``derived`` columns, and with ``next_<column>`` for ``columns``
    and the derived ones, of the row with the next smaller identifier (of the
    largest one after the smallest; null identifiers come last, rows of one
    identifier in the order of a hash of ``columns``). Identifiers may be of any
    type that has an order.

    Rows are dealt into ranges by sampled bounds; each range is one window, and
    gets as a guest row the first row of the next range. Only one row a range is
    put in order in one place. ``derived`` is computed once a row, after that.
    """
    derived = derived or {}
    # ascending keys are descending rows, read backwards
    keyed = df.withColumn("_nx_key", F.struct(F.col(ident).alias("id"), F.bitwise_not(F.xxhash64(*columns)).alias("tie")))
    rows = _in_ranges(keyed, _bounds(keyed.select("_nx_key")))
    heads = rows.groupBy("_nx_bucket").agg(F.max("_nx_key").alias("_nx_head"))
    upwards = Window.orderBy("_nx_bucket")
    # the range above a head's; the smallest range is followed by the largest's head
    links = heads.select("_nx_bucket", "_nx_head", F.coalesce(
        F.lead("_nx_bucket").over(upwards), F.min("_nx_bucket").over(upwards)).alias("_nx_to"))
    guests = (rows.join(F.broadcast(links), "_nx_bucket")                        # one row a range
              .where(F.col("_nx_key").eqNullSafe(F.col("_nx_head"))).dropDuplicates(["_nx_to"])
              .drop("_nx_bucket", "_nx_head").withColumnRenamed("_nx_to", "_nx_bucket").withColumn("_nx_guest", F.lit(True)))
    along = Window.partitionBy("_nx_bucket").orderBy("_nx_guest", F.col("_nx_key").desc())
    return (rows.withColumn("_nx_guest", F.lit(False)).unionByName(guests).withColumns(derived)
            .withColumns({f"next_{c}": F.lead(c).over(along) for c in [*columns, *derived]})
            .where(~F.col("_nx_guest")).drop("_nx_bucket", "_nx_guest", "_nx_key"))


def op7_bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, "doc_id", ["text"], {"sketch": sketch(F.col("text"))})
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    return (rows.select("doc_id", "sketch", "next_sketch", n.cast("long").alias("n_chars"), edited.alias("edited"))
            .withColumn("edited_sketch", sketch(F.col("edited")))
            .select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                    printed(F.col("sketch")).alias("fingerprint"),
                    printed(F.col("edited_sketch")).alias("edited_fingerprint"),
                    resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                    resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
                    distinct_shingles(F.col("sketch")).alias("distinct_shingles")))
