"""Repeated passages removed by external induced suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier in
the corpus. Three steps:

* Anchors. Of the ``LENGTH``-byte string at every start, the ``GRAM``-byte gram
  with the smallest hash is its anchor. Equal strings have equal anchors in equal
  places. Neighbouring starts of one anchor form a context, the bytes they cover.
  Contexts are dealt by their anchor's hash, equal ones are put together: all but
  the earliest are repeats as they stand, and an anchor with one context only has
  nothing to sort. So what is sorted is where repeated passages begin, end or
  differ, however often they are repeated. Anchors with very many contexts are
  dealt in pieces, of which the earliest meet again; where their contexts differ,
  they are cut and dealt by almost all of their strings' bytes.
* Sort. A task's contexts, anchor by anchor, are suffix-sorted (``descending``).
  The suffixes at the S* places (a byte that is smaller than the one before and,
  past equal ones, than the one after) are sorted as tuples of place and bytes,
  in runs that are spilled and merged. All others are induced: in order of their
  first byte the queues are read, and each suffix read puts the one that starts a
  byte earlier into its byte's queue, first those greater than their successor,
  then, from the other end, the rest. Queues keep the common-prefix values of
  their neighbours (capped at ``LENGTH``: minima over what was read in between),
  and are spilled to an unlinked file beyond ``SPILL`` bytes. Suffixes with a
  common prefix of ``LENGTH`` bytes are equal strings; the earliest stays.
  As no more than ``LENGTH`` bytes of a prefix matter, the S* suffixes are sorted
  by that many bytes at once: the recursion ends at its first level.
* Removal. The starts found are gathered by document and joined with its text.

Defined cases: null and empty texts have nothing removed; documents are ordered
by identifier, null first, rows of one identifier by their text's digest, equal
rows one after the other; texts are whole, of any length; other columns are
carried along, those named like the results are replaced (names starting with
``_sd_`` are reserved). An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.common import map_arrow, partitions, slices, table, written
from shelfcast.llm.shingles import _powers, buffers, mixed

LENGTH = 100
GRAM = 32
CHUNK = 1 << 20           # bytes of texts anchored at once
SORTED = 3 << 18          # bytes of contexts sorted at once; one anchor's go together
RUN = 1 << 18             # S* tuples of a sorted run
STEP = 8                  # starts of a run, where an anchor's contexts are cut
SAMPLE, LEAST_SAMPLED, HOT_PER_PARTITION = 0.02, 16, 4
SPILL = 64 << 20          # bytes of queues held in memory
RESULTS = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string"}
_BYTES = np.random.default_rng(271828).integers(1, 1 << 64, 256, dtype=np.uint64)


# --- induced sorting -------------------------------------------------------

class Queues:
    """A queue of ``(place, common prefix)`` for each byte; what exceeds ``SPILL``
    bytes lies in an unlinked file."""

    def __init__(self, spill: int):
        self.spill, self.held, self.file = spill, 0, None
        self.parts: list[list] = [[] for _ in range(256)]

    def push(self, byte: int, places: np.ndarray, common: np.ndarray) -> None:
        self.parts[byte].append((places, common))
        self.held += 9 * len(places)
        if self.held > self.spill:
            self._spilled()

    def _spilled(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile(prefix="suffix-queues-")  # noqa: SIM115
        self.file.seek(0, 2)
        for parts in self.parts:
            for i, part in enumerate(parts):
                if isinstance(part, tuple):
                    at = self.file.tell()
                    self.file.write(part[0].tobytes() + part[1].tobytes())
                    parts[i] = [at, len(part[0])]
        self.held = 0

    def pop(self, byte: int) -> tuple[np.ndarray, np.ndarray] | None:
        parts, self.parts[byte] = self.parts[byte], []
        found = []
        for part in parts:
            if isinstance(part, list):
                self.file.seek(part[0])
                data = self.file.read(9 * part[1])
                part = (np.frombuffer(data, np.int64, part[1]), np.frombuffer(data, np.uint8, part[1], 8 * part[1]))
            else:
                self.held -= 9 * len(part[0])
            found.append(part)
        if not found:
            return None
        return found[0] if len(found) == 1 else tuple(np.concatenate([f[k] for f in found]) for k in (0, 1))


class Prefixes:
    """Carries common-prefix values: for each byte, the least one read since the
    last suffix was put into that byte's queue."""

    def __init__(self):
        self.since = np.full(256, -1, dtype=np.int16)   # nothing put there yet

    def carried(self, common: np.ndarray, at: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """``common``: values of a block read; ``at``: which of it induce a suffix
        (ordered by byte, then place in the block), ``byte``: into which queue.
        Returns the values of what is put."""
        n = len(common)
        forward = np.minimum.accumulate(common)
        back = np.minimum.accumulate(common[::-1])[::-1]
        least = np.minimum(self.since[byte], forward[at]) if len(at) else np.zeros(0, dtype=np.int16)
        follows = np.zeros(len(at), dtype=bool)
        follows[1:] = byte[1:] == byte[:-1]
        where = np.flatnonzero(follows)
        if len(where):
            # minima over (previous one, this one] by powers of two
            low, high = at[where - 1] + 1, at[where]
            level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
            got = np.empty(len(where), dtype=np.uint8)
            row = common
            for k in range(int(level.max()) + 1):
                mine = np.flatnonzero(level == k)
                got[mine] = np.minimum(row[low[mine]], row[high[mine] - (1 << k) + 1])
                row = np.minimum(row[:-(1 << k)], row[1 << k:]) if len(row) > 1 << k else row
            least[where] = got
        self.since = np.minimum(self.since, forward[-1])
        if len(at):
            last = np.flatnonzero(np.append(byte[1:] != byte[:-1], True))
            after = at[last] + 1
            self.since[byte[last]] = np.where(after < n, back[np.minimum(after, n - 1)], 255)
        return np.where(least < LENGTH, least + 1, LENGTH).astype(np.uint8)


def _smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Type S: the suffix is smaller than the one after. The last one is not."""
    n = len(text)
    step = np.zeros(n, dtype=np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1] = -1
    where = np.where(step != 0, np.arange(n), n)
    return step[np.minimum.accumulate(where[::-1])[::-1]] > 0


def sorted_stars(text: np.ndarray, stars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The S* suffixes in ascending order with their common prefixes: tuples of
    bytes and place, sorted in runs that are merged from disk."""
    width = LENGTH + 4
    padded = np.concatenate([text, np.zeros(width, dtype=np.uint8)])
    view = np.lib.stride_tricks.sliding_window_view(padded, width)

    def run(part: np.ndarray) -> np.ndarray:
        rows = np.ascontiguousarray(view[part])
        return part[np.argsort(rows.view(f"S{width}").reshape(-1), kind="stable")]

    runs = [run(stars[a:a + RUN]) for a in range(0, len(stars), RUN)]
    if len(runs) > 1:
        files = []
        for r in runs:
            f = tempfile.TemporaryFile(prefix="suffix-run-")  # noqa: SIM115
            f.write(r.tobytes())
            f.seek(0)
            files.append(f)

        def read(f) -> Iterator[tuple[bytes, int]]:
            while data := f.read(8 * 4096):
                for place in np.frombuffer(data, np.int64).tolist():
                    yield padded[place:place + width].tobytes(), place

        order = np.fromiter((p for _, p in heapq.merge(*map(read, files))), np.int64, len(stars))
        for f in files:
            f.close()
    else:
        order = runs[0] if runs else stars
    common = np.zeros(len(order), dtype=np.uint8)
    for a in range(1, len(order), RUN):
        b = min(a + RUN, len(order))
        differs = view[order[a:b]] != view[order[a - 1:b - 1]]
        first = np.where(differs.any(1), differs.argmax(1), width)
        common[a:b] = np.minimum(first, LENGTH)
    return order, common


def _common(text: np.ndarray, i: int, j: int) -> int:
    a, b = (np.append(x, np.zeros(LENGTH - len(x), dtype=np.uint8)) for x in (text[i:i + LENGTH], text[j:j + LENGTH]))
    differs = np.flatnonzero(a != b)
    return int(differs[0]) if len(differs) else LENGTH


def descending(text: np.ndarray, spill: int = SPILL) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes of ``text`` from the greatest to the smallest (those that agree
    in ``LENGTH`` bytes in any order), in blocks of places and of common prefixes
    with the suffix before. A text is taken to go on with zeros."""
    n = len(text)
    if n == 0:
        return
    small = _smaller_than_next(text)
    stars = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    stars, star_common = sorted_stars(text, stars)
    star_at = np.searchsorted(text[stars], np.arange(257))

    def induce(places: np.ndarray, common: np.ndarray, queues: Queues, prefixes: Prefixes, kind: bool) -> None:
        """Put the suffixes of type ``kind`` that start one earlier into the queues."""
        at = np.flatnonzero(places > 0)
        at = at[small[places[at] - 1] == kind]
        byte = text[places[at] - 1]
        order = np.argsort(byte, kind="stable")
        at, byte = at[order], byte[order]
        values = prefixes.carried(common, at, byte)
        if not len(at):
            return
        new = places[at] - 1
        starts = np.flatnonzero(np.append(True, byte[1:] != byte[:-1]))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(at)]):
            queues.push(int(byte[a]), new[a:b], values[a:b])

    # the larger ones, upwards; the end of the text comes before all
    queues, prefixes, larger = Queues(spill), Prefixes(), Queues(spill)
    induce(np.array([n], dtype=np.int64), np.zeros(1, dtype=np.uint8), queues, prefixes, False)
    for byte in range(256):
        last = -1
        while (block := queues.pop(byte)) is not None:
            places, common = block
            larger.push(byte, places, common)
            induce(places, common, queues, prefixes, False)
            last = int(places[-1])
        a, b = star_at[byte], star_at[byte + 1]
        if a < b:
            common = star_common[a:b].copy()
            common[0] = _common(text, last, int(stars[a])) if last >= 0 else 0
            induce(stars[a:b], common, queues, prefixes, False)
    # the smaller ones, downwards, and everything as it is read
    queues, prefixes = Queues(spill), Prefixes()
    for byte in range(255, -1, -1):
        last = -1
        while (block := queues.pop(byte)) is not None:
            induce(*block, queues, prefixes, True)
            last = int(block[0][-1])
            yield block
        if (block := larger.pop(byte)) is not None:
            places, common = block[0][::-1], np.empty(len(block[0]), dtype=np.uint8)
            common[0] = _common(text, last, int(places[0])) if last >= 0 else 0
            common[1:] = block[1][1:][::-1]
            induce(places, common, queues, prefixes, True)
            yield places, common


def repeats(contexts: list[bytes], starts: np.ndarray) -> list[np.ndarray]:
    """Of contexts in the order of their places, the first ``starts`` of each being
    looked at: which of these starts have their string in an earlier place."""
    sizes = np.array([len(c) for c in contexts], dtype=np.int64)
    text = np.frombuffer(b"\0".join(contexts), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    place = np.full(len(text), -1, dtype=np.int64)        # by start: its order among all starts
    of = np.repeat(offsets, starts) + (np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts))
    place[of] = np.arange(len(of))
    found = np.zeros(len(of), dtype=bool)
    held: list[np.ndarray] = []                           # the run that a block ends in goes on in the next

    def closed(run: np.ndarray) -> None:
        found[run[run != run.min()]] = True

    for places, common in descending(text):
        own = place[places]
        new = common < LENGTH
        run = np.cumsum(new)
        wanted = own >= 0
        own, run = own[wanted], run[wanted]
        cut = int(np.searchsorted(run, 1))                # what belongs to the held run
        held.append(own[:cut])
        if not new.any():
            continue
        first = np.concatenate(held)
        if len(first) > 1:
            closed(first)
        own, run = own[cut:], run[cut:]
        tail = int(np.searchsorted(run, new.sum()))       # the last run stays open
        held = [own[tail:]]
        own, run = own[:tail], run[:tail]
        if len(own):
            begins = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
            least = np.repeat(np.minimum.reduceat(own, begins), np.diff(np.append(begins, len(own))))
            found[own[own != least]] = True
    rest = np.concatenate(held) if held else np.zeros(0, dtype=np.int64)
    if len(rest) > 1:
        closed(rest)
    return np.split(found, np.cumsum(starts)[:-1])


# --- anchors ---------------------------------------------------------------

def anchored(data: np.ndarray, cuts: np.ndarray, mixed_keys: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Contexts of texts laid end to end: anchor hash, key, digest, text, first
    start in the text, number of starts. The key is the anchor's hash; contexts of
    ``mixed_keys`` are cut into runs of ``STEP`` starts, by their distance from the
    anchor, whose key is the hash of what all strings of a run cover."""
    n = len(data)
    empty = tuple(np.zeros(0, dtype=np.int64) for _ in range(6))
    if n < LENGTH:
        return empty
    up, down = _powers(1 << max(20, n.bit_length()))
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * up[:n], out=sums[1:])
    grams = mixed((sums[GRAM:] - sums[:n - GRAM + 1]) * down[:n - GRAM + 1])
    low = np.uint64((1 << 28) - 1)                        # the place, to tell equal hashes apart
    best = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    reach, window = 1, LENGTH - GRAM + 1
    while reach < window:
        step = min(reach, window - reach)
        best = np.minimum(best[:-step], best[step:])
        reach += step
    inside = np.zeros(n - LENGTH + 2, dtype=np.int32)     # starts whose string stays in its text
    sizes = np.diff(cuts)
    long = sizes >= LENGTH
    np.add.at(inside, cuts[:-1][long], 1)
    np.add.at(inside, cuts[1:][long] - LENGTH + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
    if not len(starts):
        return empty
    anchors = (best[starts] & low).astype(np.int64)
    text = np.searchsorted(cuts, starts, side="right") - 1
    breaks = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (text[1:] != text[:-1])])
    many = np.isin(grams[anchors].view(np.int64), mixed_keys) if mixed_keys is not None and len(mixed_keys) else None
    if many is not None:
        part = (anchors - starts) // STEP
        breaks[1:] |= many[1:] & (part[1:] != part[:-1])
    begins = np.flatnonzero(breaks)
    ends = np.append(begins[1:], len(starts))
    first, count = starts[begins], ends - begins
    anchor = anchors[begins]
    key = grams[anchor].copy()
    if many is not None and (cut := np.flatnonzero(many[begins])).size:
        low = anchor[cut] - part[begins[cut]] * STEP
        key[cut] = mixed(key[cut] ^ part[begins[cut]].astype(np.uint64)
                         ^ mixed((sums[low + LENGTH - STEP + 1] - sums[low]) * down[low]))
    whole = mixed((sums[first + count + LENGTH - 1] - sums[first]) * down[first])
    digest = mixed(whole ^ ((anchor - first).astype(np.uint64) << np.uint64(32)) ^ count.astype(np.uint64))
    return (grams[anchor].view(np.int64), key.view(np.int64), digest.view(np.int64), text[begins],
            first - cuts[text[begins]], count)


def contexts_of(df: DataFrame, keys: list[str], hot: dict[int, tuple[int, bool]] | None = None) -> DataFrame:
    """``(keys, _sd_key, _sd_digest, _sd_first, _sd_n, _sd_pieces)`` of ``df(keys,
    _sd_text)``. ``hot``: in how many pieces the contexts of an anchor are dealt,
    and whether they differ so much that they are cut."""
    hot = hot or {}
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in keys])
    for name, kind in (("_sd_key", T.LongType()), ("_sd_digest", T.LongType()), ("_sd_first", T.LongType()), ("_sd_n", T.LongType()), ("_sd_pieces", T.LongType())):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_keys = np.array(sorted(hot), dtype=np.int64)
        pieces = np.array([hot[k][0] for k in sorted(hot)], dtype=np.int64)
        mixed_keys = np.array([k for k in sorted(hot) if hot[k][1]], dtype=np.int64)
        for batch in batches:
            column = batch.column(len(keys)).cast(pa.large_binary())
            for a, b in slices(column, CHUNK):
                data, cuts = buffers(column.slice(a, b - a))
                # a long text in parts, whose contexts are cut where parts end
                for at in range(0, max(1, len(data)), 8 * CHUNK):
                    some = data[at:at + 8 * CHUNK + LENGTH - 1]
                    own = np.clip(cuts - at, 0, len(some)) if len(cuts) == 2 else cuts
                    anchor, key, digest, text, first, count = anchored(some, own, mixed_keys)
                    ids = pa.array(text + a)
                    at_hot = np.minimum(np.searchsorted(hot_keys, anchor), max(len(hot) - 1, 0))
                    dealt = (np.where(hot_keys[at_hot] == anchor, pieces[at_hot], 1) if hot else np.ones(len(anchor), dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([*(batch.column(k).take(ids) for k in range(len(keys))), pa.array(key),
                                                      pa.array(digest), pa.array(first + (at if len(cuts) == 2 else 0)), pa.array(count), pa.array(dealt)],
                                                     names=schema.fieldNames())

    return map_arrow(df.select(*keys, "_sd_text"), run, schema)


def _packed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Texts compressed one by one, for a shuffle."""
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in keys]).add("_sd_size", T.LongType()).add("_sd_packed", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            column = batch.column(len(keys)).cast(pa.binary())
            for a, b in slices(column, CHUNK):
                texts = [x or b"" for x in column.slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(k).slice(a, b - a) for k in range(len(keys))), pa.array([len(x) for x in texts], pa.int64()),
                    pa.array([codec.compress(x, asbytes=True) for x in texts], pa.binary())], names=schema.fieldNames())

    return map_arrow(df.select(*keys, "_sd_text"), run, schema)


def _unpacked(sizes: pa.Array, column: pa.Array) -> Iterator[bytes]:
    codec = pa.Codec("zstd")
    for size, data in zip(sizes.to_pylist(), column.cast(pa.binary()).to_pylist()):
        yield codec.decompress(data, size, asbytes=True) if size else b""


# --- the operator ----------------------------------------------------------

def _ordered(df: DataFrame, ident: str, text: str) -> DataFrame:
    """``df`` with ``_sd_id``, ``_sd_tie`` (tells rows of one identifier apart)
    and ``_sd_text``."""
    rows = df.withColumns({"_sd_id": F.col(ident), "_sd_text": F.coalesce(F.col(text), F.lit(""))})
    again = written(rows.groupBy("_sd_id").count().where("count > 1 or _sd_id is null").select("_sd_id"), "repeated-ids")
    once = rows.withColumn("_sd_tie", F.lit(0).cast("long"))
    if again.isEmpty():
        return once
    same = rows["_sd_id"].eqNullSafe(again["_sd_id"])
    # equal rows are one with a number, then numbered within their identifier
    counted = (rows.join(again, same, "left_semi").groupBy(*rows.columns).agg(F.count("*").alias("_sd_n"))
               .withColumn("_sd_order", F.xxhash64(*rows.columns)))
    along = Window.partitionBy("_sd_id").orderBy(F.sha2("_sd_text", 256), "_sd_order")
    numbered = (counted.withColumn("_sd_to", F.sum("_sd_n").over(along.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("_sd_tie", F.explode(F.sequence(F.col("_sd_to") - F.col("_sd_n") + 1, "_sd_to"))))
    return written(once.join(again, same, "left_anti").unionByName(numbered.select(*once.columns)), "ordered")


KEYS = ["_sd_id", "_sd_tie"]


def _with_texts(docs: DataFrame, gathered: DataFrame, how: str) -> DataFrame:
    """Compressed texts joined with what was gathered for their documents."""
    texts = _packed(docs, KEYS)
    on = texts["_sd_id"].eqNullSafe(gathered["_sd_id"]) & (texts["_sd_tie"] == gathered["_sd_tie"])
    return texts.join(gathered.hint("merge"), on, how).select(*[texts[c] for c in texts.columns],
                                                               *[gathered[c] for c in gathered.columns if c not in KEYS])


def _sorted_repeats(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Runs of repeated starts ``(keys, _sd_first, _sd_n)`` among the contexts
    ``wanted(keys, _sd_key, _sd_first, _sd_n)``."""
    order = ["_sd_key", F.col("_sd_id").asc_nulls_first(), "_sd_tie", "_sd_first"]
    spans = wanted.groupBy(*KEYS).agg(F.collect_list(F.struct("_sd_first", "_sd_n", "_sd_key")).alias("_sd_spans"))
    kind = docs.schema["_sd_id"].dataType
    cut_schema = (T.StructType().add("_sd_id", kind).add("_sd_tie", T.LongType()).add("_sd_key", T.LongType())
                  .add("_sd_first", T.LongType()).add("_sd_n", T.LongType()).add("_sd_bytes", T.BinaryType()))
    out_schema = T.StructType(cut_schema.fields[:2] + cut_schema.fields[3:5])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: E731, B023
            for i, text in enumerate(_unpacked(get("_sd_size"), get("_sd_packed"))):
                own = get("_sd_spans").slice(i, 1).flatten()
                first, count, key = (own.field(k).to_pylist() for k in range(3))
                at = pa.array([i] * len(first), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    get("_sd_id").take(at), get("_sd_tie").take(at), pa.array(key, pa.int64()), pa.array(first, pa.int64()),
                    pa.array(count, pa.int64()), pa.array([text[f:f + n + LENGTH - 1] for f, n in zip(first, count)], pa.binary())],
                    names=cut_schema.fieldNames())

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def done(rows: list[tuple]) -> pa.RecordBatch:
            out = []
            for (i, tie, _, first, _, _), found in zip(rows, repeats([r[5] for r in rows], np.array([r[4] for r in rows]))):
                edge = np.flatnonzero(np.diff(np.concatenate([[0], found.astype(np.int8), [0]])))
                out += [(i, tie, first + a, b - a) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
            columns = zip(*out) if out else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [ids, *[pa.int64()] * 3])],
                                              names=out_schema.fieldNames())

        ids = None
        for batch in batches:
            ids = batch.column(0).type
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > SORTED and row[2] != held[-1][2]:
                    yield done(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield done(held)

    cuts = map_arrow(_with_texts(docs, spans, "inner"), cut, cut_schema)
    return map_arrow(cuts.repartition(partitions(docs.sparkSession), "_sd_key").sortWithinPartitions(*order), sort, out_schema)


def hot_anchors(docs: DataFrame) -> dict[int, tuple[int, bool]]:
    """Anchors that hold more than a quarter of a partition's fair share of the
    contexts (hence a few a partition at most), by a sample of the documents: into
    how many pieces to deal them, and whether many of their contexts differ. Only
    how contexts are dealt depends on the sample, no result does."""
    spark = docs.sparkSession
    seen = (contexts_of(docs.sample(SAMPLE, seed=11), KEYS).groupBy("_sd_key", "_sd_digest").agg(F.count("*").alias("n"))
            .groupBy("_sd_key").agg(F.sum("n").alias("n"), F.count("*").alias("different")))
    seen = written(seen, "sampled-anchors", per_core=1)
    fair = max((seen.agg(F.sum("n")).first()[0] or 0) / (HOT_PER_PARTITION * partitions(spark)), LEAST_SAMPLED)
    return {r[0]: (math.ceil(r[1] / fair) + 1, r[2] >= fair) for r in seen.where(F.col("n") > fair).collect()}


def _earliest(found: DataFrame, deal: list[str]) -> DataFrame:
    """Whether a context is the earliest of its equals, and whether there are
    others, among the contexts with the same ``deal``."""
    order = ["_sd_digest", F.col("_sd_id").asc_nulls_first(), "_sd_tie", "_sd_first"]
    one = Window.partitionBy(*deal).orderBy(*order)
    whole = one.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before: Column = F.lag("_sd_digest").over(one)
    return found.withColumns({
        "_sd_earliest": F.coalesce(before != F.col("_sd_digest"), F.lit(True)),
        "_sd_several": F.min("_sd_digest").over(whole) != F.max("_sd_digest").over(whole)})


def repeated_starts(docs: DataFrame) -> DataFrame:
    """Runs ``(keys, _sd_first, _sd_n)`` of starts whose string also starts earlier."""
    found = contexts_of(docs, KEYS, hot_anchors(docs))
    piece = F.pmod(F.xxhash64(*KEYS, "_sd_first"), F.col("_sd_pieces"))
    found = _earliest(found.withColumn("_sd_piece", piece), ["_sd_key", "_sd_piece"])
    dealt = F.col("_sd_pieces") > 1
    found = written(found.where(~F.col("_sd_earliest") | F.col("_sd_several") | dealt)
                    .select(*KEYS, "_sd_key", "_sd_digest", "_sd_first", "_sd_n", "_sd_earliest", "_sd_several", "_sd_pieces"),
                    "contexts", compression="zstd")
    # of an anchor dealt in pieces, the earliest of each piece meet
    met = _earliest(found.where(F.col("_sd_earliest") & dealt).drop("_sd_earliest", "_sd_several"), ["_sd_key"])
    found = found.where(~(F.col("_sd_earliest") & dealt)).unionByName(met)
    same = found.where("not _sd_earliest").select(*KEYS, "_sd_first", "_sd_n")
    return same.unionByName(_sorted_repeats(docs, found.where("_sd_earliest and _sd_several").select(
        *KEYS, "_sd_key", "_sd_first", "_sd_n")))


def deduplicated(df: DataFrame, text: str = "text", ident: str = "doc_id", texts: bool = False) -> DataFrame:
    """``df`` without the text, with ``n_bytes``, ``n_removed``, ``n_spans`` and
    ``kept_sha256``; with ``texts`` also the ``kept`` bytes."""
    keep = [c for c in df.columns if c not in (*RESULTS, text, "kept")]
    docs = _ordered(df, ident, text)
    starts = repeated_starts(docs.select(*KEYS, "_sd_text"))
    runs = starts.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("_sd_first", "_sd_n"))).alias("_sd_runs"))
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in keep])
    for name, kind in RESULTS.items():
        schema = schema.add(name, kind)
    schema = schema.add("kept", T.BinaryType()) if texts else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: E731, B023
            out = []
            for i, whole in enumerate(_unpacked(get("_sd_size"), get("_sd_packed"))):
                runs = get("_sd_runs").slice(i, 1)
                if runs.null_count:
                    out.append((len(whole), 0, 0, hashlib.sha256(whole).hexdigest(), whole))
                    continue
                first, count = (runs.flatten().field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                edge = np.zeros(len(whole) + 1, dtype=np.int32)
                np.add.at(edge, first, 1)
                np.add.at(edge, first + count + LENGTH - 1, -1)
                stays = np.cumsum(edge)[:-1] == 0
                kept = np.frombuffer(whole, dtype=np.uint8)[stays].tobytes()
                spans = int((~stays[1:] & stays[:-1]).sum()) + int(not stays[0])
                out.append((len(whole), len(whole) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            columns = list(zip(*out)) if out else [[]] * 5
            made = [pa.array(c, t) for c, t in zip(columns, [*[pa.int64()] * 3, pa.string(), pa.binary()])]
            yield pa.RecordBatch.from_arrays([*(get(f"_sd_c{k}") for k in range(len(keep))), *made[:5 if texts else 4]],
                                             names=schema.fieldNames())

    carried = docs.select(*KEYS, "_sd_text", *[F.col(c).alias(f"_sd_c{k}") for k, c in enumerate(keep)])
    rows = _carrying(carried, runs, len(keep))
    return map_arrow(rows, run, schema)


def _carrying(carried: DataFrame, runs: DataFrame, width: int) -> DataFrame:
    texts = _packed(carried.select(*KEYS, *[f"_sd_c{k}" for k in range(width)], "_sd_text"),
                    [*KEYS, *[f"_sd_c{k}" for k in range(width)]])
    on = texts["_sd_id"].eqNullSafe(runs["_sd_id"]) & (texts["_sd_tie"] == runs["_sd_tie"])
    return texts.join(runs.hint("merge"), on, "left").select(*[texts[c] for c in texts.columns], runs["_sd_runs"])


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what is left of it without repeated passages."""
    return deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
