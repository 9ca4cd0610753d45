"""Alignment of two tokenizers over the same texts, by merge-path partitioning.

Both tokenizers cut the bytes of a space and the text into tokens. The ends of
A's and of B's tokens are two ascending lists. Merging them yields the overlaps
(every step ends a stretch that lies in one token of either) and the groups (a
step at which both end). The merge is cut into pieces of ``PIECE`` steps: for
every ``PIECE``-th diagonal of the merge matrix a binary search finds how many
ends of either list lie before it. The pieces are independent and of equal work,
whatever the lengths of tokens and texts; they are merged side by side, one numpy
lane each. A piece emits the overlaps of its steps and the common ends it meets;
the running number of common ends over the pieces stitches groups that begin in
one piece and end in another.

Texts are tokenised by units: no token of either vocabulary goes on over a space
that follows something else than white space, so what lies between such borders
is tokenised once and kept in a cache of bounded size. (``Pair`` checks B's
vocabulary for that; A's split pattern has it.) A border is an end of a token of
both, hence long texts are aligned window by window, each a run of whole units.

Texts are tokenised once; their ids are written. The first pass also counts, for
each pair of ids, the documents that hold it linked (added up in the tasks
first); the second aligns the ids again, which is cheap, and scores each
document's links by these counts. How many pairs can overlap is a matter of the
two vocabularies, not of the corpus; their counts are sent to the tasks in
slices of at most ``SLICE`` pairs, one slice a pass.

Defined cases: null and empty texts, and texts whose tokens don't spell the same
bytes (one with U+2581, say), have no tokens: zeros and an empty digest. Repeated
rows are documents of their own, and count as such. Other columns are carried
along, those named like the results are replaced (names starting with ``_al_`` are
reserved). An empty table gives an empty
table. A unit without any such border is tokenised in one piece by the libraries.
"""

from __future__ import annotations

import functools
import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.bpe import read_texts
from shelfcast.llm.common import map_arrow, slices, table, written

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
PIECE = 64                # merge steps of a piece
WINDOW = 1 << 20          # bytes aligned at once
CACHED_UNITS = 300_000    # in each of two generations of the cache
JOINED = 1024             # units tokenised end to end
LONG_UNIT = 128           # characters from which a unit isn't kept
HELD = 1 << 20            # pairs a task adds up before it sends them on
SLICE = 4_000_000         # pairs whose counts are sent to the tasks at once
BORDER = re.compile(r"(?<=\S)(?= )")
ODD = re.compile(r"\s |  ")
RESULTS = {"n_a": T.LongType(), "n_b": T.LongType(), "n_groups": T.LongType(), "n_links": T.LongType(),
           "groups_sha256": T.StringType(), "n_best": T.LongType(), "count_sum": T.LongType()}


_COUNT = struct.Struct("<I").pack


def _byte_of_char() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable
    ones stand for themselves, the others follow from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def units_of(text: str) -> list[str]:
    """The units of a space and the text, each without its first space."""
    if ODD.search(text) or text[:1].isspace():
        return [u[1:] for u in BORDER.split(" " + text)]
    return text.split(" ")


class Pair:
    """Two tokenizers: their ids of a text, and the byte lengths of the tokens."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        byte = _byte_of_char()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("tokens of B must not go on over a space that follows something else")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_size = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.space = self.b.piece_to_id("▁")
        # ids as they are printed, by what follows them
        ids_a, ids_b = range(len(self.a_bytes)), range(len(self.b_bytes))
        self.printed = np.array([b"%d%c" % (i, c) for c, ids in zip(b",|,;", (ids_a, ids_a, ids_b, ids_b)) for i in ids],
                                dtype=object)
        self.young: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}

    def _encoded(self, units: list[str]) -> Iterator[tuple[str, bytes | None]]:
        """Each unit with its ids, packed: the number of A's, A's, and B's. None if
        a unit isn't spelt alike. Units that end in a border are tokenised end to
        end."""
        joined = [u for u in units if u and not u[-1].isspace() and "▁" not in u]
        whole = " " + " ".join(joined)
        raw = whole.encode()
        ends = np.cumsum([len(u.encode()) + 1 for u in joined], dtype=np.int64)
        packed = []
        for ids, sizes, spelt in ((self.a.encode_batch_fast([whole], add_special_tokens=False)[0].ids, self.a_size, self.a_bytes),
                                  (self.b.encode(whole[1:]), self.b_size, self.b_bytes)) if joined else ():
            if b"".join([spelt[i] for i in ids]) != raw:
                break
            ids = np.array(ids, dtype="<u4")
            at = np.searchsorted(np.cumsum(sizes[ids]), ends).tolist()
            data = ids.tobytes()
            packed.append([data[4 * x:4 * y + 4] for x, y in zip([0] + [x + 1 for x in at[:-1]], at)])
        if len(packed) == 2:
            yield from ((u, _COUNT(len(i) // 4) + i + j) for u, i, j in zip(joined, *packed))
            units = list(set(units) - set(joined))
        for u in units:
            raw = (" " + u).encode()
            i = self.a.encode(" " + u, add_special_tokens=False).ids
            # the library puts a space before a text, but not before an empty one
            j = self.b.encode(u) or [self.space]
            same = b"".join([self.a_bytes[x] for x in i]) == raw == b"".join([self.b_bytes[x] for x in j])
            yield u, np.array([len(i), *i, *j], dtype="<u4").tobytes() if same else None

    def lookup(self, units: list[str]) -> list[bytes | None]:
        """Packed ids of each unit, through the cache."""
        found = list(map(self.young.get, units))
        if None not in found:
            return found
        missing = {u for u, x in zip(units, found) if x is None and u not in self.young}
        own: dict[str, bytes | None] = {u: self.old[u] for u in missing if u in self.old}
        new = [u for u in missing if u not in own]
        for at in range(0, len(new), JOINED):
            own.update(self._encoded(new[at:at + JOINED]))
        if len(self.young) + len(own) > CACHED_UNITS:
            self.old, self.young = self.young, {}
        self.young.update((u, x) for u, x in own.items() if len(u) < LONG_UNIT)
        return [own[u] if x is None and u in own else x for u, x in zip(units, found)]


@functools.cache
def pair(a_file: str, b_file: str) -> Pair:
    """One pair of tokenizers a process; files are paths or names of public ones."""
    import os

    import public_tokenizers
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Pair(*(f if "/" in f else public_tokenizers.path(f) for f in (a_file, b_file)))


def diagonal_cuts(a_ends: np.ndarray, b_ends: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many ends of A are among the first ``d`` of the merge, for each ``d``;
    of equal ends A's comes first. A binary search along each diagonal."""
    low = np.maximum(diagonals - len(b_ends), 0)
    high = np.minimum(diagonals, len(a_ends))
    while True:
        rest = low < high
        if not rest.any():
            return low
        middle = (low + high) >> 1
        # A's end `middle` belongs to the first d if it isn't above B's end d - 1 - middle
        taken = rest & (a_ends[np.minimum(middle, len(a_ends) - 1)] <= b_ends[np.maximum(diagonals - 1 - middle, 0)])
        low = np.where(taken, middle + 1, low)
        high = np.where(rest & ~taken, middle, high)


def merge(a_ends: np.ndarray, b_ends: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps and groups of two lists of token ends (both end at the same
    place): the tokens ``(a, b)`` of each overlap, in order, and the numbers of
    the last tokens of A and of B in each group."""
    n, m = len(a_ends), len(b_ends)
    steps = n + m
    lanes = -(-steps // piece)
    first = np.arange(lanes, dtype=np.int64) * piece
    i = diagonal_cuts(a_ends, b_ends, first)
    j = first - i
    a_at = np.empty((piece, lanes), dtype=np.int32)
    b_at = np.empty((piece, lanes), dtype=np.int32)
    links = np.zeros((piece, lanes), dtype=bool)
    closed = np.zeros((piece, lanes), dtype=bool)
    a_more = np.append(a_ends, np.iinfo(np.int64).max)
    b_more = np.append(b_ends, np.iinfo(np.int64).max)
    for step in range(piece):
        a, b = a_more[i], b_more[j]
        a_at[step], b_at[step] = i, j
        from_a = a <= b
        from_a &= i < n
        # the step of a B end that A has just ended at makes no overlap, but closes a group
        shared = ~from_a & (a_more[i - 1] == b) & (i > 0)
        live = (i < n) | (j < m)
        links[step] = live & ~shared
        closed[step] = shared & live
        i = i + from_a
        j = j + (~from_a & live)
    # pieces one after the other
    on, ends = links.T.reshape(-1), closed.T.reshape(-1)
    a_all, b_all = a_at.T.reshape(-1), b_at.T.reshape(-1)
    return a_all[on], b_all[on], a_all[ends] - 1, b_all[ends]


class Aligned:
    """The alignment of a run of texts laid end to end."""

    def __init__(self, own: Pair, a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray):
        """``a``, ``b``: ids; ``a_cuts``, ``b_cuts``: where each text's begin."""
        self.own, self.a, self.b, self.a_cuts, self.b_cuts = own, a, b, a_cuts, b_cuts
        if len(a):
            self.link_a, self.link_b, self.last_a, self.last_b = merge(np.cumsum(own.a_size[a]), np.cumsum(own.b_size[b]))
        else:
            self.link_a = self.link_b = self.last_a = self.last_b = np.zeros(0, dtype=np.int64)
        self.link_cuts = np.searchsorted(self.link_a, a_cuts)
        self.group_cuts = np.searchsorted(self.last_a, a_cuts)

    def pairs(self) -> np.ndarray:
        """Ids of A and B of each link, in one number."""
        return self.a[self.link_a] * len(self.own.b_bytes) + self.b[self.link_b]

    def printed(self) -> list[bytes]:
        """The groups of each text, with a last separator."""
        n, m, groups = len(self.a), len(self.b), len(self.last_a)
        sizes_a, sizes_b = np.diff(self.last_a, prepend=-1), np.diff(self.last_b, prepend=-1)
        group_a, group_b = np.repeat(np.arange(groups), sizes_a), np.repeat(np.arange(groups), sizes_b)
        na, nb = len(self.own.a_bytes), len(self.own.b_bytes)
        code_a, code_b = self.a.astype(np.int64), self.b.astype(np.int64) + 2 * na
        code_a[self.last_a] += na
        code_b[self.last_b] += nb
        codes = np.empty(n + m, dtype=np.int64)
        before_b = np.concatenate([[0], np.cumsum(sizes_b)])
        codes[np.arange(n) + before_b[group_a]] = code_a
        codes[np.arange(m) + (self.last_a + 1)[group_b]] = code_b
        out = self.own.printed[codes].tolist()
        cuts = (self.a_cuts + self.b_cuts).tolist()
        return [b"".join(out[x:y]) for x, y in zip(cuts, cuts[1:])]


def parts_of(text: str) -> Iterator[str]:
    """A text in parts of about ``WINDOW`` characters, cut at borders of units;
    the space at a cut belongs to neither."""
    at = 0
    while len(text) - at > WINDOW and (cut := BORDER.search(text, at + WINDOW)):
        yield text[at:cut.start()]
        at = cut.start() + 1
    yield text[at:]


def tokens_of(own: Pair, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of A and of B of texts laid end to end, and where each text's begin.
    Texts that the tokenizers don't spell alike come without tokens."""
    parts = []
    for some in (parts_of(texts[0]) if len(texts) == 1 and texts[0] else [texts]):
        some = [some] if isinstance(some, str) else some
        split = [units_of(t) if t or len(texts) == 1 and texts[0] else [] for t in some]
        found, at, rows = own.lookup(list(chain.from_iterable(split))), 0, []
        for units in split:
            part = found[at:at + len(units)]
            at += len(units)
            rows.append([] if None in part else part)
            if None in part and len(texts) == 1:
                parts, rows = [], [[]]
                break
        units = list(chain.from_iterable(rows))
        packed = np.frombuffer(b"".join(units), dtype="<u4").astype(np.int64)
        ends = np.cumsum(np.array(list(map(len, units)), dtype=np.int64)) >> 2
        heads = np.concatenate([[0], ends])[:-1]
        n_a = packed[heads]
        n_b = ends - heads - 1 - n_a
        of_a = np.repeat(np.tile([False, True, False], len(units)), np.stack([np.ones_like(n_a), n_a, n_b], 1).reshape(-1))
        of_b = ~of_a
        of_b[heads] = False
        at = np.cumsum([0] + [len(r) for r in rows])
        cuts = [np.concatenate([[0], np.cumsum(n)])[at] for n in (n_a, n_b)]
        parts.append((packed[of_a], packed[of_b], *cuts))
        if len(texts) == 1 and not units:
            break
    if len(parts) == 1:
        return parts[0]
    a, b = (np.concatenate([x[k] for x in parts]) for k in (0, 1))
    return a, b, np.array([0, len(a)]), np.array([0, len(b)])


def alignments(own: Pair, a: np.ndarray, b: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> Iterator[Aligned]:
    """Alignments of texts laid end to end: of all at once, or of one long text
    window by window, cut where tokens of both end."""
    if len(a_cuts) > 2 or len(a) + len(b) <= 2 * WINDOW:
        yield Aligned(own, a, b, a_cuts, b_cuts)
        return
    i = j = 0
    width = WINDOW
    while i < len(a):
        x, y = np.cumsum(own.a_size[a[i:i + width]]), np.cumsum(own.b_size[b[j:j + width]])
        both = np.intersect1d(x, y, assume_unique=True)
        if not len(both):
            width *= 2
            continue
        p, q = int(np.searchsorted(x, both[-1])) + 1, int(np.searchsorted(y, both[-1])) + 1
        yield Aligned(own, a[i:i + p], b[j:j + q], np.array([0, p]), np.array([0, q]))
        i, j, width = i + p, j + q, WINDOW


def _packed(ids: np.ndarray, cuts: np.ndarray, width: int) -> pa.Array:
    """Ids of each text as little-endian integers of ``width`` bytes."""
    data = ids.astype(f"<u{width}").tobytes()
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1,
                                 [None, pa.py_buffer((cuts * width).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _width(own: Pair) -> int:
    return 2 if max(len(own.a_bytes), len(own.b_bytes)) <= 1 << 16 else 4


def tokenised(df: DataFrame, keep: list[str], text: str, a_file: str, b_file: str) -> DataFrame:
    """Two kinds of rows: a text's columns ``keep`` and its packed ids ``_al_a``,
    ``_al_b``; and ``_al_pair``, ``_al_n``: a linked pair of ids (A's times the
    size of B's vocabulary, plus B's) and in how many of a task's texts it is."""
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in keep])
    for name, kind in (("_al_a", T.BinaryType()), ("_al_b", T.BinaryType()), ("_al_pair", T.LongType()), ("_al_n", T.LongType())):
        schema = schema.add(name, kind)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pair(a_file, b_file)
        room, width = len(own.a_bytes) * len(own.b_bytes), _width(own)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        kinds: list[pa.DataType] = []

        def added() -> tuple[np.ndarray, np.ndarray]:
            keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(place, weights=np.concatenate([n for _, n in held]), minlength=len(keys)).astype(np.int64)

        def sent() -> Iterator[pa.RecordBatch]:
            keys, counts = added()
            for a in range(0, len(keys), 1 << 16):
                part = pa.array(keys[a:a + (1 << 16)])
                yield pa.RecordBatch.from_arrays([*(pa.nulls(len(part), k) for k in kinds), pa.nulls(len(part), pa.binary()),
                                                  pa.nulls(len(part), pa.binary()), part, pa.array(counts[a:a + (1 << 16)])],
                                                 names=names)

        for batch in batches:
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            kinds = [c.type for c in kept]
            column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            for a, b in slices(column, WINDOW):
                tokens = tokens_of(own, read_texts(column.slice(a, b - a)))
                yield pa.RecordBatch.from_arrays([
                    *(c.slice(a, b - a) for c in kept), _packed(tokens[0], tokens[2], width), _packed(tokens[1], tokens[3], width),
                    pa.nulls(b - a, pa.int64()), pa.nulls(b - a, pa.int64())], names=names)
                found = []
                for x in alignments(own, *tokens):
                    number = np.repeat(np.arange(len(x.link_cuts) - 1, dtype=np.int64), np.diff(x.link_cuts))
                    found.append(np.unique(number * room + x.pairs()))
                each = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
                held.append(np.unique(each % room, return_counts=True))
                size += len(held[-1][0])
                if size > 2 * HELD:
                    held[:] = [added()]
                    size = len(held[0][0])
                    if size > HELD:
                        yield from sent()
                        held.clear()
                        size = 0
        if held:
            yield from sent()

    return map_arrow(df.select(*dict.fromkeys([*keep, text])), run, schema)


def _scored(rows: DataFrame, keep: list[str], a_file: str, b_file: str, most: np.ndarray, low: int, high: int,
            counts: tuple[np.ndarray, np.ndarray], last: bool) -> DataFrame:
    """The rows of texts with the results, scores added up over the pairs from
    ``low`` to below ``high``, of which those missing in ``counts`` occur once."""
    going_on = "n_a" in rows.columns
    carried = [*keep, *([] if last else ["_al_a", "_al_b"])]
    schema = T.StructType([rows.schema[c] for c in carried])
    for name, kind in RESULTS.items():
        schema = schema.add(name, kind)
    sent = rows.sparkSession.sparkContext.broadcast((most, *counts))
    names = list(RESULTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pair(a_file, b_file)
        most, keys, times = sent.value
        kind = f"<u{_width(own)}"
        for batch in batches:
            get = lambda c: batch.column(batch.schema.get_field_index(c)).slice(a, b - a)  # noqa: E731, B023
            whole = batch.column(batch.schema.get_field_index("_al_a")).cast(pa.binary())
            for a, b in slices(whole, WINDOW):
                packed = [get(c).to_pylist() for c in ("_al_a", "_al_b")]
                ids = [np.frombuffer(b"".join(p), dtype=kind).astype(np.int64) for p in packed]
                cuts = [np.cumsum([0] + [len(x) for x in p]) // _width(own) for p in packed]
                sums = np.zeros((6, b - a), dtype=np.int64)
                digests = [] if going_on else [hashlib.sha256() for _ in range(b - a)]
                ends = [b""] * (b - a)
                for x in alignments(own, *ids, *cuts):
                    pairs = x.pairs()
                    at = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
                    n = np.where(keys[at] == pairs, times[at], 1) if len(keys) else np.ones(len(pairs), dtype=np.int64)
                    n[(pairs < low) | (pairs >= high)] = 0
                    best = n == most[pairs // len(own.b_bytes)]
                    for row, values in ((4, best), (5, n)):
                        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
                        sums[row] += np.diff(total[x.link_cuts])
                    if going_on:
                        continue
                    for row, cut in ((0, x.a_cuts), (1, x.b_cuts), (2, x.group_cuts), (3, x.link_cuts)):
                        sums[row] += np.diff(cut)
                    for i, s in enumerate(x.printed()):
                        digests[i].update(ends[i] + s[:-1])
                        ends[i] = s[-1:]
                if going_on:
                    columns = [get(c) for c in names[:5]]
                    sums[4] += get("n_best").to_numpy(zero_copy_only=False)
                    sums[5] += get("count_sum").to_numpy(zero_copy_only=False)
                else:
                    hexes = [d.hexdigest() if n else "" for d, n in zip(digests, sums[0])]
                    columns = [*map(pa.array, sums[:4]), pa.array(hexes, pa.string())]
                yield pa.RecordBatch.from_arrays([*map(get, carried), *columns, pa.array(sums[4]), pa.array(sums[5])],
                                                 names=schema.fieldNames())

    return map_arrow(rows.select(*keep, "_al_a", "_al_b", *(names if going_on else [])), run, schema)


def align(df: DataFrame, text: str = "text", a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """``df`` without the text, with the numbers of tokens, groups and links, the
    digest of the groups, and the links' scores by the counts of their pairs."""
    keep = [c for c in df.columns if c not in RESULTS and c != text]
    own = pair(a_file, b_file)
    width = len(own.b_bytes)
    found = written(tokenised(df, keep, text, a_file, b_file), "tokens", compression="zstd")
    counts = written(found.where(F.col("_al_pair").isNotNull()).groupBy(F.col("_al_pair").alias("pair"))
                     .agg(F.sum("_al_n").alias("n")), "pair-counts")
    tokens = counts.groupBy(F.floor(F.col("pair") / width).alias("a")).agg(
        F.max("n").alias("most"), F.count(F.when(F.col("n") > 1, 1)).alias("held")).toArrow()   # at most A's vocabulary
    most = np.ones(len(own.a_bytes), dtype=np.int64)
    held = np.zeros(len(own.a_bytes), dtype=np.int64)
    ids = tokens["a"].to_numpy()
    most[ids], held[ids] = tokens["most"].to_numpy(), tokens["held"].to_numpy()
    # runs of A's ids whose pairs fit in a slice
    cuts, room = [0], SLICE
    for i, n in enumerate(held.tolist()):
        if n > room and i > cuts[-1]:
            cuts.append(i)
            room = SLICE
        room -= n
    cuts.append(len(held))
    out = found.where(F.col("_al_pair").isNull())
    for low, high in zip(cuts, cuts[1:]):
        last = high == len(held)
        part = counts.where((F.col("n") > 1) & (F.col("pair") >= low * width) & (F.col("pair") < high * width)).toArrow()
        keys, times = part["pair"].to_numpy(), part["n"].to_numpy()
        order = np.argsort(keys)
        out = _scored(out, keep, a_file, b_file, most, low * width, high * width, (keys[order], times[order]), last)
        if not last:
            out = written(out, "aligned")
    return out


def op12_merge_path_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, groups and links of the two tokenizers."""
    return align(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
