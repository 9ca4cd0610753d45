"""Byte-level BPE: encoding and decoding of whole texts.

Pre-tokenisation without a regular expression. Each code point is mapped to a
class by one array lookup (letter, number, white space, rest; apostrophes that
open a contraction and white space before text are told apart by the following
classes). The split pattern is an automaton over eight states. Each class is a
function from states to states; all functions that arise by composing them form
a small finite set, whose composition table is computed once. A prefix scan
with that associative table (blocks side by side, then over the blocks' totals)
gives the state before every code point at once, and a lookup in (state, class)
says where a token starts.

The slices between boundaries are encoded by pair merging, lowest rank first,
behind a cache of bounded size. Token offsets are kept, and decoding gathers the
tokens' bytes from the vocabulary's byte array by its offsets.

Defined cases: a null text is empty and has no tokens; bytes that are not UTF-8
are read as U+FFFD; a text of any length is cut into windows at token starts
(matching starts afresh there), so work arrays stay bounded. Repeated rows give
repeated results; extra columns pass through ``encode``.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfcast.llm.common import map_arrow, slices, table

VOCABULARY = "byte_bpe_50k.tiktoken"
WINDOW = 1 << 20          # code points of a long text scanned at once
CACHED_PIECES = 200_000   # in each of two generations of the cache
LONG_PIECE = 256          # bytes from which merging keeps a heap

# classes of code points
LETTER, NUMBER, OTHER, SHORT, LONG, SPACE_BEFORE, BLANK_BEFORE, BLANK = range(8)
# states: after a complete token; in a run of letters, numbers, other, white
# space; after a space that opens the next token; one or two letters of a
# contraction to come
DONE, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_BLANK, PREFIX, ONE_LEFT, TWO_LEFT = range(8)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and "a token starts here", by state and class."""
    opened = [IN_LETTERS, IN_NUMBERS, IN_OTHER, ONE_LEFT, TWO_LEFT, PREFIX, DONE, IN_BLANK]
    step = np.array([opened] * 8, dtype=np.uint8)
    starts = np.ones((8, 8), dtype=bool)

    def goes_on(state: int, kinds: tuple[int, ...], to: int) -> None:
        step[state, list(kinds)] = to
        starts[state, list(kinds)] = False

    for state in (IN_LETTERS, PREFIX):
        goes_on(state, (LETTER,), IN_LETTERS)
    for state in (IN_NUMBERS, PREFIX):
        goes_on(state, (NUMBER,), IN_NUMBERS)
    for state in (IN_OTHER, PREFIX):
        goes_on(state, (OTHER, SHORT, LONG), IN_OTHER)
    goes_on(IN_BLANK, (BLANK,), IN_BLANK)
    goes_on(ONE_LEFT, tuple(range(8)), DONE)
    goes_on(TWO_LEFT, tuple(range(8)), ONE_LEFT)
    return step, starts


@functools.cache
def scan_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Element of each input (class, or class + 8 at a text's start), the
    composition table, element applied to state, start flags, identity."""
    step, starts = _automaton()
    inputs = [tuple(int(x) for x in step[:, c]) for c in range(8)]
    inputs += [(int(step[DONE, c]),) * 8 for c in range(8)]
    elements = {tuple(range(8)): 0}
    todo = list(elements)
    while todo:
        f = todo.pop()
        for g in inputs:
            h = tuple(g[s] for s in f)
            if h not in elements:
                elements[h] = len(elements)
                todo.append(h)
    names = list(elements)
    compose = np.array([[elements[tuple(g[s] for s in f)] for g in names] for f in names], dtype=np.uint16)
    apply = np.array(names, dtype=np.uint8)
    return np.array([elements[g] for g in inputs], dtype=np.uint16), compose, apply, starts, 0


@functools.cache
def class_table() -> np.ndarray:
    """Class of every code point: the letters, numbers and white space of the
    tokenizer library's own Unicode tables, asked once a process."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for kind, of in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\s")):
        matched = tiktoken.Encoding(of, pat_str=of, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        out[np.frombuffer(bytes(matched).decode().encode("utf-32-le"), dtype=np.uint32)] = kind
    return out


def prefix_scan(elements: np.ndarray, compose: np.ndarray, identity: int) -> np.ndarray:
    """Inclusive prefix compositions, by doubling."""
    out, reach = elements.copy(), 1
    while reach < len(out):
        out[reach:] = compose[out[:-reach], out[reach:]]
        reach *= 2
    return out


def token_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where tokens start in texts laid end to end. ``points``: code points;
    ``text_starts``: the positions of the texts' first code points."""
    n = len(points)
    if n == 0:
        return np.zeros(0, dtype=bool)
    inputs, compose, apply, flags, identity = scan_tables()
    kinds = class_table()[points]
    first = np.zeros(n + 1, dtype=bool)
    first[text_starts] = True
    first[n] = True
    blank = kinds == BLANK
    text_next = np.zeros(n, dtype=bool)          # a code point of the same text follows and is no white space
    text_next[:-1] = ~blank[1:] & ~first[1:n]
    before = np.flatnonzero(blank & text_next)
    kinds[before] = np.where(points[before] == 0x20, SPACE_BEFORE, BLANK_BEFORE)
    for at in np.flatnonzero(points == 0x27):
        if at + 1 < n and not first[at + 1]:
            one = points[at + 1]
            if one in (0x73, 0x74, 0x6D, 0x64):                            # s t m d
                kinds[at] = SHORT
            elif at + 2 < n and not first[at + 2] and (one, points[at + 2]) in (
                    (0x72, 0x65), (0x76, 0x65), (0x6C, 0x6C)):             # re ve ll
                kinds[at] = LONG
    length = max(1, min(256, int(np.sqrt(n))))
    rows = -(-n // length)
    padded = np.full(rows * length, identity, dtype=np.uint16)
    padded[:n] = inputs[kinds + 8 * first[:n].astype(np.uint8)]
    across = np.ascontiguousarray(padded.reshape(rows, length).T)         # [place in block, block]
    for j in range(1, length):
        across[j] = compose[across[j - 1], across[j]]
    totals = prefix_scan(across[-1], compose, identity)
    entering = np.zeros(rows, dtype=np.uint8)
    entering[1:] = apply[totals[:-1], DONE]
    after = apply[across, entering[None, :]].T.reshape(-1)[:n]
    states = np.empty(n, dtype=np.uint8)
    states[0] = DONE
    states[1:] = after[:-1]
    return flags[states, kinds] | first[:n]


class Tokenizer:
    """Ranks of a vocabulary file, the cache of encoded pieces, and the byte
    array of all tokens with its offsets."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.blob = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.offsets = np.zeros(size + 1, dtype=np.int64)
        np.cumsum([len(t) for t in tokens], out=self.offsets[1:])
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one piece: of all adjacent pairs the one of the lowest
        rank is merged, the leftmost of equals, until none is in the vocabulary."""
        known = self.ranks.get(piece)
        if known is not None:
            return [known]
        return (self._merge_heap if len(piece) >= LONG_PIECE else self._merge_list)(piece)

    def _merge_list(self, piece: bytes) -> list[int]:
        rank, never = self.ranks.get, 1 << 60
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [rank(a + b, never) for a, b in zip(parts, parts[1:])]
        while pairs:
            least = min(pairs)
            if least == never:
                break
            i = pairs.index(least)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], never)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], never)
        return [self.ranks[p] for p in parts]

    def _merge_heap(self, piece: bytes) -> list[int]:
        rank, n = self.ranks.get, len(piece)
        end = list(range(1, n + 1))              # end of the part that starts here
        back = list(range(-1, n - 1))            # start of the part before
        alive = [True] * n

        def pair(i: int) -> None:
            j = end[i]
            if j < n and (r := rank(piece[i:end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))

        heap: list[tuple[int, int, int]] = []
        for i in range(n - 1):
            pair(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] == n or end[end[i]] != stop or end[i] >= stop:
                continue
            j = end[i]
            alive[j], end[i] = False, stop
            if stop < n:
                back[stop] = i
            pair(i)
            if back[i] >= 0:
                pair(back[i])
        return [self.ranks[piece[i:end[i]]] for i in range(n) if alive[i]]

    def _packed(self, piece: str) -> bytes:
        """Ids of a piece as little-endian 32-bit integers, through the cache."""
        got = self.old.pop(piece, None)
        if got is None:
            got = np.array(self.merge(piece.encode("utf-8", "replace")), dtype="<u4").tobytes()
        if len(self.young) >= CACHED_PIECES:
            self.old, self.young = self.young, {}
        self.young[piece] = got
        return got

    def _pieces(self, text: str, starts: np.ndarray) -> list[bytes]:
        at = starts.tolist()
        found = list(map(self.young.get, cut := [text[a:b] for a, b in zip(at, at[1:] + [len(text)])]))
        for i, x in enumerate(found):
            if x is None:
                piece = cut[i]
                found[i] = self.young.get(piece) or self._packed(piece)
        return found

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        ends = np.cumsum(sizes)
        joined = "".join(texts)
        if len(joined) > WINDOW and len(texts) == 1:
            return [self._encode_long(texts[0])]
        points = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)
        heads = np.unique((ends - sizes)[sizes > 0])
        starts = np.flatnonzero(token_starts(points, heads))
        found = self._pieces(joined, starts)
        cuts = np.searchsorted(starts, ends).tolist()
        return [b"".join(found[a:b]) for a, b in zip([0] + cuts, cuts)]

    def _encode_long(self, text: str) -> bytes:
        out, at, width = [], 0, WINDOW
        while at < len(text):
            window = text[at:at + width]
            points = np.frombuffer(window.encode("utf-32-le", "replace"), dtype=np.uint32)
            starts = np.flatnonzero(token_starts(points, np.array([0])))
            if at + width < len(text):
                # what follows the window may change its last classes
                starts = starts[starts < len(window) - 4]
                if len(starts) < 2:
                    width *= 2
                    continue
                out += self._pieces(window[:starts[-1]], starts[:-1])
                at, width = at + int(starts[-1]), WINDOW
            else:
                out += self._pieces(window, starts)
                at = len(text)
        return b"".join(out)

    def token_offsets(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset of each token in the text's UTF-8."""
        sizes = self.offsets[ids + 1] - self.offsets[ids]
        return np.cumsum(sizes) - sizes

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens, gathered by offset, a bounded run at a time."""
        out = []
        for a in range(0, len(ids), WINDOW // 4):
            part = ids[a:a + WINDOW // 4].astype(np.int64)
            starts = self.offsets[part]
            sizes = self.offsets[part + 1] - starts
            placed = np.cumsum(sizes) - sizes
            out.append(self.blob[np.arange(int(sizes.sum())) + np.repeat(starts - placed, sizes)].tobytes())
        return b"".join(out)


@functools.cache
def tokenizer(vocabulary: str) -> Tokenizer:
    """One tokenizer a process; ``vocabulary`` is a path or the name of a public
    tokenizer's file."""
    if "/" not in vocabulary:
        import public_tokenizers
        vocabulary = public_tokenizers.path(vocabulary)
    return Tokenizer(vocabulary)


def read_texts(column: pa.Array) -> list[str]:
    """Texts of a binary column, null as empty."""
    return ["" if b is None else b.decode("utf-8", "replace") for b in column.to_pylist()]


def _encoded(batches: Iterator[pa.RecordBatch], text: str, vocabulary: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows of bounded size with their ids."""
    own = tokenizer(vocabulary)
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        column = column.cast(pa.binary())
        for a, b in slices(column, WINDOW):
            yield batch.slice(a, b - a), own.encode_texts(read_texts(column.slice(a, b - a)))


def encode(df: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, offsets: bool = True) -> DataFrame:
    """``df`` without the text, with ``ids`` and, if asked for, each token's byte
    ``offsets`` (replacing columns of these names)."""
    keep = [c for c in df.columns if c not in (text, "ids", "offsets")]
    schema = T.StructType([df.schema[c] for c in keep]).add("ids", T.ArrayType(T.IntegerType()))
    if offsets:
        schema = schema.add("offsets", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(vocabulary)
        for rows, packed in _encoded(batches, text, vocabulary):
            ids = [np.frombuffer(p, dtype="<u4").astype(np.int32) for p in packed]
            columns = [rows.column(rows.schema.get_field_index(c)) for c in keep]
            columns.append(pa.array(ids, pa.list_(pa.int32())))
            if offsets:
                columns.append(pa.array([own.token_offsets(i) for i in ids], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return map_arrow(df.select(*keep, text), run, schema)


def decode(df: DataFrame, ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """``df`` with the ``bytes`` its ids stand for (a null list: empty)."""
    keep = [c for c in df.columns if c != "bytes"]
    schema = T.StructType([df.schema[c] for c in keep]).add("bytes", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(vocabulary)
        for rows in batches:
            lists = rows.column(rows.schema.get_field_index(ids)).to_pylist()
            out = pa.array([own.decode(np.array(x or [], dtype=np.int64)) for x in lists], pa.binary())
            yield pa.RecordBatch.from_arrays([*rows.columns, out], names=[*keep, "bytes"])

    return map_arrow(df.select(*keep), run, schema)


def digests(df: DataFrame, text: str = "text", ident: str = "doc_id", vocabulary: str = VOCABULARY) -> DataFrame:
    """Number of tokens, digest of the ids and digest of the decoded bytes."""
    schema = T.StructType([df.schema[ident]]).add("n_tokens", T.LongType()) \
        .add("ids_sha256", T.StringType()).add("decoded_sha256", T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(vocabulary)
        for rows, packed in _encoded(batches, text, vocabulary):
            decoded = [own.decode(np.frombuffer(p, dtype="<u4")) for p in packed]
            yield pa.RecordBatch.from_arrays([
                rows.column(0), pa.array([len(p) // 4 for p in packed], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                pa.array([hashlib.sha256(d).hexdigest() for d in decoded])],
                names=[ident, "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(df.select(ident, text), run, schema)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of tokens, and the digests of its ids and of the
    bytes they decode to."""
    return digests(table(spark, sf_dir, "documents"))
