"""Language identification by rank-order profiles.

The profile of a language is the list of its most frequent character n-grams,
one to three long, in order. A text's most frequent n-grams are compared with
each profile: the out-of-place distance sums how many places each is away from
its place there, and counts the full length of the profile for one that is
missing. The nearest profile names the language.

N-grams are taken over letters only, lower-cased, with one mark for whatever
lies between words. Profiles count every labelled row that isn't held out:
tasks add up their rows' n-grams before anything is shuffled. What is collected
are the profiles, ``PROFILE`` n-grams a language.

Defined cases: null texts and texts without letters are ``und`` with score 0, as
is everything if no row is labelled; n-grams of equal count are ordered by their
code points, equally near languages by name. Long texts are counted in windows
that end with a word. Extra columns pass through ``predict``; those named like its
results are replaced.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.bpe import read_texts
from shelfcast.llm.common import map_arrow, slices, table

PROFILE = 300
LONGEST = 3
WINDOW = 1 << 20          # characters counted at once
HELD = 1 << 18            # n-grams a task adds up before it sends them on
UNKNOWN = "und"
_MARK = 1                 # stands for what lies between words


@functools.cache
def letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)])


def _keys(points: np.ndarray) -> np.ndarray:
    """All n-grams as 64-bit keys, 21 bits a code point; a mark only at the ends."""
    inside = letters()[points]
    if not inside.any():
        return np.zeros(0, dtype=np.int64)
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    run = np.concatenate([[_MARK], np.where(inside, points, _MARK)[keep], [_MARK]]).astype(np.int64)
    if run[-2] == _MARK:
        run = run[:-1]
    letter = run != _MARK
    out = [run[letter]]
    for n in range(2, LONGEST + 1):
        m = len(run) - n + 1
        if m <= 0:
            break
        key, ok = np.zeros(m, dtype=np.int64), np.ones(m, dtype=bool)
        for j in range(n):
            key = (key << 21) | run[j:m + j]
            if 0 < j < n - 1:
                ok &= letter[j:m + j]
        if n == 2:
            ok = letter[:m] | letter[1:m + 1]
        out.append(key[ok])
    return np.concatenate(out)


def counted(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their sums."""
    if counts is None:
        ordered = np.sort(keys)
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, int)
        return ordered[first], np.diff(np.concatenate([first, [len(ordered)]])).astype(np.int64)
    distinct, place = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(place, weights=counts, minlength=len(distinct)).astype(np.int64)


def windows(text: str) -> Iterator[str]:
    """Parts of a text of ``WINDOW`` characters and up to the end of the word: no
    n-gram goes on over a part's end."""
    at = 0
    while at < len(text):
        end = min(at + WINDOW, len(text))
        while end < len(text) and text[end - 1].isalpha():
            end += 1
        yield text[at:end]
        at = end


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of a text and their counts."""
    text = text.lower()
    parts = [counted(_keys(np.frombuffer(part.encode("utf-32-le", "replace"), dtype=np.uint32))) for part in windows(text)]
    if len(parts) == 1:
        return parts[0]
    if not parts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))


def ranked(keys: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, most frequent first."""
    if len(keys) > 4 * most:
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
    return keys[np.lexsort((keys, -counts))][:most]


def learn(df: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """The profile of each language of the labelled rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                keys, counts = counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys), pa.array(counts)],
                                                 names=["lang", "gram", "n"])

        for batch in batches:
            column = batch.column(0).cast(pa.binary())
            names = np.array(batch.column(1).to_pylist(), dtype=object)
            for a, b in slices(column, WINDOW):
                texts = read_texts(column.slice(a, b - a))
                for name in dict.fromkeys(names[a:b]):
                    # texts of a language end to end, apart by a mark
                    part = grams(" ".join(t for t, own in zip(texts, names[a:b]) if own == name))
                    held[name].append(part)
                    size += len(part[0])
                if size > HELD:
                    for name in held:
                        held[name] = [counted(np.concatenate([p[0] for p in held[name]]),
                                              np.concatenate([p[1] for p in held[name]]))]
                    size = sum(len(p[0][0]) for p in held.values())
                    if size > HELD // 2:
                        yield from sent()
                        held.clear()
                        size = 0
        yield from sent()

    counts = map_arrow(df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(text, lang), run,
                       "lang string, gram long, n long")
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = (counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
           .withColumn("place", F.row_number().over(order)).where(F.col("place") <= PROFILE))
    out: dict[str, list[int]] = defaultdict(list)
    for r in sorted(top.select("lang", "place", "gram").collect()):       # PROFILE rows a language
        out[r[0]].append(r[2])
    return {name: np.array(g, dtype=np.int64) for name, g in sorted(out.items())}


class Profiles:
    """The place of every profile n-gram in every language."""

    def __init__(self, profiles: dict[str, np.ndarray]):
        self.names = list(profiles)
        self.grams = np.unique(np.concatenate(list(profiles.values()))) if profiles else np.zeros(0, dtype=np.int64)
        self.places = np.full((len(self.names), len(self.grams)), PROFILE, dtype=np.int64)
        for i, own in enumerate(profiles.values()):
            self.places[i, np.searchsorted(self.grams, own)] = np.arange(len(own))

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of ranked n-grams to each language, as a share
        of the largest possible."""
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        known = self.grams[at] == own
        place = self.places[:, at]
        off = np.where(known & (place < PROFILE), np.abs(place - np.arange(len(own))), PROFILE)
        return off.sum(1) / (PROFILE * len(own))

    def name(self, text: str) -> tuple[str, float]:
        """The language, and how much nearer it is than all together."""
        keys, counts = grams(text)
        if not len(keys) or not self.names:
            return UNKNOWN, 0.0
        near = 1 - self.distances(ranked(keys, counts))
        best = int(np.argmax(near))
        total = float(near.sum())
        return self.names[best], float(near[best] / total) if total > 0 else 1 / len(self.names)


def predict(df: DataFrame, profiles: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """``df`` without the text, with ``lang_pred`` and ``score``."""
    keep = [c for c in df.columns if c not in (text, "lang_pred", "score")]
    schema = T.StructType([df.schema[c] for c in keep]).add("lang_pred", T.StringType()).add("score", T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Profiles(profiles)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            for a, b in slices(column, WINDOW):
                named = [own.name(t) for t in read_texts(column.slice(a, b - a))]
                kept = [batch.column(batch.schema.get_field_index(c)).slice(a, b - a) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, pa.array([x[0] for x in named], pa.string()),
                                                  pa.array([x[1] for x in named], pa.float64())],
                                                 names=schema.fieldNames())

    return map_arrow(df.select(*keep, text), run, schema)


def held_out(ident: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(ident).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op5_rank_order_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its predicted language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = learn(docs.where(~held_out("doc_id")))
    return predict(docs.select("doc_id", "text"), profiles).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
