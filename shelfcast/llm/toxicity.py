"""Toxicity by subword bags.

A text is cut into words (runs of letters, marks and digits, lower-cased). The
vector of a word is the mean of the embeddings of its character n-grams, three
to five long with the word's ends marked, hashed into buckets, so that a word
never seen, or a misspelt one, shares most vectors with its relatives. The
vectors of a window of words are averaged (shorter texts as if padded with null
vectors) and a linear softmax tells toxic from clean. Embeddings and softmax
are trained jointly, by Adagrad in numpy. One toxic word in a long text would
vanish in an average over all of it, hence windows: the most toxic window makes
the text's score. Training follows that: after a start on random windows, each
round takes the window a toxic text now scores highest in, and for clean texts
their highest and a random one. A logistic curve over the windows' best logits,
fitted with the labels' class shares restored, turns it into a probability.

The model is fit on a bounded sample of labelled rows of every length: at most
``FIT_ROWS`` a class, those of the smallest hash. Of these the first that hold
``FIT_CHARS`` characters together are trained on (a single text of more isn't);
the curve is fitted on all of them, whole texts scored in tasks, since a text's
highest window rises with its length. Scoring covers all rows and whole texts. As the model is linear after the embedding, a
worker needs one number a bucket (a megabyte).

Defined cases: null and empty texts score what a text without known words does;
without labels of both classes the score is the share of toxic labels (0
without labels). Repeated rows score alike.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.bpe import read_texts
from shelfcast.llm.common import map_arrow, slices, table

BUCKETS = 1 << 18
NGRAMS = (3, 4, 5)
DIMENSIONS = 8
WINDOW_WORDS = 8
FIT_ROWS = 2000       # a class
FIT_CHARS = 5_000_000 # a class, all its texts together
ROUNDS = (3, 9)       # on random windows, on the highest windows
BATCH = 1 << 20
_FACTORS = np.random.default_rng(41).integers(1, 1 << 32, max(NGRAMS), dtype=np.uint32) | np.uint32(1)


@functools.cache
def word_points() -> np.ndarray:
    """Whether a code point is part of words: letters, marks and numbers."""
    return np.array([unicodedata.category(chr(c))[0] in "LMN" for c in range(sys.maxunicode + 1)])


@dataclass
class Grams:
    """Buckets of the n-grams of some texts, the word of each, and the number of
    words before each text."""

    buckets: np.ndarray
    words: np.ndarray
    cuts: np.ndarray

    def word_scores(self, of_bucket: np.ndarray) -> np.ndarray:
        n = int(self.cuts[-1])
        total = np.bincount(self.words, weights=of_bucket[self.buckets], minlength=n)
        return total / np.maximum(np.bincount(self.words, minlength=n), 1)

    def best(self, of_bucket: np.ndarray) -> np.ndarray:
        """Highest window of each text; 0 for a text without words."""
        out = np.zeros(len(self.cuts) - 1)
        filled = np.flatnonzero(np.diff(self.cuts))
        if len(filled):
            out[filled] = np.maximum.reduceat(window_scores(self.word_scores(of_bucket), self.cuts), self.cuts[filled])
        return out


def window_scores(words: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Mean over the window that ends at each word and stays in its text."""
    sums = np.concatenate([[0.0], np.cumsum(words)])
    at = np.arange(1, len(sums))
    first = np.repeat(cuts[:-1], np.diff(cuts))
    return (sums[at] - sums[np.maximum(first, at - WINDOW_WORDS)]) / WINDOW_WORDS


def grams_of(texts: list[str]) -> Grams:
    """All texts laid end to end, every run of other characters as one mark."""
    lowered = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), dtype=np.uint32)
    inside = word_points()[points]
    keep = inside.copy()
    keep[1:] |= inside[:-1]          # the mark after a word; the first mark opens the first word
    keep[:1] = True
    ends = np.cumsum([len(t) for t in lowered])
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    before = np.concatenate([[0], np.cumsum(opens)])
    cuts = before[np.concatenate([[0], ends])]
    points, inside = np.where(inside, points, np.uint32(32))[keep], inside[keep]
    word = np.cumsum(inside & ~np.concatenate([[False], inside[:-1]])) - 1
    buckets, words = [], []
    for n in NGRAMS:
        m = len(points) - n + 1
        if m <= 0:
            continue
        ok = inside[1:m + 1].copy()
        mixed = points[:m] * _FACTORS[0]
        for j in range(1, n):
            mixed = mixed + points[j:m + j] * _FACTORS[j]
            if 1 < j < n - 1:
                ok &= inside[j:m + j]
        at = np.flatnonzero(ok)
        mixed = (mixed[at] ^ (mixed[at] >> np.uint32(15))) * np.uint32(2654435769) + np.uint32(n)
        buckets.append(mixed >> np.uint32(32 - 18))
        words.append(word[at + 1])
    if not buckets:
        return Grams(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), cuts)
    return Grams(np.concatenate(buckets).astype(np.int64), np.concatenate(words), cuts)


@dataclass
class Model:
    """Embedding a bucket, softmax weights, and the curve over best logits."""

    embedding: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def of_bucket(self) -> np.ndarray:
        return (self.embedding @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float32)

    def probability(self, best: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * best + self.offset, -40, 40)))


def constant(share: float) -> Model:
    share = min(max(share, 1e-9), 1 - 1e-9)
    return Model(np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32), np.zeros((DIMENSIONS, 2)), 0.0,
                 float(np.log(share / (1 - share))))


def _by_word(texts: list[str], run: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all texts in the order of words, where each word's begin, and
    where each text's words begin; put together from runs of texts, four bytes
    an n-gram. The runs are laid into one array: it is sized by the most n-grams
    the texts can have, and what isn't filled takes no memory."""
    grams = np.empty(len(NGRAMS) * sum(len(t.lower()) + 2 for t in texts), dtype=np.int32)
    held, sizes, cuts = 0, [], [np.zeros(1, dtype=np.int64)]
    for a in range(0, len(texts), run):
        part = grams_of(texts[a:a + run])
        grams[held:held + len(part.buckets)] = part.buckets[np.argsort(part.words, kind="stable")]
        held += len(part.buckets)
        sizes.append(np.bincount(part.words, minlength=int(part.cuts[-1])))
        cuts.append(part.cuts[1:] + cuts[-1][-1])
    starts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1, dtype=np.int64)
    return grams[:held], starts, np.concatenate(cuts)


def _word_scores(grams: np.ndarray, starts: np.ndarray, of_bucket: np.ndarray, run: int = 1 << 16) -> np.ndarray:
    """Mean of the buckets' values by word (every word has an n-gram)."""
    out = np.zeros(len(starts) - 1)
    for a in range(0, len(out), run):
        b = min(a + run, len(out))
        values = of_bucket[grams[starts[a]:starts[b]]]
        out[a:b] = np.add.reduceat(values, starts[a:b] - starts[a]) / np.diff(starts[a:b + 1])
    return out


def fit(texts: list[str], toxic: np.ndarray, share: float, seed: int = 5) -> Model:
    """Train on texts with labels 0 and 1; ``share``: of toxic labels among all."""
    rng = np.random.default_rng(seed)
    grams, starts, cuts = _by_word(texts)
    has = np.flatnonzero(np.diff(cuts))
    first, past = cuts[:-1][has], cuts[1:][has]
    label = toxic[has].astype(np.int64)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    weights = rng.normal(0, 0.5, (DIMENSIONS, 2))
    bias = np.zeros(2)
    steps = [np.full(embedding.shape[0], 1e-6), np.full(weights.shape, 1e-6), np.full(2, 1e-6)]
    balance = len(label) / (2 * np.maximum(np.bincount(label, minlength=2), 1))

    def random_ends() -> np.ndarray:
        return rng.integers(first, past)

    def highest_ends() -> np.ndarray:
        scores = window_scores(_word_scores(grams, starts, embedding @ (weights[:, 1] - weights[:, 0])), cuts)
        return np.array([a + int(np.argmax(scores[a:b])) for a, b in zip(first, past)])

    def learn(ends: np.ndarray, y: np.ndarray, begin: np.ndarray) -> None:
        order = rng.permutation(len(ends))
        for part in np.array_split(order, max(1, len(order) // 256)):
            a = np.maximum(begin[part], ends[part] - WINDOW_WORDS + 1)
            words = np.concatenate([np.arange(i, j + 1) for i, j in zip(a, ends[part])])
            window = np.repeat(np.arange(len(part)), ends[part] - a + 1)
            sizes = starts[words + 1] - starts[words]
            at = np.concatenate([grams[starts[w]:starts[w + 1]] for w in words])
            share_of = np.repeat(1.0 / (np.maximum(sizes, 1) * WINDOW_WORDS), sizes)
            of = np.repeat(window, sizes)
            held = np.zeros((len(part), DIMENSIONS))
            for d in range(DIMENSIONS):
                held[:, d] = np.bincount(of, weights=embedding[at, d] * share_of, minlength=len(part))
            z = held @ weights + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            p *= balance[y[part]][:, None]
            to_weights, to_bias, to_held = held.T @ p, p.sum(0), p @ weights.T
            used, place = np.unique(at, return_inverse=True)
            grad = np.zeros((len(used), DIMENSIONS))
            for d in range(DIMENSIONS):
                grad[:, d] = np.bincount(place, weights=to_held[of, d] * share_of, minlength=len(used))
            steps[0][used] += (grad ** 2).mean(1)
            embedding[used] -= 0.3 * grad / np.sqrt(steps[0][used])[:, None]
            for value, g, held_step in ((weights, to_weights, steps[1]), (bias, to_bias, steps[2])):
                held_step += g ** 2
                value -= 0.1 * g / np.sqrt(held_step)

    early, late = ROUNDS
    for _ in range(early):
        ends = np.concatenate([random_ends() for _ in range(6)])
        learn(ends, np.tile(label, 6), np.tile(first, 6))
    for _ in range(late):
        high, clean = highest_ends(), label == 0
        learn(np.concatenate([high, random_ends()[clean]]), np.concatenate([label, label[clean]]),
              np.concatenate([first, first[clean]]))
    model = Model(embedding.astype(np.float32), weights, 1.0, 0.0)
    best = np.zeros(len(texts))
    if len(has):
        best[has] = np.maximum.reduceat(window_scores(_word_scores(grams, starts, model.of_bucket()), cuts), first)
    model.slope, model.offset = _curve(best, toxic, share)
    return model


def _curve(best: np.ndarray, toxic: np.ndarray, share: float) -> tuple[float, float]:
    """Logistic regression on one number, classes weighted to ``share``."""
    scale = max(float(best.std()), 1e-9)
    x = np.stack([best / scale, np.ones(len(best))], 1)
    counts = np.maximum(np.bincount(toxic, minlength=2), 1)
    weight = np.where(toxic == 1, share / counts[1], (1 - share) / counts[0])
    theta = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (weight * (p - toxic)) + 1e-4 * theta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        theta -= np.linalg.solve(hess, grad)
    return float(theta[0] / scale), float(theta[1])


def held_out(ident: str):
    return F.pmod(F.crc32(F.col(ident).cast("string").cast("binary")), F.lit(5)) == 0


def fit_rows(docs: DataFrame, labels: DataFrame, text: str = "text", ident: str = "doc_id") -> tuple[Model, float]:
    """Fit on the bounded sample of labelled rows that aren't held out."""
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col(ident).isNotNull() & ~held_out(ident))
             .groupBy(ident).agg(F.max("toxic").alias("_toxic")))
    counts = {r[0]: r[1] for r in known.groupBy("_toxic").agg(F.count("*")).collect()}   # two rows
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if len(counts) < 2:
        return constant(share), share
    # identifiers are chosen without their texts; only the chosen rows' texts move
    texts = docs.where(F.col(text).isNotNull())
    named = texts.groupBy(ident).agg(F.max(F.length(text)).alias("_chars")).join(known, ident)
    chosen, trained = [], []
    for y in (0, 1):
        rows = named.where(F.col("_toxic") == y).orderBy(F.xxhash64(ident, F.lit(29)), ident).limit(FIT_ROWS).collect()
        chosen += rows
        held = 0
        for r in (r for r in rows if r["_chars"] <= FIT_CHARS):
            held += r["_chars"]
            if held > FIT_CHARS:
                break
            trained.append(r)
    if {r["_toxic"] for r in trained} != {0, 1}:
        return constant(share), share

    def sample(rows: list) -> DataFrame:
        few = docs.sparkSession.createDataFrame(rows, named.schema)      # at most FIT_ROWS a class
        return texts.select(ident, text).join(F.broadcast(few), ident).groupBy(ident).agg(
            F.min("_toxic").alias("y"), F.min(text).alias("t"))

    picked = sorted(sample(trained).select("y", "t", ident).collect(), key=lambda r: (r[0], r[2]))
    model = fit([r[1] for r in picked], np.array([r[0] for r in picked], dtype=np.int64), share)
    found = _best_logits(sample(chosen).select("y", "t"), model).collect()
    model.slope, model.offset = _curve(np.array([r["best"] for r in found]), np.array([r["y"] for r in found], dtype=np.int64), share)
    return model, share


def _best_logits(rows: DataFrame, model: Model) -> DataFrame:
    """``(y, best)``: the logit of each text's highest window."""
    sent = rows.sparkSession.sparkContext.broadcast(model.of_bucket())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1).cast(pa.binary())
            for a, b in slices(column, BATCH):
                best = grams_of(read_texts(column.slice(a, b - a))).best(sent.value)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).cast(pa.int32()), pa.array(best, pa.float64())],
                                                 names=["y", "best"])

    return map_arrow(rows.select(F.col("y").cast("int").alias("y"), "t"), run, "y int, best double")


def score(df: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """``df`` without the text, with the score as column ``to`` (replacing one of
    this name)."""
    keep = [c for c in df.columns if c not in (text, to)]
    schema = T.StructType([df.schema[c] for c in keep]).add(to, T.DoubleType())
    sent = df.sparkSession.sparkContext.broadcast((model.of_bucket(), model.slope, model.offset))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_bucket, slope, offset = sent.value
        curve = Model(np.zeros((1, 1)), np.zeros((1, 2)), slope, offset)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            for a, b in slices(column, BATCH):
                best = grams_of(read_texts(column.slice(a, b - a))).best(of_bucket)
                columns = [batch.column(batch.schema.get_field_index(c)).slice(a, b - a) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(curve.probability(best))], names=[*keep, to])

    return map_arrow(df.select(*keep, text), run, schema)


def op10_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score and whether it is predicted toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, _ = fit_rows(docs, table(spark, sf_dir, "labels"))
    return (score(docs, model).withColumn("held_out", F.coalesce(held_out("doc_id"), F.lit(False)))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
            .select("doc_id", "held_out", "score", "predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", ident: str = "doc_id",
               most: float = 0.5) -> DataFrame:
    """The rows scored below ``most``, with the columns of ``docs``."""
    model, _ = fit_rows(docs, labels, text, ident)
    scored = score(docs.withColumn("_tox_text", F.col(text)), model, "_tox_text", "_tox_score")
    return scored.where(F.col("_tox_score") < most).select(*docs.columns)
