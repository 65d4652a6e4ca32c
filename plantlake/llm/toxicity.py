"""Toxicity from two class-conditional Kneser-Ney character models with shared backoff counts.

Both models predict the characters of a word from up to four before them.  Their highest order is counted for each class
(toxic, ordinary); every lower order is one shared Kneser-Ney table of continuation counts over both classes, so an
expression that is rare in one class falls back to the same smoothed estimate as in the other and only real evidence
separates them.  All counts come from all labelled training rows, aggregated by Spark; the rows of the calibration are
counted apart as well, so that they can be taken off again.

For scoring, what is left of both models is the log-likelihood ratio of each seen n-gram and the ratio of the two
backoff weights of each context (the shared part cancels for unseen n-grams).  Every ratio is kept, under a 64-bit key of
its characters.  Up to ``HELD_RATIOS`` of them are broadcast as sorted arrays; more stay a Spark table, and the distinct
words of the texts are scored by joining their n-grams with it.  A text is described by its
length-normalised difference of log-likelihoods and by that of its most telling words, and a logistic calibration turns
these into a score.  It is fitted on a bounded sample of training rows, described by models without the counts of these
rows; texts are then scored by the models of all training rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import PerWorker, checkpoint, fresh, packed, part_count, per_batch
from .wordhash import mix

ORDER = 5
DISCOUNT = 0.75
HELD_RATIOS = 1 << 21  # ratios that are broadcast, at most; with more, words are scored by a join
CALIBRATION_ROWS = 20_000  # labelled rows that fit the calibration, at most
THRESHOLD = 0.3
CACHE_WORDS = 100_000
TELLING = 3.0  # nats by which a word must favour the toxic model to be counted as telling

_find_words = re.compile(r"[^\W_]+").findall
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], dtype=np.uint64)


def held_out(doc_id: Column) -> Column:
    """Rows kept for evaluation: crc32 of the id as text, modulo 4, is 2.  A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def text_words(text: str) -> list[str]:
    return _find_words(text.lower())


def grams(ws: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ``ORDER`` code points that end at each character of each word (its end included), one row each, and the number
    of rows of each word."""
    pad = "\x02" * (ORDER - 1)
    joined = "".join([f"{pad}{w}\x03" for w in ws])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.array([len(w) + 1 for w in ws], dtype=np.int64)
    padded = lengths + ORDER - 1
    at = np.arange(len(codes)) - np.repeat(np.cumsum(padded) - padded, padded)
    ends = np.flatnonzero(at >= ORDER - 1)
    return codes[ends[:, None] + np.arange(1 - ORDER, 1)], lengths


def gram_keys(codes: np.ndarray) -> np.ndarray:
    """A 64-bit key of each row of code points."""
    key = np.full(len(codes), codes.shape[1], dtype=np.uint64)
    for k in range(codes.shape[1]):
        key = mix(key + (codes[:, k].astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[k])
    return key


def gram_codes(column: pa.Array) -> np.ndarray:
    """The code points of equally long strings."""
    joined = "".join(column.to_pylist()).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, dtype=np.uint32).reshape(len(column), -1)


COUNTS = ("n0", "n1", "s0", "s1")  # of each class: in all training rows, in those of the calibration


def word_counts(df: DataFrame) -> DataFrame:
    """(text, toxic, apart) rows -> word and ``COUNTS``: how often each class has the word, summed in each batch first."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        totals = [Counter() for _ in COUNTS]
        for text, toxic, apart in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "apart")), strict=True):
            ws = text_words(text)
            totals[toxic].update(ws)
            if apart:
                totals[2 + toxic].update(ws)
        every = list(totals[0].keys() | totals[1].keys())
        return pa.RecordBatch.from_arrays([pa.array(every, pa.string()), *(pa.array([t[w] for w in every], pa.int64()) for t in totals)], names=["word", *COUNTS])

    counted = df.select("text", "toxic", "apart").mapInArrow(per_batch(run), "word string, n0 bigint, n1 bigint, s0 bigint, s1 bigint")
    return counted.groupBy("word").agg(*(F.sum(c).alias(c) for c in COUNTS))


def gram_counts(counted: DataFrame) -> DataFrame:
    """Words and ``COUNTS`` -> gram and ``COUNTS``: ``ORDER`` characters each, summed in each batch first."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, lengths = grams(batch.column("word").to_pylist())
        _, first, inverse = np.unique(gram_keys(codes), return_index=True, return_inverse=True)
        text = codes[first].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        sums = [np.bincount(inverse, np.repeat(batch.column(c).to_numpy(), lengths), len(first)).astype(np.int64) for c in COUNTS]
        names = [text[i : i + ORDER] for i in range(0, len(text), ORDER)]
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *map(pa.array, sums)], names=["gram", *COUNTS])

    counted = counted.mapInArrow(per_batch(run), "gram string, n0 bigint, n1 bigint, s0 bigint, s1 bigint")
    return counted.groupBy("gram").agg(*(F.sum(c).alias(c) for c in COUNTS))


def train(top: DataFrame, parts: int | None = None) -> DataFrame:
    """(gram, n0, n1) -> key, value: the ratios that scoring needs, of n-grams and (one character shorter) contexts.

    A key is the 64 bits of ``gram_keys``, which tell the two lengths apart."""
    tail = lambda k: F.substring("gram", -k, k)  # noqa: E731  the last k characters
    context = F.expr("substring(gram, 1, length(gram) - 1)")
    types = top.select(tail(ORDER - 1).alias("gram")).groupBy("gram").agg(F.count("*").alias("t"))
    levels = {ORDER - 1: types}  # continuation counts: distinct characters seen before each shorter n-gram
    for k in range(ORDER - 2, 0, -1):
        levels[k] = levels[k + 1].select(tail(k).alias("gram")).groupBy("gram").agg(F.count("*").alias("t"))
    total = levels[1].agg(F.sum("t").alias("s"), F.count("*").alias("n")).first()
    s, n = float(total["s"] or 1), float((total["n"] or 0) + 1)
    shared = levels[1].select("gram", ((F.col("t") - F.lit(DISCOUNT)) / s + F.lit(DISCOUNT * (n - 1) / s / n)).alias("p"))
    own = Window.partitionBy("context")

    def with_backoff(level: DataFrame, k: int) -> DataFrame:
        lower = shared.withColumnRenamed("gram", "shorter")
        return level.withColumn("context", context).withColumn("shorter", tail(k - 1)).join(lower, "shorter")

    for k in range(2, ORDER):
        level = with_backoff(levels[k], k).withColumn("all", F.sum("t").over(own)).withColumn("kinds", F.count("*").over(own))
        p = (F.col("t") - DISCOUNT) / F.col("all") + DISCOUNT * F.col("kinds") / F.col("all") * F.col("p")
        shared = level.select("gram", p.alias("p"))
    level = with_backoff(top, ORDER)
    for c in ("0", "1"):
        seen = F.col(f"n{c}") > 0
        level = level.withColumn(f"all{c}", F.sum(f"n{c}").over(own)).withColumn(f"kinds{c}", F.sum(seen.cast("int")).over(own))
        weight = F.when(F.col(f"all{c}") > 0, DISCOUNT * F.col(f"kinds{c}") / F.col(f"all{c}")).otherwise(1.0)
        own_part = F.when(seen, (F.col(f"n{c}") - DISCOUNT) / F.col(f"all{c}")).otherwise(0.0)
        level = level.withColumn(f"w{c}", weight).withColumn(f"p{c}", own_part + weight * F.col("p"))
    level = checkpoint(level.select("gram", "context", F.log(F.col("p1") / F.col("p0")).cast("float").alias("r"), F.log(F.col("w1") / F.col("w0")).cast("float").alias("b")), parts)
    contexts = level.groupBy("context").agg(F.first("b").alias("value"))
    named = level.select("gram", F.col("r").alias("value")).unionByName(contexts.select(F.col("context").alias("gram"), "value"))
    return checkpoint(named.mapInArrow(per_batch(_keyed), "key bigint, value float"), parts)


def _keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
    lengths = pa.compute.utf8_length(batch.column("gram")).to_numpy()
    keys = np.zeros(batch.num_rows, dtype=np.uint64)
    for length in (ORDER, ORDER - 1):
        own = lengths == length
        if own.any():
            keys[own] = gram_keys(gram_codes(batch.column("gram").filter(pa.array(own))))
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column("value")], names=["key", "value"])


@dataclass
class Ratios:
    """All ratios, of n-grams and of contexts, in the order of their keys."""

    keys: np.ndarray
    values: np.ndarray

    def _look(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key; NaN where there is none."""
        if not len(self.keys):
            return np.full(len(keys), np.nan)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at].astype(np.float64), np.nan)

    def words(self, ws: list[str]) -> np.ndarray:
        """Log-likelihood ratio (toxic to ordinary, in nats) of each word."""
        codes, lengths = grams(ws)
        seen = self._look(gram_keys(codes))
        unseen = np.nan_to_num(self._look(gram_keys(codes[:, :-1])), nan=0.0)
        return np.add.reduceat(np.where(np.isnan(seen), unseen, seen), np.cumsum(lengths) - lengths)


def tables(ratios: DataFrame) -> Ratios | DataFrame:
    """The ratios in memory, or as they are if there are more than ``HELD_RATIOS``."""
    if ratios.count() > HELD_RATIOS:
        return ratios
    got = ratios.toArrow()
    keys = got["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return Ratios(keys[order], got["value"].to_numpy()[order])


FEATURES = 5


def describe(r: np.ndarray, chars: int) -> tuple[float, ...]:
    """The features of a text of ``chars`` characters with these ratios of its words."""
    r = np.sort(r)
    telling = r[r > TELLING]
    return r.sum() / chars, max(r[-1], 0.0), max(r[-3:].sum(), 0.0), np.log1p(len(telling)), telling.sum() / chars


class Scorer:
    """Word ratios with a bounded cache, and the features of texts."""

    def __init__(self, ratios: Ratios) -> None:
        self.ratios = ratios
        self.cache: dict[str, float] = {}

    def features(self, texts: list[str]) -> np.ndarray:
        split = [text_words(t) for t in texts]
        new = list({w for ws in split for w in ws}.difference(self.cache))
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache = {}
            new = list({w for ws in split for w in ws})
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            self.cache.update(zip(part, self.ratios.words(part).tolist(), strict=True))
        out = np.zeros((len(texts), FEATURES))
        known = self.cache.__getitem__
        for i, ws in enumerate(split):
            if not ws:
                continue
            out[i] = describe(np.array(list(map(known, ws))), len(texts[i]))
        return out


def _slices(texts: list[str], size: int = 2 << 20) -> Iterator[list[str]]:
    """Runs of texts of about ``size`` characters."""
    part, chars = [], 0
    for t in texts:
        part.append(t)
        chars += len(t)
        if chars >= size:
            yield part
            part, chars = [], 0
    if part:
        yield part


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton's method on standardised features; (weights with the intercept last, means, scales)."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    penalty = np.diag([ridge * len(x)] * x.shape[1] + [1e-6]) / 100
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + penalty + 1e-9 * np.eye(len(w)), z.T @ (y - p) - penalty @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


@dataclass
class ToxicityModel:
    ratios: Ratios | DataFrame | None
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        z = np.hstack([(features - self.mean) / self.scale, np.ones((len(features), 1))])
        return 1 / (1 + np.exp(-np.clip(z @ self.weights, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Train on the labelled rows that are not held out.  All of them count for the language models.  The calibration is
    fitted on a quarter of them (a sample of at most ``CALIBRATION_ROWS`` by a hash of the id), described by models
    without the counts of the sample.

    Null labels and ids are left out; an id with several labels counts as toxic if one of them is.  Null texts are
    empty.  Without labelled rows every score is 0.5; with one class only, its share is the score.
    """
    usable = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).cast("long").alias("__id"))
        .agg(F.max(F.col(label).cast("int")).alias("toxic"))
    )
    fold = F.pmod(F.xxhash64("__id"), F.lit(4)) == 0
    parts = part_count(docs, text)
    sample = checkpoint(usable.where(fold).orderBy(F.xxhash64("__id", F.lit(7)), "__id").limit(CALIBRATION_ROWS), parts)
    texts = docs.select(F.col(id_col).cast("long").alias("__id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    apart = F.broadcast(sample.select("__id", F.lit(True).alias("apart")))
    labelled = texts.where(~held_out(F.col("__id"))).join(usable.hint("merge"), "__id").join(apart, "__id", "left")
    top = checkpoint(gram_counts(word_counts(labelled.withColumn("apart", F.coalesce("apart", F.lit(False))))), parts)
    ratios = tables(train(top.select("gram", "n0", "n1"), parts))
    rest = top.select("gram", (F.col("n0") - F.col("s0")).alias("n0"), (F.col("n1") - F.col("s1")).alias("n1")).where("n0 + n1 > 0")
    scored = _features(texts.join(F.broadcast(sample), "__id").select("toxic", "text"), tables(train(rest, parts))).toArrow()
    x = np.array([scored[f"f{i}"].to_numpy() for i in range(FEATURES)]).T.reshape(-1, FEATURES)
    y = scored["toxic"].to_numpy().astype(float)
    if not len(y):
        return ToxicityModel(ratios, np.zeros(FEATURES + 1), np.zeros(FEATURES), np.ones(FEATURES))
    order = np.lexsort([*x.T, y])  # the fit must not depend on the order in which rows arrive
    return ToxicityModel(ratios, *fit_logistic(x[order], y[order]))


_FEATURE_FIELDS = ", ".join(f"f{i} double" for i in range(FEATURES))


def _feature_columns(x: np.ndarray) -> list[pa.Array]:
    return [pa.array(x[:, i]) for i in range(FEATURES)]


def _features(df: DataFrame, ratios: Ratios | DataFrame) -> DataFrame:
    """(toxic, text) -> toxic, f0 .. f4."""
    if isinstance(ratios, DataFrame):
        return _with_features(df, "text", ratios).select("toxic", *(F.coalesce(f"__f.f{i}", F.lit(0.0)).alias(f"f{i}") for i in range(FEATURES)))
    shared = df.sparkSession.sparkContext.broadcast(PerWorker(Scorer, ratios))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scorer = shared.value.get()
        x = np.vstack([scorer.features(part) for part in _slices(batch.column("text").to_pylist())])
        return pa.RecordBatch.from_arrays([batch.column("toxic"), *_feature_columns(x)], names=["toxic", *(f"f{i}" for i in range(FEATURES))])

    return df.mapInArrow(per_batch(run), f"toxic int, {_FEATURE_FIELDS}")


def _word_ratios(ws: DataFrame, ratios: DataFrame) -> DataFrame:
    """word -> word, r: as ``Ratios.words``, by joins of the words' n-grams and contexts with the table of ratios."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, lengths = grams(batch.column("word").to_pylist())
        names = batch.column("word").take(pa.array(np.repeat(np.arange(batch.num_rows), lengths)))
        at = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        keys = [pa.array(gram_keys(c).view(np.int64)) for c in (codes, codes[:, :-1])]
        return pa.RecordBatch.from_arrays([names, pa.array(at), *keys], names=["word", "at", "gram", "context"])

    parts = ws.mapInArrow(per_batch(run), "word string, at bigint, gram bigint, context bigint")
    for c in ("gram", "context"):
        parts = parts.join(ratios.select(F.col("key").alias(c), F.col("value").cast("double").alias(f"of_{c}")), c, "left")
    part = F.struct("at", F.coalesce("of_gram", "of_context", F.lit(0.0)).alias("r"))
    whole = parts.groupBy("word").agg(F.array_sort(F.collect_list(part)).alias("w"))
    return whole.select("word", F.aggregate("w", F.lit(0.0), lambda acc, x: acc + x["r"]).alias("r"))


def _with_features(df: DataFrame, text: str, ratios: DataFrame) -> DataFrame:
    """``df`` with the features of its texts in the struct ``__f`` (null without words), no ratio leaving its partition.

    128 bits and the length stand for a text; texts that repeat each other are described once.
    """
    whole = F.col(f"`{text}`")
    key = F.struct(F.xxhash64(F.lit("score"), whole).alias("a"), F.xxhash64(F.lit("text"), whole).alias("b"), F.length(whole).alias("size"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, ws, n = [], [], []
        for i, t in enumerate(batch.column("text").to_pylist()):
            found = Counter(text_words(t))
            rows += [i] * len(found)
            ws += found.keys()
            n += found.values()
        keys = batch.column("key").take(pa.array(rows, pa.int64()))
        return pa.RecordBatch.from_arrays([keys, pa.array(ws, pa.string()), pa.array(n, pa.int64())], names=["key", "word", "n"])

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.zeros((batch.num_rows, FEATURES))
        for i, (size, ws) in enumerate(zip(batch.column("size").to_pylist(), batch.column("ws").to_pylist(), strict=True)):
            x[i] = describe(np.repeat([w["r"] for w in ws], [w["n"] for w in ws]), size)
        return pa.RecordBatch.from_arrays([batch.column("key"), *_feature_columns(x)], names=["key", *(f"f{i}" for i in range(FEATURES))])

    kind = "key struct<a: bigint, b: bigint, size: int>"
    pairs = df.select(key.alias("key"), whole.alias("text")).mapInArrow(per_batch(run), f"{kind}, word string, n bigint")
    pairs = checkpoint(pairs.groupBy("key", "word").agg(F.max("n").alias("n")))
    scored = pairs.join(_word_ratios(pairs.select("word").distinct(), ratios), "word")
    described = scored.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("r", "n"))).alias("ws")).select("key", "key.size", "ws")
    described = described.mapInArrow(per_batch(features), f"{kind}, {_FEATURE_FIELDS}")
    found = described.select(F.col("key").alias("__of"), F.struct(*(f"f{i}" for i in range(FEATURES))).alias("__f"))
    return df.select("*", key.alias("__of")).join(found, "__of", "left").drop("__of")


def score(df: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with a score from 0 to 1 for the whole of each text; a null text counts as empty."""
    probabilities = replace(model, ratios=None).probabilities  # the tables go out once, in the broadcast
    names = [c for c in df.columns if c != out]
    hidden = fresh(df, "__score")
    source = df.select(*[F.col(f"`{c}`") for c in names], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias(hidden))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name != hidden]
    if isinstance(model.ratios, DataFrame):
        packed_rows = source.select(packed(source, names).alias("rest"), F.col(hidden).alias("text"))
        found = _with_features(packed_rows, "text", model.ratios)
        x = [F.coalesce(f"__f.f{i}", F.lit(0.0)) for i in range(FEATURES)]
        # the logistic of ``ToxicityModel.probabilities``, as a column
        z = sum(((c - F.lit(float(m))) / F.lit(float(s)) * F.lit(float(w)) for c, m, s, w in zip(x, model.mean, model.scale, model.weights[:-1], strict=True)), F.lit(float(model.weights[-1])))
        p = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
        return found.select(*[F.col(f"rest.`{c}`").alias(c) for c in names], p.alias(out))
    shared = df.sparkSession.sparkContext.broadcast(PerWorker(Scorer, model.ratios))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scorer = shared.value.get()
        p = np.concatenate([probabilities(scorer.features(part)) for part in _slices(batch.column(hidden).to_pylist())])
        kept = [batch.column(c) for c in batch.schema.names if c != hidden]
        return pa.RecordBatch.from_arrays([*kept, pa.array(p)], names=[*names, out])

    return source.mapInArrow(per_batch(run), ", ".join([*fields, f"`{out}` double"]))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Score every row of ``docs``: id, held_out, score, predicted (1 from ``THRESHOLD`` on)."""
    model = fit(docs, labels, id_col, text)
    scored = score(docs.select(F.col(id_col), F.col(text).alias("__t")), model, "__t", "__p")
    return scored.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), F.col("__p").alias("score"), (F.col("__p") >= THRESHOLD).cast("int").alias("predicted"))
