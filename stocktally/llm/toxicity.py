"""Toxicity: class-conditional Kneser-Ney models of the letters of words, with shared backoff."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stocktally.llm.common import (
    Shared, Words, bounded_sample, chunks, collected, cut_lineage, fold_of, join_small, mix64, release, text_sizes, with_columns, without,
)

ORDER = 8  # bytes of an n-gram; eight bytes are one exact integer
_D = 0.75  # absolute discount
_FLUSH = 2_000_000  # distinct n-grams a task holds before it hands them on
_WORDS = 500_000  # distinct words a task holds before it hands them on
_UNIT = float(1 << 24)  # ratios are summed as whole numbers of 1 / _UNIT: sums are exact in any order
_LOW = 3  # bytes of the longest n-grams of the small tables
_GROUPS = 200_000  # n-grams a task holds at a time
_CELLS, _STEPS = 1 << 24, 64  # slots of the bounds of n-grams, one byte each; steps of a bound
_SLOTS = 1 << 26  # bits of the filter of words that count, and of that of n-grams, 8 MB each
_DOUBT = 2000.0  # weight of the prior that holds the slopes of all features but the first near 0
_COMMON = 1 << 19  # n-grams whose ratios every worker holds at most, 8 MB
_BUCKET = 32_768  # bits of one bitmap of bitmap_construct_agg


def word_grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams that end at each letter and at the end of every distinct word; the first of each word.

    The history before a word is blank: the code of a word's first letter holds zero bytes before it.
    """
    if not words.distinct:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    raw, starts = words.bytes()
    wide, size = raw.astype(np.uint64), np.diff(starts)  # a word's letters and one zero
    at = np.arange(1, len(raw))
    begin = np.repeat(starts[:-1], size)
    codes = np.zeros(len(at), np.uint64)
    for k in range(ORDER):
        back = at - k
        codes |= np.where(back > begin, wide[np.maximum(back, 0)], 0).astype(np.uint64) << np.uint64(8 * k)
    return codes, starts[:-1]


def gram_counts(labelled: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary) over all rows of (__text, __label). Tasks add up before the shuffle."""

    def run(batches):
        held: list[np.ndarray] = []

        def merged():
            codes, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return np.stack([codes, *[np.bincount(at, np.concatenate([h[k] for h in held]), len(codes)).astype(np.uint64) for k in (1, 2)]])

        def rows(x):
            for a in range(0, x.shape[1], 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 100_000].view(np.int64)) for c in x], ["gram", "toxic", "ordinary"])

        for batch in batches:
            texts = batch.column(0)
            for a, b in chunks(text_sizes(texts)):
                words = Words(texts.slice(a, b - a).to_pylist(), lower=True)
                codes, starts = word_grams(words)
                if not len(codes):
                    continue
                toxic = np.array(batch.column(1).slice(a, b - a).to_pylist(), bool)[words.docs]
                n = np.diff(np.append(starts, len(codes)))
                each = [np.repeat(np.bincount(words.ids[pick], minlength=len(starts)).astype(np.uint64), n) for pick in (toxic, ~toxic)]
                held.append(np.stack([codes, *each]))
                held[:] = [merged()]
                if held[0].shape[1] > _FLUSH:
                    yield from rows(held.pop())
        if held:
            yield from rows(held[0])

    made = labelled.select("__text", (F.col("__label") == 1).alias("__toxic")).mapInArrow(run, "gram long, toxic long, ordinary long")
    return made.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _suffix(width: int) -> Column:
    return F.col("gram").bitwiseAND(F.lit((1 << 8 * width) - 1))


def _lower_orders(counts: DataFrame) -> DataFrame:
    """(suffix, lower): interpolated Kneser-Ney probabilities of the n-grams of _LOW bytes, which count distinct extensions."""
    level = counts.select(_suffix(_LOW + 1).alias("gram")).distinct()
    levels = {}
    for width in range(_LOW, 0, -1):
        level = levels[width] = cut_lineage(level.groupBy(_suffix(width).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "level")
    context = Window.partitionBy(F.shiftrightunsigned("gram", 8))  # at most 256 rows: a context's next bytes
    lower = None
    for width in range(1, _LOW + 1):
        level = levels[width].withColumns({"total": F.sum("n").over(context), "fan": F.count(F.lit(1)).over(context)})
        if lower is None:
            level = level.withColumn("lower", F.lit(1 / 256))
        else:
            level = level.withColumn("suffix", _suffix(width - 1)).join(lower, "suffix")
        p = F.greatest(F.col("n") - _D, F.lit(0.0)) / F.col("total") + _D * F.col("fan") / F.col("total") * F.col("lower")
        lower = level.select(F.col("gram").alias("suffix"), p.alias("lower"))
    return lower


def _pooled(codes: np.ndarray, n: np.ndarray, width: int, low: np.ndarray) -> np.ndarray:
    """Interpolated Kneser-Ney probabilities of n-grams of `width` bytes; `low`: those of their last _LOW bytes."""
    if width == _LOW:
        return low
    suffix, first, to_suffix, kinds = np.unique(codes & np.uint64((1 << 8 * (width - 1)) - 1), return_index=True, return_inverse=True, return_counts=True)
    lower = _pooled(suffix, kinds.astype(np.float64), width - 1, low[first])[to_suffix]
    _, to_context = np.unique(codes >> np.uint64(8), return_inverse=True)
    total, fan = np.bincount(to_context, n), np.bincount(to_context)
    return np.maximum(n - _D, 0) / total[to_context] + (_D * fan / total)[to_context] * lower


def gram_ratios(counts: DataFrame, strength: float) -> DataFrame:
    """(gram, ratio) from (gram, toxic, ordinary): log P(toxic) - log P(ordinary), in whole units."""
    return rated_grams(counts, strength).select("gram", "ratio")


def rated_grams(counts: DataFrame, strength: float) -> DataFrame:
    """gram_ratios with n, the number of times that an n-gram has been counted.

    Each class has an interpolated Kneser-Ney model: its counts are discounted, and what they lose goes to one model of
    the pooled counts, itself Kneser-Ney at all orders, that both share. Both are then drawn to the pooled model by one
    weight for a context, from the class that has seen it less, so that an expression the smaller class has had no
    chance to show is no evidence. n-grams with the same _LOW bytes before the last one lie side by side: their contexts, and their
    suffixes of more than _LOW bytes, are complete there. A task holds some such groups at a time.
    """

    def ratios(key, gram, toxic, ordinary, low):
        codes, classes = gram.astype(np.int64).view(np.uint64), [toxic.astype(np.float64), ordinary.astype(np.float64)]
        pooled = _pooled(codes, classes[0] + classes[1], ORDER, low)
        _, at = np.unique(codes >> np.uint64(8), return_inverse=True)
        totals = [np.bincount(at, n) for n in classes]
        back = (strength / (np.minimum(*totals) + strength))[at]
        logs = []
        for n, total in zip(classes, totals, strict=True):
            fan = np.bincount(at, n > 0)
            seen = np.maximum(total, 1)[at]
            own = np.where(total[at] > 0, (np.maximum(n - _D, 0) + _D * fan[at] * pooled) / seen, pooled)
            logs.append(np.log((1 - back) * own + back * pooled))
        made = gram, np.round((logs[0] - logs[1]) * _UNIT).astype(np.int64), toxic + ordinary
        return pa.RecordBatch.from_arrays([pa.array(x) for x in made], ["gram", "ratio", "n"])

    def run(batches):
        held = None
        for batch in batches:
            made = [np.asarray(c) for c in batch.columns]
            held = made if held is None else [np.concatenate(x) for x in zip(held, made, strict=True)]
            cut = np.searchsorted(held[0], held[0][-1]) if len(held[0]) > _GROUPS else 0
            if cut:
                yield ratios(*[x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            yield ratios(*held)
        release()

    key = F.shiftrightunsigned("gram", 8).bitwiseAND(F.lit((1 << 8 * _LOW) - 1)).alias("key")
    known = join_small(counts.withColumn("suffix", _suffix(_LOW)), _lower_orders(counts), "suffix", "inner")
    placed = known.select(key, "gram", "toxic", "ordinary", "lower").repartition("key").sortWithinPartitions("key")
    return placed.mapInArrow(run, "gram long, ratio long, n long")


def split_grams(rated: DataFrame) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """Codes, in order, and ratios of the n-grams counted most often, _COMMON at most; (gram, ratio) of all others."""
    size = F.floor(F.log2("n") * 8).cast("int")  # some hundred classes
    classes = sorted((tuple(r) for r in rated.groupBy(size.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    least, room = 1 << 30, _COMMON
    for k, n in classes:
        if n > room:
            break
        least, room = k, room - n
    common = collected(rated.filter(size >= least).select("gram", "ratio")).sort_by("gram")
    return np.asarray(common.column("gram")), np.asarray(common.column("ratio")), rated.filter(size < least).select("gram", "ratio")


def gram_filter(grams: DataFrame) -> np.ndarray:
    """word_filter of n-grams, by a hash of their codes."""

    def slots(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_spread(np.asarray(batch.column(0)).view(np.uint64)))], ["a"])

    return word_filter(grams.select("gram").mapInArrow(slots, "a long"))


def _spread(codes: np.ndarray) -> np.ndarray:
    return (mix64(codes) & np.uint64(_SLOTS - 1)).astype(np.int64)


def _inside(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0


def _slots(codes: np.ndarray) -> np.ndarray:
    return (mix64(codes) & np.uint64(_CELLS - 1)).astype(np.int64)


def gram_bounds(ratios: DataFrame) -> np.ndarray:
    """Per slot of the n-grams' hashes the largest ratio, at least 0, in steps of 1 / _STEPS and rounded up; 255: no bound.

    Of fixed size, for any number of n-grams: with more of them fewer words can be ruled out.
    """

    def steps(batches):
        for batch in batches:
            step = np.minimum(np.ceil(np.asarray(batch.column(1)) / (_UNIT / _STEPS)), 255).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(_slots(np.asarray(batch.column(0)).view(np.uint64))), pa.array(step)], ["slot", "step"])

    most = ratios.filter("ratio > 0").mapInArrow(steps, "slot long, step int").groupBy("slot").agg(F.max("step").alias("step"))

    def packed(key, part):
        cells = np.zeros(1 << 16, np.uint8)
        cells[np.asarray(part.column("slot")) & 0xFFFF] = np.asarray(part.column("step"))
        return pa.table({"k": pa.array([key[0].as_py()], pa.int64()), "cells": pa.array([cells.tobytes()], pa.binary())})

    parts = collected(most.groupBy(F.shiftright("slot", 16).alias("k")).applyInArrow(packed, "k long, cells binary"))
    out = np.zeros((_CELLS >> 16, 1 << 16), np.uint8)
    for k, cells in zip(parts.column("k").to_pylist(), parts.column("cells").to_pylist(), strict=True):
        out[k] = np.frombuffer(cells, np.uint8)
    return out.ravel()


def word_ids(words: list[bytes]) -> np.ndarray:
    """Words x 2: the halves of a hash of 128 bits."""
    import xxhash

    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.int64).reshape(-1, 2)


def word_values(docs: DataFrame, ratios: DataFrame, margin: float) -> DataFrame:
    """(a, b, value) of the distinct lower-case words of docs.text whose log-likelihood ratio exceeds the margin, in whole units.

    Words whose bounds add up to the margin at most are left out before their n-grams are joined to the exact ratios.
    """
    shared = Shared(docs.sparkSession, gram_bounds(ratios))

    def distinct(batches):
        held: set[bytes] = set()

        def rows():
            all_words = list(held)
            held.clear()
            for a, b in chunks(np.fromiter(map(len, all_words), np.int64, len(all_words)), rows=50_000):
                words = Words([])
                words.distinct = all_words[a:b]
                codes, starts = word_grams(words)
                steps = shared.value[_slots(codes)].astype(np.int64)
                may = np.add.reduceat(np.where(steps == 255, 1 << 32, steps), starts) > _STEPS * margin
                yield pa.RecordBatch.from_arrays([pa.array([words.distinct[i] for i in np.flatnonzero(may)], pa.binary())], ["word"])

        for batch in batches:
            texts = batch.column(0)
            for a, b in chunks(text_sizes(texts)):
                for t in texts.slice(a, b - a).to_pylist():
                    if t:
                        held.update(t.lower().encode("utf-8", "surrogatepass").split())
                if len(held) > _WORDS:
                    yield from rows()
        yield from rows()
        release()

    def grams(batches):
        for batch in batches:
            for a, b in chunks(text_sizes(batch.column(0))):
                words = Words([])
                words.distinct = batch.column(0).slice(a, b - a).to_pylist()
                codes, starts = word_grams(words)
                ids = np.repeat(word_ids(words.distinct), np.diff(np.append(starts, len(codes))), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array(codes.view(np.int64))], ["a", "b", "gram"])
            release()

    words = docs.select("text").mapInArrow(distinct, "word binary").distinct()
    found = words.mapInArrow(grams, "a long, b long, gram long").join(ratios, "gram")
    value = F.sum("ratio") - round(margin * _UNIT)
    return found.groupBy("a", "b").agg(value.alias("value")).filter(F.col("value") > 0)


def word_filter(values: DataFrame) -> np.ndarray:
    """One bit per slot of the words' hashes: of fixed size, for any number of words. A set bit says that a word may be there."""
    slot = F.col("a").bitwiseAND(F.lit(_SLOTS - 1)) + 1
    maps = collected(values.groupBy(F.bitmap_bucket_number(slot).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")))
    out = np.zeros((_SLOTS // _BUCKET, _BUCKET // 8), np.uint8)
    for k, bits in zip(maps.column("k").to_pylist(), maps.column("bits").to_pylist(), strict=True):
        out[k - 1] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def with_sums(docs: DataFrame, values: DataFrame, rated: DataFrame, keep: list[str] | None) -> DataFrame:
    """The kept columns of docs, __words (null for a null text), __ratio and __whole.

    __ratio is the sum of the values of a text's words, per word: documents hand on their distinct words that pass the filter, with
    counts, and the join with `values` is exact. __whole is the sum of the ratios of all n-grams of all words, for and against, per
    word: workers add those of common n-grams themselves, and documents hand on the others that pass a filter, with counts, for an
    exact join.
    """
    codes_, ratios_, others = split_grams(rated)
    shared = Shared(docs.sparkSession, (word_filter(values), codes_, ratios_, gram_filter(others)))

    def listed(doc, n_docs, *columns):
        ends = pa.array(np.searchsorted(doc, np.arange(n_docs + 1)).astype(np.int32))
        return [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int64))) for x in columns]

    def compute(texts):
        counting, common, common_ratios, rarer = shared.value
        words = Words(texts, lower=True)
        ids = word_ids(words.distinct)
        wide = max(len(ids), 1)

        def counts_of(some):
            pick = some[words.ids]
            pairs, n = np.unique(words.docs[pick] * wide + words.ids[pick], return_counts=True)
            return *np.divmod(pairs, wide), n

        doc, word, n = counts_of(_inside(counting, ids[:, 0] & (_SLOTS - 1)))
        lists = listed(doc, len(texts), ids[word, 0], ids[word, 1], n)
        codes, starts = word_grams(words)
        signed = codes.view(np.int64)
        at = np.minimum(np.searchsorted(common, signed), max(len(common) - 1, 0))
        known = common[at] == signed if len(common) else np.zeros(len(signed), bool)
        added = np.where(known, common_ratios[at], 0) if len(common) else np.zeros(len(signed), np.int64)
        whole = words.sums(np.add.reduceat(added, starts) if len(starts) else added)  # whole numbers below 2 ** 53: exact
        rare = np.flatnonzero(~known & _inside(rarer, _spread(codes)))
        first = np.searchsorted(rare, np.append(starts, len(codes)))  # of each word, among the rare n-grams
        held = np.diff(first)
        doc, word, n = counts_of(held > 0)
        times = held[word]
        place = np.arange(times.sum()) + np.repeat(first[word] - np.cumsum(times) + times, times)
        lists += listed(np.repeat(doc, times), len(texts), signed[rare[place]], np.repeat(n, times))
        return [pa.array(words.lengths, mask=np.array([t is None for t in texts], bool)), pa.array(whole.astype(np.int64)), *lists]

    made = "__words long, __common long, __a array<long>, __b array<long>, __n array<long>, __gram array<long>, __times array<long>"
    counted = with_columns(docs, "text", made, compute, most=4 << 20, keep=keep)
    counted = cut_lineage(counted.withColumn("__row", F.monotonically_increasing_id()), "counted")
    each = counted.filter(F.size("__a") > 0).select("__row", F.inline(F.arrays_zip(F.col("__a").alias("a"), F.col("__b").alias("b"), F.col("__n").alias("n"))))
    sums = join_small(each, values, ["a", "b"], "inner").groupBy("__row").agg(F.sum(F.col("value") * F.col("n")).alias("__sum"))
    rare = counted.filter(F.size("__gram") > 0).select("__row", F.inline(F.arrays_zip(F.col("__gram").alias("gram"), F.col("__times").alias("n"))))
    rest = rare.join(others, "gram").groupBy("__row").agg(F.sum(F.col("ratio") * F.col("n")).alias("__rest"))
    per_word = F.lit(1 / _UNIT) / F.greatest(F.col("__words"), F.lit(1))
    out = counted.drop("__a", "__b", "__n", "__gram", "__times")
    out = out.join(cut_lineage(sums, "sums"), "__row", "left").join(cut_lineage(rest, "rest"), "__row", "left")
    out = out.withColumns({
        "__ratio": F.coalesce("__sum", F.lit(0)) / _UNIT / F.greatest(F.col("__words"), F.lit(1)),
        "__whole": F.coalesce((F.col("__common") + F.coalesce("__rest", F.lit(0))) * per_word, F.lit(0.0)),
    })
    return out.drop("__row", "__sum", "__common", "__rest")


def calibrated(features: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Slopes, one for each column of features, and offset of a logistic curve by Newton steps; if a class is missing the defaults, by the first.

    The slopes of the other features are drawn to 0 by a prior, so that some dozen rows do not set them.
    """
    k = features.shape[1]
    if len(set(label.tolist())) < 2:
        return np.append(60.0, np.zeros(k - 1)), -3.0
    scale = np.maximum(features.std(0), 1e-9)
    x = np.hstack([features / scale, np.ones((len(features), 1))])
    w, firm = np.zeros(k + 1), np.array([1e-2, *[_DOUBT] * (k - 1), 0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - label) + firm * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(np.append(firm[:k], 1e-6))
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
    return w[:k] / scale, float(w[k])


def score_toxicity(
    docs: DataFrame, labels: DataFrame, *, label: str = "toxic", folds: int = 5, held_out: int = 0,
    calibration_rows: int = 5000, strength: float = 20.0, margin: float = 2.0, threshold: float = 0.5, keep: list[str] | None = None,
) -> DataFrame:
    """docs with held_out, score (0 to 1, higher: toxic likelier), predicted, and the two ratios that the score is made of.

    At most about `calibration_rows` ids of each label, from one fold besides the held-out one, place the logistic
    curve; counts come from every other labelled row outside the held-out fold. n-grams of eight bytes within lower-case words are
    counted by class; each class has a Kneser-Ney model that backs off to one of all labelled rows. All n-grams and words stay
    in tables of rows: the n-grams' ratios are joined to the distinct words of docs, and the words that count to
    the documents. whole_ratio is the log-likelihood ratio of the whole text, of all its words for and against, divided by their
    number. ratio is the part of it that stands out: each word's log-likelihood ratio as far as it exceeds `margin` (margin=0 counts
    every word that speaks for label 1), divided likewise. The logistic curve weighs both, the whole by the labelled rows that
    support its weight (see calibrated). Texts of any length are counted and scored whole. Null and empty texts have ratios 0. Without labels of both kinds the curve keeps its defaults, which follow ratio.
    Copies get the same score. Input columns of the new names are replaced.
    """
    calibration = (held_out + folds - 1) % folds
    ids = (
        labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__label")).dropna()
        .withColumn("__fold", fold_of(F.col("__id"), folds)).filter(F.col("__fold") != held_out)
        .groupBy("__id", "__fold").agg(F.max("__label").alias("__label"))
    )
    texts = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text")).filter(F.col("__text").isNotNull())
    sample = cut_lineage(bounded_sample(ids.filter(F.col("__fold") == calibration), "__id", calibration_rows, "__label"), "curve")
    learned = ids.join(F.broadcast(sample.select("__id")), "__id", "left_anti")
    counts = cut_lineage(gram_counts(join_small(texts, learned, "__id", "inner")), "grams")
    rated = cut_lineage(rated_grams(counts, strength), "ratios")
    values = cut_lineage(word_values(docs, rated.select("gram", "ratio"), margin), "values")
    scored = with_sums(without(docs, ["score", "predicted", "ratio", "whole_ratio"]), values, rated, None if keep is None else list({*keep, "doc_id"}))
    shown = scored.filter(F.col("__words").isNotNull()).join(F.broadcast(sample), F.col("doc_id") == F.col("__id")).select("__ratio", "__whole", "__label")
    known = collected(shown).sort_by([(c, "ascending") for c in ("__ratio", "__whole", "__label")])  # sums in one order
    features = np.array([known.column(c).to_pylist() for c in ("__ratio", "__whole")], np.float64).T
    slopes, offset = calibrated(features, np.array(known.column("__label").to_pylist(), np.float64))
    line = float(slopes[0]) * F.col("__ratio") + float(slopes[1]) * F.col("__whole") + offset
    line = F.greatest(F.least(line, F.lit(500.0)), F.lit(-500.0))
    score = 1 / (1 + F.exp(-line))
    out = scored.select(
        *[F.col(f"`{c}`") for c in scored.columns if c not in ("__words", "__ratio", "__whole")], score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"), F.col("__ratio").alias("ratio"), F.col("__whole").alias("whole_ratio"),
    ).withColumn("held_out", F.coalesce(fold_of(F.col("doc_id"), folds) == held_out, F.lit(False)))
    return out if keep is None else out.select(*keep, "held_out", "score", "predicted", "ratio", "whole_ratio")
