"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text and one on toxic text.
A window of words is compressed after the ordinary dictionary alone and after both
(ordinary first, so the toxic one only adds matches); the bytes saved are the
window's distance.  A document's features are its largest distances and how
often they pass fixed steps; a logistic model over them, fitted out of fold on
labelled rows and weighted to the base rate, gives the calibrated score.

Labels mark documents, but only a few words of a toxic document are toxic.  The toxic
dictionary therefore holds the parts of words, the strongest last, whose byte n-grams
stand in far more toxic than ordinary documents.  How many standard errors more is chosen
among ``MARK_Z`` by the loss of the calibration on texts out of fold, so a large
vocabulary of rare toxic words is learnt where it helps; the dictionary's size follows
the marked parts, up to that of the ordinary one.

Fitting takes a bounded sample of labelled ids (``MAX_TOXIC`` and ``MAX_ORDINARY`` ids
with a text of at most ``MAX_TRAIN_CHARS`` characters, first by hash; of an id's texts the
smallest); class counts come from all labels.  Scoring is a narrow map over whole texts; the model that
goes to the tasks is the two dictionaries and a dozen numbers (under 200 kB).

Defined results: null and empty texts get the score of a text without any window;
null ids are scored like others; repeated rows keep a row each; repeated or
contradicting labels count as they come; without labelled rows of both classes every
score is the base rate (logged if the labels have both); an empty table gives no rows.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

LOG = logging.getLogger(__name__)
MAX_TOXIC, MAX_ORDINARY = 2_000, 4_000
MAX_TRAIN_CHARS = 32_768
WINDOW_WORDS = 5
#: A longer window (a text without spaces) is cut.
WINDOW_BYTES = 512
ORDINARY_DICT, TOXIC_DICT, LEVEL = 65_536, 65_536, 3
GRAMS = (5, 6, 7)
GRAM_BUCKETS = 1 << 22
#: An n-gram marks toxic texts by its share of them: so many times the ordinary share, and so many standard errors
#: more: the first of these, or a laxer one whose loss out of fold is lower by so many standard errors of the difference.
RATIO, MARK_Z, GAIN_Z = 8.0, (5.0, 3.5, 2.5), 2.0
FOLDS = 2
STEPS = (3, 4, 5, 6)
THRESHOLD = 0.7


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    base: float


def windows(text: str | None) -> list[bytes]:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    out = []
    for i in range(0, len(words), WINDOW_WORDS):
        w = b" " + b" ".join(words[i:i + WINDOW_WORDS]) + b" "
        if len(w) <= WINDOW_BYTES:
            out.append(w)
        else:
            out.extend(w[j:j + WINDOW_BYTES] for j in range(0, len(w), WINDOW_BYTES))
    return out


class Scorer:
    """Distances and score of a text; built once per worker."""

    def __init__(self, model: Model):
        self.model = model
        if model.toxic:
            self.short = self._compress(model.ordinary + model.toxic)
            self.plain = self._compress(model.ordinary)

    @staticmethod
    def _compress(content: bytes):
        import zstandard
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_checksum=False, write_content_size=False,
                                        write_dict_id=False).compress

    @staticmethod
    def shape(saved: np.ndarray) -> np.ndarray:
        top = np.sort(saved)[::-1]
        n = len(saved)
        passed = [int((saved >= s).sum()) for s in STEPS]
        return np.array([top[0], top[:2].mean(), top[:4].mean(), saved.mean(), *np.log1p(passed), np.log(n),
                         passed[0] / n, passed[2] / n])

    def features(self, text: str | None) -> np.ndarray:
        plain, short = self.plain, self.short
        return self.shape(np.array([len(plain(w)) - len(short(w)) for w in windows(text)] or [0]))

    def score(self, text: str | None) -> float:
        m = self.model
        if not m.toxic:
            return m.base
        z = m.weights[0] + ((self.features(text) - m.mean) / m.scale) @ m.weights[1:]
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def _grams(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash buckets of the n-grams of a lower-cased text, the place of each and its length; none crosses two words."""
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    space = np.concatenate([[0], np.cumsum((a == 32) | ((a >= 9) & (a <= 13)))])
    buckets, places, sizes = [], [], []
    for n in GRAMS:
        m = len(a) - n + 1
        if m <= 0:
            continue
        h = np.zeros(m, np.uint64)
        for j in range(n):
            h = (h ^ a[j:j + m]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        # a space may only stand at either end (word starts and ends are part of a gram)
        ok = np.flatnonzero(space[n - 1:n - 1 + m] - space[1:1 + m] == 0)
        buckets.append((h[ok] % np.uint64(GRAM_BUCKETS)).astype(np.int64))
        places.append(ok)
        sizes.append(np.full(len(ok), n))
    return (np.concatenate(buckets), np.concatenate(places), np.concatenate(sizes)) if buckets else (np.empty(0, np.int64),) * 3


def _lower(text: str) -> bytes:
    return b" " + b" ".join(text.encode("utf-8", "surrogatepass").lower().split()) + b" "


def gram_errors(toxic: list[bytes], ordinary: list[bytes]) -> np.ndarray:
    """By how many standard errors more of the toxic texts hold a gram (0 where it can't mark them)."""
    df = np.zeros((2, GRAM_BUCKETS), np.int32)
    for side, texts in enumerate((toxic, ordinary)):
        for t in texts:
            df[side, np.unique(_grams(t)[0])] += 1
    n1, n0 = len(toxic), len(ordinary)
    z = np.empty(GRAM_BUCKETS, np.float32)
    for at in range(0, GRAM_BUCKETS, 1 << 18):  # in slices, to keep the work arrays small
        part = slice(at, at + (1 << 18))
        d1, d0 = df[0, part], df[1, part]
        p = (d1 + d0) / (n1 + n0)
        errors = (d1 / n1 - d0 / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-9)
        z[part] = np.where((d1 >= 2) & (d1 / n1 > RATIO * (d0 + 0.25) / n0), errors, 0)
    return z


def toxic_parts(toxic: list[bytes], z: np.ndarray, least: float) -> dict[bytes, float]:
    """The parts of words covered by grams of more than ``least`` errors, with the most errors of each."""
    least = min(least, 0.6 * float(z.max()))  # as strict as the sample allows
    out: dict[bytes, float] = {}
    for t in toxic:
        b, at, n = _grams(t)
        zs = z[b]
        hit = zs > least
        if not hit.any():
            continue
        at, n, zs = at[hit], n[hit], zs[hit]
        steps = np.zeros(len(t) + 1, np.int64)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + n, -1)
        cover = (np.cumsum(steps)[:-1] > 0) & (np.frombuffer(t, np.uint8) != 32)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], cover, [False]])))
        starts, ends = edges[::2], edges[1::2]
        best = np.zeros(len(starts), np.float32)
        np.maximum.at(best, np.searchsorted(ends, at + 1, side="right"), zs)  # a gram's second byte is never a space
        for i, j, s in zip(starts.tolist(), ends.tolist(), best.tolist(), strict=True):
            w = t[i:j]
            out[w] = max(out.get(w, 0.0), s)
    return out


def _train(size: int, samples: list[bytes]) -> bytes:
    """A zstandard dictionary of the samples; too few samples for the trainer serve as they are."""
    import zstandard
    samples = [s for s in samples if len(s) >= 8]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def dictionaries(toxic: list[bytes], ordinary: list[bytes], levels: tuple[float, ...]) -> tuple[bytes, list[bytes]]:
    """The ordinary dictionary, and the toxic one at each of ``levels`` (empty if nothing marks toxic texts)."""
    pieces = []
    for t in ordinary:
        words = t.split()
        pieces.extend(b" ".join(words[i:i + 40]) for i in range(0, len(words), 40))
    z = gram_errors(toxic, ordinary)
    out = []
    for least in levels:
        parts = toxic_parts(toxic, z, least)
        chosen, size = [], 2
        for w in sorted(parts, key=lambda w: (-parts[w], w)):
            size += len(w) + 1
            if size > TOXIC_DICT:
                break
            chosen.append(w)
        out.append(b" " + b" ".join(reversed(chosen)) + b" " if chosen else b"")
    return _train(ORDINARY_DICT, pieces), out


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps."""
    x = np.c_[np.ones(len(x)), x]
    ridge = 0.05 * np.eye(x.shape[1])
    ridge[0, 0] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (p - y)) + ridge @ beta
        beta -= np.linalg.solve((x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, grad)
    return beta


def held_out(id_col: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Fit on the labelled rows that are not held out."""
    lab = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
           .select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")))
    rows = (docs.filter(F.col(text_col).isNotNull() & (F.length(text_col) <= MAX_TRAIN_CHARS))
            .select(F.col(id_col).alias("__did"), F.col(text_col).alias("__text")))
    # the ids of the sample are chosen first, among those with a usable text; only their texts are collected
    usable = rows.select("__did").distinct()
    found = common.materialize(lab.distinct().join(usable, F.col("__id") == F.col("__did"), "left_semi"), "toxicity-labels")
    order = F.xxhash64(F.col("__id"))
    some = {y: [r["__id"] for r in found.filter(F.col("__y") == y).select("__id")
                .orderBy(order, "__id").limit(n).collect()] for y, n in ((1, MAX_TOXIC), (0, MAX_ORDINARY))}
    counts = {r["__y"]: r["n"] for r in lab.groupBy("__y").agg(F.count("*").alias("n")).collect()}
    base = counts.get(1, 0) / max(1, sum(counts.values()))
    spark = docs.sparkSession
    picked = spark.createDataFrame([(i, y) for y, ids in some.items() for i in ids], f"__id {lab.schema['__id'].dataType.simpleString()}, __y int")
    texts = (rows.join(F.broadcast(picked), F.col("__did") == F.col("__id"))  # at most 6,000 ids
             .groupBy("__id", "__y").agg(F.min("__text").alias("__text")))
    sample = sorted((r["__y"], r["__id"], r["__text"]) for r in texts.collect())
    return learn([(r[0], r[2]) for r in sample], counts, base)


def learn(sample: list[tuple[int, str]], counts: dict[int, int], base: float) -> Model:
    """The model of ``sample`` (class, text); ``counts`` are the rows of each class it stands for."""
    y = np.array([s[0] for s in sample], float)
    data = [_lower(s[1]) for s in sample]
    fold = np.array([i % FOLDS for i in range(len(sample))])
    parts = [[(c, f) for c in (0, 1) if not ((y == c) & (fold == f)).any()] for f in range(FOLDS)]
    none = Model(b"", b"", np.zeros(1), np.zeros(0), np.ones(0), base)
    if not sample or any(parts):
        if counts.get(0) and counts.get(1):
            LOG.warning("toxicity: %d toxic and %d ordinary labelled texts are too few to learn from; every score is the base rate %.4f",
                        int((y == 1).sum()), int((y == 0).sum()), base)
        return none
    x = None
    pick = lambda mask: [d for d, m in zip(data, mask, strict=True) if m]
    usable = np.ones(len(MARK_Z), bool)
    for f in range(FOLDS):
        o, ts = dictionaries(pick((y == 1) & (fold != f)), pick((y == 0) & (fold != f)), MARK_Z)
        usable &= [bool(t) for t in ts]
        if not usable.any():
            return none
        scorers = [Scorer(Model(o, t, np.zeros(1), np.zeros(0), np.ones(0), base)) if u else None for t, u in zip(ts, usable, strict=True)]
        plain = next(s.plain for s in scorers if s)
        for i in np.flatnonzero(fold == f):
            ws = windows(sample[i][1])
            sizes = [len(plain(w)) for w in ws]
            for k, s in enumerate(scorers):
                if s:
                    v = s.shape(np.array([n - len(s.short(w)) for n, w in zip(sizes, ws, strict=True)] or [0]))
                    x = np.zeros((len(MARK_Z), len(sample), len(v))) if x is None else x
                    x[k, i] = v
    share = np.array([counts[0] / (y == 0).sum(), counts[1] / (y == 1).sum()])
    w = share[y.astype(int)]
    w *= len(y) / w.sum()
    best = None
    for k in np.flatnonzero(usable):
        mean, scale = x[k].mean(0), x[k].std(0) + 1e-9
        beta = _logistic((x[k] - mean) / scale, y, w)
        at = beta[0] + ((x[k] - mean) / scale) @ beta[1:]
        loss = w * np.logaddexp(0, np.where(y == 1, -at, at))
        # a laxer level only where its gain is no chance of the sample
        if best is None or (best[0] - loss).sum() > GAIN_Z * np.sqrt(len(y)) * (best[0] - loss).std():
            best = (loss, k, mean, scale, beta)
    _, k, mean, scale, beta = best
    o, (t,) = dictionaries(pick(y == 1), pick(y == 0), MARK_Z[k:k + 1])
    return Model(o, t, beta, mean, scale, base)


def _rated(df: DataFrame, model: Model, text_col: str, name: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def rate(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        common.tidy()
        scorer = Scorer(shared.value)
        for part in parts:
            yield pd.Series([scorer.score(t) for t in part], dtype="float64")
        del scorer
        common.tidy()

    return df.withColumn(name, rate(F.col(text_col)))


def score(df: DataFrame, model: Model, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``score`` (double) and ``predicted`` (int) for every row."""
    out = _rated(df, model, text_col, "score")
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int"))


def keep_clean(df: DataFrame, model: Model, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that score below the threshold, with the columns of ``df`` as they are."""
    return _rated(df, model, text_col, "__score").filter(F.col("__score") < threshold).drop("__score")
