"""D3: a span scorer learnt from labelled findings (averaged passive-aggressive perceptron, Viterbi decoding).

``fit`` takes any DataFrame with a text and a findings array (patterns, reviewed
decisions, a lexicon); ``scorer_spec`` turns the model into a scorer for ``detect_ner``.

* A text is tagged line by line; a token is a run of letters or digits, or one other
  sign.  Tags are O, B-x and I-x for every label x; I-x stands only behind B-x or I-x.
* A token's score per tag is the sum of hashed features (word, shape, prefix, suffix, and
  whether it touches the token before) of itself and of both neighbours, plus the
  score of staying inside a span.  Words are scored once per run of texts; only lines where some span
  could lead over O are decoded, those of like length together.  Memory is bounded by the run; a line is never cut.
* Fitting is iterative parameter mixing over all distinct lines, marked or not: they are dealt over shards by content hash
  (one per ``SHARD_CHARS`` characters, ``shards`` at least), tokenised once and stored as word numbers.  Every shard trains
  one epoch from the mixed weights in its own task; what it changed is averaged over the shards by parts of the model;
  the model is the last epoch's mix of the shards' running means.  Equal input gives an equal model.
  A caller may bound the lines (``max_marked``, ``max_plain``, ``max_chars``); by default nothing is left out.

Defined results: null and empty texts have no spans; findings that overlap are merged by
``merge`` before fitting (of several on one token the first counts); repeated lines count
once; without a marked line the model finds nothing; extra columns are ignored by ``fit``.
"""

from __future__ import annotations

import functools
import hashlib
import sys
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.functions.spans import FINDINGS_DDL
from shroud.operators.ner import SCORERS, ScorerSpec
from shroud.session import checkpoint_root

DIM = 1 << 14
#: Cells (lines x longest line) decoded at once.
CELLS = 1 << 16
#: Characters of text tagged at once.
RUN_CHARS = 1 << 19
#: Lines looked at together while fitting (fewer if they have ``CELLS`` tokens).
GROUP = 1024
#: Characters of the lines of one shard, on average.
SHARD_CHARS = 8 << 20
#: Features whose weights are averaged together.
PART = 256
FORBIDDEN = -1e9
#: More than a line's tokens can lead by together.
FAR = 1e7
EDGE = "\x02"
N_FEATURES = 5
LINE_DDL = "line string, starts array<int>, ends array<int>, entities array<string>"


@dataclass
class TaggerModel:
    """Weights by (neighbour, feature, tag), scores of I-x behind B-x and I-x, and the labels in tag order."""
    labels: tuple
    weights: np.ndarray
    moves: np.ndarray

    def __post_init__(self):
        self.version = hashlib.sha256(self.weights.tobytes() + self.moves.tobytes() + repr(self.labels).encode()).hexdigest()[:16]

    def __repr__(self):
        return f"TaggerModel({self.version})"


def _token_re():
    """A token with the blank before it, if there is one."""
    import regex
    return regex.compile(r"\s?(?:[\p{L}\p{M}]+|\p{N}+|[^\s\p{L}\p{M}\p{N}])")


def words_of(line: str, token) -> list[str]:
    return token.findall(" " + line)


def _bare(word: str) -> str:
    return word[1:] if len(word) > 1 and word[0].isspace() else word


def places_of(line: str, token) -> list[tuple[int, int]]:
    return [(m.end() - 1 - len(_bare(m.group())), m.end() - 1) for m in token.finditer(" " + line)]


@functools.lru_cache(maxsize=1 << 16)
def _features(word: str, dim: int) -> tuple[int, ...]:
    w = _bare(word)
    glued = w is word
    low = w.lower()
    shape = "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in w[:1] + w[-1:])
    parts = (f"w{low}", f"h{shape}{min(len(w), 12)}{glued}", f"s{low[-3:]}", f"p{low[:2]}{glued}", f"b{shape}")
    return tuple(zlib.crc32(p.encode("utf-8", "surrogatepass")) % dim for p in parts)


def word_scores(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """(neighbour, word, tag): sums over the words' features; a feature's weights are read in one piece."""
    by_feature = np.ascontiguousarray(weights.transpose(1, 0, 2)).reshape(weights.shape[1], -1)
    out = by_feature[features[:, 0]]
    for k in range(1, features.shape[1]):
        out += by_feature[features[:, k]]
    return out.reshape(len(features), len(weights), -1).transpose(1, 0, 2)


class _Lines:
    """Tokenised lines with the features of their distinct words."""

    def __init__(self, lines: list[list[str]], dim: int):
        ids: dict[str, int] = {EDGE: 0}
        self.rows = [np.fromiter((ids.setdefault(w, len(ids)) for w in ws), np.int64, len(ws)) for ws in lines]
        self.features = np.array([_features(w, dim) for w in ids], np.int64)

    def windows(self, which) -> tuple[np.ndarray, np.ndarray]:
        """Padded word ids with an edge on both sides, and the lengths."""
        n = np.array([len(self.rows[i]) for i in which])
        out = np.zeros((len(which), n.max() + 2), np.int64)
        for r, i in enumerate(which):
            out[r, 1:n[r] + 1] = self.rows[i]
        return out, n

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """(neighbour, word, tag)"""
        return word_scores(weights, self.features)


def emissions(scores: np.ndarray, padded: np.ndarray) -> np.ndarray:
    return scores[0, padded[:, :-2]] + scores[1, padded[:, 1:-1]] + scores[2, padded[:, 2:]]


def viterbi(emit: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tags of every line (0 behind its end); ties go to the smaller tag.

    ``moves`` scores I-x behind B-x (row 0) and behind I-x (row 1).  O and B-x may follow any
    tag at no cost, so a step is linear in the number of tags."""
    n, size, k = emit.shape
    before, from_b = np.zeros((size, n), np.int16), np.zeros((size, n, k // 2), bool)
    best = emit[:, 0].copy()
    best[:, 2::2] = FORBIDDEN
    for t in range(1, size):
        before[t] = best.argmax(axis=1)
        behind_b, behind_i = best[:, 1::2] + moves[0], best[:, 2::2] + moves[1]
        from_b[t] = behind_b >= behind_i
        step = np.repeat(best.max(axis=1)[:, None], k, axis=1)
        step[:, 2::2] = np.maximum(behind_b, behind_i)
        best = np.where((t < lengths)[:, None], step + emit[:, t], best)
    out = np.zeros((n, size), np.int16)
    tag, rows = best.argmax(axis=1), np.arange(n)
    for t in range(size - 1, -1, -1):
        live = t < lengths
        out[:, t] = np.where(live, tag, 0)
        inside = (tag > 0) & (tag % 2 == 0)
        prior = np.where(inside, tag - from_b[t, rows, np.maximum(tag // 2 - 1, 0)] if k > 1 else tag, before[t])
        tag = np.where(live, prior, tag)
    return out


def may_leave_o(emit: np.ndarray, moves: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of lines whose tokens stand behind one another in ``emit`` (others between them don't count): True where
    some span may lead over O.  The best path of all others is O throughout.

    ``lead`` of a span that ends at a token is that of B-x where it begins and of I-x, with its better move, behind it;
    the best of them is a running sum and a running maximum, begun anew by a step of ``-FAR`` into each line."""
    begin = emit[:, 1::2] - emit[:, :1]
    step = (emit[:, 2::2] - emit[:, :1] + moves.max(axis=0)).astype(np.float64)
    step[starts] = -FAR
    outside = np.ones(len(emit), bool)
    outside[_ranges(starts, ends)] = False
    begin[outside], step[outside] = FORBIDDEN, 0
    np.cumsum(step, axis=0, out=step)
    lead = np.maximum.accumulate(begin - step, axis=0)
    lead += step
    return np.logical_or.reduceat((lead > -0.01).any(axis=1) & ~outside, starts)


def _groups(lengths: np.ndarray, most: int):
    """Ranges of lines of at most ``most`` lines and ``CELLS`` tokens (a longer line stands alone)."""
    a, ends = 0, np.cumsum(lengths, dtype=np.int64)
    while a < len(ends):
        done = int(ends[a - 1]) if a else 0
        b = min(a + most, max(a + 1, int(np.searchsorted(ends, done + CELLS, side="right"))))
        yield a, b
        a = b


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = ends - starts
    return np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _runs(lines: _Lines, which):
    """The lines of ``which`` in order of length, in runs of at most ``CELLS`` cells (a longer line stands alone)."""
    order = sorted((int(i) for i in which), key=lambda i: len(lines.rows[i]))
    run = []
    for i in order:
        if run and (len(run) + 1) * len(lines.rows[i]) > CELLS:
            yield run
            run = []
        run.append(i)
    if run:
        yield run


class TaggerScorer:
    """Scorer for ``detect_ner``; ``options["model"]`` is a :class:`TaggerModel`.

    A span's score is the logistic of its tokens' mean lead over tag O."""

    def __init__(self, spec: ScorerSpec):
        self.model, self.threshold = spec.options["model"], spec.threshold
        self.token = _token_re()

    def predict(self, text: str):
        return self.predict_all([text])[0]

    def predict_all(self, texts: list):
        """Spans of every text.  Texts are taken in runs of ``RUN_CHARS`` characters (a longer text stands alone)."""
        out, run, size = [], [], 0
        for text in texts:
            text = text or ""
            if run and size + len(text) > RUN_CHARS:
                out += self._predict_run(run)
                run, size = [], 0
            run.append(text)
            size += len(text)
        return out + self._predict_run(run)

    def _predict_run(self, texts: list):
        out, where, words = [[] for _ in texts], [], []
        for n, text in enumerate(texts):
            at = 0
            for line in text.split("\n"):
                w = words_of(line, self.token)
                if w:
                    where.append((n, at, line))
                    words.append(w)
                at += len(line) + 1
        if not words:
            return out
        lines = _Lines(words, self.model.weights.shape[1])
        scores = lines.scores(self.model.weights)
        for run in _runs(lines, self._marked(lines, scores)):
            padded, lengths = lines.windows(run)
            emit = emissions(scores, padded)
            tags = viterbi(emit, lengths, self.model.moves)
            for r in np.flatnonzero(tags.any(axis=1)):
                n, at, line = where[run[r]]
                out[n] += self._spans(tags[r], emit[r], places_of(line, self.token), at)
        return [sorted(spans) for spans in out]

    def _marked(self, lines, scores) -> np.ndarray:
        """Lines with a span that may lead over O; the best path of all others is O throughout."""
        n = np.array([len(r) for r in lines.rows])
        flat = np.zeros(n.sum() + len(n) + 1, np.int64)              # an edge before, between and behind the lines
        first = np.cumsum(n + 1) - n
        flat[_ranges(first, first + n)] = np.concatenate(lines.rows)
        out = np.zeros(len(n), bool)
        for a, b in _groups(n, len(n)):
            at = flat[first[a] - 1:first[b - 1] + n[b - 1] + 1]
            emit = scores[0, at[:-2]] + scores[1, at[1:-1]] + scores[2, at[2:]]
            start = first[a:b] - first[a]
            out[a:b] = may_leave_o(emit, self.model.moves, start, start + n[a:b])
        return np.flatnonzero(out)

    def _spans(self, tags, emit, places, at):
        spans, i = [], 0
        while i < len(places):
            if tags[i] % 2 == 0:
                i += 1
                continue
            j = i + 1
            while j < len(places) and tags[j] == tags[i] + 1:
                j += 1
            lead = np.mean([emit[t, tags[t]] - emit[t, 0] for t in range(i, j)])
            score = round(float(1 / (1 + np.exp(-np.clip(lead, -30, 30)))), 6)
            if score >= self.threshold:
                spans.append((at + places[i][0], at + places[j - 1][1], self.model.labels[tags[i] // 2], score))
            i = j
        return spans


SCORERS["tagger"] = TaggerScorer


def scorer_spec(model: TaggerModel, threshold: float = 0.5) -> ScorerSpec:
    return ScorerSpec(labels=model.labels, threshold=threshold, kind="tagger", options={"model": model})


# ---- fitting ----
def labelled_lines(df: DataFrame, text_col: str, findings_col: str) -> DataFrame:
    """``line, starts, ends, entities``: every line with the parts of the findings that lie on it."""
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text, spans in zip(frame["t"], frame["f"], strict=True):
                spans, k, at = sorted((s["start"], s["end"], s["entity"]) for s in spans), 0, 0
                for line in text.split("\n"):
                    end, on = at + len(line), []
                    while k < len(spans) and spans[k][0] < end:
                        on.append((max(spans[k][0], at) - at, min(spans[k][1], end) - at, spans[k][2]))
                        if spans[k][1] > end:
                            break
                        k += 1
                    while k < len(spans) and spans[k][1] <= end + 1:
                        k += 1
                    if line:
                        rows.append((line, [s[0] for s in on], [s[1] for s in on], [s[2] for s in on]))
                    at = end + 1
            yield pd.DataFrame(rows, columns=["line", "starts", "ends", "entities"])

    src = df.select(F.col(text_col).alias("t"), F.coalesce(F.col(findings_col).cast(FINDINGS_DDL), F.array().cast(FINDINGS_DDL)).alias("f"))
    return src.where("t IS NOT NULL").mapInPandas(cut, LINE_DDL)


def _gold(places, starts, ends, entities, labels) -> np.ndarray:
    """Tags of a line: a token belongs to the first span that it shares a character with."""
    out, k, last = np.zeros(len(places), np.int16), 0, -1
    for i, (a, b) in enumerate(places):
        while k < len(starts) and ends[k] <= a:
            k += 1
        if k < len(starts) and starts[k] < b and entities[k] in labels:
            out[i] = 2 * labels.index(entities[k]) + (2 if last == k else 1)
            last = k
    return out


class Shard:
    """Lines as word numbers: an edge (word 0) before, between and behind them; tags of the marked lines."""

    COLUMNS = {"ids": np.uint32, "lengths": np.int32, "features": np.uint16, "marked": np.int32, "tags": np.int16}
    DDL = ", ".join(f"{c} binary" for c in COLUMNS)

    def __init__(self, parts: dict):
        self.ids, self.lengths, features, marked, tags = (np.frombuffer(parts[c], t) for c, t in self.COLUMNS.items())
        self.features = features.reshape(-1, N_FEATURES)
        self.first = 1 + np.cumsum(self.lengths + 1, dtype=np.int64) - (self.lengths + 1)
        self.gold = dict(zip(marked.tolist(), np.split(tags, np.cumsum(self.lengths[marked])[:-1]), strict=True)) if len(marked) else {}

    @classmethod
    def pack(cls, rows, labels: tuple, dim: int = DIM) -> dict:
        """``(line, starts, ends, entities)`` rows; lines without a token are left out."""
        token, words = _token_re(), {EDGE: 0}
        ids, lengths, marked, tags = [np.zeros(1, np.uint32)], [], [], []
        for line, starts, ends, entities in rows:
            found = words_of(line, token)
            if not found:
                continue
            if len(starts):
                gold = _gold(places_of(line, token), starts, ends, entities, labels)
                if gold.any():
                    marked.append(len(lengths))
                    tags.append(gold)
            ids.append(np.fromiter((words.setdefault(w, len(words)) for w in found), np.uint32, len(found)))
            ids.append(ids[0])
            lengths.append(len(found))
        features = np.fromiter((f for w in words for f in _features(w, dim)), np.uint16, len(words) * N_FEATURES)
        parts = (np.concatenate(ids), lengths, features, marked, np.concatenate(tags) if tags else [])
        return {c: np.asarray(x, t).tobytes() for (c, t), x in zip(cls.COLUMNS.items(), parts, strict=True)}

    def line(self, i: int) -> np.ndarray:
        """Word numbers with an edge on both sides."""
        return self.ids[self.first[i] - 1:self.first[i] + self.lengths[i] + 1]


def _wrong(shard: Shard, a: int, b: int, weights: np.ndarray, moves: np.ndarray) -> list[int]:
    """Lines ``a`` to ``b`` whose best path is not the right one."""
    used, flat = np.unique(shard.ids[shard.first[a] - 1:shard.first[b - 1] + shard.lengths[b - 1] + 1], return_inverse=True)
    scores = word_scores(weights, shard.features[used])
    emit = scores[0, flat[:-2]] + scores[1, flat[1:-1]] + scores[2, flat[2:]]
    start = shard.first[a:b] - shard.first[a]
    free = may_leave_o(emit, moves, start, start + shard.lengths[a:b])
    rows = [i for i in range(a, b) if free[i - a] or i in shard.gold]
    out = []
    for run in _by_length(rows, shard.lengths):
        n = shard.lengths[run]
        padded = np.full((len(run), n.max()), -1, np.int64)
        for r, i in enumerate(run):
            padded[r, :n[r]] = np.arange(start[i - a], start[i - a] + n[r])
        tags = viterbi(emit[padded], n, moves)
        out += [i for r, i in enumerate(run) if (tags[r, :n[r]] != shard.gold.get(i, 0)).any()]
    return sorted(out)


def _by_length(rows: list[int], lengths: np.ndarray):
    """Rows in order of length, in runs of at most ``CELLS`` cells (a longer line stands alone)."""
    run: list[int] = []
    for i in sorted(rows, key=lambda i: (lengths[i], i)):
        if run and (len(run) + 1) * lengths[i] > CELLS:
            yield run
            run = []
        run.append(i)
    if run:
        yield run


def train_epoch(shard: Shard, weights: np.ndarray, moves: np.ndarray):
    """One pass over a shard's lines: the last and the averaged weights and moves.

    Lines are looked at in groups; only one that its group's first weights get wrong is decoded by
    itself, and if it is still wrong, it moves the weights just so far that the right path leads by
    one per wrong token (a step of at most 1 per feature)."""
    weights, moves = weights.copy(), moves.copy()
    late_w, late_m, steps = np.zeros_like(weights), np.zeros_like(moves), len(shard.lengths)
    for a, b in _groups(shard.lengths, GROUP):
        for i in _wrong(shard, a, b, weights, moves):
            padded = shard.line(i)
            want = shard.gold.get(i)
            if want is None:
                want = np.zeros(len(padded) - 2, np.int16)
            used, back = np.unique(padded, return_inverse=True)
            emit = emissions(weights[:, shard.features[used]].sum(axis=2), back[None, :])
            got = viterbi(emit, np.array([len(want)]), moves)[0]
            wrong = np.flatnonzero(want != got)
            if not len(wrong):
                continue
            change, change_m = _difference(shard.features[padded], want, got, wrong, weights.shape)
            at, by = change
            lead = float((weights.reshape(-1)[at] * by).sum() + (moves * change_m).sum())
            norm = float((by ** 2).sum() + (change_m ** 2).sum())
            if not norm:   # wrong tokens that cancel each other out
                continue
            step = min(1.0, (len(wrong) - lead) / norm)
            weights.reshape(-1)[at] += step * by
            late_w.reshape(-1)[at] += (i + 1) * step * by
            moves += step * change_m
            late_m += (i + 1) * step * change_m
    return weights, moves, weights - late_w / max(steps, 1), moves - late_m / max(steps, 1)


def _difference(features, want, got, wrong, shape):
    """Features of the right path less those of the found one: (flat places, amounts), and those of the moves."""
    flat = [np.ravel_multi_index((np.full_like(features[wrong + d], d), features[wrong + d], np.broadcast_to(path[wrong][:, None], (len(wrong), features.shape[1]))), shape)
            for d in range(3) for path in (want, got)]
    sign = np.repeat(np.tile([1.0, -1.0], 3), flat[0].size)
    at, back = np.unique(np.concatenate([f.reshape(-1) for f in flat]), return_inverse=True)
    by = np.bincount(back, sign, len(at)).astype(np.float32)
    moves = np.zeros((2, shape[2] // 2), np.float32)
    for s, path in ((1, want), (-1, got)):
        inside = 1 + np.flatnonzero((path[1:] > 0) & (path[1:] % 2 == 0))
        np.add.at(moves, ((path[inside - 1] == path[inside]).astype(int), path[inside] // 2 - 1), s)
    return (at[by != 0], by[by != 0]), moves


def _smallest(max_marked: int, max_plain: int):
    """A task's distinct lines of smallest ``(h, line)``: ``max_marked`` with a span and ``max_plain`` without."""
    def cut(t: pa.Table, n: int) -> pa.Table:
        t = t.sort_by([("h", "ascending"), ("line", "ascending")])
        if len(t) > 1:
            again = pc.and_(pc.equal(t["h"][1:], t["h"][:-1]), pc.equal(t["line"][1:], t["line"][:-1]))
            t = t.filter(pa.chunked_array([pa.array([True]), *pc.invert(again).chunks], pa.bool_()))
        return t.slice(0, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, pa.Table] = {}
        for b in batches:
            new = pa.Table.from_batches([b])
            spans = pc.greater(pc.list_value_length(new["starts"]), 0)
            for marked, n in ((True, max_marked), (False, max_plain)):
                part = new.filter(spans if marked else pc.invert(spans))
                if marked in held:
                    if len(held[marked]) >= n > 0:
                        part = part.filter(pc.less_equal(part["h"], held[marked]["h"][n - 1]))
                    if not len(part):
                        continue
                    part = pa.concat_tables([held[marked], part])
                held[marked] = cut(part, n).combine_chunks()
        for t in held.values():
            yield from t.to_batches()
    return run


def _stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Written once below the shared folder and read back."""
    path = f"{checkpoint_root(df.sparkSession)}/tagger/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def fit(df: DataFrame, text_col: str = "text", findings_col: str = "findings", labels: tuple | None = None, *,
        max_marked: int | None = None, max_plain: int | None = None, max_chars: int | None = None,
        shards: int = 4, epochs: int = 6) -> TaggerModel:
    """A model of the findings of ``df`` (see the module for the method), learnt from all its lines.

    ``labels`` names the entities to learn (their number sets the model's size); by default
    those of the lines, in order.  ``max_marked`` lines with a span and ``max_plain`` without, of smallest
    hash, and lines up to ``max_chars`` are what a caller may restrict it to."""
    lines = labelled_lines(df, text_col, findings_col)
    if max_chars is not None:
        lines = lines.where(F.length("line") <= max_chars)
    lines = lines.withColumn("h", F.xxhash64("line", "starts", "ends", "entities"))
    if max_marked is None and max_plain is None:
        lines = lines.dropDuplicates(["h", "line"])
    else:
        # every task sends its own smallest lines, among which those of the whole table are
        cut = _smallest(*(sys.maxsize if n is None else n for n in (max_marked, max_plain)))
        near = _stored(lines.mapInArrow(cut, f"{LINE_DDL}, h long"), "near").dropDuplicates(["h", "line"])
        pick = lambda marked, n: (lambda x: x if n is None else x.orderBy("h", "line").limit(n))(near.where((F.size("starts") > 0) == marked))
        lines = pick(True, max_marked).unionAll(pick(False, max_plain))
    lines = _stored(lines, "lines")
    if labels is None:
        labels = tuple(r[0] for r in lines.select(F.explode("entities").alias("e")).distinct().orderBy("e").collect())
    n = 2 * len(labels) + 1
    weights, moves = np.zeros((3, DIM, n), np.float32), np.zeros((2, len(labels)), np.float32)
    final = weights, moves
    if labels:
        shards = max(shards, -(-(lines.agg(F.sum(F.length("line"))).first()[0] or 0) // SHARD_CHARS))
        packed = _packed(lines, shards, labels)
        for _ in range(epochs):
            mixed = _epoch(packed, weights, moves)
            if mixed is None:
                break
            weights, moves, final = mixed[0], mixed[1], (mixed[2], mixed[3])
    return TaggerModel(labels, *final)


def _packed(lines: DataFrame, shards: int, labels: tuple) -> DataFrame:
    """One row per shard: its lines in order of ``(h, line)`` as a :class:`Shard`."""
    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["h", "line"])
        rows = zip(frame["line"], frame["starts"], frame["ends"], frame["entities"], strict=True)
        return pd.DataFrame([{"shard": key[0], **Shard.pack(rows, labels)}])

    # a partition count of its own: the shards are small in bytes and would be put into one task
    dealt = lines.withColumn("shard", F.expr(f"cast(pmod(h, {shards}) as int)")).repartition(shards, "shard")
    return _stored(dealt.groupBy("shard").applyInPandas(pack, f"shard int, {Shard.DDL}"), "shards",
                   **{"parquet.block.row.count.limit": "1"})  # Spark reads up to 4,096 rows of a row group at once


def _epoch(packed: DataFrame, weights: np.ndarray, moves: np.ndarray) -> list | None:
    """The mean over the shards of the last and averaged weights and moves; what comes back has the size of the model."""
    shared = packed.sparkSession.sparkContext.broadcast((weights, moves))
    size = PART * weights.shape[2]
    n_parts = 3 * weights.shape[1] // PART

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        old = np.concatenate([x.reshape(-1) for x in shared.value])
        for batch in batches:
            for row in range(batch.num_rows):
                w, m, aw, am = train_epoch(Shard({c: batch.column(c)[row].as_py() for c in Shard.COLUMNS}), *shared.value)
                last, mean = (np.concatenate([x.reshape(-1), y.reshape(-1)]).astype(np.float32) - old for x, y in ((w, m), (aw, am)))
                at = np.flatnonzero((last != 0) | (mean != 0))
                # the parts that changed; the moves are behind the weights, in a part of their own
                part, first = np.unique(np.minimum(at // size, n_parts), return_index=True)
                cut = lambda x: [c.tobytes() for c in np.split(x, first[1:])] if len(at) else []  # noqa: E731,B023
                yield pa.RecordBatch.from_arrays(
                    [pa.array([-1, *part.tolist()], pa.int32()), pa.array([batch.column("shard")[row].as_py()] * (len(part) + 1), pa.int32()),
                     *(pa.array([b"", *cut(x)], pa.binary()) for x in (at, last[at], mean[at]))],
                    names=["part", "shard", "at", "last", "mean"])

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """Sums of a part's changes in order of the shards (the sum doesn't hang on the order of tasks)."""
        if key[0] < 0:
            return pd.DataFrame([(key[0], len(frame), b"", b"", b"")], columns=["part", "n", "at", "last", "mean"])
        frame = frame.sort_values("shard")
        at, back = np.unique(np.concatenate([np.frombuffer(x, np.int64) for x in frame["at"]]), return_inverse=True)
        sums = [np.bincount(back, np.concatenate([np.frombuffer(x, np.float32) for x in frame[c]]), len(at)) for c in ("last", "mean")]
        return pd.DataFrame([(key[0], len(frame), at.tobytes(), *(x.tobytes() for x in sums))], columns=["part", "n", "at", "last", "mean"])

    done = packed.mapInArrow(train, "part int, shard int, at binary, last binary, mean binary").groupBy("part").applyInPandas(
        add, "part int, n int, at binary, last binary, mean binary").collect()
    shared.unpersist()
    count = sum(r["n"] for r in done if r["part"] < 0)
    if not count:
        return None
    new = [np.concatenate([weights.reshape(-1), moves.reshape(-1)]) for _ in range(2)]
    for r in done:
        at = np.frombuffer(r["at"], np.int64)
        for x, c in zip(new, ("last", "mean"), strict=True):
            x[at] += (np.frombuffer(r[c], np.float64) / count).astype(np.float32)
    return [y for x in new for y in (x[:weights.size].reshape(weights.shape), x[weights.size:].reshape(moves.shape))]
