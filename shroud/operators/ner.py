"""D3: entity recognition with a pluggable span scorer (iterator pandas UDF).

The contract names a learned span model.  ``shroud.operators.tagger`` fits one on
labelled findings; no pretrained weights are available offline, so the default scorer
here is a **stand-in**: deterministic, built from hashed character features, and of no
claimed quality.  This module fixes the interface a scorer plugs into:

* a scorer is built once per Python worker from a small, picklable spec
  (label names, threshold, model path or seed) -- never per row or per batch;
* it receives Arrow batches of texts and returns candidate spans with a score
  per label (``predict`` for one text, or ``predict_all`` for a batch);
* results go back onto the document row as arrays (no shuffle), where the
  Spark-side greedy decoder (D4) removes overlaps.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shroud.functions.spans import greedy_decode

NER_FIELDS = "ner_start array<int>, ner_end array<int>, ner_entity array<string>, ner_score array<double>"


@dataclass(frozen=True)
class ScorerSpec:
    labels: tuple = ("person", "organization", "location")
    threshold: float = 0.5
    seed: int = 7
    dim: int = 4096
    kind: str = "hashed"            # name of a scorer in SCORERS
    options: dict = field(default_factory=dict, hash=False, compare=False)


class HashedSpanScorer:
    """Stand-in scorer.  Candidates are runs of capitalised words; each label
    scores a candidate by a fixed pseudo-random linear model over hashed
    character trigrams of the span and its left context."""

    def __init__(self, spec: ScorerSpec):
        import numpy as np
        import regex
        self.spec = spec
        rng = np.random.default_rng(spec.seed)
        self.weights = rng.normal(0.0, 1.0, size=(len(spec.labels), spec.dim)).astype("float32")
        self.bias = rng.normal(0.0, 0.5, size=len(spec.labels)).astype("float32")
        self.candidate_re = regex.compile(r"\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*")
        self.np = np

    def _features(self, s: str):
        idx = [int.from_bytes(hashlib.blake2b(s[i:i + 3].encode(), digest_size=4).digest(), "little")
               % self.spec.dim for i in range(max(len(s) - 2, 1))]
        return self.np.asarray(idx, dtype="int64")

    def predict(self, text: str):
        out = []
        if not text:
            return out
        for m in self.candidate_re.finditer(text):
            start, end = m.start(), m.end()
            feats = self._features(text[max(0, start - 8):end].lower())
            logits = self.weights[:, feats].mean(axis=1) * 8.0 + self.bias
            probs = 1.0 / (1.0 + self.np.exp(-logits))
            for li, p in enumerate(probs):
                if p >= self.spec.threshold:
                    out.append((start, end, self.spec.labels[li], float(round(p, 6))))
        return out


class LexiconScorer:
    """Named entities from a fixed lexicon: ``options["terms"]`` maps a whole word (as
    written, letters only around it) to its label; every hit scores ``options["score"]``."""

    def __init__(self, spec: ScorerSpec):
        import regex
        self.terms = dict(spec.options["terms"])
        self.score = float(spec.options.get("score", 1.0))
        self.keep = self.score >= spec.threshold
        words = "|".join(regex.escape(w) for w in sorted(self.terms, key=len, reverse=True))
        self.find = regex.compile(rf"(?<![\p{{L}}\p{{M}}\p{{N}}])(?:{words})(?![\p{{L}}\p{{M}}\p{{N}}])").finditer if words else None

    def predict(self, text: str):
        if not text or not self.keep or self.find is None:
            return []
        return [(m.start(), m.end(), self.terms[m.group()], self.score) for m in self.find(text)]


SCORERS = {"hashed": HashedSpanScorer, "lexicon": LexiconScorer}
_CACHE: dict = {}


def scorer_for(spec: ScorerSpec):
    """One scorer per Python worker process and spec (models load once)."""
    key = (spec.kind, spec.labels, spec.threshold, spec.seed, spec.dim, json.dumps(spec.options, sort_keys=True, default=repr))
    if key not in _CACHE:
        _CACHE[key] = SCORERS[spec.kind](spec)
    return _CACHE[key]


SPANS = "array<struct<start:int,end:int,entity:string,score:double>>"


def detect_ner(df: DataFrame, text_col: str = "text", spec: ScorerSpec | None = None,
               out: str = "ner") -> DataFrame:
    """Adds ``out``: array<finding> of NER spans after greedy decoding.

    An iterator pandas UDF: only the text goes to Python and only spans come back; the
    row's other columns stay in the JVM and nothing is shuffled.
    """
    import pandas as pd

    spec = spec or ScorerSpec()

    def predict(parts):
        model = scorer_for(spec)
        predict_all = getattr(model, "predict_all", lambda ts: [model.predict(t) for t in ts])
        for texts in parts:
            found = predict_all([t if isinstance(t, str) else "" for t in texts])
            yield pd.Series([[dict(zip(("start", "end", "entity", "score"), s)) for s in spans] for spans in found], dtype=object)

    predict.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    scored = df.withColumn("__spans", F.pandas_udf(predict, SPANS)(F.col(text_col)))
    findings = ("transform(coalesce(__spans, array()), a -> named_struct('start', a.start, 'end', a.end, 'entity', a.entity, "
                "'detector', 'ner', 'score', a.score))")
    return scored.withColumn(out, F.expr(greedy_decode(findings))).drop("__spans")


# ---- fixed values: lexicon of the built-in scorer (word, label); words of the given texts ----
LEXICON = ScorerSpec(kind="lexicon", labels=("person", "organization", "location"), threshold=0.5, options={
    "score": 0.9, "terms": {"Eriner": "person", "Anon": "person", "Ofonrereer": "organization", "Thor": "organization", "Thon": "location"}})
# ---- end of fixed values ----
