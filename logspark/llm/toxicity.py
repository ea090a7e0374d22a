"""Toxicity by maximum-scoring segments over token log-odds.

Training, on a bounded sample of labelled rows: each token (a word or a prefix of 4 to 7 characters of it, counted once
a document) gets its log-odds between toxic and clean documents under an informative Dirichlet prior; those that are
positive and significant stay. Scoring: a word has the largest weight of its tokens, all other words a small negative
one, and one linear scan (Ruzzo and Tompa) finds every maximal-scoring segment of a text. Extreme-value statistics
turn a segment's score into the number of such segments expected by chance in a clean text of that length; a segment
is significant if that number is below MAX_EXPECTED. The evidence of the significant segments, calibrated by a
logistic curve on the same sample, is the document's score. Labels, language, source and id are never inputs.

Edge cases: null, empty and wordless texts have no segment and get the score of no evidence; without labelled rows, or
with one class only, every text gets the (smoothed) base rate; a row without a label or id is scored but not learned
from; of repeated labels for one id the largest holds; equal texts get equal scores.

Scale: the sample has at most SAMPLE rows of each class, taken by the smallest hash of the id; the model grows with
the sample, not with the corpus, and is what tasks hold. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logspark.llm.common import ALNUM, id_text, map_rows

#: Labelled rows of each class that training reads at most.
SAMPLE = 5000
#: Total weight of the prior, as documents; least z-score, log-odds and toxic documents of a token.
PRIOR, MIN_Z, MIN_ODDS, MIN_DOCS = 20.0, 3.0, 1.0, 4
MAX_EXPECTED = 0.5
PREFIXES = (4, 5, 6, 7)
MEMORY = 300_000


def words_of(data: bytes) -> list[str]:
    return data.translate(ALNUM).decode("utf-8", "replace").split(" ")


def tokens(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def log_odds(y1, y0, n1: float, n0: float):
    """Log-odds of a token in toxic against clean documents, and its z-score, with the background as prior."""
    a = PRIOR * (y1 + y0) / (n1 + n0) + 0.01
    odds = np.log((y1 + a) / (n1 + PRIOR - y1 - a + 1)) - np.log((y0 + a) / (n0 + PRIOR - y0 - a + 1))
    return odds, odds / np.sqrt(1 / (y1 + a) + 1 / (y0 + a))


class Model:
    """Token weights, the weight of all other words, extreme-value parameters and the calibration curve."""

    def __init__(self, weights: dict[str, float], drift: float = 0.02, rate: float = 1.0, scale: float = 0.1, curve: tuple[float, float] = (0.0, 1.0)):
        self.weights, self.drift, self.rate, self.scale, self.curve = weights, drift, rate, scale, curve

    def segments(self, words: list[str], memory: dict[str, float]) -> list[tuple[float, int, int]]:
        """Maximal-scoring segments (score, first word, last word + 1), in linear time.

        Each segment knows the last one before it with a smaller left sum, so that a search skips what lies between.
        """
        found: list[tuple[float, float, int, int, int]] = []  # left sum, right sum, first, end, the last with a smaller left sum
        if len(memory) > MEMORY:
            memory.clear()
        get, weights, low = memory.get, self.weights, -self.drift
        at = []
        for i, w in enumerate(words):
            if (s := get(w)) is None:
                memory[w] = s = max([weights.get(t, low) for t in tokens(w)])
            if s > 0:
                at.append((i, s))
        total, last = 0.0, 0
        for i, s in at:
            total -= self.drift * (i - last)
            last = i + 1
            left, right, first = total, total + s, i
            total = right
            j = len(found) - 1
            while j >= 0 and found[j][0] >= left:
                j = found[j][4]
            while j >= 0 and found[j][1] < right:
                left, _, first, _, before = found[j]
                del found[j:]
                j = before
            found.append((left, right, first, i + 1, j))
        return [(right - left, a, b) for left, right, a, b, _ in found]

    def expected(self, score: float, n: int) -> float:
        """Segments of at least this score in a clean text of n words."""
        return self.scale * n * math.exp(-min(700.0, self.rate * score))

    def evidence(self, words: list[str], memory: dict[str, float]) -> tuple[float, list[tuple[float, int, int]]]:
        n = len(words)
        significant = [x for x in self.segments(words, memory) if self.expected(x[0], n) < MAX_EXPECTED]
        return math.log1p(sum(-math.log(max(1e-300, self.expected(x[0], n))) for x in significant)), significant

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.curve[0] + self.curve[1] * evidence))))


def _rate(scores: np.ndarray, p: np.ndarray, drift: float) -> float:
    """The positive solution of sum p exp(rate * score) = 1."""
    f = lambda x: float((p * np.exp(np.minimum(x * scores, 600))).sum() + (1 - p.sum()) * math.exp(-x * drift) - 1)
    low, high = 1e-6, 1.0
    while f(high) < 0 and high < 50:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression with a weak ridge, by Newton's method."""
    a = np.column_stack([np.ones(len(x)), x])
    b = np.array([math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag([1e-3, 1e-2]), a.T @ (y - p) - np.array([0, 1e-2 * b[1]]))
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), max(0.0, float(b[1]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, may_learn: Callable[[Column], Column] | None = None) -> Model:
    """The model of (doc_id, text) and labels (doc_id, toxic); may_learn(doc_id) tells the rows to learn from."""
    may_learn = may_learn or (lambda c: ~held_out(c))
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & may_learn(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    hashed = F.xxhash64("doc_id")
    chosen = [known.where(F.col("toxic") == c).orderBy(hashed, "doc_id").limit(sample) for c in (0, 1)]
    texts = docs.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").select("doc_id", "toxic", "text")  # at most 2 * sample ids
    texts = texts.persist()
    try:
        n0, n1 = (texts.where(F.col("toxic") == c).count() for c in (0, 1))
        if not n0 or not n1:
            return Model({}, curve=(math.log((n1 + 0.5) / (n0 + n1 + 1) / (1 - (n1 + 0.5) / (n0 + n1 + 1))), 0.0))
        counted = texts.mapInArrow(_distinct_tokens, "token string, toxic int").groupBy("token").agg(F.sum("toxic").alias("y1"), F.count(F.lit(1)).alias("n"))
        rows = counted.where((F.col("y1") >= MIN_DOCS) & (F.col("y1") * n0 > (F.col("n") - F.col("y1")) * n1)).collect()  # tokens of the bounded sample
        y1 = np.array([r.y1 for r in rows], float)
        y0 = np.array([r.n - r.y1 for r in rows], float)
        odds, z = log_odds(y1, y0, n1, n0)
        use = (z >= MIN_Z) & (odds >= MIN_ODDS)
        weights = {r.token: float(o) for r, o, u in zip(rows, odds, use, strict=True) if u}
        model = Model(weights)
        seen = texts.select(F.concat_ws(":", "toxic", "doc_id").alias("key"), "text")
        facts = lambda: map_rows(seen, "toxic int, n int, hits array<double>, counts array<long>, best double, x double", _facts(model)).collect()  # noqa: E731  a few numbers for each row of the sample
        found = facts()
        clean = [r for r in found if not r.toxic]
        n = sum(r.n for r in clean) + 1
        times: Counter = Counter()
        for r in clean:
            times.update(dict(zip(r.hits, r.counts, strict=True)))
        hits = np.array(sorted(times) or [1.0])
        share = np.array([times[h] for h in hits.tolist()] if times else [1]) / n
        model.drift = max(0.02, 2 * float((hits * share).sum()))
        model.rate = _rate(hits, share, model.drift)
        best = np.array([r.best for r in facts() if not r.toxic and r.best > 0] or [0.0])
        middle = float(np.median(best))
        model.scale = max(1e-4, float((best >= middle).sum()) / n * math.exp(min(50.0, model.rate * middle)))
        found = facts()
        model.curve = _curve(np.array([r.x for r in found]), np.array([r.toxic for r in found], float))
        return model
    finally:
        texts.unpersist()


def _distinct_tokens(batches):
    import pyarrow as pa

    for b in batches:
        for toxic, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            found = {t for w in {*words_of((text or "").encode())} if w for t in tokens(w)}
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([toxic] * len(found), pa.int32())], names=["token", "toxic"])


def _facts(model: Model) -> Callable:
    def run(key, data: bytes) -> tuple:
        words = [w for w in words_of(data) if w]
        memory: dict[str, float] = {}
        segments = model.segments(words, memory)
        times = Counter(s for w in words if (s := memory[w]) > 0)  # at most as many values as the model has weights
        return int(key.split(":")[0]), len(words), list(times), list(times.values()), max([s[0] for s in segments], default=0.0), model.evidence(words, memory)[0]

    return run


def _judge(doc_id, data: bytes, held) -> tuple:
    model, memory = held
    words = [w for w in words_of(data) if w]
    x, segments = model.evidence(words, memory)
    return doc_id, model.score(x), ",".join(f"{a}:{b}" for _, a, b in segments)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, threshold: float = 0.3) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted, and the significant segments as word numbers."""
    df = id_text(docs, id_col, text_col)
    sent = df.sparkSession.sparkContext.broadcast(train(df, labels, sample))
    out = map_rows(df, "doc_id long, score double, segments string", _judge, (("toxicity", uuid.uuid4().hex), lambda: (sent.value, {})))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "segments")
