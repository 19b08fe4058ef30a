"""Toxic passages as maximum-scoring segments, calibrated by extreme-value statistics.

1. Tokens are words and their leading pieces of 4, 5 and 6 characters (invented or inflected words share a stem).
   Each gets its log-odds between the toxic and the other labelled texts that have it, with a Dirichlet prior of ``PRIOR`` texts
   divided like the classes, lessened by ``SURE`` standard deviations, so that chance words get nothing. Texts
   count once, copies of a text not at all.
2. A word scores its surest token's log-odds if that is positive, and ``-GAP`` otherwise. One linear scan finds every
   maximal segment of positive sum (Ruzzo and Tompa): the passages.
3. The best of many segments follows an extreme-value law in the text's length n: ``evidence = lambda * S - ln(1 + K n)``
   with lambda from the scores of the other class, where a random word gains nothing (sum of p * exp(lambda * s) is 1).
   Evidence, the passages' number and the length go through a logistic regression: the score. Tokens are learned from
   ``SHARE`` of the labelled documents and the regression from the others, which the tokens have not seen.

Bounds (parameters): learned from at most ``FIT_ROWS`` labelled documents in order of a hash of the id. The lexicon holds every token
that can change a word's score: all with a positive score, and of the others those that begin like one of them
(a word whose tokens are all negative scores ``-GAP`` with or without them). It is bounded by the lessons alone. Scoring is one pass over
all whole texts without a shuffle; a task remembers the scores of ``MEMO_WORDS`` words.

Defined cases: of a word's tokens with scores equally far from 0 the first one counts (the word before its pieces, short pieces before long ones); a null text is empty and has no passage; an empty text scores by that; repeated rows are scored each;
if a class has no labels to learn from, every score is the mean label (0 without any); an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from quarterdeck.llm.common import batch_of, fit_logistic, free_prefix, held_out, labelled_ids, logistic, staged, text_or_empty, text_slices

FIT_ROWS = 40_000
#: Of five labelled documents, so many teach tokens.
SHARE = 3
PIECES = (4, 5, 6)
PRIOR, SURE, GAP, MOST = 2.0, 3.0, 0.5, 8.0
K = 0.1
MEMO_WORDS = 100_000
THRESHOLD = 0.5
WORD = re.compile(r"[^\W_]+")


def tokens_of(word: str) -> list[str]:
    """The word and its leading pieces (marked, so that they differ from words)."""
    return [word, *(f"{word[:k]}*" for k in PIECES if len(word) >= k)]


def token_counts(docs: DataFrame) -> DataFrame:
    """token, label, n: in how many texts of a class a token is; counted in each task before the shuffle."""
    schema = pa.schema([("token", pa.string()), ("label", pa.int32()), ("n", pa.int64())])

    class Tokens(dict):
        def __missing__(self, raw: str) -> frozenset:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[raw] = out = frozenset(t for word in WORD.findall(raw.lower()) for t in tokens_of(word))
            return out

    def flush(counts: dict):
        for label, own in counts.items():
            yield batch_of(schema, (list(own), [label] * len(own), list(own.values())))

    def run(batches):
        counts, tokens = {0: Counter(), 1: Counter()}, Tokens()
        for batch in text_slices(batches, 0):
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[label].update(set().union(*map(tokens.__getitem__, set(text.split()))))
            if sum(map(len, counts.values())) > MEMO_WORDS:
                yield from flush(counts)
                counts = {0: Counter(), 1: Counter()}
        yield from flush(counts)

    return docs.select("text", "label").mapInArrow(run, "token string, label int, n long")


def log_odds(counts: DataFrame, texts: dict[int, int]) -> DataFrame:
    """token, score, n0 of every token whose shrunk log-odds are not zero; ``texts``: how many texts a class has."""
    of = lambda k: F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(f"n{k}")
    per = counts.groupBy("token").agg(of(1), of(0))
    every = texts[0] + texts[1]
    share = {k: PRIOR * texts[k] / every for k in (0, 1)}

    def odds(k: int) -> Column:
        has = F.col(f"n{k}") + share[k]
        return F.log(has / F.greatest(texts[k] + PRIOR - has, F.lit(0.5)))

    sigma = F.sqrt(1 / (F.col("n1") + share[1]) + 1 / (F.col("n0") + share[0]))
    delta = odds(1) - odds(0)
    score = F.signum(delta) * F.greatest(F.abs(delta) - SURE * sigma, F.lit(0.0))
    return per.select("token", F.least(score, F.lit(MOST)).alias("score"), "n0").where(F.abs("score") > 0.01)


def lexicon_of(odds: DataFrame) -> DataFrame:
    """The rows of :func:`log_odds` that can matter: positive tokens, and negative ones with the first letters of a positive one.

    A word's tokens are itself and its leading pieces, so all that have as many letters share the first ``PIECES[0]`` of them.
    """
    letters = F.substring(F.regexp_replace("token", r"\*$", ""), 1, PIECES[0])
    odds = odds.withColumn("letters", letters)
    sure = odds.where(F.col("score") > 0).select("letters").distinct()
    return odds.join(sure, "letters", "left_semi").drop("letters")


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, sum), in linear time."""
    found: list[tuple] = []  # begin, end, sum left of begin, sum up to end, nearest earlier one with a smaller left sum
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    for i in np.flatnonzero(scores > 0).tolist():
        begin, end, left, right = i, i + 1, float(sums[i]), float(sums[i + 1])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                break
            begin, left = found[j][0], found[j][2]
            del found[j:]
        found.append((begin, end, left, right, j))
    return [(b, e, r - l) for b, e, l, r, _ in found]


FOUND = ("n_words", "best", "n_segments")


def passages(docs: DataFrame, lexicon: dict[str, float], spans: bool = False) -> DataFrame:
    """The rows of ``docs`` (all columns) with n_words, best (sum of the best segment), n_segments; ``spans`` adds all segments.

    The new columns have ``free_prefix`` before their names; the text is looked at where it lies, so nothing is joined.
    """
    prefix = free_prefix(docs.columns)
    held = docs.sparkSession.sparkContext.broadcast(lexicon)
    at = docs.columns.index("text")
    one = pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    class Memo(dict):
        def __missing__(self, raw: str) -> float:
            best = None
            for word in WORD.findall(raw.lower()):
                for token in tokens_of(word):
                    s = held.value.get(token)
                    if s is not None and (best is None or abs(s) > abs(best)):
                        best = s
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[raw] = out = best if best is not None and best > 0 else -GAP
            return out

    def run(batches):
        memo = Memo()
        score = memo.__getitem__
        for batch in text_slices(batches, at):
            n, best, many, every = [], [], [], []
            for text in batch.column(at).to_pylist():
                words = (text or "").split()
                values = np.fromiter(map(score, words), np.float64, len(words))
                found = segments(values) if len(words) and values.max() > 0 else []
                n.append(len(words))
                best.append(max((s for _, _, s in found), default=0.0))
                many.append(len(found))
                if spans:
                    every.append([{"begin": b, "end": e, "score": s} for b, e, s in found])
            new = [pa.array(n, pa.int64()), pa.array(best, pa.float64()), pa.array(many, pa.int64())]
            new += [pa.array(every, pa.list_(one))] if spans else []
            names = [*batch.schema.names, *[f"{prefix}{c}" for c in FOUND], *([f"{prefix}segments"] if spans else [])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    schema = StructType(list(docs.schema.fields))
    for name, kind in zip(FOUND, ("long", "double", "long"), strict=True):
        schema = schema.add(f"{prefix}{name}", kind)
    if spans:
        schema = schema.add(f"{prefix}segments", ArrayType(StructType().add("begin", "long").add("end", "long").add("score", "double")))
    return docs.mapInArrow(run, schema)


def extreme_value_rate(scores: np.ndarray, counts: np.ndarray, total: float) -> float:
    """lambda: words of the other class then gain nothing on average; a chance hit of the top score is always allowed for."""
    s = np.append(scores, [-GAP, MOST])
    rest = max(total - counts.sum(), 1.0)
    p = np.append(counts, [rest, 1.0])
    p = p / p.sum()
    if (p * s).sum() >= 0:
        return 0.1
    low, high = 1e-6, 20.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(mid * s)).sum() < 1 else (low, mid)
    return low


@dataclass
class Model:
    """What is learned: token scores, the extreme-value rate, and the regression's weights (None: ``constant`` scores)."""

    lexicon: dict[str, float]
    rate: float
    weights: np.ndarray | None
    constant: float

    def terms(self, prefix: str = "_") -> list[Column]:
        words, best, many = (F.col(f"{prefix}{c}") for c in FOUND)
        evidence = F.lit(self.rate) * best - F.log1p(K * words)
        return [evidence, F.log1p(many), F.log1p(words), F.least(best, F.lit(MOST))]

    def score(self, prefix: str = "_") -> Column:
        """The score, from the columns that ``passages`` adds."""
        return F.lit(self.constant) if self.weights is None else logistic(self.terms(prefix), self.weights)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled documents among ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    ids = staged(labelled_ids(labels, "toxic", FIT_ROWS), "toxicity-ids")
    known = docs.join(F.broadcast(ids), "doc_id")  # two numbers for each of at most FIT_ROWS documents
    teaches = F.pmod(F.xxhash64("doc_id", F.lit("teach")), F.lit(5)) < SHARE
    lessons = staged(known.where(teaches).select("text", "label").dropDuplicates(), "toxicity-lessons")
    sizes = lessons.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size(F.split("text", r"\s+"))).alias("words"))
    sizes = {r["label"]: r for r in sizes.collect()}
    model = Model({}, 0.1, None, 0.0)
    if set(sizes) == {0, 1}:
        texts = {k: r["n"] for k, r in sizes.items()}
        rows = lexicon_of(staged(log_odds(token_counts(lessons), texts), "toxicity-odds")).orderBy("token").collect()
        model.lexicon = {r["token"]: r["score"] for r in rows}
        plain = [r for r in rows if not r["token"].endswith("*") and r["score"] > 0]
        scores, counts = np.array([r["score"] for r in plain]), np.array([float(r["n0"]) for r in plain])
        model.rate = extreme_value_rate(scores, counts, float(sizes[0]["words"]))
    terms = [t.alias(f"t{i}") for i, t in enumerate(model.terms())]
    seen = passages(known.where(~teaches), model.lexicon).select("label", *terms)
    seen = np.array(seen.orderBy(*seen.columns).limit(2 * FIT_ROWS).collect(), np.float64).reshape(-1, len(terms) + 1)
    if len(np.unique(seen[:, 0])) == 2:
        model.weights = fit_logistic(seen[:, 1:], seen[:, 0])
    elif len(seen):
        model.constant = float(seen[:, 0].mean())
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, n_words, best, n_segments of every document."""
    model = fit(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    found = passages(rows, model.lexicon)
    return found.select("doc_id", held_out().alias("held_out"), model.score().alias("score"), *[F.col(f"_{c}").alias(c) for c in FOUND])


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``THRESHOLD``; one pass, no join."""
    model = fit(docs, labels)
    return passages(docs, model.lexicon).where(model.score(free_prefix(docs.columns)) < THRESHOLD).select(*docs.columns)


def op6_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity_scores(docs, labels)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
