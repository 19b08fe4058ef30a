"""Classifiers by held-out accuracy on the given labels; neighbours by brute force; segments by their definition."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from quarterdeck.llm import neighbours, quality, toxicity
from quarterdeck.llm.common import fit_logistic

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("query", "label"), [(toxicity.op6_toxic_segments, "toxic"), (quality.op9_compression_quality, "quality")])
def test_held_out_accuracy(spark, query, label):
    out = query(spark, SF).cache()
    assert out.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert out.where("score is null or score < 0 or score > 1 or isnan(score)").count() == 0
    rows = out.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    right = np.mean([r.predicted == r[label] for r in rows])
    assert right >= 0.9, right


@pytest.mark.parametrize("query", ["toxic", "quality"])
def test_classifiers_on_odd_rows(spark, odd_docs, no_docs, odd_rows, query):
    score = toxicity.toxicity_scores if query == "toxic" else quality.quality_scores
    labels = [(r[0], int("tail" in (r[1] or "")), "x") for r in odd_rows] + [(None, 1, "x"), (9999, None, "x"), (409, 1, "x"), (409, 0, "x")]
    table = spark.createDataFrame(labels, f"doc_id long, {query} int, text string")
    out = score(odd_docs, table).collect()
    assert len(out) == len(odd_rows) and all(0 <= r.score <= 1 for r in out)
    assert score(odd_docs, table.limit(0)).where("score is not null").count() == len(odd_rows)
    assert score(no_docs, table).count() == 0


def test_labels_of_held_out_rows_are_never_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = ({r.doc_id: r.score for r in quality.quality_scores(docs, t).collect()} for t in (labels, turned))
    assert one == two


def brute_segments(scores):
    """Ruzzo and Tompa by recursion: the largest segment, then both sides of it."""
    best, at = 0.0, None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best + 1e-12:
                best, at = total, (i, j + 1)
    if at is None:
        return []
    left, right = brute_segments(scores[: at[0]]), brute_segments(scores[at[1] :])
    return left + [(*at, best)] + [(b + at[1], e + at[1], s) for b, e, s in right]


def test_maximal_segments():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-2.0, -1.0, 1.5, 2.25, -0.5]) + rng.random() / 97 for _ in range(rng.randint(0, 25))]
        got = toxicity.segments(np.array(scores))
        want = brute_segments(scores)
        assert [(b, e) for b, e, _ in got] == [(b, e) for b, e, _ in want]
    assert toxicity.segments(np.zeros(0)) == []


def test_toxic_passages_are_found(spark):
    """All texts hold the same clean words, in any order, so that none of them gains a score by chance."""
    rng = random.Random(2)
    clean = lambda first, n: " ".join(rng.sample([f"w{first + i}" for i in range(n)], n))
    rows = [(i, clean(0, 80) + (" vile filth scum" if i % 4 == 0 else "") + " " + clean(100, 40)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    found = toxicity.passages(docs, model.lexicon, spans=True).collect()
    for r in found:
        spans = [(s.begin, s.end) for s in r._segments if s.score > 4]
        assert spans == ([(80, 83)] if r.doc_id % 4 == 0 else [])
    kept = {r.doc_id for r in toxicity.without_toxic(docs, labels).collect()}
    assert kept == {i for i in range(400) if i % 4}


def test_scores_equal_a_plain_version(spark):
    """Tokens, lexicon, best segment and score of every text, computed in plain Python from the learned model's terms."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels)
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    known = {r.doc_id: r.label for r in toxicity.labelled_ids(labels, "toxic", toxicity.FIT_ROWS).collect()}
    teach = docs.select("doc_id").where(F.pmod(F.xxhash64("doc_id", F.lit("teach")), F.lit(5)) < toxicity.SHARE).collect()
    lessons = {(rows[r.doc_id], known[r.doc_id]) for r in teach if r.doc_id in known}
    texts = {k: sum(label == k for _, label in lessons) for k in (0, 1)}
    has: dict[str, list[int]] = {}
    for text, label in lessons:
        for token in {t for raw in text.split() for w in toxicity.WORD.findall(raw.lower()) for t in toxicity.tokens_of(w)}:
            has.setdefault(token, [0, 0])[label] += 1
    share = {k: toxicity.PRIOR * texts[k] / sum(texts.values()) for k in (0, 1)}
    odds = lambda n, k: np.log((n[k] + share[k]) / max(texts[k] + toxicity.PRIOR - n[k] - share[k], 0.5))
    every = {}
    for token, n in has.items():
        delta = odds(n, 1) - odds(n, 0)
        sure = abs(delta) - toxicity.SURE * np.sqrt(1 / (n[1] + share[1]) + 1 / (n[0] + share[0]))
        if sure > 0.01:
            every[token] = min(np.sign(delta) * sure, toxicity.MOST)

    def word_score(raw: str) -> float:
        found = [every[t] for w in toxicity.WORD.findall(raw.lower()) for t in toxicity.tokens_of(w) if t in every]
        best = max(found, key=abs, default=0.0)
        return best if best > 0 else -toxicity.GAP

    assert sum(s > 0 for s in every.values()) == sum(s > 0 for s in model.lexicon.values()) > 20
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, labels).collect()}
    assert set(got) == set(rows)
    for i, text in rows.items():
        values = np.array([word_score(w) for w in text.split()])
        sums, low, best = 0.0, 0.0, 0.0
        for v in values:  # the best segment's sum, by the smallest sum before each end
            sums += v
            low, best = min(low, sums), max(best, sums - min(low, sums))
        assert got[i].n_words == len(values) and got[i].best == pytest.approx(best, abs=1e-6), i
        evidence = model.rate * best - np.log1p(toxicity.K * len(values))
        terms = [evidence, np.log1p(got[i].n_segments), np.log1p(len(values)), min(best, toxicity.MOST)]
        assert got[i].score == pytest.approx(1 / (1 + np.exp(-(np.dot(terms, model.weights[:-1]) + model.weights[-1]))), abs=1e-6)


def test_quality_samples_pass_over_what_does_not_fit(spark):
    assert quality.fitting([5, 0, 90, 3, 4, 2], 10) == [0, 3, 5]
    assert quality.fitting([100], 10) == [] and quality.fitting([], 10) == []
    rows = [(i, "x" * (9000 if i % 3 == 0 else 10 + i)) for i in range(200)] + [(7, "another text of that id"), (7, "another text of that id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    ids = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, label int")
    samples = quality.class_samples(docs, ids, limit=5000)
    assert all(200 < sum(map(len, s)) <= 5000 and max(map(len, s)) < 9000 for s in samples.values())
    seen = {s for k in samples for s in samples[k]}
    teach = {r.doc_id for r in ids.where(quality.teaches()).collect()}
    assert seen == {t.encode() for i, t in rows if i in teach and len(t) < 9000}


def test_quality_scores_equal_a_plain_version(spark):
    """Sizes by the library's one-shot compressor with the same dictionaries, and the regression's formula on them."""
    import zstandard

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", quality.text_or_empty().alias("text"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    samples = quality.class_samples(docs, quality.labelled_ids(labels, "quality", quality.FIT_ROWS))
    packers = [zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(quality.dictionary(samples[k]))) for k in (1, 0)]
    packers.append(zstandard.ZstdCompressor(level=quality.LEVEL))
    known = {r.doc_id: r.label for r in quality.labelled_ids(labels, "quality", quality.FIT_ROWS).where(~quality.teaches()).collect()}
    table = {}
    for r in docs.collect():
        text = r.text.encode()
        g, b, p = (len(c.compress(text)) for c in packers)
        each = len(text) + 20
        d, g, b, p, n = (b - g) / max(b, g), g / each, b / each, p / each, np.log1p(len(text))
        table[r.doc_id] = [d, g, b, p, n, d * d, g * g, b * b, p * p, n * n, d * n, g * n, b * n, p * n]
    fit = [(known[i], t) for i, t in table.items() if i in known]
    weights = fit_logistic(np.array([t for _, t in fit]), np.array([float(label) for label, _ in fit]))
    for r in quality.quality_scores(docs, labels).collect():
        want = 1 / (1 + np.exp(-np.clip(np.dot(table[r.doc_id], weights[:-1]) + weights[-1], -700, 700)))
        assert r.score == pytest.approx(want, abs=1e-4), r.doc_id


def test_logistic_fit_is_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40000, 2)) * [3, 0.1]
    p = 1 / (1 + np.exp(-(0.7 * x[:, 0] - 4 * x[:, 1] + 0.3)))
    w = fit_logistic(x, (rng.random(40000) < p).astype(float), ridge=1e-6)
    assert np.abs(w - [0.7, -4, 0.3]).max() < 0.6


def test_logistic_fit_settles_on_nearly_parted_classes():
    """Many terms made of few, and classes that a line parts but for two rows: weights stay bounded and the slope is flat."""
    rng = np.random.default_rng(1)
    a = np.concatenate([rng.normal(-0.2, 0.15, 900), rng.normal(0.25, 0.1, 5000)])
    b = np.concatenate([rng.normal(0.3, 0.1, 900), rng.normal(0.5, 0.02, 5000)])
    y = np.concatenate([np.zeros(900), np.ones(5000)])
    y[[3, 2000]] = 1 - y[[3, 2000]]
    x = np.column_stack([a, b, a * a, b * b, a * b, a**3, np.exp(b)])
    w = fit_logistic(x, y)
    p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -700, 700)))
    z = np.column_stack([(x - x.mean(axis=0)) / (x.std(axis=0) + 1e-9), np.ones(len(x))])
    own = np.append(w[:-1] * (x.std(axis=0) + 1e-9), w[-1] + w[:-1] @ x.mean(axis=0))
    assert np.abs(z.T @ (y - p) - 1e-2 * own).max() < 1e-3
    assert ((p >= 0.3) == y).mean() > 0.99


def brute_neighbours(vectors, queries, k):
    ids = np.array(sorted(vectors))
    data = np.array([vectors[i] for i in ids], np.float64)
    out = {}
    for q in queries:
        s = data @ data[np.searchsorted(ids, q)]
        order = [i for i in np.lexsort((ids, -np.round(s, 12))) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def test_neighbours_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 10)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), 0, "z") for i in range(300)]
    rows += [(1000 + i, [1.0] * 8, 0, "z") for i in range(120)]  # a hot vector, with ties
    good = {r[0]: r[1] for r in rows}
    rows += [(2000, None, 0, "z"), (2001, [0.0] * 8, 0, "z"), (2002, [1.0, None] + [1.0] * 6, 0, "z"), (2003, [float("nan")] * 8, 0, "z")]
    rows += [(2004, [float("inf")] + [1.0] * 7, 0, "z"), (2005, [1.0] * 3, 0, "z"), (None, [1.0] * 8, 0, "z"), (0, good[0], 0, "z")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, leaf int, rank string").repartition(4)
    out = neighbours.search(table, F.col("vec_id") % 20 == 0, k=20, target=1.0).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute_neighbours(good, [i for i in good if i % 20 == 0], 20)
    assert set(got) == set(want)
    hit = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want) / sum(map(len, want.values()))
    assert hit > 0.95
    for q in (1000, 1020):
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]
    for q, found in got.items():
        assert all(abs(s - float(np.dot(np.float64(good[q]), np.float64(good[v])))) < 1e-12 for v, s in found)
    assert neighbours.search(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.search(table.where("vec_id < 5"), F.col("vec_id") == 0).count() == 4


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors = {r.vec_id: r.embedding for r in rows}
    want = brute_neighbours(vectors, [i for i in vectors if i % 20 == 0], 20)
    got = {}
    for r in neighbours.op3_kmeans_tree(spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = sum(len(got[q] & {v for v, _ in want[q]}) for q in want) / sum(map(len, want.values()))
    assert hit >= 0.9, hit
