"""Mixing: the native plan against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

from quarterdeck.llm import mixing


def brute(rows, weights=mixing.WEIGHTS, budget=1.5, cap=2.0, seed=7):
    sizes = [(d, s, len(re.findall(mixing.WORD, t or ""))) for d, t, _, s in rows]
    per = defaultdict(int)
    for _, s, n in sizes:
        per[s] += n
    order = sorted(per, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, total = {}, budget * sum(per.values())
    left, rest = set(order), total
    while left:  # hold at the cap whatever is above it, until nothing is
        level = rest / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] >= cap * per[s]}
        if not over:
            target.update({s: level * weight[s] for s in left})
            break
        target.update({s: cap * per[s] for s in over})
        rest -= sum(cap * per[s] for s in over)
        left -= over
    out = []
    for s in order:
        share = target[s] / per[s] if per[s] else 0.0
        whole = int(share)
        pi, need, before = share - whole, target[s] - whole * per[s], 0
        u = lambda d: (int(hashlib.md5(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        for d, n in sorted(((d, n) for d, x, n in sizes if x == s), key=lambda r: (u(r[0]), r[0] is not None, r[0] or 0, r[1])):
            extra = pi > 1e-12 and before + n / 2 <= need + 1e-6
            before += n
            out.append((d, n, (whole + extra) * n))
    return Counter(out), target


def test_mix_equals_brute_force(odd_docs, odd_rows):
    got = mixing.mix(odd_docs).collect()
    want, target = brute(odd_rows)
    assert Counter((r.doc_id, r["size"], r.taken) for r in got) == want
    for r in got:
        assert abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        assert r.taken <= 2 * r["size"]
    assert abs(sum(target.values()) - 1.5 * sum(r["size"] for r in got)) < 1e-6


def test_targets_are_capped_and_reshared(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 10), ("d", 0)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got["a"] == 20 and got["c"] == 20 and got["d"] == 0 and abs(got["b"] - (1.5 * 1020 - 40)) < 1e-9


def test_hot_source_in_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    rows = [(i, "a b c d e f g"[: 1 + 2 * (i % 7)], "en", "hot" if i % 3 else f"s{i % 2}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    want, _ = brute(rows)
    assert Counter((r.doc_id, r["size"], r.taken) for r in mixing.mix(docs).collect()) == want


def test_rows_are_repeated_as_taken(odd_docs, odd_rows):
    copies = Counter()
    for r in mixing.mix(odd_docs).collect():
        copies[r.doc_id] += r.copies
    out = mixing.mixed_rows(odd_docs)
    assert out.columns == odd_docs.columns
    got = Counter(r.doc_id for r in out.select("doc_id").collect())
    assert got == Counter({d: n for d, n in copies.items() if n})


def test_mix_of_nothing(no_docs):
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_rows(no_docs).count() == 0
