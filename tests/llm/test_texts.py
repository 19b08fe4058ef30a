"""Fingerprints, near duplicates, suffix dedup and licences against brute force."""

import hashlib
import random
import textwrap
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_samples import words
from pyspark.sql import functions as F
from quarterdeck.llm import components, fingerprint, induction, licenses, minhash, suffix
from quarterdeck.llm.anchors import Hasher, anchors
from quarterdeck.llm.bits import bitmap, passes
from quarterdeck.llm.shingles import Shingler


# fingerprints


def prints(texts):
    return fingerprint.Fingerprinter().fingerprints([t.encode() for t in texts])


def test_fingerprint_is_a_multiset_of_paragraphs():
    a, b, c, d = prints(["one two\nthree\n\nfour five six seven", "three\nfour five six seven\none two\n", "one two\nthree\nthree", "one two\nthree"])[0]
    assert a == b and c != d and a != c
    whole, part, line = prints(["p q r s\nx y z w\nx y z w", "x y z w\np q r s", "x y z w"])[0]
    assert fingerprint.combine(whole, deleted=line) == part and fingerprint.combine(part, inserted=line) == whole


def test_likeness_follows_shared_text():
    rng = random.Random(5)
    a, b = words(rng, 800), words(rng, 800)
    _, like = prints([a, a[: len(a) // 2] + b[: len(b) // 2], b, a])
    near = lambda i, j: fingerprint.likeness(like[[i]], like[[j]])[0]
    assert near(0, 3) == 1 and 0.35 < near(0, 1) < 0.65 and near(0, 2) < 0.25


def test_fingerprint_query_equals_brute_force(spark, odd_docs, odd_rows, tmp_path):
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = fingerprint.op2_multiset_fingerprints(spark, str(tmp_path)).collect()
    order = sorted(((d, t or "") for d, t, *_ in odd_rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = []
    for i, (d, t) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        half = len(t) // 2
        want.append((d, len(t), hashlib.sha256((t[: len(t) - half] + following[:half]).encode()).hexdigest()))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in out) == Counter(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    texts = {d: t for d, t, *_ in odd_rows if d not in (None, 412)}
    by = defaultdict(set)
    for r in out:
        if r.doc_id in texts:
            by[texts[r.doc_id] or ""].add(r.fingerprint)
    assert all(len(s) == 1 for s in by.values()) and len({next(iter(s)) for s in by.values()}) == len(by)


def test_fingerprints_of_one_and_no_rows(spark, no_docs):
    assert fingerprint.with_next(no_docs).count() == 0
    one = spark.createDataFrame([(7, "a b c d")], "doc_id long, text string")
    assert sorted((r.doc_id, r.extra) for r in fingerprint.with_next(one).collect()) == [(7, False), (7, True)]


# components, bitmaps


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(500, 500 + i) for i in range(1, 60)] + [(900, 900)]
    links += [(1000 + i, 1001 + i) for i in range(40)]
    parent = {x: x for p in links for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent if x != 900}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bitmap_never_loses_a_key(spark):
    keys = spark.range(500).select(F.xxhash64("id").alias("k"))
    bits = bitmap(keys, "k")
    there = np.array([r.k for r in keys.collect()], np.int64)
    other = np.array([r.k for r in spark.range(500, 5500).select(F.xxhash64("id").alias("k")).collect()], np.int64)
    assert passes(bits, there).all() and passes(bits, other).mean() < 0.01


# near duplicates


def brute_classes(rows):
    shingler, table, texts = Shingler(5), {}, defaultdict(list)
    for d, t, *_ in rows:
        _, h, n, keys = shingler.counted([t or ""])
        table[id_ := len(table)] = (d, dict(zip(h.tolist(), n.tolist(), strict=True)), keys[0])
        texts[d].append(id_)
    df = Counter(x for _, c, _ in table.values() for x in c)
    n = len(table)
    weigh = lambda c: {x: k * np.log1p(n / (df[x] + n)) for x, k in c.items()}
    parent = {d: d for d in texts if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    entries = [(d, weigh(c), k) for d, c, k in table.values() if d is not None]
    for i, (d, a, k) in enumerate(entries):
        for e, b, m in entries[i + 1 :]:
            both = sum(min(a[x], b[x]) for x in a.keys() & b.keys())
            union = sum(a.values()) + sum(b.values()) - both
            if k == m or (union and both / union >= 0.8):
                x, y = root(d), root(e)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in parent}


def test_near_duplicates_equal_brute_force(odd_docs, odd_rows):
    out = minhash.near_duplicates(odd_docs).collect()
    assert len(out) == len(odd_rows)
    assert {r.class_id for r in out if r.doc_id is None} == {None}
    assert {r.doc_id: r.class_id for r in out if r.doc_id is not None} == brute_classes(odd_rows)


def test_large_group_of_near_copies_with_a_chain(spark):
    """Copies that differ in more and more words from the first: a pivot links only some, the rest goes by later steps."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(400)]
    rows, text = [], list(base)
    for i in range(80):
        rows.append((i, " ".join(text), "en", "s"))
        text = list(text) if i % 4 else list(base)
        for _ in range(1 + i % 4):
            text[rng.randrange(400)] = f"n{rng.randrange(10**6)}"
    rows += [(1000 + i, words(rng, 100), "en", "s") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == brute_classes(rows)


def edited(seed: int, *changes: int) -> list[tuple]:
    """Documents 1, 2, ...: copies of 150 words, so many of them changed; 0.8 or more are alike only as the seed was chosen."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i, k in enumerate(changes):
        text = list(base)
        for p in rng.sample(range(150), k) if k else ():
            text[p] = f"n{rng.randrange(10**6)}"
        rows.append((i + 1, " ".join(text), "en", "s"))
    return rows


def test_a_chain_is_linked_when_its_pivots_leave_nothing_open(spark):
    """1-2 and 2-3 are linked, 1-3 is not; in every bucket of 2 and 3 the pivot is 1, and 3 is then open alone."""
    rows = edited(4883, 3, 0, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == brute_classes(rows) == {1: 1, 2: 1, 3: 1}


@pytest.mark.parametrize("seed", [8397, 9267])
def test_a_large_bucket_asks_for_no_second_band(spark, monkeypatch, seed):
    """2 and 3 are linked and share one band only, with 1, the pivot, which is linked to neither."""
    monkeypatch.setattr(minhash, "WORTH", 2.0)  # one turn only: the rest meets by fine keys
    rows = edited(seed, 4, 0, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == brute_classes(rows) == {1: 1, 2: 2, 3: 2}


def test_divided_buckets_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "WORTH", 2.0)
    rows = [(100 * g + d, *rest) for g in range(6) for d, *rest in edited(g, *range(1, 16), *range(1, 16))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == brute_classes(rows)


def counted_comparisons(spark, monkeypatch, n: int, unrelated: int) -> tuple[int, dict, list]:
    """Exact comparisons, classes and rows for n near copies of a text that is not there, and unrelated texts beside them."""
    rows = [(d, *rest) for d, *rest in edited(7, *[4] * n)]
    rng = random.Random(8)
    rows += [(10_000 + i, words(rng, 100), "en", "s") for i in range(unrelated)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    real, seen = minhash.compared, []

    def counting(pairs, texts, idf):
        pairs = minhash.staged(pairs, "counted")
        seen.append(pairs.count())
        return real(pairs, texts, idf)

    monkeypatch.setattr(minhash, "compared", counting)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    monkeypatch.setattr(minhash, "compared", real)
    return sum(seen), got, rows


@pytest.mark.parametrize("unrelated", [10, 400])
def test_comparisons_grow_with_the_group_not_with_its_square(spark, monkeypatch, unrelated):
    few, classes, rows = counted_comparisons(spark, monkeypatch, 200, unrelated)
    assert classes == brute_classes(rows)
    many, _, _ = counted_comparisons(spark, monkeypatch, 400, unrelated)
    assert few < 200 * 8 and many < 2.6 * few, (few, many)


def test_weighted_samples_agree_by_likeness():
    rng = np.random.default_rng(4)
    shingle = np.sort(rng.integers(0, 2**63, 400, dtype=np.uint64))
    a, b = rng.integers(1, 4, 400).astype(float), rng.integers(1, 4, 400).astype(float)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    sampler = minhash.WeightedSampler(1500)
    one, two = (sampler.sample(np.array([0, 400]), shingle, w) for w in (a, b))
    assert abs((one == two).mean() - want) < 0.05


def test_one_of_each_keeps_one_row_per_class(odd_docs, odd_rows):
    out = minhash.one_of_each(odd_docs)
    assert out.columns == odd_docs.columns
    kept = Counter(r.doc_id for r in out.collect())
    classes = brute_classes(odd_rows)
    assert {d for d in kept if d is not None} == set(classes.values())
    assert all(n == 1 for d, n in kept.items() if d is not None) and kept[None] == 2


def test_near_duplicates_of_nothing(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0 and minhash.one_of_each(no_docs).count() == 0


# suffix dedup


def brute_spans(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int)])))
        out.append([(int(b), int(e)) for b, e in zip(edge[0::2], edge[1::2], strict=True)])
    return out


@pytest.mark.parametrize("limit", [10**6, 7, 40])
def test_induced_sorting_marks_what_repeats(tmp_path, limit):
    rng, length, left = random.Random(limit), 6, 5
    for _ in range(8):
        pieces = []
        for g in range(3):
            for _ in range(rng.randint(1, 25)):
                anchor = rng.randint(0, left)
                pieces.append((g, bytes(rng.choices(b"\x00a\xff", k=rng.randint(1, anchor + 1) + length - 1)), anchor))
        shard = induction.Shard(left, length, str(tmp_path), limit)
        for p in pieces:
            shard.add(*p)
        marks = shard.repeated(length)
        count = Counter((g, a - o, p[o : o + length]) for g, p, a in pieces for o in range(len(p) - length + 1))
        for i, (g, p, a) in enumerate(pieces):
            for o in range(len(p) - length + 1):
                assert bool(marks[left - a + o][i]) == (count[g, a - o, p[o : o + length]] > 1)


def test_anchor_hashes_fill_a_bitmap_evenly():
    data = np.random.default_rng(5).integers(0, 256, 6_000_000, np.uint8).tobytes()
    hasher = Hasher()
    keys = np.unique(np.concatenate([anchors([data[at : at + 500_000]], 200, hasher)[1] for at in range(0, len(data), 500_000)]))
    places = np.unique(keys >> np.uint64(64 - 26))  # as bits.bitmap has them
    assert len(places) > 0.99 * len(keys)


def test_anchors_divide_the_starts():
    rng = random.Random(8)
    texts = [bytes(rng.choices(b"abc ", k=rng.randint(0, 900))) for _ in range(30)] + [b"ab" * 600, b""]
    of, _, spot, first, n = anchors(texts, 100, Hasher())
    for i, t in enumerate(texts):
        own = sorted((f, k) for o, f, k in zip(of, first, n, strict=True) if o == i)
        assert [s for f, k in own for s in range(f, f + k)] == list(range(max(0, len(t) - 99)))
    assert ((spot >= first + n - 1) & (spot + 64 <= first + 100)).all()


@pytest.mark.parametrize(("hot", "in_memory"), [(50_000, 1 << 15), (3, 1 << 15), (3, 8), (50_000, 8)])
def test_suffix_dedup_equals_brute_force(odd_docs, odd_rows, hot, in_memory):
    out = suffix.remove_repeats(odd_docs, hot=hot, in_memory=in_memory).collect()
    texts = [(t or "").encode() for _, t, *_ in odd_rows]
    want = Counter((d, t, tuple(s)) for (d, *_), t, s in zip(odd_rows, texts, brute_spans(texts, 200), strict=True))
    assert Counter((r.doc_id, bytes(r.text), tuple((s.begin, s.end) for s in r.spans or ())) for r in out) == want


def test_shared_passage_in_many_texts(spark):
    """One passage in many different texts makes one hot anchor; slices give the same result."""
    rng = random.Random(11)
    passage = words(rng, 70)
    rows = [(i, words(rng, 20) + " " + passage[i % 9 :] + " " + words(rng, 20), "en", "s") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    want = {r[0]: s for r, s in zip(rows, brute_spans([r[1].encode() for r in rows], 200), strict=True)}
    for hot in (5, 50_000):
        got = {r.doc_id: [(s.begin, s.end) for s in r.spans or ()] for r in suffix.remove_repeats(docs, hot=hot).collect()}
        assert got == want


def test_texts_are_cut_in_place(odd_docs, odd_rows):
    out = suffix.cut_texts(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == len(odd_rows)
    texts = [(t or "").encode() for _, t, *_ in odd_rows]
    left = Counter()
    for (d, t, *_), raw, spans in zip(odd_rows, texts, brute_spans(texts, 200), strict=True):
        kept, at = b"", 0
        for b, e in spans:
            kept, at = kept + raw[at:b], e
        left[d, None if t is None else (kept + raw[at:]).decode(errors="ignore")] += 1
    rows = out.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == left
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)


def workers_of_a_task(node, above=0):
    """The most Python nodes that one task runs through, with a worker each."""
    if "Adaptive" in node.nodeName():
        return workers_of_a_task(node.executedPlan(), above)
    above = 0 if node.nodeName().endswith("Exchange") else above + ("Arrow" in node.nodeName())
    below = node.children()
    inner = [node.plan()] if "QueryStage" in node.nodeName() else [below.apply(i) for i in range(below.size())]
    return max([above, *(workers_of_a_task(n, above) for n in inner)])


def test_cutting_holds_one_worker_a_task(odd_docs, odd_rows):
    out = suffix.cut_texts(odd_docs)
    planned = out._jdf.queryExecution()
    assert workers_of_a_task(planned.executedPlan()) == 1
    assert len(out.collect()) == len(odd_rows)  # the plan that ran: a small side is not broadcast after all
    assert workers_of_a_task(planned.executedPlan()) == 1


def test_spans_are_joined_in_little_memory():
    """Joined as by going through them one by one, without a Python object for each of a batch's spans."""
    rng = random.Random(12)
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def batch(rows, most, size):
        spans = [[(b := rng.randrange(size), b + rng.randrange(1, 260)) for _ in range(rng.randrange(most + 1))] for _ in range(rows)]
        column = pa.array([[{"begin": b, "end": e} for b, e in s] for s in spans], kind)
        return spans, pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int64())] * 2 + [column], names=["doc", "mark", "spans"])

    for _ in range(50):
        spans, rows = batch(rng.randrange(9), 12, 3000)
        want = []
        for each in spans:
            covered = {x for b, e in each for x in range(2 * b, 2 * e + 1)}  # doubled: spans that touch share a point
            edges = sorted(x for x in covered if x - 1 not in covered), sorted(x for x in covered if x + 1 not in covered)
            want.append([{"begin": b // 2, "end": e // 2} for b, e in zip(*edges, strict=True)])
        for part, expected in ((rows, want), (rows.slice(1), want[1:])):
            (got,) = suffix._joined([part])
            assert got.schema == rows.schema and got.column(2).to_pylist() == expected and got.column(0).equals(part.column(0))
    _, rows = batch(400, 400, 20_000)
    tracemalloc.start()
    try:
        list(suffix._joined([rows]))
        assert tracemalloc.get_traced_memory()[1] < 15 * rows.nbytes
    finally:
        tracemalloc.stop()


def test_suffix_dedup_of_nothing(no_docs):
    assert suffix.remove_repeats(no_docs).count() == 0 and suffix.cut_texts(no_docs).count() == 0


# licences


def test_licences_and_inheritance(spark):
    apache = licenses.TEMPLATES[3][1]
    rng = random.Random(6)
    files = [
        (1, "repo/LICENSE", apache),
        (2, "repo/src/a.py", words(rng, 50)),
        (3, "repo/src/deep/er/b.py", words(rng, 900) + "\nReleased under the MIT License.\n" + words(rng, 30)),
        (4, "repo/vendor/COPYING", "Licensed under CC BY-NC 4.0."),
        (5, "repo/vendor/x/c.py", "the of and is to under this work license"),
        (6, "other/d.py", words(rng, 20)),
        (7, "top.py", None),
        (8, None, ""),
        (9, "/repo/e.py", "x"),
        (2, "repo/src/a.py", words(rng, 50)),
    ] + [(100 + i, f"many/{i % 7}/f{i}", words(rng, 30)) for i in range(60)]
    table = spark.createDataFrame([(*f, "z", 1) for f in files], "file_id long, path string, text string, licence string, distance int")
    got = {r.file_id: (r.licence, r.origin, r.licence_directory, r.distance) for r in licenses.scan(table).collect()}
    assert got[1] == ("Apache-2.0", "own", None, None) and got[4] == ("CC-BY-NC-4.0", "own", None, None)
    assert got[2] == ("Apache-2.0", "inherited", "repo", 1)
    assert got[3] == ("MIT", "own", None, None)
    assert got[5] == ("CC-BY-NC-4.0", "inherited", "repo/vendor", 1)
    assert got[6] == got[7] == got[8] == got[9] == got[100] == (None, "none", None, None)
    assert licenses.scan(table.limit(0)).count() == 0


def test_telling_words_lose_no_candidate():
    """Cosines by dense vectors over all words, for random mixtures of template words and others."""
    rng = random.Random(3)
    frequencies = np.append(np.random.default_rng(1).integers(0, 900, licenses.CELLS), 1000)
    matcher = licenses.Matcher(frequencies)
    stock = [w for _, t in licenses.TEMPLATES for w in t.split()] + [f"zz{i}" for i in range(50)]
    vectors = [dict(zip(*map(np.ndarray.tolist, matcher.vector(t)), strict=True)) for _, t in licenses.TEMPLATES]
    norm = lambda v: sum(x * x for x in v.values()) ** 0.5
    for _ in range(300):
        line = rng.choice(licenses.TEMPLATES)[1].split() if rng.random() < 0.5 else []
        line = " ".join([w for w in line if rng.random() < 0.8] + rng.choices(stock, k=rng.randint(1, 12)))
        v = dict(zip(*map(np.ndarray.tolist, matcher.vector(line)), strict=True))
        best = max(sum(v[w] * t.get(w, 0) for w in v) / norm(v) / norm(t) for t in vectors)
        got = matcher.matches([line])[0]
        assert (got is not None) == (best >= licenses.COSINE) or abs(best - licenses.COSINE) < 1e-6
        assert got is None or abs(got[1] - best) < 1e-9


@pytest.mark.parametrize(
    ("line", "licence"),
    [
        ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
        ("Available under CC BY-SA 4.0.", "CC-BY-SA-4.0"),
        ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"),
        ("Licensed under CC BY-NC 3.0.", None),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
        ("Licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
        ("Licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
        ("Released under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
        ("This work is licensed under the GNU General Public License.", None),
        ("Released under the BSD License.", None),
        ("Released under the BSD 2-Clause License.", "BSD-2-Clause"),
        ("Released under the BSD 3-Clause License.", "BSD-3-Clause"),
        ("Released under the Apache License.", None),
        ("Released under the Apache License, Version 2.0.", "Apache-2.0"),
        ("Licensed under the Eclipse Public License, Version 2.0.", "EPL-2.0"),
        ("Licensed under the Eclipse Public License, Version 1.0.", None),
        ("Licensed under the EUPL, the European Union Public Licence, version 1.2.", "EUPL-1.2"),
        ("Licensed under the MIT License.", "MIT"),
        ("Licensed under the Mozilla Public License, version 1.1.", None),
    ],
)
@pytest.mark.parametrize("common", [0, 900])
def test_a_line_states_its_own_licence(line, licence, common):
    """With flat weights, and with stop words light."""
    frequencies = np.append(np.zeros(licenses.CELLS, np.int64), 1000)
    words_, _ = licenses.Matcher(frequencies).vector("under the a of and is to this by or in for with that")
    frequencies[licenses.cells(words_)] = common
    got = licenses.Matcher(frequencies).matches([line], stated=True)[0]
    assert (got and got[0]) == licence


def test_every_template_states_its_licence():
    matcher = licenses.Matcher(np.append(np.zeros(licenses.CELLS, np.int64), 1000))
    clauses = "\n2. Redistributions in binary form must reproduce the above copyright notice."
    name = "\n3. Neither the name of the copyright holder nor the names of its contributors may be used."
    for licence, text in licenses.TEMPLATES:
        if text.startswith("Redistribution"):
            assert matcher.matches([text], stated=True) == [None]
            text += clauses + (name if licence == "BSD-3-Clause" else "")
        assert matcher.matches([text], stated=True)[0][0] == licence


@pytest.mark.parametrize("width", [40, 50, 60, 72])
@pytest.mark.parametrize("common", [0, 900])
@pytest.mark.parametrize("prefix", ["", "# "])
def test_a_wrapped_header_before_code(width, common, prefix):
    """A notice over several lines, with code right after it, or between lines of code."""
    frequencies = np.append(np.zeros(licenses.CELLS, np.int64), 1000)
    words_, _ = licenses.Matcher(frequencies).vector("under the a of and is to this by or in for with that")
    frequencies[licenses.cells(words_)] = common
    matcher = licenses.Matcher(frequencies)
    code = [f"x{i} = call{i}(y{i})" for i in range(40)]
    for licence, text in licenses.TEMPLATES:
        if len(text) > 150 and not text.startswith("Redistribution"):
            header = [prefix + line for line in textwrap.wrap(text, width)]
            for lines, at in ((header + code, 0), (code + header + code, len(code))):
                got = matcher.matches(["\n".join(lines)], stated=True)[0]
                assert got is not None and got[0] == licence and got[1] > 0.9 and got[2] == at
