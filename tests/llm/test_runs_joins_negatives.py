"""Periodic runs, the Jaccard join and hard negatives against plain versions of their definitions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headway.llm import jaccard, negatives, periodic
from headway.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, runs string, item long, root long, best int, `a.b` string"


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    vocabulary = ["".join(draw.choice("abcdeéß") for _ in range(draw.randint(2, 8))) for _ in range(300)]

    def text(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    long, line = text(3000), text(40)
    out = [(i, text(draw.randint(1, 90))) for i in range(60)]
    out += [(100 + i, long) for i in range(3)] + [(110, long[:9000] + " Changed " + long[9000:])]
    out += [(120 + i, "\n".join([text(3), *[line] * i, text(3)])) for i in range(8)]
    out += [(130 + i, f"{line} {line} {text(2 + 8 * i)}") for i in range(6)]
    out += [(200, None), (201, ""), (202, " \t\n\r\x0b\x0c"), (None, text(30)), (203, "Two words"),
            (204, "two WORDS"), (205, "la " * 700), (206, "la la " * 30), (None, text(30))]
    out += [out[0], out[0], (0, "another text of the same number"), (0, None)]
    return [(i, t, "x", 7, 7, 7, "x") for i, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def counted(rows) -> Counter:
    return Counter(map(tuple, rows))


# periodic runs

def plain_runs(words: list, least: int = periodic.LEAST) -> list[tuple[int, int, int]]:
    smallest = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 3 * q):
                smallest.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in smallest.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id: int | None, words: list) -> list:
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest(doc_id: int | None, words: list) -> tuple:
    words = planted(doc_id, words)
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def test_runs_of_whole_texts_equal_a_plain_search(spark, tmp_path, docs, rows):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()
    expected = [digest(r[0], WORD.findall(r[1] or "")) for r in rows]
    assert counted(found) == counted(expected)
    assert sum(1 for e in expected if e[1]) > 5


@pytest.mark.parametrize("seed", range(8))
def test_runs_over_few_words(seed):
    draw = random.Random(seed)
    texts = []
    for _ in range(60):
        base = [draw.choice("abc"[:draw.randint(1, 3)]) for _ in range(draw.randint(1, 9))]
        words = []
        while len(words) < draw.randint(0, 140):
            words += base * draw.randint(1, 5)
            words += draw.choices("abx", k=draw.randint(0, 1))
            base = base[:draw.randint(1, len(base))] if draw.random() < 0.2 else base
        texts.append([w.encode() for w in words])
    for least in (24, 9):
        assert periodic.find_runs(texts, least) == {i: r for i, t in enumerate(texts)
                                                    if (r := plain_runs(t, least))}


def test_one_word_many_times_is_one_run_in_linear_time():
    assert periodic.find_runs([[b"a"] * 60_000]) == {0: [(0, 60_000, 1)]}
    varied = [w for i in range(1500) for w in (b"%d" % i, *[b"l%d" % j for j in range(20)])]
    assert periodic.find_runs([varied]) == {}  # one line behind 1,500 different words


# Jaccard join

def shingle_set(text: str | None) -> frozenset:
    parts = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(parts[i:i + 5]) for i in range(max(1, len(parts) - 4)) if parts)


def plain_groups(sets: list[frozenset]) -> list[int]:
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]) and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


def near_copies(seed: int) -> list[str]:
    """Texts beside copies with a few words changed, cut or added, and a chain drifting away."""
    draw = random.Random(seed)

    def word():
        return "".join(draw.choice("abcdefgh") for _ in range(6))

    texts = []
    for changes in (1, 2, 3, 4, 5, 6, 8) * 3:
        base = [word() for _ in range(draw.choice((30, 90, 200)))]
        texts.append(" ".join(base))
        for _ in range(3):
            copy = list(base)
            for at in draw.sample(range(len(base)), changes):
                copy[at] = word()
            texts.append(" ".join(copy[:draw.randint(len(base) * 3 // 4, len(base))]))
    for _ in range(60):
        base = list(base)
        base[draw.randrange(len(base))] = word()
        texts.append(" ".join(base))
    return texts


@pytest.mark.parametrize("block", [jaccard.BLOCK, 300])
def test_groups_equal_comparing_all(spark, rows, block):
    texts = [r[:2] for r in rows] + [(1000 + i, t) for i, t in enumerate(near_copies(4))]
    sets = [shingle_set(t) for _, t in texts]
    group = plain_groups(sets)
    expected = []
    for (i, _), s, g in zip(texts, sets, group):
        ids = [x[0] for x, y in zip(texts, group) if y == g and x[0] is not None]
        expected.append((i, len(s), min(ids, default=None) if s else i))
    frame = spark.createDataFrame([(*t, 1, 1, "x") for t in texts],
                                  "doc_id long, text string, n long, item long, root string")
    assert counted(jaccard.resembling(frame.repartition(4), block=block).collect()) == counted(expected)


def changed(count: int, changes: int) -> list[tuple[int, str]]:
    draw, out = random.Random(8), []
    for i in range(count):
        copy = [f"w{j}" for j in range(120)]
        for c, at in enumerate(draw.sample(range(120), changes)):
            copy[at] = f"x{i}-{c}"
        out.append((i, " ".join(copy)))
    return out


@pytest.mark.parametrize("changes, groups", [(1, 1), (4, None)])
def test_dense_families_move_rows_along_their_size(spark, monkeypatch, changes, groups):
    """Texts that all link, and texts that all share most of their shingles but never link."""
    links, moved = jaccard.spanning_links, []
    monkeypatch.setattr(jaccard, "_cell", lambda pdf: pdf[["item", "item"]].set_axis(["u", "v"], axis=1))
    for count in (150, 300, 600):
        sets = spark.createDataFrame([(i, t) for i, t in changed(count, changes)], "item long, text string")
        sets = sets.select("item", F.col("text").cast("binary").alias("text")).mapInArrow(
            jaccard._sets, "item long, tokens array<long>")
        moved.append(jaccard.links(sets).count())
    assert 100 <= moved[0] <= 150 and moved[1] <= 2.2 * moved[0] and moved[2] <= 2.2 * moved[1]
    texts = [jaccard.shingles(t.encode()) for _, t in changed(300, changes)]
    every = np.ones(len(texts), bool)
    found, roots = links(texts, [np.sort(t) for t in texts], every, every)
    expected = plain_groups([frozenset(t.tolist()) for t in texts])
    assert {int(u): int(v) for u, v in zip(found, roots)} == {
        i: g for i, g in enumerate(expected) if i != g}
    assert groups is None or len(set(expected)) == groups


def test_every_order_alone_keeps_all_links():
    draw = np.random.default_rng(2)
    base = draw.integers(0, 1 << 62, 400, dtype=np.uint64)
    one, other = np.sort(base[:380]), np.sort(base[20:])
    values, flat = np.unique(np.concatenate([one, other]), return_inverse=True)
    sets = jaccard.Ragged(flat, np.array([380, 380]))
    for order in jaccard.ORDERS:
        prefix = jaccard.first_tokens(sets, values, order)
        assert prefix.sizes.tolist() == [77, 77] and set(prefix[0]) & set(prefix[1])
    assert [jaccard.prefix_length(n) for n in (1, 4, 5, 6, 10)] == [1, 1, 2, 2, 3]


@pytest.mark.parametrize("seed", range(5))
def test_longer_prefixes_share_what_they_must(seed):
    draw = random.Random(seed)
    for _ in range(300):
        common = draw.sample(range(10 ** 6), draw.randint(1, 120))
        only = draw.randint(0, len(common) // 4)
        one = sorted(common + [10 ** 6 + i for i in draw.sample(range(only + 1), draw.randint(0, only))])
        other = sorted(common + [-1 - i for i in range(draw.randint(0, only))])
        if 5 * len(common) >= 4 * len({*one, *other}):
            a, b = (set(x[:jaccard.longer_prefix(len(x))]) for x in (one, other))
            assert len(a & b) >= jaccard.to_share(len(one)) and len(a & b) >= jaccard.to_share(len(other))


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_shared_tokens_are_found_across_batches(size):
    draw = random.Random(size)
    rows = sorted((draw.randrange(30), draw.randrange(4)) for _ in range(60))
    batches = [pa.RecordBatch.from_pydict({"token": [t for t, _ in rows[i:i + size]],
                                           "item": [x for _, x in rows[i:i + size]]})
               for i in range(0, len(rows), size)]
    found = {(r["token"], r["item"]): r["times"] for b in jaccard._counted(iter(batches))
             for r in b.to_pylist()}
    have = {}
    for t, x in rows:
        have.setdefault(t, set()).add(x)
    ends = {rows[0][0], rows[-1][0]}
    assert found == {(t, x): jaccard.MOST if t in ends else len(s) for t, s in have.items()
                     if t in ends or len(s) > 1 for x in s}


# hard negatives

def plain_negatives(vectors: list[tuple], scale: int = 256, every: int = 50) -> list[tuple]:
    width = max((len(e) for _, e, _ in vectors if e), default=0)
    usable = [(v, [int(np.floor(scale * x)) for x in e] + [0] * (width - len(e)), y) for v, e, y in vectors
              if None not in (v, e, y) and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for i, (a, q, label) in enumerate(usable):
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, r)), v, j, y) for j, (v, r, y) in enumerate(usable)
                        if j != i)
        for p, positive, _, _ in [s for s in scored if s[3] == label][:5]:
            good = [(v, -s) for s, v, _, y in scored if y != label and -50 * p <= -100 * s <= -95 * p][:3]
            out += [(a, positive, k + 1, v, -p, s) for k, (v, s) in enumerate(good)]
    return out


@pytest.mark.parametrize("settings", [{}, {"rows": 11, "anchors": 2}])
@pytest.mark.parametrize("shape", ["normal", "positive", "few"])
def test_negatives_equal_scoring_everything(spark, shape, settings):
    draw = np.random.default_rng(5)
    data = draw.normal(size=(120, 6)).round(1)
    if shape == "positive":
        data = np.abs(data) * np.array([9, 1, 0.1, 1, 0.5, 0])
    labels = draw.integers(0, 60 if shape == "few" else 3, 120)
    vectors = [(i, x.tolist(), int(y)) for i, (x, y) in enumerate(zip(data, labels))]
    vectors += [(150, [0.0] * 6, 1), (200, None, 1), (250, [1.0, None, 2.0, 0.0, 0.0, 0.0], 1),
                (300, [float("nan")] * 6, 1), (350, [1.0] * 6, None), (None, [1.0] * 6, 1),
                (400, [1.0, 2.0], 1), (50, vectors[50][1], vectors[50][2]), (450, [float("inf")] * 6, 2)]
    vectors += [vectors[0], (121, vectors[0][1], (vectors[0][2] + 1) % 3)]
    frame = spark.createDataFrame([(*v, 1, "x") for v in vectors],
                                  "vec_id long, embedding array<double>, label int, block int, asked string")
    found = negatives.hard_negatives(frame, F.col("vec_id") % 50 == 0, F.col("label"), **settings)
    assert counted(found.collect()) == counted(plain_negatives(vectors))


def test_the_index_reads_and_completes_a_part():
    draw = np.random.default_rng(6)
    rows = (draw.normal(size=(4000, 64)) * np.linspace(3, 0.1, 64) * 100).astype(np.int64)
    index = negatives.Index(rows)
    anchor = rows[17]
    search = negatives.Search(index, anchor)
    places, scores = search.at_least(0.6 * search.highest)
    exact = rows @ anchor
    expected = np.flatnonzero(exact >= 0.6 * search.highest)
    assert places.tolist() == expected.tolist() and scores.tolist() == exact[expected].tolist()
    assert search.entries < 0.3 * rows.size and search.completed < 0.2 * len(rows)
    entries = search.entries
    places, scores = search.at_least(0.2 * search.highest)  # goes on, reads nothing twice
    expected = np.flatnonzero(exact >= 0.2 * search.highest)
    assert places.tolist() == expected.tolist() and scores.tolist() == exact[expected].tolist()
    assert entries < search.entries <= rows.size


def test_anchors_read_whole_dimensions_together():
    draw = np.random.default_rng(7)
    rows = (draw.normal(size=(3000, 64)) * 200).astype(np.int64)
    index, ids = negatives.Index(rows), np.arange(3000)
    for own, tail in zip(range(40), negatives.tails(index, rows[:40])):
        exact = rows @ rows[own]
        exact[own] = exact.min()
        places, scores = negatives.best_positives(index, ids, rows[own], own, 5, tail)
        assert scores.tolist() == sorted(exact.tolist())[:-6:-1] == exact[places].tolist()
    assert 0 < index.head < 8 and not set(index.lists) - set(range(index.head))
    assert list(negatives.tails(index, rows[:2] * 10 ** 12)) == [None, None]  # not exact: each for itself


def test_scores_beyond_the_type_are_refused():
    huge = np.full((2, 2), 1 << 40, np.int64)
    with pytest.raises(ValueError, match="2\\^62"):
        negatives.Search(negatives.Index(huge), huge[0])


def test_empty_tables_give_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert periodic.periodic_runs(periodic.with_planted_runs(none)).count() == 0
    assert jaccard.resembling(none).count() == 0
    assert negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0, F.col("label")).count() == 0
