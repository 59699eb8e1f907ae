"""Joins of similar documents and vectors against brute force, with every odd kind of row."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orewright.llm import base, embedding_pairs, ngram_join
from orewright.llm.base import components
from orewright.llm.embedding_pairs import embedding_links
from orewright.llm.ngram_join import ngram_jaccard_join, prefix_length

from .conftest import odd_texts, words


def groups(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    links = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    comp = groups(sets, links)
    return {i: (len(sets[i]), comp[i]) for i in sets}


def test_join_equals_brute_force_on_odd_rows(odd_docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_join(odd_docs).collect()}
    assert got == brute(dict(enumerate(odd_texts())))


def test_join_finds_pairs_at_the_threshold_across_groups(ready):
    """Chains and groups whose members are just above and just below three quarters, sharing a passage."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    passage, texts = [word() for _ in range(30)], {}
    for family in range(12):
        base = passage + [word() for _ in range(60)]
        for _ in range(8):
            new = list(base)
            for at in draw.sample(range(len(new)), draw.randint(0, 4)):
                new[at] = word()
            texts[len(texts)] = " ".join(new)
    docs = ready.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_join(docs).collect()}
    want = brute(texts)
    assert got == want
    assert len({c for _, c in want.values()}) > 12  # some of a family are apart


def test_join_of_nothing(ready):
    assert ngram_jaccard_join(ready.createDataFrame([], "doc_id long, text string")).count() == 0


def test_prefix_length_is_enough():
    for n in range(1, 60):
        for m in range(n, 80):
            least = next((i for i in range(n + 1) if 100 * i >= 75 * (n + m - i)), None)
            if least is not None:  # a set that misses its whole prefix shares too few
                assert n - prefix_length(n) < least and m - prefix_length(m) < least


def test_several_orders_are_used():
    assert ngram_join.ORDERS >= 3
    tokens = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sketch = np.ones(1 << ngram_join.SKETCH_BITS, np.uint16)
    seeds = ngram_join._seeds(3)
    prefixes = [set(ngram_join.ordered_prefix(tokens, sketch, s)) for s in seeds]
    assert prefixes[0] != prefixes[1] != prefixes[2]
    sketch[ngram_join._slots(tokens[:5])] = 1000  # what is common comes last
    assert not set(tokens[:5]) & set(ngram_join.ordered_prefix(tokens, sketch, seeds[0]))


def test_components_of_a_path_and_a_hub(ready):
    links = [(i, i + 1) for i in range(30)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5)]
    draw = random.Random(2)
    links = [(a, b) if draw.random() < 0.5 else (b, a) for a, b in links]
    got = {r.id: r.component for r in components(ready.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(31), 0), **dict.fromkeys(range(1000, 1050), 1000)}


def test_components_take_no_step_beyond_stars(ready, monkeypatch):
    steps, own = [], base._small_star
    monkeypatch.setattr(base, "_small_star", lambda edges: steps.append(1) or own(edges))
    for links, most in (([], 0), ([(1, 2), (3, 1), (8, 9), (5, 5), (2, 1)], 0), ([(1, 3), (2, 3)], 1)):
        steps.clear()
        got = {r.id: r.component for r in components(ready.createDataFrame(links, "a long, b long")).collect()}
        assert got == {i: c for i, c in groups({i for x in links for i in x if x[0] != x[1]}, links and [x for x in links if x[0] != x[1]]).items()}
        assert len(steps) <= most


def vectors(draw, n, d):
    centers = draw.normal(size=(6, d))
    rows = []
    for i in range(n):
        v = centers[draw.integers(6)] + draw.normal(size=d) * draw.choice([0.02, 0.08, 0.12, 1.0])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(draw.integers(2))))
    return rows


@pytest.mark.parametrize("tile", [16, 1024])
def test_vector_links_equal_brute_force(ready, tile):
    rows = vectors(np.random.default_rng(1), 150, 12)
    rows += [(150 + k, rows[3][1], rows[3][2]) for k in range(20)]  # copies
    rows += [
        (200, None, 0), (201, [0.0] * 12, 0), (202, [1.0, None] + [0.0] * 10, 0), (203, [float("nan")] + [1.0] * 11, 0),
        (204, [float("inf")] + [1.0] * 11, 0), (205, rows[3][1], None), (206, [], 0), (207, [2.0], 0), (208, [3.0], 0), rows[0],
        (None, rows[0][1], 0),
    ]
    got = {
        r.vec_id: (r.n_links, r.component_id, r.kept)
        for r in embedding_links(ready.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("n", F.lit(1)), tile=tile).collect()
    }
    usable = {
        i: (np.array(v), lab) for i, v, lab in rows
        if i is not None and v and lab is not None and None not in v and np.isfinite(v).all() and any(v)
    }
    links = [
        (a, b) for a, b in itertools.combinations(sorted(usable), 2)
        if usable[a][1] == usable[b][1] and len(usable[a][0]) == len(usable[b][0])
        and usable[a][0] @ usable[b][0] / np.sqrt((usable[a][0] @ usable[a][0]) * (usable[b][0] @ usable[b][0])) >= embedding_pairs.COSINE
    ]
    ids = {r[0] for r in rows if r[0] is not None}
    comp = groups(ids, links)
    degree = dict.fromkeys(ids, 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    assert got == {i: (degree[i], comp[i], comp[i] == i) for i in ids}
    assert len(links) > 200


def test_vectors_of_nothing(ready):
    assert embedding_links(ready.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_vectors_of_extreme_components(ready):
    """Cosines do not depend on length: squares that over- or underflow, and subnormal components."""
    base = [3.0, 4.0, 12.0, 0.5]
    lengths = [1.0, 1e-200, 1e200, 1e-320, 1.4e307, 7e-310]
    rows = [(i, [x * s for x in base], "a") for i, s in enumerate(lengths)]
    rows += [(10 + i, [-x * s for x in base], "a") for i, s in enumerate(lengths)]
    rows += [(30, [1e200, 0.0], "b"), (31, [2e200, 0.0], "b"), (32, [0.0, 1e-300], "b"), (33, [5e-324, 0.0], "b"), (34, [1e300, 1e-300], "b")]
    found = embedding_links(ready.createDataFrame(rows, "vec_id long, embedding array<double>, label string"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in found.collect()}
    assert {i: got[i] for i in range(6)} == dict.fromkeys(range(6), (5, 0))
    assert {i: got[i] for i in range(10, 16)} == dict.fromkeys(range(10, 16), (5, 10))
    assert got[30] == got[31] == got[33] == got[34] == (3, 30) and got[32] == (0, 32)
