"""Models of texts: exact likelihoods, held-out accuracy, and every odd kind of row."""

import collections
import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orewright.llm import language_model as lm
from orewright.llm.labelled import training_rows
from orewright.llm.language_model import language_scores
from orewright.llm.quality import quality
from orewright.llm.toxicity import MOVES, PAYS, START, Grammar, toxicity
from orewright.llm.words import shingle_sets, slices

from .conftest import odd_texts, words


def held(doc_id, folds, at):
    return zlib.crc32(str(doc_id).encode()) % folds == at


def corpus(ready):
    """Documents in two languages of which some shout or insult, and their labels."""
    draw = random.Random(6)
    tongues = [["".join(draw.choice(a) for _ in range(draw.randint(2, 7))) for _ in range(200)] for a in ("abcde", "uvwxy")]
    docs, labels = [], []
    for i in range(500):
        w = [draw.choice(tongues[i % 2]) for _ in range(draw.randint(8, 60))]
        bad, toxic = i % 5 == 0, i % 4 == 0
        if bad:
            w = [x.upper() + "!!" for x in w] if i % 2 else [x for y in w for x in (y, "|")]
        if toxic:
            for _ in range(3):
                w[draw.randrange(len(w))] = draw.choice(["nitwit", "nitwits", "twerp"])
        docs.append((i, " ".join(w) + "."))
        labels.append((i, int(not bad), int(toxic)))
    odd = [(1000 + k, t) for k, t in enumerate(odd_texts())] + [(None, "no id"), docs[3]]
    labels += [(1001, None, 1), (1003, 7, None), (None, 1, 1), labels[2], (99999, 0, 0)]
    d = ready.createDataFrame(docs + odd, "doc_id long, text string").withColumn("label", F.lit(1)).withColumn("score", F.lit(2.0))
    return d, ready.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("x"))


@pytest.mark.parametrize("scorer, label", [(quality, "quality"), (toxicity, "toxic")])
def test_labels_are_learned(ready, scorer, label):
    docs, labels = corpus(ready)
    rows = scorer(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and held(r.doc_id, 5, 0)) for r in rows)
    want = {r.doc_id: r[label] for r in labels.filter("doc_id < 500").collect()}
    tested = [r for r in rows if r.doc_id in want and r.held_out]
    assert sum(r.predicted == want[r.doc_id] for r in tested) >= 0.97 * len(tested)
    once = {r.doc_id: (r.score, r.predicted) for r in rows}
    assert once == {r.doc_id: (r.score, r.predicted) for r in scorer(docs, labels).collect()}


@pytest.mark.parametrize("scorer", [quality, toxicity])
def test_without_labels_or_documents(ready, scorer):
    docs, labels = corpus(ready)
    assert len({r.score for r in scorer(docs.limit(5), labels.limit(0)).collect()}) == 1
    assert scorer(docs.limit(0), labels).count() == 0


def test_training_rows_leave_out_the_fold_and_keep_the_bound(ready):
    docs, labels = corpus(ready)
    rows = training_rows(docs, labels, "toxic", 50).collect()
    assert len({r.doc_id for r in rows}) == 50 and not any(held(r.doc_id, 5, 0) for r in rows)


def test_grammar_reads_clauses():
    g = Grammar({"twerp": 2.0, "nitw*": 1.5, "kill": 1.0})
    paid = lambda text: {a: round(v, 6) for a, v in g.clause(text.split(), [g.amount(t) for t in text.split()]).items()}
    assert paid("a twerp came") == {"outright": 2.0}
    assert paid("you are a twerp") == paid("twerp that you are") == {"targeted": 2.0}
    assert paid("he is not a twerp") == {"negated": 2.0}
    assert paid("not one of those who is a twerp") == {"outright": 2.0}
    assert paid("she said twerp") == {"reported": 2.0}
    assert paid('" nitwit " twerp') == {"reported": 1.5, "outright": 2.0}
    assert paid("i will kill you") == {"threat targeted": 1.0}
    assert g.features("") == [1.0] + [0.0] * (len(g.features("")) - 1)
    reached = {s for s, _ in MOVES}
    assert START in reached and len(reached) == 2 * 4 * 3 and {s for s, _ in PAYS} == reached


def test_forward_and_expected_counts_equal_sums_over_all_paths():
    draw = np.random.default_rng(0)
    k = lm.STATES
    chain = lm.Chain.from_counts(draw.random(k), draw.random((k, k)), draw.random((k, lm.CLASSES)))
    seen = draw.integers(0, lm.CLASSES, 4)
    total, moves, starts = 0.0, np.zeros((k, k)), np.zeros(k)
    for path in itertools.product(range(k), repeat=4):
        p = chain.start[path[0]] * chain.emit[seen[0], path[0]]
        for a, b, o in zip(path, path[1:], seen[1:]):
            p *= chain.move[a, b] * chain.emit[o, b]
        total += p
        starts[path[0]] += p
        for a, b in zip(path, path[1:]):
            moves[a, b] += p
    begin = np.array([0, 4])
    s, m, e, log = chain.counts(seen, begin)
    assert np.allclose(s, starts / total) and np.allclose(m, moves / total) and np.isclose(e.sum(), 4) and np.isclose(log, math.log(total))
    assert np.allclose(chain.log10_likelihoods(seen, begin), math.log10(total))
    long = draw.integers(0, lm.CLASSES, 3 * lm.RUN + 7)
    alpha, score = chain.start * chain.emit[long[0]], 0.0
    for o in long[1:]:
        score += math.log10(alpha.sum())
        alpha = (alpha / alpha.sum()) @ chain.move * chain.emit[o]
    assert np.isclose(chain.log10_likelihoods(long, np.array([0, len(long)]))[0], score + math.log10(alpha.sum()))


def test_training_raises_the_likelihood():
    draw = np.random.default_rng(1)
    seen = np.concatenate([draw.integers(0, 5, 300) + 10 * (i % 2) for i in range(20)])
    begin = np.arange(0, len(seen) + 1, 300)
    chain = lm.Chain.from_counts(np.ones(lm.STATES), np.ones((lm.STATES, lm.STATES)), draw.random((lm.STATES, lm.CLASSES)))
    logs = []
    for _ in range(8):
        *counts, log = chain.counts(seen, begin)
        chain = lm.Chain.from_counts(*counts)
        logs.append(log)
    assert all(b > a - 1e-6 for a, b in zip(logs, logs[1:]))


def test_language_scores_equal_counts_and_beat_them(ready, monkeypatch):
    docs, _ = corpus(ready)
    rows = language_scores(docs).collect()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    counts = collections.Counter()
    for i, t in texts:
        if i is None or not held(i, 7, 2):
            counts.update(words(t) + ["\0end"])
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter()
    for i, t in texts:
        w = words(t) + ["\0end"]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        want[i, i is not None and held(i, 7, 2), len(w), sum(counts[x] > 0 for x in w), n, round(base, 6)] += 1
    got = collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert got == want
    fresh = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 500]
    assert sum(r.score for r in fresh) > sum(r.base_score for r in fresh)
    assert all(r.score < 0 for r in rows)


def test_the_first_guess_counts_all_training_texts(ready):
    docs, _ = corpus(ready)
    many = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).crossJoin(ready.range(3).select(F.col("id").alias("copy")))
    many = many.unionByName(ready.createDataFrame([(7, "only here", 0)], "doc_id long, text string, copy long")).withColumn("training", F.lit(True))
    model = lm.fit_language_model(many, lm.word_counts(many), rounds=0)
    pairs, first = lm.class_pairs(many, model.top)
    want, want_first = np.zeros_like(pairs), np.zeros_like(first)
    for r in many.collect():
        h, t, _ = lm._tokens(pa.array([r.text], pa.large_string()))
        seen = lm._classes(h, t, model.top)
        for gap in lm.GAPS:
            np.add.at(want, (seen[:-gap], seen[gap:]), 1)
        want_first[seen[0]] += 1
    assert (pairs == want).all() and (first == want_first).all()
    # Every class that occurs behind or before another weighs more than what smoothing gives one that does not.
    occurs = (want.sum(0) + want.sum(1)) > 0
    assert model.chain.emit.max(1)[occurs].min() > 5 * model.chain.emit.max(1)[~occurs].max()
    logs = [lm._Pairs(pairs, 0).fit(steps).log_likelihood() for steps in (0, 5, 20)]
    assert logs[0] < logs[1] < logs[2]


def plain_log10(chain, seen):
    """Of one sequence, step by step."""
    now, score = chain.start * chain.emit[seen[0]], 0.0
    for o in seen[1:]:
        score += math.log10(now.sum())
        now = (now / now.sum()) @ chain.move * chain.emit[o]
    return score + math.log10(now.sum())


@pytest.mark.parametrize("lengths", [[], [1], [2, 1, 2], [lm.RUN + 2], [5, 3000, 40, 1, 2500, 64, 1100, 2 * lm.RUN + 1, 7], [9] * 40 + [3000] * 3 + [2000]])
def test_likelihoods_of_sequences_of_many_lengths(lengths):
    draw = np.random.default_rng(3)
    k = lm.STATES
    chain = lm.Chain.from_counts(draw.random(k), draw.random((k, k)), draw.random((k, lm.CLASSES)))
    seen, begin = draw.integers(0, lm.CLASSES, sum(lengths)), np.cumsum([0, *lengths])
    want = [plain_log10(chain, seen[a:b]) for a, b in itertools.pairwise(begin)]
    assert np.allclose(chain.log10_likelihoods(seen, begin), want, rtol=1e-12)
    starts, moves, emits, log = chain.counts(seen, begin)
    assert np.isclose(starts.sum(), len(lengths)) and np.isclose(moves.sum(), len(seen) - len(lengths))
    assert np.allclose(emits.sum(0), np.bincount(seen, minlength=lm.CLASSES)) and np.isclose(log / math.log(10), sum(want))


def test_a_chunk_is_cut_into_tokens_once(monkeypatch):
    texts = [t or "" for t in odd_texts()] + ["one two one", "two", "three one two"]
    training = [i % 3 > 0 for i in range(len(texts))]
    column = pa.array(texts, pa.large_string())
    group = pa.table({"doc_id": pa.array(range(len(texts))), "text": column, "training": training})
    draw = np.random.default_rng(4)
    k = lm.STATES
    chain = lm.Chain.from_counts(draw.random(k), draw.random((k, k)), draw.random((k, lm.CLASSES)))
    tokens = [lm._tokens(column[i : i + 1])[:2] for i in range(len(texts))]
    counts = collections.Counter(itertools.chain(*(h.tolist() for (h, _), use in zip(tokens, training) if use)))
    frequent = np.sort(np.array([w for w, _ in counts.most_common(6) if w != int(lm.END_WORD)], np.uint64))
    elsewhere = {int(tokens[-1][0][0]): 7, int(tokens[-2][0][0]): 5}
    counts.update(elsewhere)
    others = pa.table({"word": np.array(list(elsewhere), np.uint64).view(np.int64), "n": [counts[w] for w in elsewhere]})
    of_classes = draw.integers(50, 90, (2, lm.CLASSES)).astype(float)
    model = lm.LanguageModel(chain, frequent, 1000, 300, *of_classes)
    want = []
    for h, t in tokens:
        c = np.array([counts[w] for w in h.tolist()])
        classes = lm._classes(h, t, frequent)
        inside = sum(math.log10((n + 1) / (of_classes[:, x].sum() + 1)) for n, x in zip(c, classes) if x != lm.END_CLASS)
        want.append((len(h), (c > 0).sum(), np.log10((c + 1) / 1301).sum(), inside + plain_log10(chain, classes)))
    made = []
    cut = lm._tokens
    monkeypatch.setattr(lm, "slices", lambda batch, column, most: slices(batch, column, 300))
    monkeypatch.setattr(lm, "_tokens", lambda column: made.append(len(column)) or cut(column))
    found = lm._scored(group, others, model)
    assert found["doc_id"].to_pylist() == list(range(len(texts))) and len(made) > 2
    assert np.allclose(np.stack([found[c].to_numpy() for c in ("n_tokens", "n_known", "base_score", "score")], 1), want, rtol=1e-10)
    assert sum(made) == len(texts)


def test_language_scores_of_nothing(ready):
    assert language_scores(ready.createDataFrame([], "doc_id long, text string")).count() == 0
    assert language_scores(ready.createDataFrame([(5, None)], "doc_id long, text string")).count() == 1


def test_shingles_do_not_depend_on_segments(monkeypatch):
    texts = odd_texts()
    column = pa.array(texts)
    whole = [s.tolist() for s in shingle_sets(column)]
    monkeypatch.setattr("orewright.llm.words.SEGMENT", 64)
    assert [s.tolist() for s in shingle_sets(column)] == whole
    parts = [s.tolist() for b in slices(pa.RecordBatch.from_arrays([column], ["text"]), "text", 1000) for s in shingle_sets(b.column(0))]
    assert parts == whole
    for text, s in zip(texts, whole):
        w = words(text)
        assert len(s) == (len({tuple(w[i : i + 5]) for i in range(len(w) - 4)}) if len(w) >= 5 else bool(w))
