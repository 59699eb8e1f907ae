"""A hidden Markov language model of documents, trained by Baum-Welch over all training texts.

Latent states emit word classes, classes emit words. The ``TOP`` most frequent words are classes of their own, all
others fall into classes by their last two bytes; a class gives its words their counts plus one, and one
more share to words never seen. The probability of a text is that of its class sequence, summed over all paths of
states by the scaled forward recursion, times that of each word in its class, with an end behind the last word.
It is exact, and the texts' probabilities sum to one over unseen words taken together.

Counts of words are summed over all training texts by Spark and never leave it: chunks of documents ask for
the counts of their own words by a join, and only counts that differ from a chunk's own go back. Expected
counts of transitions and emissions are summed per task and then by Spark; the driver holds tables of states by
classes, the same size for any corpus. A first guess comes from how often two classes stand ``GAPS`` places apart
in all training texts, at most ``CLASSES`` squared counts: states and moves are fitted to these pairs from several
random starts, and the one that explains them best goes on to whole sequences.

Long texts: training cuts sequences into runs of ``RUN`` tokens; scoring never does, it takes all texts of a slice
one token further at a time and, where only a few long ones go on, multiplies the transfer matrices of their runs.
A chunk's tokens are made once; what depends on a word alone is worked out once for each distinct word of the chunk.

Defined cases: a missing or empty text is an end alone. Rows without an id are training rows. Every row gives one row, also rows with
equal ids. Without training rows all words are unknown. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.llm.base import crc_of_id, stored
from orewright.llm.words import _FOLD, column_bytes, slices, word_spans

STATES = 6
TOP = 1000
TAILS = 1021
CLASSES = TOP + TAILS + 1  # and the end
END_CLASS = CLASSES - 1
END_WORD = np.uint64(0x0E4D)
ROUNDS = 2
RUN = 1024
FEW = 16
GAPS = (1, 4, 16)
STARTS = 8
CHUNK_CHARS = 12_000_000


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and tail of every token, ends included, and where each text's tokens begin."""
    data, offsets = column_bytes(column)
    hashes, tails, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for h, s, e in word_spans(data, offsets):
        last = _FOLD[data[e - 1]].astype(np.int64)
        before = np.where(e - s > 1, _FOLD[data[e - 2]], 0).astype(np.int64)
        hashes.append(h), starts.append(s), tails.append((last * 257 + before * 31) % TAILS)
    hashes, tails = np.concatenate(hashes), np.concatenate(tails)
    first = np.searchsorted(np.concatenate(starts), offsets)
    n = len(offsets) - 1
    begin = first + np.arange(n + 1)
    out_h, out_t = np.empty(len(hashes) + n, np.uint64), np.empty(len(hashes) + n, np.int64)
    ends = np.zeros(len(out_h), bool)
    ends[begin[1:] - 1] = True
    out_h[ends], out_t[ends] = END_WORD, -1
    out_h[~ends], out_t[~ends] = hashes, tails
    return out_h, out_t, begin


def _distinct(hashes: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of tokens, their tails, and which of them each token is."""
    coded = pa.array(hashes).dictionary_encode()
    words, at = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    of_words = np.empty(len(words), np.int64)
    of_words[at] = tails
    return words, of_words, at


def _classes(hashes: np.ndarray, tails: np.ndarray, top: np.ndarray) -> np.ndarray:
    """Class of every token; ``top`` holds the sorted hashes of the words that are classes of their own."""
    words, tails, each = _distinct(hashes, tails)
    return _word_classes(words, tails, top)[each]


def _word_classes(words: np.ndarray, tails: np.ndarray, top: np.ndarray) -> np.ndarray:
    out = TOP + tails
    if len(top):
        at = np.minimum(np.searchsorted(top, words), len(top) - 1)
        found = top[at] == words
        out[found] = at[found]
    out[tails < 0] = END_CLASS
    return out


class Chain:
    """States' start, moves and emissions of classes."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, np.ascontiguousarray(emit.T)  # class by state

    @classmethod
    def from_counts(cls, start, move, emit) -> Chain:
        norm = lambda x: x / x.sum(-1, keepdims=True)
        return cls(norm(start + 0.1), norm(move + 0.1), norm(emit + 0.01))

    def _steps(self, seen: np.ndarray, begin: np.ndarray):
        """Sequences by length, longest first, and their begins; how many have a token at each step, and what emits these, states by sequences."""
        length = np.diff(begin)
        order = np.argsort(-length, kind="stable")
        at, emit = begin[:-1][order], np.ascontiguousarray(self.emit.T)
        alive = np.searchsorted(-length[order], -np.arange(1, (length[order[0]] if len(order) else 0) + 1), "right")
        return order, at, alive, lambda t: emit.take(seen[at[: alive[t]] + t], 1)

    def _step(self, now: np.ndarray | None, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States by sequences one token further, scaled to sum to one, and what they summed to; sequences that ended are left out."""
        now = (self.start[:, None] if now is None else self.move.T @ now[:, : emit.shape[1]]) * emit
        total = now.sum(0)
        now /= total
        return now, total

    def counts(self, seen: np.ndarray, begin: np.ndarray):
        """Expected starts, moves and emissions over sequences, and their log likelihood."""
        k = len(self.start)
        _, at, alive, emitted = self._steps(seen, begin)
        place = np.concatenate([[0], np.cumsum(alive)])  # of each step's first token where steps follow each other
        alpha, scale, now = np.empty((k, len(seen))), np.empty(len(seen)), None
        for t, m in enumerate(alive):
            now, total = self._step(now, emitted(t))
            alpha[:, place[t] : place[t] + m], scale[place[t] : place[t] + m] = now, total
        moves, beta = np.zeros((k, k)), np.ones((k, len(at)))
        for t in range(len(alive) - 1, 0, -1):  # alpha becomes the states' weights, from the last step back
            m = alive[t]
            here, after = slice(place[t - 1], place[t - 1] + m), slice(place[t], place[t] + m)
            back = emitted(t)
            back *= beta[:, :m]
            back /= scale[after]
            moves += alpha[:, here] @ back.T
            alpha[:, after] *= beta[:, :m]
            beta[:, :m] = self.move @ back
        alpha[:, : len(at)] *= beta
        by_step = np.concatenate([np.zeros(0, np.int64), *(seen[at[:m] + t] for t, m in enumerate(alive))])
        emits = np.stack([np.bincount(by_step, weights, CLASSES) for weights in alpha])
        return alpha[:, : len(at)].sum(1), moves * self.move, emits, float(np.log(scale).sum())

    def log10_likelihoods(self, seen: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Of each sequence, exactly. Once fewer than ``FEW`` go on, and for more than ``RUN`` tokens, they go by products of transfer matrices."""
        order, at, alive, emitted = self._steps(seen, begin)
        sums, now = np.zeros(len(order)), None
        for t, m in enumerate(alive):
            if 0 < t < len(alive) - RUN and m < FEW:
                for i in range(m):
                    sums[i] += self._long(now[:, i], seen[at[i] + t : begin[order[i] + 1]])
                break
            now, total = self._step(now, emitted(t))
            sums[:m] += np.log10(total)
        out = np.empty(len(order))
        out[order] = sums
        return out

    def _long(self, now: np.ndarray, rest: np.ndarray) -> float:
        """What a sequence's further tokens add, from its states before them."""
        k, n = len(self.start), len(rest)
        run = max(64, math.isqrt(n))
        runs = n // run
        emit = np.ascontiguousarray(self.emit.T)
        made, logs, score = np.repeat(np.eye(k)[:, :, None], runs, 2), np.zeros(runs), 0.0  # state after, state before, run
        for t in range(run):
            made = (self.move.T @ made.reshape(k, -1)).reshape(k, k, runs)
            made *= emit.take(rest[t : runs * run : run], 1)[:, None, :]
            total = made.sum((0, 1))
            made /= total
            logs += np.log10(total)
        tails = ((self.move * self.emit[o]).T for o in rest[runs * run :])
        for matrix in itertools.chain(np.moveaxis(made, 2, 0), tails):
            now = matrix @ now
            total = float(now.sum())
            now, score = now / total, score + math.log10(total)
        return score + float(logs.sum())


def _runs(begin: np.ndarray) -> np.ndarray:
    """Boundaries with every sequence cut into runs of at most RUN tokens."""
    cuts = [np.arange(a, b, RUN) for a, b in zip(begin[:-1], begin[1:], strict=True)]
    return np.concatenate([*cuts, begin[-1:]])


def class_pairs(training: DataFrame, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How often a class stands some of ``GAPS`` places before a class in a text, and how often one begins a text, over all rows (text)."""
    cells = CLASSES * CLASSES
    shared = training.sparkSession.sparkContext.broadcast(top)

    def count(batches):
        total = np.zeros(cells + CLASSES, np.int64)
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                h, t, begin = _tokens(part.column(0))
                seen, text = _classes(h, t, shared.value), np.repeat(np.arange(len(begin) - 1), np.diff(begin))
                for gap in GAPS:
                    at = np.flatnonzero(text[gap:] == text[:-gap])
                    total[:cells] += np.bincount(seen[at] * CLASSES + seen[at + gap], minlength=cells)
                total[cells:] += np.bincount(seen[begin[:-1]], minlength=CLASSES)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["cell", "n"])

    counted = training.select("text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(cells + CLASSES)
    out[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    return out[:cells].reshape(CLASSES, CLASSES), out[cells:]


class _Pairs:
    """States fitted to counts of pairs by EM: the weight of every two states and what they emit."""

    def __init__(self, pairs: np.ndarray, seed: int):
        draw = np.random.default_rng(seed)
        self.pairs, base = pairs, pairs.sum(0) + 0.1
        self.both = (np.full((STATES, STATES), 0.05 / max(1, STATES - 1)) + 0.95 * np.eye(STATES)) / STATES
        self.emits = base * draw.gamma(2.0, 0.5, (STATES, CLASSES))
        self.moves = self.both * 1000

    def _emit(self) -> np.ndarray:
        return (self.emits + 0.01) / (self.emits + 0.01).sum(1, keepdims=True)

    def fit(self, steps: int) -> _Pairs:
        for _ in range(steps if self.pairs.any() else 0):
            emit = self._emit()
            after, before = self.both @ emit, self.both.T @ emit
            ratio = self.pairs / (emit.T @ after)
            self.moves = self.both * (emit @ ratio @ emit.T)
            self.emits = emit * (after @ ratio.T + before @ ratio)
            self.both = (self.moves + 0.1) / (self.moves + 0.1).sum()
        return self

    def log_likelihood(self) -> float:
        emit = self._emit()
        return float((self.pairs * np.log(emit.T @ self.both @ emit)).sum())

    def chain(self, first: np.ndarray) -> Chain:
        starts = self.both.sum(1)[:, None] * self._emit()
        return Chain.from_counts((starts / starts.sum(0) * first).sum(1), self.moves, self.emits)


def _start_chain(pairs: np.ndarray, first: np.ndarray) -> Chain:
    """States that stay, apart by chance at first, brought further apart by EM on the pairs; the best of several."""
    best, most = None, -math.inf
    for seed in range(STARTS):
        found = _Pairs(pairs, seed).fit(30)
        log = found.log_likelihood()
        if best is None or log > most:
            best, most = found, log
    return best.fit(70).chain(first)


class LanguageModel:
    """What every task needs to know: the chain, the top words, totals of words and of classes."""

    def __init__(self, chain: Chain, top: np.ndarray, tokens: int, words: int, class_tokens: np.ndarray, class_words: np.ndarray):
        self.chain, self.top, self.tokens, self.words = chain, top, tokens, words
        self.class_tokens, self.class_words = class_tokens, class_words


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, tail, n): counts of hashed words over the training rows (text, training), ends as a word with tail -1."""

    def count(batches):
        words, tails, sums = [], [], []

        def flush():
            w, at, inverse = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
            n = np.bincount(inverse, np.concatenate(sums)).astype(np.int64)
            t = np.concatenate(tails)[at]
            words.clear(), tails.clear(), sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(t, pa.int32()), pa.array(n)], ["word", "tail", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                h, t, _ = _tokens(part.column(0))
                w, t, each = _distinct(h, t)
                words.append(w), tails.append(t), sums.append(np.bincount(each, minlength=len(w)))
                if sum(map(len, words)) > 3_000_000:
                    yield flush()
        if words:
            yield flush()

    counted = docs.filter("training").select("text").mapInArrow(count, "word long, tail int, n long")
    return counted.groupBy("word", "tail").agg(F.sum("n").alias("n"))


def fit_language_model(docs: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> LanguageModel:
    top = counts.filter("tail >= 0").orderBy(F.desc("n"), "word").limit(TOP).toPandas()
    top_words = np.sort(top["word"].to_numpy(np.int64).view(np.uint64))
    class_tokens, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():  # at most TAILS + 1 rows
        at = END_CLASS if r["tail"] < 0 else TOP + r["tail"]
        class_tokens[at], class_words[at] = r["n"], r["v"]
    tokens, words = int(class_tokens.sum()), int(class_words.sum())
    for word, tail, n in zip(top["word"].to_numpy(np.int64).view(np.uint64), top["tail"], top["n"], strict=True):
        class_tokens[TOP + tail] -= n
        class_words[TOP + tail] -= 1
        at = np.searchsorted(top_words, word)
        class_tokens[at], class_words[at] = n, 1

    training = docs.filter("training")
    chain = _start_chain(*class_pairs(training, top_words))
    for _ in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast((chain, top_words))

        def expect(batches, shared=shared):
            chain, top_words = shared.value
            total = None
            for batch in batches:
                for part in slices(batch, "text", 8 << 20):
                    h, t, begin = _tokens(part.column(0))
                    found = np.concatenate([x.ravel() for x in chain.counts(_classes(h, t, top_words), _runs(begin))[:3]])
                    total = found if total is None else total + found
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["cell", "value"])

        cells = training.select("text").mapInArrow(expect, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
        total = np.zeros(STATES + STATES * STATES + STATES * CLASSES)
        total[cells["cell"].to_numpy(int)] = cells["value"]
        start, move, emit = np.split(total, [STATES, STATES + STATES * STATES])
        chain = Chain.from_counts(start, move.reshape(STATES, STATES), emit.reshape(STATES, CLASSES))
    return LanguageModel(chain, top_words, tokens, words, class_tokens, class_words)


def language_scores(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, a row for each document."""
    spark = docs.sparkSession
    held = F.coalesce(crc_of_id(F.col("doc_id").cast("long")) % 7 == 2, F.lit(False))
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), (~held).alias("training")
    )
    counts = stored(word_counts(docs), "words")
    model = spark.sparkContext.broadcast(fit_language_model(docs, counts, rounds))

    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(chars / CHUNK_CHARS))
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int")).repartition(
        max(chunks, int(spark.conf.get("spark.sql.shuffle.partitions"))), "chunk"
    )

    def own_words(group: pa.Table) -> pa.Table:
        words, _, known, _ = _own_counts(group)
        chunk = group["chunk"][0].as_py()
        return pa.table({"chunk": pa.array(np.full(len(words), chunk, np.int32)), "word": words.view(np.int64), "own": known})

    def score(key, group: pa.Table, others: pa.Table) -> pa.Table:
        return _scored(group, others, model.value)

    asked = dealt.groupBy("chunk").applyInArrow(own_words, "chunk int, word long, own long")
    answered = asked.join(counts.select("word", "n"), "word").filter("n <> own").select("chunk", "word", "n")
    return dealt.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def _parts(group: pa.Table):
    for batch in group.select(["text", "doc_id", "training"]).combine_chunks().to_batches():
        yield from slices(batch, "text", 8 << 20)


def _own_counts(group: pa.Table):
    """A chunk's distinct words, their tails and how often its training rows have each; its parts as (rows, their distinct words'
    places among the chunk's, which of them each token is, where each row's tokens begin)."""
    parts, words, tails, sums = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for part in _parts(group):
        h, t, begin = _tokens(part.column(0))
        w, t, each = _distinct(h, t)
        training = np.repeat(part.column(2).to_numpy(zero_copy_only=False), np.diff(begin))
        parts.append((part, each, begin))
        words.append(w), tails.append(t), sums.append(np.bincount(each, training, len(w)))
    words, at, merged = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
    known = np.bincount(merged, np.concatenate(sums), len(words)).astype(np.int64)
    places = np.split(merged, np.cumsum([len(x) for x in sums[1:]]))
    return words, np.concatenate(tails)[at], known, [(part, w, each, begin) for w, (part, each, begin) in zip(places, parts, strict=False)]


def _scored(group: pa.Table, others: pa.Table, model: LanguageModel) -> pa.Table:
    words, tails, n, parts = _own_counts(group)
    if len(others) and len(words):
        n[np.searchsorted(words, others["word"].to_numpy().view(np.uint64))] = others["n"].to_numpy()
    classes = _word_classes(words, tails, model.top)
    bases = np.log10((n + 1) / (model.tokens + model.words + 1))
    insides = np.where(classes == END_CLASS, 0.0, np.log10((n + 1) / (model.class_tokens[classes] + model.class_words[classes] + 1)))
    out = []
    for part, w, each, begin in parts:
        known, seen, base, inside = (n > 0)[w][each], classes[w][each], bases[w][each], insides[w][each]
        at = begin[:-1]
        out.append(
            pd.DataFrame(
                {
                    "doc_id": part.column(1).to_pandas(integer_object_nulls=True), "held_out": ~part.column(2).to_numpy(zero_copy_only=False),
                    "n_tokens": np.diff(begin), "n_known": np.add.reduceat(known.astype(np.int64), at), "train_tokens": model.tokens,
                    "base_score": np.add.reduceat(base, at), "score": np.add.reduceat(inside, at) + model.chain.log10_likelihoods(seen, begin),
                }
            )
        )
    schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
         ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )
    return pa.concat_tables([pa.Table.from_pandas(x, schema, preserve_index=False) for x in out]) if out else schema.empty_table()
