"""Toxicity by a weighted finite-state pattern grammar over clauses.

A clause is cut into words, each read as a symbol: an insult or a threat (from a lexicon learned from labelled
texts, as whole words and as stems), a target (second person), a negation, a verb of reported speech, a
quotation mark, or any other word. Four small transducers read the symbols in step, and the grammar is their
composition: ``TARGET`` remembers that somebody is addressed, ``NEGATION`` covers the words behind a negation,
``REPORT`` covers what is quoted or told, and the last one pays out for every insult or threat, into the
account that the others' states name. A clause so gives amounts by account (said outright, at a target, negated,
reported), not a count of words. A document's score is a logistic function of its clauses' amounts, its
weights learned on at most ``labelled.SAMPLE`` labelled rows outside the held-out fold, as is the lexicon.

A word or stem enters the lexicon by the lower bound of its log odds between labels, which is also what it pays.

Defined cases: a missing or empty text pays nothing and has the base score. Without labels of both kinds all scores
are ``0.25``. Every row gives one row, also rows with equal ids or none. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orewright.llm.labelled import fit_logistic, held_out, training_rows
from orewright.llm.words import slices

CUT = 0.5
LEAST_WEIGHT = 1.0
LEXICON = 20_000
STEMS = (4, 5, 6)

# Words that shape a clause, in the languages of the corpus.
TARGETS = frozenset("you your yours u du dich dir dein deine ihr euch tu te toi ton ta vous votre usted tú ti tus su".split())
NEGATIONS = frozenset("not no never nobody isn aren don doesn nicht kein keine nie pas jamais aucun ne nunca jamás ni".split())
REPORTS = frozenset("said says say told wrote writes called claimed quoted reported according sagte sagt schrieb laut dit disait selon écrit dijo dice según escribió".split())
THREATS = frozenset("kill hurt destroy burn shoot stab attack töten umbringen schlagen tuer frapper détruire matar golpear destruir".split())
QUOTES = frozenset('"“”„«»')

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n\"“”„«»]")
_CLAUSE_END = frozenset(".!?;\n")

# Transducers as (state, symbol) -> state; a pair that is not listed keeps its state.
TARGET = {("none", "target"): "near"}
NEGATION = {
    ("plain", "negation"): "negated3", ("negated3", "word"): "negated2", ("negated2", "word"): "negated1", ("negated1", "word"): "plain",
    ("negated3", "negation"): "plain", ("negated2", "negation"): "negated3", ("negated1", "negation"): "negated3",
}
REPORT = {
    ("own", "report"): "told", ("own", "quote"): "quoted", ("told", "quote"): "quoted", ("quoted", "quote"): "own",
}
ACCOUNTS = ("outright", "targeted", "negated", "reported", "threat", "threat targeted")


def _account(symbol: str, target: str, negation: str, report: str) -> str:
    """Where the last transducer pays, given the states of the others."""
    if report != "own":
        return "reported"
    if negation != "plain":
        return "negated"
    if symbol == "threat":
        return "threat targeted" if target == "near" else "threat"
    return "targeted" if target == "near" else "outright"


def _composed() -> tuple[dict, dict]:
    """All states reachable from the start: (state, symbol) -> state, and (state, symbol) -> account."""
    symbols = ("word", "target", "negation", "report", "quote", "insult", "threat")
    start = ("none", "plain", "own")
    moves, pays, todo = {}, {}, [start]
    while todo:
        state = todo.pop()
        for symbol in symbols:
            t, n, r = state
            if symbol in ("insult", "threat"):
                pays[state, symbol] = _account(symbol, *state)
            read = "word" if symbol in ("insult", "threat", "target", "report") and (n, symbol) not in NEGATION else symbol
            after = (TARGET.get((t, symbol), t), NEGATION.get((n, read), n), REPORT.get((r, symbol), r))
            if (after, "word") not in moves and after not in todo and after != state:
                todo.append(after)
            moves[state, symbol] = after
    return moves, pays


MOVES, PAYS = _composed()
START = ("none", "plain", "own")


class Grammar:
    """The composed transducers with a lexicon: token or ``stem*`` -> amount."""

    def __init__(self, lexicon: dict[str, float]):
        self.words = {k: v for k, v in lexicon.items() if not k.endswith("*")}
        self.stems = {k[:-1]: v for k, v in lexicon.items() if k.endswith("*")}

    def amount(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        for n in STEMS:
            if len(word) >= n:
                found = max(found, self.stems.get(word[:n], 0.0))
        return found

    def clause(self, tokens: list[str], amounts: list[float]) -> dict[str, float]:
        """What a clause pays into each account. A target behind the insult counts as well: the clause is read twice."""
        target = "near" if any(t in TARGETS for t in tokens) else "none"
        state, paid = (target, *START[1:]), {}
        for token, amount in zip(tokens, amounts, strict=True):
            if amount:
                symbol = "threat" if token in THREATS else "insult"
                account = PAYS[state, symbol]
                paid[account] = paid.get(account, 0.0) + amount
            elif token in TARGETS:
                symbol = "target"
            elif token in NEGATIONS:
                symbol = "negation"
            elif token in REPORTS:
                symbol = "report"
            elif token in QUOTES:
                symbol = "quote"
            else:
                symbol = "word"
            state = MOVES.get((state, symbol), state)
        return paid

    def features(self, text: str) -> list[float]:
        """Per account: the largest amount of a clause and the logarithm of the sum; nothing outside clauses counts."""
        tokens = _TOKEN.findall(text.lower())
        amount, known = self.amount, {}
        for t in set(tokens):
            if a := amount(t):
                known[t] = a
        most, total = dict.fromkeys(ACCOUNTS, 0.0), dict.fromkeys(ACCOUNTS, 0.0)
        if known:
            begin = 0
            for end in [i for i, t in enumerate(tokens) if t in _CLAUSE_END] + [len(tokens)]:
                part = tokens[begin:end]
                begin = end + 1
                if not known.keys().isdisjoint(part):
                    for account, paid in self.clause(part, [known.get(t, 0.0) for t in part]).items():
                        most[account] = max(most[account], paid)
                        total[account] += paid
        return [1.0, *(most[a] / 5 for a in ACCOUNTS), *(math.log1p(total[a]) for a in ACCOUNTS)]


N_FEATURES = 1 + 2 * len(ACCOUNTS)


def _entries(text: str) -> set[str]:
    words = set(re.findall(r"[^\W\d_]+", text.lower()))
    return words | {f"{w[:n]}*" for w in words for n in STEMS if len(w) >= n}


def learned_lexicon(training: DataFrame, most: int = LEXICON) -> dict[str, float]:
    """Words and stems with the lower bound of their log odds, counted in the training rows by Spark.

    The most telling so many, which is all a grammar needs; the count of entries met goes into the bound.
    """

    def count(batches):
        found = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[label].update(_entries(text))
        for label, counts in found.items():
            entries = list(counts.items())
            for at in range(0, len(entries), 50_000):
                part = entries[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([e for e, _ in part]),
                        pa.array([n * label for _, n in part], pa.int64()), pa.array([n * (1 - label) for _, n in part], pa.int64()),
                    ],
                    ["entry", "yes", "no"],
                )

    sizes = {r["label"]: r["count"] for r in training.groupBy("label").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return {}
    counts = training.select("text", "label").mapInArrow(count, "entry string, yes long, no long")
    counts = counts.groupBy("entry").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).filter("yes >= 3")
    yes, no = F.col("yes") + 0.5, F.col("no") + 0.5
    odds = F.log(yes / (sizes[1] + 1)) - F.log(no / (sizes[0] + 1)) - 1.64 * F.sqrt(1 / yes + 1 / no)
    best = counts.select("entry", odds.alias("weight")).filter(F.col("weight") >= LEAST_WEIGHT)
    return {r["entry"]: r["weight"] for r in best.orderBy(F.desc("weight"), "entry").limit(most).collect()}


class ToxicityModel:
    def __init__(self, grammar: Grammar, weights: np.ndarray, cut: float = CUT):
        self.grammar, self.weights, self.cut = grammar, weights, cut

    def scores(self, texts) -> np.ndarray:
        if not self.weights.any():
            return np.full(len(texts), 0.25)
        x = np.array([self.grammar.features(t or "") for t in texts]).reshape(-1, N_FEATURES)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -35, 35)))


def fit_toxicity(training: DataFrame) -> ToxicityModel:
    """Learns the lexicon, then the weights of the accounts; features of the training rows are brought together."""
    lexicon = learned_lexicon(training)
    grammar = Grammar({**{t: LEAST_WEIGHT for t in THREATS}, **lexicon})

    def read(batches):
        for batch in batches:
            f = [grammar.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(f, pa.list_(pa.float64()))], ["label", "f"])

    rows = training.select("text", "label").mapInArrow(read, "label int, f array<double>").toPandas()
    x = np.array(rows["f"].tolist(), np.float64).reshape(-1, N_FEATURES)
    y = rows["label"].to_numpy(float)
    if len(set(y)) < 2:
        return ToxicityModel(grammar, np.zeros(N_FEATURES))
    return ToxicityModel(grammar, fit_logistic(x, y, 1e-4))


def scored_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted, a row for each document."""

    def score(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                s = model.scores(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= model.cut).cast("int").alias("predicted")
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored_toxicity(docs, fit_toxicity(training_rows(docs, labels, "toxic")))
