"""Personal data by weak supervision, in native column expressions only.

Candidates are matches of a strict and of a loose pattern for each kind. Four labelers vote on each
candidate (1 yes, 0 no, or no vote): the strict rule (no vote on loose matches), a gazetteer (top-level domains, reserved address
blocks, issuer and country prefixes), cue words before the span, and the span's shape. Votes are counted by
kind and pattern, at most ``4 * 3 ** 4`` rows, on which expectation-maximisation estimates how reliable each
labeler is and how likely each candidate is real, without labels. A logistic classifier of the votes,
trained on these likelihoods, decides on candidates beyond the strict rule; spans of the strict rule stay.

Strict rules, leftmost and non-overlapping per kind, failing matches dropped and not retried:
email; ip, parts up to 255; card, 16 to 19 digits passing Luhn; phone, a plus and 8 to 15 digits.
Offsets count code points, ends are exclusive. The patterns here are possessive forms of the stated ones:
they match the same, do not backtrack and need no stack for long runs of digits. A match can only begin
at the start of a run of its first class or where the last match ended (``\\G``), so a run is read once.

Defined cases: a missing or empty text, or one without matches, has no spans. Every row gives one row, also rows with
equal or missing ids. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orewright.llm.base import stored

KINDS = ("email", "ip", "card", "phone")

_LOCAL = r"[A-Za-z0-9._%+-]"
STRICT = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a strict match; most texts are passed by here.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?+[0-9]){15}", "phone": r"\+[0-9]"}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z0-9-]{1,63}+){1,8}+",
    "phone": r"(?<![0-9(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![\x20.-]?[0-9])",
}
LOOSE_HINT = {"email": r"[\[(](?:at|AT)[\])]", "phone": r"[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"}

# Fixed values of the gazetteers and cues.
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "info", "co", "de", "fr", "es", "uk", "eu", "example", "test")
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "82", "86", "91")
CUES = {
    "email": r"(?i)(?:e-?mail|contact|write to|mailto|kontakt|correo|courriel)[\s:]*$",
    "ip": r"(?i)(?:\bip|address|host|server|adresse|direcci)[\s:]*$",
    "card": r"(?i)(?:card|visa|mastercard|credit|karte|carte|tarjeta)[\s:]*$",
    "phone": r"(?i)(?:phone|tel|call|mobile|fax|telefon|t.l.fono)[.\s:]*$",
}
NOT_CUES = r"(?i)(?:version|section|chapter|isbn|\bv|no\.|#)[\s:]*$"
ACCEPT = 0.9

_SPAN = "array<struct<start:int,stop:int,found:string,before:string>>"


def _matches(text: Column, pattern: str, hint: str) -> Column:
    """Every match of a pattern with its offsets: lengths of the pieces between matches and of the matches, summed."""
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def add(done: Column, pair: Column) -> Column:
        begin = done["at"] + F.length(pair["pieces"])
        stop = begin + F.length(pair["found"])
        span = F.struct(begin.alias("start"), stop.alias("stop"), pair["found"].alias("found"), F.right(pair["pieces"], F.lit(24)).alias("before"))
        return F.struct(stop.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    pairs = F.filter(F.arrays_zip(pieces.alias("pieces"), found.alias("found")), lambda p: p["found"].isNotNull())
    spans = F.aggregate(pairs, start, add)["spans"]
    return F.when(text.rlike(hint), spans).otherwise(F.array().cast(_SPAN))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass Luhn: from the right, every second one doubled, less nine above nine."""

    def value(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    each = F.transform(F.sequence(F.lit(1), F.length(digits)), value)
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def _strict(kind: str, found: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3) & (F.right(p, F.lit(3)).cast("int") <= 255))
    n = F.length(_digits(found))
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(_digits(found))).otherwise(False)
    return n.between(8, 15)


def _gazetteer(kind: str, found: Column) -> Column:
    digits = _digits(found)
    if kind == "email":
        return F.lower(F.regexp_extract(found, r"([A-Za-z0-9-]+)\s*\z", 1)).isin(*DOMAINS)
    if kind == "ip":
        return ~found.rlike(r"\A(?:0|127|255)\.|\A(?:[0-9]\.){3}[0-9]\z")
    if kind == "card":
        return digits.rlike(r"\A(?:4|5[1-5]|2[2-7]|6(?:011|5)|3[0-9])")
    return F.when(found.startswith("+"), digits.rlike(rf"\A(?:{'|'.join(COUNTRY_CODES)})")).otherwise(digits.rlike(r"\A[2-9]"))


def _shape(kind: str, found: Column) -> Column:
    n = F.length(_digits(found))
    if kind == "email":
        return F.length(found).between(6, 80)
    if kind == "ip":
        return F.length(found).between(7, 15)
    if kind == "card":
        return n.between(13, 19)
    return n.between(10, 13)


def _vote(c: Column) -> Column:
    return F.when(c.isNull(), 2).when(c, 1).otherwise(0)


def _labelled(kind: str, loose: bool):
    """A function from a match to a candidate with the labelers' votes."""

    def label(s: Column) -> Column:
        strict = F.lit(False) if loose else _strict(kind, s["found"])
        cue = F.when(s["before"].rlike(CUES[kind]), True).when(s["before"].rlike(NOT_CUES), False)
        ballot = (F.lit(None).cast("boolean") if loose else strict, _gazetteer(kind, s["found"]), cue, _shape(kind, s["found"]))
        votes = sum((3**k * _vote(v) for k, v in enumerate(ballot)), F.lit(0))
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"),
            strict.alias("strict"), votes.cast("int").alias("votes"),
        )

    return label


def _candidates(text: Column) -> Column:
    """All candidates of a text: kind number, offsets, whether strict, and the votes as digits in base 3."""
    all_spans = []
    for kind in KINDS:
        spans = [_matches(text, STRICT[kind], HINT[kind])]
        if kind in LOOSE:
            spans.append(_matches(text, LOOSE[kind], LOOSE_HINT[kind]))
        for loose, found in enumerate(spans):
            all_spans.append(F.transform(found, _labelled(kind, bool(loose))))
    return F.concat(*all_spans)


def _ballot(votes: int) -> tuple[int, ...]:
    return tuple(votes // 3**k % 3 for k in range(4))


def reliabilities(counts: list[tuple[int, int]], rounds: int = 50) -> dict[int, float]:
    """Likelihood that a candidate is real, for each pattern of votes, by expectation-maximisation over counts.

    Each labeler has a rate of each vote on real and on other candidates (smoothed by one vote, the
    strict rule and real candidates starting in agreement), independent of the other labelers.
    """
    real = {v: (0.5 + sum(x == 1 for x in _ballot(v))) / (1 + sum(x != 2 for x in _ballot(v))) for v, _ in counts}
    for _ in range(rounds):
        mass = [sum(n * (real[v] if side else 1 - real[v]) for v, n in counts) for side in (0, 1)]
        prior = (mass[1] + 1) / (mass[0] + mass[1] + 2)
        rate = {}
        for side in (0, 1):
            for k in range(4):
                for vote in range(3):
                    seen = sum(n * (real[v] if side else 1 - real[v]) for v, n in counts if _ballot(v)[k] == vote)
                    right = 0.5 if vote == 2 else 2.0 if vote == side else 0.5
                    rate[side, k, vote] = (seen + right) / (mass[side] + 3.0)
        for v, _ in counts:
            yes = math.log(prior) + sum(math.log(rate[1, k, x]) for k, x in enumerate(_ballot(v)) if x != 2)
            no = math.log(1 - prior) + sum(math.log(rate[0, k, x]) for k, x in enumerate(_ballot(v)) if x != 2)
            real[v] = 1 / (1 + math.exp(min(50.0, no - yes)))
    return real


def span_classifier(counts: list[tuple[int, int]], real: dict[int, float], steps: int = 400) -> list[float]:
    """Weights (bias, then one for each labeler) of a logistic model of the votes, fit to the likelihoods."""
    weights, total = [0.0] * 5, sum(n for _, n in counts) or 1
    inputs = {v: [1.0] + [{0: -1.0, 1: 1.0, 2: 0.0}[x] for x in _ballot(v)] for v, _ in counts}
    for _ in range(steps):
        slope = [0.001 * w for w in weights]
        for v, n in counts:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w * x for w, x in zip(weights, inputs[v], strict=True))))))
            for i, x in enumerate(inputs[v]):
                slope[i] += n / total * (p - real[v]) * x
        weights = [w - 1.0 * s for w, s in zip(weights, slope, strict=True)]
    return weights


def _is_chosen(c: Column, chosen: dict[int, list[int]]) -> Column:
    out = F.lit(False)
    for number, votes in chosen.items():
        out = out | ((c["kind"] == number) & c["votes"].isin(*votes))
    return out


def personal_data(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """doc_id, spans: array of (kind, start, stop, strict) by kind and start, a row for each document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stored(docs.select("doc_id", _candidates(text).alias("candidates")), "candidates")
    tally = rows.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes").count().collect()
    chosen: dict[int, list[int]] = {}
    for number in range(len(KINDS)):
        counts = [(r["votes"], r["count"]) for r in tally if r["kind"] == number]
        if not counts:
            continue
        weights = span_classifier(counts, reliabilities(counts))
        limit = math.log(accept / (1 - accept))
        passed = [v for v, _ in counts if weights[0] + sum(w * {0: -1, 1: 1, 2: 0}[x] for w, x in zip(weights[1:], _ballot(v), strict=True)) >= limit]
        if passed:
            chosen[number] = passed
    strict = F.filter("candidates", lambda c: c["strict"])
    added = F.filter(
        "candidates",
        lambda c: ~c["strict"] & _is_chosen(c, chosen)
        & ~F.exists(strict, lambda s: (s["start"] < c["stop"]) & (c["start"] < s["stop"])),
    )
    keep = lambda spans: F.transform(spans, lambda c: F.struct(c["kind"], c["start"], c["stop"], c["strict"]))
    return rows.select("doc_id", F.array_sort(F.concat(keep(strict), keep(added))).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    name = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans, name), ",")
