"""Operators in native columns against brute force: decontamination, mixing, personal data, preferences."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from orewright.llm.decontamination import OVERLAP, SEEDS, _seeds_of, contaminated
from orewright.llm.mixing import mixed_documents, mixed_sources, source_targets
from orewright.llm.personal_data import KINDS, personal_data, reliabilities, span_classifier, span_text
from orewright.llm.preferences import clean_turns, pairs_by_first_turn, preference_examples

from .conftest import WORD, odd_texts


# --- decontamination -----------------------------------------------------------------------------------------


def bare(text):
    found = [w.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for w in WORD.findall(text or "")]
    return [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in found if w]


def brute_contaminated(docs, items):
    out = {}
    for d, text in docs:
        w = bare(text)
        for i, item in items:
            it, best = bare(item), 0
            for shift in range(-len(it), len(w)):
                pairs = [(w[shift + k] == it[k]) if 0 <= shift + k < len(w) else False for k in range(len(it))]
                hit = len(it) < len(SEEDS[0]) and it and all(pairs)
                for seed in SEEDS:
                    on = [p for p, c in enumerate(seed) if c == "1"]
                    hit = hit or any(all(pairs[a + p] for p in on) and 0 <= shift + a and shift + a + len(seed) <= len(w) for a in range(len(it) - len(seed) + 1))
                if hit:
                    best = max(best, sum(pairs))
            if it and best and best >= -(-OVERLAP * len(it) // 1):
                out[d, i] = best
    return out


def test_contaminated_equals_brute_force(ready):
    draw = random.Random(3)
    word = lambda: "".join(draw.choice("abcdefg") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(n)).capitalize() + ".") for i, n in enumerate([20, 15, 40, 8, 5, 3, 12])] + [(7, ""), (8, None), (9, "...")]
    docs = [(100 + i, t) for i, t in enumerate(odd_texts()) if len(t or "") < 2000]
    for i, item in items[:7]:
        for swaps in (0, 1, 2, 4, 8):
            w = item.split()
            for at in draw.sample(range(len(w)), min(swaps, len(w))):
                w[at] = word()
            docs.append((len(docs), f"({word()} {word()}, " + " ".join(w) + f"\n{word()}"))
        docs.append((len(docs), item))
        docs.append((len(docs), " ".join(item.split()[: len(item.split()) * 3 // 4])))
    df = ready.createDataFrame([*docs, (None, items[0][1])], "doc_id long, text string").withColumn("item_id", F.lit(1)).withColumn("n", F.lit(1))
    bench = ready.createDataFrame([*items, (None, items[0][1]), items[1]], "item_id long, text string").withColumn("at", F.lit(1))
    got = {(r.doc_id, r.item_id): r.matched for r in contaminated(df, bench).collect()}
    assert got == brute_contaminated(docs, items)
    assert len(got) > 20 and any(m < len(bare(dict(items)[i])) for (_, i), m in got.items())


def test_check_sql_finds_parts_and_insertions(ready, tmp_path):
    """The query's SQL goes by the rules of acceptance: planted parts, swaps and insertions are in both."""
    import duckdb

    from orewright.llm.queries import QUERIES, SQL

    draw = random.Random(17)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([15, 20, 31, 44, 59])]
    docs = [(k, " ".join(word() for _ in range(40))) for k in range(5)]
    around = lambda w: " ".join([word(), *w, word() + "."])
    for _, text in items:
        w = text.split()
        n = len(w)
        swapped = list(w)
        for at in range(0, n, 4):
            swapped[at] = word()
        for part in (w, w[:13], w[n // 3 :], w[: n // 2] + [word()] + w[n // 2 :], w[: n // 2 - 2] + w[n // 2 + 1 :], swapped, w[:9], w[5:] + w[:5]):
            docs.append((len(docs), around(part)))
        docs.append((len(docs), around([w[0], *[word() if k % 2 else x for k, x in enumerate(w)]])))
    ready.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    ready.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted(tuple(r) for r in QUERIES["op6_decontamination"](ready, str(tmp_path)).collect())
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    assert got == sorted(con.execute(SQL["op6_decontamination"]).fetchall())
    assert {i for _, i, _, _ in got} == {0, 1, 2, 3, 4} and len(got) > 25


def avoids(seeds, n, wrong):
    """Whether some item of n words with so many unequal ones is hit by none of the seeds."""
    span, masks = max(map(len, seeds)), [int(s, 2) for s in seeds]
    least = {0: 0}  # of unequal words, by which of the last places are equal
    for _ in range(n):
        after = {}
        for state, k in least.items():
            for bit in (0, 1):
                full = state << 1 | bit
                if not any(full & m == m for m in masks):
                    key = full & ((1 << span - 1) - 1)
                    after[key] = min(after.get(key, n + 1), k + 1 - bit)
        least = after
    return min(least.values(), default=n + 1) <= wrong


def test_some_seed_hits_every_alignment():
    for n in range(4, 27):
        assert not avoids(_seeds_of(n), n, n - math.ceil(OVERLAP * n)), n
    assert not any(map(_seeds_of, (1, 2, 3))) and math.ceil(OVERLAP * 3) == 3
    assert avoids(("11011011", "11100111"), 16, 4)


def test_no_alignment_is_lost(ready):
    """Against all shifts, whatever the seeds."""
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    items = [(n, [word() for _ in range(n)]) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 13, 14, 16, 17, 20, 24, 40)]
    docs, expected = [], {}
    for i, item in items:
        wrong = len(item) - math.ceil(OVERLAP * len(item))
        every = [set(range(s, len(item), 4)) for s in range(4)]
        for swapped in [at for at in every if len(at) <= wrong] + [set(draw.sample(range(len(item)), wrong)) for _ in range(12)]:
            laid = [word() if k in swapped else w for k, w in enumerate(item)]
            expected[len(docs), i] = sum(a == b for a, b in zip(laid, item, strict=True))
            docs.append((len(docs), " ".join([word(), *laid, word(), word()])))
    bench = ready.createDataFrame([(i, " ".join(item)) for i, item in items], "item_id long, text string")
    got = contaminated(ready.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id): r.matched for r in got} == expected


def test_parts_of_long_items_and_insertions_count(ready):
    draw = random.Random(12)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    long, longer, plain = ([word() for _ in range(n)] for n in (59, 400, 16))
    some = lambda n: [word() for _ in range(n)]
    docs = [
        some(30) + long[5:45] + some(9), longer[100:370], long[:30] + some(1) + long[30:], plain[:8] + some(2) + plain[8:], plain[:8] + plain[9:],
        long[20:33] + some(5), some(40) + [*long[20:25], *some(3), *long[28:33]], long[20:29] + some(9), plain[:8] + some(60) + plain[8:], longer[399:] + some(20),
    ]
    rows = [(k, " ".join(d)) for k, d in enumerate(docs)]
    bench = ready.createDataFrame([(i, " ".join(w)) for i, w in enumerate([long, longer, plain])], "item_id long, text string")
    got = contaminated(ready.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id): r.matched for r in got} == {(0, 0): 40, (1, 1): 270, (2, 0): 30, (3, 2): 8, (4, 2): 8, (5, 0): 13, (6, 0): 10}


def test_contamination_of_nothing(ready):
    docs = ready.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = ready.createDataFrame([], "item_id long, text string")
    assert contaminated(docs, none).count() == 0
    assert contaminated(docs.limit(0), ready.createDataFrame([(1, "a b c")], none.schema)).count() == 0


# --- mixing --------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = [s for s in open_ if level * w[s] > most * sizes[s]]
        if not full:
            return out | {s: level * w[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


@pytest.mark.parametrize("sizes", [{"b": 10, "a": 1, None: 7}, {"x": 5}, {"a": 0, "b": 9}, {"a": 100, "b": 3, "c": 1, "d": 50, "é": 2, None: 400}])
def test_targets_share_out_the_excess(ready, sizes):
    df = ready.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix_meets_targets_and_repeats_itself(odd_docs):
    mixed = mixed_sources(odd_docs).select("doc.doc_id", "doc.source", "doc.text", "size", "source_size", "target", "taken")
    rows = mixed.collect()
    assert len(rows) == odd_docs.count()
    totals, taken = {}, {}
    for r in rows:
        assert r["size"] == len(WORD.findall(r.text or "")) and 0 <= r.taken <= 2 * r["size"]
        totals[r.source] = totals.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    targets = brute_targets(totals)
    for r in rows:
        assert r.source_size == totals[r.source] and r.target == pytest.approx(targets[r.source])
    for s in totals:
        assert abs(taken[s] - targets[s]) <= 1
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixed.collect()), key=repr)
    copies = mixed_documents(odd_docs)
    assert copies.columns == odd_docs.columns
    out = {}
    for r in copies.collect():
        out[r.source] = out.get(r.source, 0) + len(WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    assert out == {s: n for s, n in taken.items() if n}


def test_heavier_documents_come_first(ready):
    """Documents full of markup draw later keys, so fewer of them are in a half."""
    rows = [(i, "plain words only " * 5 if i % 2 else "| *** ### $$$ | " * 5, "s") for i in range(600)]
    docs = ready.createDataFrame(rows, "doc_id long, text string, source string")
    chosen = [r.doc_id % 2 for r in mixed_sources(docs, share=0.5).filter("taken > 0").select("doc.doc_id").collect()]
    assert sum(chosen) > 0.7 * len(chosen)


def test_sources_of_noise_are_not_lost(ready):
    """Sources of symbols only, many of one row: every document has its row, every source the words of its target."""
    rows = [(i, "| *** ### $$$ |", f"one{i}") for i in range(200)] + [(i, "| ## " * (i % 5 + 1), "noise") for i in range(200, 500)]
    mixed = mixed_sources(ready.createDataFrame(rows, "doc_id long, text string, source string"))
    found = mixed.select("doc.doc_id", "doc.source", "target", "taken").collect()
    assert sorted(r.doc_id for r in found) == list(range(500))
    taken, targets = {}, {r.source: r.target for r in found}
    for r in found:
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - math.floor(t)) <= 1e-9 for s, t in targets.items())


def test_mix_of_nothing(ready):
    assert mixed_sources(ready.createDataFrame([], "doc_id long, text string, source string")).count() == 0


# --- personal data -------------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(x - 9 if x > 9 else x for x in twice) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def brute_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def test_strict_spans_equal_the_stated_patterns(ready):
    draw = random.Random(9)
    alphabet = "ab@@..--++() 0123456789019 %_é\U0001f600\n"
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 60))) for _ in range(1500)]
    texts += [None, "", "9" * 30_000, "1 " * 10_000, "a." * 10_000 + "@", "4111 1111 1111 1111", "a@b.c_d@e.f.g", "1.2.3.4.5.6.7.8", "+1 (743) 555-3824"]
    df = ready.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("candidates", F.lit(1))
    found = personal_data(df).select("doc_id", span_text(F.filter("spans", lambda s: s["strict"])).alias("s")).collect()
    assert {r.doc_id: r.s for r in found} == {i: ",".join(brute_spans(t)) for i, t in enumerate(texts)}


def test_reliable_votes_add_spans(ready):
    """Loose matches that look and stand like the strict ones are added; others are not, and strict ones stay."""
    rows = [(i, f"call me: phone +1 555 {i % 900 + 100} {i + 1000} or mail x{i}@mail.com") for i in range(300)]
    rows += [(1000, "phone: 555-234-5678 today"), (1001, "phone: 4.4.4"), (1002, "see user [at] mail [dot] com, email: joe [at] mail [dot] com")]
    got = {r.doc_id: r.s for r in personal_data(ready.createDataFrame(rows, "doc_id long, text string")).select("doc_id", span_text(F.col("spans")).alias("s")).collect()}
    assert all(got[i] == ",".join(brute_spans(t)) for i, t in rows[:300])
    assert got[1000] == "phone:7:19" and got[1001] == "" and "email" in got[1002]


def test_expectation_maximisation_tells_sides_apart():
    counts = [(1 + 3 + 18 + 27, 80), (0 + 0 + 18 + 0, 60), (1 + 0 + 18 + 27, 10), (0 + 3 + 18 + 0, 10)]
    real = reliabilities(counts)
    assert real[49] > 0.9 and real[18] < 0.1 and real[46] > real[21]
    weights = span_classifier(counts, real)
    assert weights[1] > 0 and weights[4] > 0
    assert KINDS == ("email", "ip", "card", "phone") and hashlib.sha256(b"").hexdigest()


def test_personal_data_of_nothing(ready):
    assert personal_data(ready.createDataFrame([], "doc_id long, text string")).count() == 0


# --- preferences ---------------------------------------------------------------------------------------------


def brute_example(a, b):
    cut = next((t for t in sorted({*a, *b}) if a.get(t) != b.get(t)), None)
    shown = lambda turns: "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in turns)
    rest = lambda c: [v for t, v in sorted(c.items()) if cut is not None and t >= cut]
    prompt = [v for t, v in sorted(a.items()) if cut is None or t < cut]
    return prompt, cut is None, shown(prompt), shown(rest(a)), shown(rest(b)), rest(a), rest(b)


def test_preferences_equal_brute_force(ready):
    said = {
        1: [("system", "s"), ("user", "hi"), ("assistant", "yes é\U0001f600"), ("user", "more"), ("assistant", "end")],
        2: [("system", "s"), ("user", "hi"), ("assistant", "no")],
        3: [("system", "s"), ("user", "hi"), ("assistant", "yes é\U0001f600"), ("user", "more"), ("assistant", "end")],
        4: [("user", "alone")], 5: [("system", "s"), ("user", "hi")], 6: [("system", "s"), ("assistant", "hi")],
    }
    rows = [(c, t, r, x) for c, turns in said.items() for t, (r, x) in enumerate(turns)]
    rows += [rows[0], (7, 0, None, None), (8, 0, "user", ""), (None, 0, "user", "x"), (1, None, "user", "x")]
    df = ready.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(1)).withColumn("cut", F.lit(2))
    turns = clean_turns(df)
    pairs = pairs_by_first_turn(turns)
    assert {tuple(p) for p in pairs.collect()} == {(1, 2), (1, 3), (1, 5), (1, 6), (7, 8)}
    extra = ready.createDataFrame([(4, 1), (4, 99), (1, 2)], pairs.schema)
    said |= {7: [("user", "")], 8: [("user", "")], 99: []}
    found = preference_examples(turns, pairs.unionByName(extra)).collect()
    assert len(found) == 7
    for r in found:
        a, b = (dict(enumerate(said[i])) for i in (r.chosen_id, r.rejected_id))
        prompt, tied, *texts, rest_a, rest_b = brute_example(a, b)
        assert (r.n_prompt_turns, r.tied, r.prompt, r.chosen, r.rejected) == (len(prompt), tied, *texts)
        for text, mask, rest in ((r.chosen, r.chosen_mask, rest_a), (r.rejected, r.rejected_mask, rest_b)):
            counted = [text[slice(*map(int, m.split(":")))] for m in mask.split(",") if m]
            assert counted == [x + "<|im_end|>" for role, x in rest if role == "assistant"]


def test_preferences_of_nothing(ready):
    turns = clean_turns(ready.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert preference_examples(turns, pairs_by_first_turn(turns)).count() == 0
