import random
import re

import pytest

from orewright.llm.base import prepared

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Columns that no operator knows, named like some that operators make.
CLASHING = {"n": "int", "size": "int", "words": "string", "doc": "string", "copy": "int", "score": "double", "hash": "long", "component": "long"}


def words(text):
    return WORD.findall((text or "").translate(FOLD))


@pytest.fixture(scope="session")
def ready(spark):
    return prepared(spark)


def odd_texts():
    """Texts of every kind that needs a rule: missing, empty, white space, short, long, repeated, nearly repeated."""
    draw = random.Random(4)
    vocabulary = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 6))) for _ in range(300)]
    prose = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    base, long = prose(80), prose(6_000)
    near = [base.replace(base.split()[k], "changed", 1) for k in (3, 40, 70)]
    texts = [None, "", " \t\n", "one", "One two", "one two three four five", base, base, base.upper(), *near, long, long + " more"]
    texts += [prose(draw.randint(1, 60)) for _ in range(30)]
    texts += ["x" * 5000, "a " * 3000, "\x0b1\x0c2\x1c3", near[0] + " and some more words that follow here"]
    return texts


@pytest.fixture
def odd_docs(ready):
    """The odd texts with ids, a missing id, a repeated row, and columns with clashing names."""
    rows = [(i, t, f"s{i % 3}" if i % 7 else None) for i, t in enumerate(odd_texts())]
    rows += [rows[6], (None, "no id here at all", "s0")]
    extra = list(CLASHING.items())
    schema = "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(f"{k} {v}" for k, v in extra)
    return ready.createDataFrame([(i, t, s, "en", len(t or ""), *[None] * len(extra)) for i, t, s in rows], schema)
