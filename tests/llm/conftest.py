"""Small documents with the cases every operator must handle."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, word string, _k bigint"


def rows():
    rnd = random.Random(3)
    syl = {"en": "the an ing of ther ion ed to re wh".split(), "de": "der ung ich ein sch ver zu ß ä en".split()}
    out = []
    for i in range(60):
        lang = "en" if i % 2 else "de"
        text = " ".join("".join(rnd.choices(syl[lang], k=rnd.randint(1, 3))) for _ in range(rnd.choice([3, 12, 40, 90])))
        out.append((i, text, lang, f"s{i % 4}"))
    long = " ".join(rnd.choices(syl["en"], k=6000))
    near = out[7][1].split() if len(out[7][1].split()) > 30 else out[9][1].split()
    base = " ".join(rnd.choices(syl["en"], k=4) + [f"w{j}" for j in range(80)])
    out += [(100, long, "en", "s0"), (101, base, "en", None), (102, base.replace("w40", "zz"), "en", "s1"), (103, base.replace(" ", "  \t\n"), "en", "s1")]
    out += [(104, None, None, "s1"), (105, "", "en", "s2"), (106, " \n ", "en", None), (107, "123 45 !!", "en", "s2"), (108, "Hi.", "en", "s3")]
    out += [(None, " ".join(near), "en", "s0"), (110, base, "en", "s2"), (110, base, "en", "s2"), (111, "İ Σ <|endoftext|> É, 'S. é́", "en", "s2")]
    return [(*r, None if r[1] is None else len(r[1]), "x", 1) for r in out]


@pytest.fixture(scope="session")
def docs(spark):
    """With extra columns whose names the operators also use."""
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
