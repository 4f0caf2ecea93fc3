import random

from pyspark.sql import functions as F

from helpers import PRESS_RELEASE, one
from quarry.functions import fixed
from quarry.functions.regex import jre, re2
from quarry.operators import clean as X


def test_clean_text_removes_headers_and_keeps_content(spark):
    out = one(spark, X.clean_text(F.col("t")), t=PRESS_RELEASE)
    assert "CORPORATE COMMUNICATIONS" not in out
    assert "Media Information" not in out
    assert "Media Contact" not in out
    assert "The BMW Group" not in out
    assert "Quieter tyres for the city" in out
    assert "Munich. Engineers present a tyre that rolls more quietly on wet roads." in out
    assert "\n\n" in out
    assert "near the plant." in out


def test_hyphen_reassembly(spark):
    assert "beautiful car" in one(spark, X.clean_text(F.col("t")), t="This is a beauti-\nful car.")


def test_hyphen_repair_is_non_overlapping(spark):
    assert one(spark, X.fix_hyphens(F.col("t")), t="a-\nb-\nc") == "ab-\nc"


def test_hyphen_repair_equals_the_plain_pattern(spark):
    import re

    rng = random.Random(3)
    texts = ["".join(rng.choice("a\u00e9_9- -\n-\n") for _ in range(rng.randrange(14))) for _ in range(400)] + ["-\na", "a-\n", "a-\nb-\ncd-\ne-\nf"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", X.fix_hyphens("t").alias("r")).collect():
        assert r["r"] == re.sub(r"(\w)-\n(\w)", r"\1\2", r["t"]), r["t"]


def test_strip_equals_python_on_any_mix_of_spaces(spark):
    from quarry.functions.regex import strip_space

    rng = random.Random(4)
    texts = ["".join(rng.choice(" \n\t\x0b\x1c\x85\xa0\u2003\u3000\u200ba.\u00e9\U0001f600$\\") for _ in range(rng.randrange(9))) for _ in range(400)] + ["", " ", "\n\n"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = {r["t"]: r["r"] for r in df.select("t", strip_space(F.col("t")).alias("r")).collect()}
    assert got.pop(None) is None
    assert got == {t: t.strip() for t in got}


def test_word_count_equals_python_on_any_mix_of_spaces(spark):
    import sys

    spaces = [chr(x) for x in range(sys.maxunicode + 1) if not 0xD800 <= x < 0xE000 and chr(x).isspace()]
    rng = random.Random(5)
    texts = ["".join(rng.choice([*spaces, "a", "\u00e9", "\u200b", "\U0001f600"] * 1 + ["b", "c"] * 9) for _ in range(rng.randrange(12))) for _ in range(400)]
    texts += ["", " ", *[f"a{x}b" for x in spaces]]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = {r["t"]: r["n"] for r in df.select("t", X.word_count("t").alias("n")).collect()}
    assert got.pop(None) is None
    assert got == {t: len(t.split()) for t in got}


def test_strip_is_linear_in_runs_of_spaces(spark):
    import time

    from quarry.operators import filtering, formatting

    df = spark.createDataFrame([("a" + " " * 400_000 + "b",)], "t string")
    strips = [X.strip_and_collapse("t"), formatting._strip(F.col("t")), filtering._strip(F.col("t"))]
    start = time.time()
    assert [len(x) for x in df.select(*[F.concat(s, F.lit("")) for s in strips]).first()] == [400_002] * 3
    assert time.time() - start < 20  # each run once for every one of its characters: minutes


def test_page_number_lines_swallow_blank_lines(spark):
    import re

    t = "a\n12\n\n\nb\n7\nc"
    assert one(spark, X.drop_page_numbers(F.col("t")), t=t) == re.sub(r"^\d+\s*$", "", t, flags=re.MULTILINE)


def test_text_that_cleans_to_empty_is_kept(spark):
    df = spark.createDataFrame([(1, "CONFIDENTIAL"), (2, "")], "id int, raw_text string")
    rows = {r["id"]: r["cleaned"] for r in X.clean_documents(df).collect()}
    assert rows == {1: ""}


def test_length_cap_at_cap_and_cap_plus_one(spark):
    df = spark.createDataFrame([(1, "a" * 10), (2, "b" * 11)], "id int, raw_text string")
    assert [r["id"] for r in X.clean_documents(df, cap=10).collect()] == [1]


def test_cleaning_chain_evaluated_once(spark):
    df = spark.createDataFrame([(1, "x")], "id int, raw_text string")
    plan = X.clean_documents(df)._jdf.queryExecution().optimizedPlan().toString()
    # 5 pre-steps + 47 rules + 2 final steps, each exactly once
    assert plan.count("regexp_replace(") == 54


def test_guarded_rule_is_exact(spark):
    t = "The information about WLTP values.\n\nNext paragraph."
    assert one(spark, X.strip_boilerplate(F.col("t")), t=t).strip() == "Next paragraph."


def test_regex_forms():
    assert jre(r"a\Z") == "(?imsdu)a\\z"
    assert jre(r"[\w\.]+", "") == r"[\p{L}\p{N}_\.]+"
    r = re2(r"Media\s+Contact\..*?(?=\n\n|\Z)")
    assert r.pattern.startswith("(?ims)Media[") and r.pattern.endswith(r"Contact\..*?(\n\n|\z)")
    assert r.replacement == r"\1" and "(?=" not in r.pattern


def test_word_count(spark):
    assert one(spark, X.word_count(F.col("t")), t="  a b\n\tc  ") == 3
    assert one(spark, X.word_count(F.col("t")), t="") == 0


def test_idx_from_name(spark):
    assert one(spark, X.idx_from_name(F.col("t")), t="1234_title.pdf") == 1234
    assert one(spark, X.idx_from_name(F.col("t")), t="title.pdf") is None


def test_assemble_pages_skips_empty_pages(spark):
    pages = spark.createDataFrame([("d", 2, "c"), ("d", 0, "a"), ("d", 1, ""), ("e", 0, "")], "source string, page_no int, text string")
    got = {r["source"]: r["raw_text"] for r in X.assemble_pages(pages).collect()}
    assert got == {"d": "a\n\nc", "e": ""}


def test_required_words_are_read_off_the_pattern():
    from quarry.functions.regex import required_words

    assert required_words(r"Media\s+Contact\..*?(?=\n\n|\Z)") == [["media"], ["contact."]]
    assert required_words(r"(?:WLTP|NEFZ).*?x?abc*(?:def)?") == [["wltp", "nefz"]]
    assert required_words(r"a+|bcd") == [] and required_words(r"[abc]def?(?!xyz)") == []
    for _, p in fixed.BOILERPLATE_RULES:
        assert required_words(p), p


def test_guards_change_no_result(spark):
    rnd = random.Random(4)
    words = ["Media", "Information", "Contact.", "CORPORATE", "COMMUNICATIONS", "Page 3", "Subject", "Phone: +49 1", "The BMW Group", "With its four brands", "useful life.", "WLTP", "Die Angaben"]
    words += ["www.bmw.de/wltp x", "Website", "www.x.com/a", "Fax +4", "CONTACTS", "\n", "\n\n", " ", "12 May 2020", "a", "Investor Relations", "ſubject", "Thema", "PreſſE", "ınformation", "medİa", "Kelvin", "faX +1", "E-mail: a@b.c"]
    rows = [("".join(rnd.choice(words) + rnd.choice([" ", "\n", " ", "\n\n"]) for _ in range(rnd.randint(1, 25))),) for _ in range(400)] + [(PRESS_RELEASE,), ("",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    got = df.select(X.strip_boilerplate("t").alias("a"), X.strip_boilerplate("t", guards=False).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got) and sum(r["a"] is not None for r in got) == 402


def test_text_is_folded_once_per_change(spark):
    df = spark.createDataFrame([("x",)], "t string")
    plan = df.select(X.strip_boilerplate("t").alias("r"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") <= 1 + len(fixed.BOILERPLATE_RULES)  # not once per word looked up


def test_whitespace_classes_are_those_of_python(spark):
    import re

    odd = [chr(i) for i in range(0x3001) if chr(i).isspace()] + ["\u200b", "\ufeff", "\x7f", "\x00", "\u0130", "ß", "~", "!"]
    rows = [(f"{a}{b}x{a}y{b}{a}",) for a in odd for b in odd] + [(" a  b\t\tc \t d\te",)]
    got = spark.createDataFrame(rows, "t string").select("t", X.word_count("t").alias("n"), X.strip_and_collapse("t").alias("s"), X.norm_spaces("t").alias("b")).collect()
    for r in got:
        assert r["n"] == len(r["t"].split())
        assert r["s"] == re.sub(r"\n{3,}", "\n\n", r["t"].strip()) and r["b"] == re.sub(r"[ \t]+", " ", r["t"])
