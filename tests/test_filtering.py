from pyspark.sql import functions as F

from helpers import one
from quarry.operators import filtering as L


def test_parse_two_markers_uses_first(spark):
    p = one(spark, L.parse_response(F.col("g")), g=" analysis think assistantfinal A assistantfinal B ")
    assert (p["reasoning"], p["answer"]) == ("think", "A assistantfinal B")


def test_parse_without_marker(spark):
    p = one(spark, L.parse_response(F.col("g")), g="  plain  ")
    assert (p["reasoning"], p["answer"]) == (None, "plain")


def test_reject_without_reason(spark):
    r = one(spark, L.route_reject(F.col("a")), a="REJECT:")
    assert r["rejected"] is True and r["reason"] == ""


def test_tail_append_at_8000_and_8001(spark):
    assert one(spark, L.append_tail(F.col("a"), F.col("o")), a="X", o="y" * 8000) == "X"
    assert one(spark, L.append_tail(F.col("a"), F.col("o")), a="X", o="y" * 8000 + "z") == "Xz"


def test_blank_input_is_rejected_as_empty(spark):
    df = spark.createDataFrame([(" \n ", "whatever")], "text string, generated string")
    v = L.verdicts(df).first()
    assert v["rejected"] and v["reason"] == "Empty content" and v["content"] is None


def test_rule_verdict(spark):
    good = "Title here\n" + " ".join(["the cat is in the house and it was good"] * 5)
    df = spark.createDataFrame(
        [("Title here", "Header stuff\n" + good, "en"), ("T", "• \n• \n•", "en"), ("T", "the and of " * 10, "de")],
        "title string, text string, lang string",
    )
    out = [r[0] for r in df.select(L.rule_verdict("title", "text", "lang")).collect()]
    assert out[0].startswith("Title here")
    assert out[1] == "REJECT: only bullet points"
    assert out[2] == "REJECT: wrong language"


def test_score_batches_plugin(spark):
    df = spark.createDataFrame([(i, "t", f"text {i}") for i in range(30)] + [(99, "t", "  ")], "id int, title string, text string")
    v = L.verdicts(L.score_batches(df, L.echo_generator))
    rows = {r["id"]: r["content"] for r in v.collect()}
    assert len(rows) == 31 and rows[3] == "text 3" and rows[99] is None


def test_rule_verdict_reads_whole_text(spark):
    head = "the cat is in the house and it was good " * 200
    df = spark.createDataFrame([("", head + "#%&$" * 50_000, "en"), ("", head + "\nSubject mail\nend", "en")], "title string, text string, lang string")
    out = [r[0] for r in df.select(L.rule_verdict("title", "text", "lang")).collect()]
    assert out[0] == "REJECT: garbled text"
    assert "Subject" not in out[1] and out[1].endswith("end")
