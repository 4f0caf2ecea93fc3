from pyspark.sql import functions as F

from helpers import one
from quarry.operators import formatting as FM


def test_instruct(spark):
    out = one(spark, FM.format_instruct(F.col("a"), F.col("b")), a="Test Article", b="Some content.")
    assert "<|im_start|>system" in out and "BMW automotive expert" in out
    assert "Tell me about: Test Article" in out and "Some content." in out and "<|im_end|>" in out


def test_article(spark):
    out = one(spark, FM.format_article(F.col("a"), F.col("b")), a="Test Article", b="Some content.")
    assert "### BMW Press Release: Test Article" in out and "Some content." in out


def test_qa_keeps_first_paragraph(spark):
    out = one(spark, FM.format_qa(F.col("a"), F.col("b")), a="BMW i4", b="The BMW i4 is an electric sedan.\n\nIt has great range.")
    assert "What is the latest news about BMW i4?" in out
    assert "The BMW i4 is an electric sedan." in out and "great range" not in out


def test_qa_without_blank_line(spark):
    out = one(spark, FM.format_qa(F.col("a"), F.col("b")), a="T", b="only one paragraph")
    assert "only one paragraph<|im_end|>" in out


def test_unknown_style_returns_content(spark):
    assert one(spark, FM.format_style(F.col("a"), F.col("b"), "unknown"), a="Title", b="Raw content.") == "Raw content."


def test_clean_title_drops_all_trailing_dots(spark):
    assert one(spark, FM.clean_title(F.col("a")), a="  A title...  ") == "A title"
    assert one(spark, FM.clean_title(F.col("a")), a="A . .") == "A . "


def test_round_trip(spark):
    framed = FM.serialize_processed(F.col("t"), F.col("d"), F.col("s"), F.col("c"), F.col("r"))
    df = spark.createDataFrame([("My Title", "2024-01-01", "source.pdf", "Body content.", "Because it is good.")], "t string, d string, s string, c string, r string")
    p = df.select(FM.parse_processed(framed, F.lit("test.txt")).alias("p")).first()["p"]
    assert (p["title"], p["date"], p["source"], p["content"]) == ("My Title", "2024-01-01", "source.pdf", "Body content.")


def test_malformed_file_falls_back_to_stem(spark):
    p = one(spark, FM.parse_processed(F.col("t"), F.col("n")), t="Just some text.", n="malformed.txt")
    assert p["title"] == "malformed" and p["content"] == "Just some text." and p["date"] is None and p["source"] == "malformed.txt"


def test_empty_date_is_null_and_last_header_wins(spark):
    text = "--- METADATA ---\nTITLE: a\nTITLE: b\nDATE: \nSOURCE: s\n--- CONTENT ---\n  body  "
    p = one(spark, FM.parse_processed(F.col("t"), F.col("n")), t=text, n="x.txt")
    assert (p["title"], p["date"], p["content"]) == ("b", None, "body")


def test_prompt_modes(spark):
    topics = spark.createDataFrame([("BMW Neue Klasse",)], "topic string")
    rows = {r["mode"]: r["prompt"] for r in FM.prompt_set(topics).collect()}
    assert "/think Tell me about" in rows["think"]
    assert "/no_think Tell me about" in rows["no_think"]
    assert "/think" not in rows["finetuned"] and "/no_think" not in rows["finetuned"]
