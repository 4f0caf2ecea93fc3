from pyspark.sql import functions as F

from helpers import one
from quarry.operators import discover as C
from quarry.operators import pages as P


def test_article_id_fallbacks(spark):
    assert one(spark, C.article_id_of(F.col("a"), F.col("u")), a="", u="https://x/detail/T1EN/slug") == "T1EN"
    assert one(spark, C.article_id_of(F.col("a"), F.col("u")), a="", u="noslash") is None


def test_names_with_large_index(spark):
    df = spark.createDataFrame([(1234, "T1EN", "Größe/Test.")], "idx int, id string, title string")
    r = df.select(C.scraped_filename("idx", "id", "title").alias("a"), C.pdf_filename("idx", "title").alias("b")).first()
    assert r["a"] == "1234_T1EN_Größe_Test_.json" and r["b"] == "1234_Größe_Test_.pdf"


def test_keep_first_dedup(spark):
    links = spark.createDataFrame([(1, 0, "a", "x"), (1, 1, "b", "y"), (1, 2, "a", "z")], "page_id int, pos int, id string, slug string")
    got = {r["id"]: r["slug"] for r in C.dedup_keep_first(links, ["page_id"], ["pos"]).collect()}
    assert got == {"a": "x", "b": "y"}


def test_target_already_met(spark):
    new = spark.createDataFrame([(1, 0)], "page_id int, pos int")
    assert C.target_limit(new, 5, 5, ["page_id", "pos"]).count() == 0
    assert C.target_limit(new, 10, 5, ["page_id", "pos"]).count() == 0
    assert C.target_limit(new, 4, 5, ["page_id", "pos"]).count() == 1


def test_upsert_overwrites_with_null(spark):
    cat = spark.createDataFrame([(0, "T1EN", "u", "old", "2020", None, False, None)], "idx bigint, article_id string, url string, title string, date string, pdf_url string, scraped boolean, scraped_at string")
    res = spark.createDataFrame([(0, "new", None, None, "now")], "idx bigint, title string, date string, pdf_url string, scraped_at string")
    r = C.catalog_upsert(cat, res).first()
    assert (r["title"], r["date"], r["scraped"]) == ("new", None, True)


def test_pub_date_forms(spark):
    assert one(spark, P.iso_utc(P.parse_pub_date(F.col("t"))), t="Munich, 5 MARCH 2024.") == "2024-03-05T00:00:00+00:00"
    assert one(spark, P.iso_utc(P.parse_pub_date(F.col("t"))), t="31 February 2024 or 1.2.2023") == "2023-02-01T00:00:00+00:00"
    assert one(spark, P.iso_utc(P.parse_pub_date(F.col("t"))), t="March 7, 2021") == "2021-03-07T00:00:00+00:00"
    assert one(spark, P.parse_pub_date(F.col("t")), t="no date") is None


def test_html_to_text_keeps_headings_and_long_blocks(spark):
    html = "<nav>menu</nav><h1>Title</h1><p>" + "word " * 60 + "</p><p>short</p><footer>f</footer>"
    out = one(spark, P.html_to_text(F.col("h")), h=html)
    assert out.startswith("# Title\n\nword") and "short" not in out and "menu" not in out
    assert one(spark, P.page_title(F.col("t")), t=out) == "Title"
