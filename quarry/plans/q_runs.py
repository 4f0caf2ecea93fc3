"""Queries for whole runs (I2): the preprocessing phases over the derived
views, each called as a user calls it, twice: an earlier run over the labelled
documents, then one over all of them that skips what is done."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry import collect as CO
from quarry import pipeline as P
from quarry.manifest import Manifest
from quarry.operators import headers as H
from quarry.plans import q_collect as QC
from quarry.plans import views as V
from quarry.plans.q_filter import FILTERED_VIEWS
from quarry.plans.q_prepare import PREPARED_VIEWS, sql_split_on
from quarry.plans.registry import query, with_views
from quarry.session import shared_dir


class _Inputs:
    def __init__(self, spark, sf):
        self.folder = shared_dir(spark, "run")
        self.catalog = V.catalog(spark, sf)
        self.all = V.press_documents(spark, sf).select("doc_id", "source", "raw_text", "lang")
        self.earlier = self.all.join(V.table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
        self.run = lambda docs, phase, **kw: P.preprocess(spark, self.folder, docs, self.catalog, phase, **kw)


EARLIER = "doc_id IN (SELECT doc_id FROM labels)"


@query(
    "run_regex",
    with_views(
        f"SELECT source, title, date, md5(cleaned) AS content_md5, CASE WHEN {EARLIER} THEN 1 ELSE 2 END AS attempt FROM rx",
        **{k: v for k, v in PREPARED_VIEWS.items() if k != "ex"},
    ),
)
def q_run_regex(spark, sf):
    """I2 phase regex: two runs, the second cleans only what the first has not"""
    x = _Inputs(spark, sf)
    x.run(x.earlier, "regex")
    m = x.run(x.all, "regex").manifest
    return m.read("regex", P.CLEANED).select("source", "title", "date", F.md5("content").alias("content_md5"), "attempt")


@query(
    "run_llm",
    with_views(
        f"SELECT source, rejected, CASE WHEN rejected THEN reason_ END AS reason, md5(CASE WHEN NOT rejected THEN content END) AS content_md5, "
        f"CASE WHEN {EARLIER} AND NOT rejected THEN 1 ELSE 2 END AS attempt FROM v",
        **{k: v for k, v in FILTERED_VIEWS.items() if k not in ("acc", "ex")},
    ),
)
def q_run_llm(spark, sf):
    """I2 phase llm: accepted texts stay as they are, rejects of the earlier run are judged again"""
    x = _Inputs(spark, sf)
    x.run(x.earlier, "regex")
    x.run(None, "llm")
    x.run(x.all, "regex")
    m: Manifest = x.run(None, "llm").manifest
    good = P.accepted(m).select("source", "rejected", "reason", F.md5("content").alias("content_md5"), "attempt")
    last = max(i for i, _ in m.outputs("llm"))
    bad = P.rejected(m).select("source", F.lit(True).alias("rejected"), "reason", F.lit(None).cast("string").alias("content_md5"), F.lit(last).alias("attempt"))
    return good.unionByName(bad)


def _summary_sql(used: str, rejects: str) -> str:
    return (
        "SELECT CAST(count(*) AS BIGINT) AS total_processed, CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train_samples, "
        "CAST(count(*) FILTER (WHERE split = 'eval') AS BIGINT) AS eval_samples, CAST(coalesce(sum(word_count), 0) AS BIGINT) AS total_words, "
        f"'instruct' AS format_style, {used} AS llm_filtered, {rejects} AS rejected_count FROM sp"
    )


@query(
    "run_format",
    with_views(_summary_sql("false", "CAST(0 AS BIGINT)"), **FILTERED_VIEWS, sp=sql_split_on("ex", "source_pdf")),
)
def q_run_format(spark, sf):
    """I2 phase format after regex and llm: accepted texts are preferred; the summary as written"""
    x = _Inputs(spark, sf)
    x.run(x.all, "regex")
    x.run(None, "llm")
    return x.run(None, "format").summary


def _examples(df):
    return df.select(F.md5("text").alias("text_md5"), "title", "source_pdf", "date", F.col("word_count").cast("bigint").alias("word_count"), F.col("split").cast("string").alias("split"))


EXAMPLES_SQL = "SELECT md5(text) AS text_md5, title, source_pdf, date, word_count, split FROM sp"


@query("run_all", with_views(EXAMPLES_SQL, **FILTERED_VIEWS, sp=sql_split_on("ex", "source_pdf")))
def q_run_all(spark, sf):
    """I2 phase all, after an earlier run of it over fewer documents: splits as written"""
    x = _Inputs(spark, sf)
    x.run(x.earlier, "all")
    return _examples(x.run(x.all, "all").examples)


@query("run_no_llm", with_views(EXAMPLES_SQL, **PREPARED_VIEWS, sp=sql_split_on("ex", "source_pdf")))
def q_run_no_llm(spark, sf):
    """I2 phase no-llm although accepted texts are there: JSON lines as written"""
    x = _Inputs(spark, sf)
    x.run(x.earlier, "all")
    out = x.run(x.all, "no-llm").output
    fields = "text string, title string, source_pdf string, date string, word_count bigint, split string"
    return _examples(spark.read.schema(fields).json(f"{out}/jsonl"))


# cleaned texts without the lines that stand in a tenth of them (and in three)
WITHOUT_HEADERS = dict(FILTERED_VIEWS)
WITHOUT_HEADERS["hl"] = f"""SELECT line FROM (SELECT DISTINCT source, trim(unnest(string_split(cleaned, chr(10))), ' ' || chr(9) || chr(13)) AS line FROM rx) WHERE line <> ''
    GROUP BY line HAVING count(*) >= greatest({H.MIN_DOCUMENTS}, (SELECT ceil(count(*) * {H.MIN_SHARE}) FROM rx))"""
WITHOUT_HEADERS["fin"] = """SELECT * EXCLUDE (cleaned, known), array_to_string(list_filter(string_split(cleaned, chr(10)),
    lambda x: NOT list_contains(known, trim(x, ' ' || chr(9) || chr(13)))), chr(10)) AS text FROM rx, (SELECT coalesce(list(line), []) AS known FROM hl)"""
_order = [k for k in WITHOUT_HEADERS if k not in ("hl", "fin")]
_order[_order.index("rx") + 1 : _order.index("rx") + 1] = ["hl", "fin"]
WITHOUT_HEADERS = {k: WITHOUT_HEADERS[k] for k in _order}


@query("run_all_headers", with_views(EXAMPLES_SQL, **WITHOUT_HEADERS, sp=sql_split_on("ex", "source_pdf")))
def q_run_all_headers(spark, sf):
    """I2 phase all with the removal of repeated headers (L9, rule 2)"""
    x = _Inputs(spark, sf)
    return _examples(x.run(x.all, "all", header_share=H.MIN_SHARE).examples)


# ------------------------------------------------------------ collection run
# Two runs over the given pages as listing: the second goes on to a higher
# target. The article behind a catalog row is the given page at its position.
FIRST_TARGET, LAST_TARGET = 60, 150


def _collected(spark, sf):
    pages = V.press_pages(spark, sf)
    n = pages.count()
    at = lambda todo: todo.select("idx", (F.col("idx") % n).alias("page_id"))
    html = lambda todo: at(todo).join(pages.select("page_id", "html"), "page_id").select("idx", "html")
    fetched = V.fetches(spark, sf).select(F.col("idx").alias("page_id"), "status", "content")
    files = lambda todo: at(todo).join(fetched, "page_id").select("idx", "status", "content")
    folder = shared_dir(spark, "collection")
    listing = V.table(spark, sf, "pages")
    for target in (FIRST_TARGET, LAST_TARGET, LAST_TARGET):
        got = CO.collect(spark, folder, listing, target, html, files, F.lit(QC.SCRAPED_AT), QC.LINK_PATTERN)
    return got


COLLECT_VIEWS = dict(
    l=QC.LINKS_SQL,
    g="SELECT id, arg_min(page_id, (page_id, pos)) AS page_id, arg_min(pos, (page_id, pos)) AS pos, arg_min(slug, (page_id, pos)) AS slug FROM l GROUP BY id",
    c=f"SELECT row_number() OVER (ORDER BY page_id, pos) - 1 AS idx, id AS article_id, {QC.sql_norm_url('id', 'slug')} AS u FROM g QUALIFY idx < {LAST_TARGET}",
    md=f"SELECT c.idx, article_id, u AS url, html, {QC.sql_html_to_text('html')} AS markdown FROM c JOIN ({QC.PP}) pp ON pp.page_id = c.idx % (SELECT count(*) FROM pages)",
    a=QC.ARTICLE_SQL.replace("SELECT url,", "SELECT idx, article_id, url,"),
    k="SELECT c.idx, c.article_id, c.u AS url, a.title, a.date, a.pdf_url, a.idx IS NOT NULL AS scraped FROM c LEFT JOIN a ON a.idx = c.idx",
)


@query("run_collect", with_views("SELECT * FROM k", **COLLECT_VIEWS))
def q_run_collect(spark, sf):
    """Collection run in three calls: urls to a target, articles, attachments; the catalog it leaves"""
    return _collected(spark, sf).catalog.drop("scraped_at")


@query(
    "run_collect_files",
    with_views(
        f"""SELECT k.idx, {QC.sql_pdf_name('k.idx', 'k.title')} AS file_name, f.status,
              CASE WHEN f.status <> 200 THEN 'failed' WHEN f.content IS NULL OR f.content[1:4] <> '%PDF'::BLOB THEN 'not_pdf' ELSE 'ok' END AS result,
              CASE WHEN f.status = 200 AND f.idx % 3 <> 0 THEN 1 WHEN k.idx < {FIRST_TARGET} THEN 3 ELSE 2 END AS fetches
            FROM k JOIN f ON f.idx = k.idx % (SELECT count(*) FROM pages) WHERE nullif(k.pdf_url, '') IS NOT NULL""",
        **COLLECT_VIEWS,
        f=V.fetches_sql(),
    ),
)
def q_run_collect_files(spark, sf):
    """Attachments of the collection run: good files are fetched once, the others again by every call"""
    f = _collected(spark, sf).files
    return f.groupBy("idx", "file_name").agg(F.max("status").alias("status"), F.max("result").alias("result"), F.count(F.lit(1)).cast("int").alias("fetches"))
