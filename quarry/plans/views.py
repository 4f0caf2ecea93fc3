"""Derived views over the driver tables, in two forms each.

The Spark form is a DataFrame function; the SQL form is a DuckDB CTE body
used by the oracle. Both must produce the same rows. The views wrap the
invented prose of ``documents`` in press-release furniture (headers, page
markers, contact blocks, hyphen breaks) so that every cleaning rule family
has work to do; they never drop rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import fixed
from quarry.functions.regex import sql_str


# Tables whose rows carry text or vectors heavy enough that one task per
# input file would leave cores idle when a file holds a single row group.
SPREAD_TABLES = {"documents", "pages", "conversations", "embeddings", "events", "benchmark"}


def spread(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the cluster's cores when the scan would leave cores idle.

    So it does with fewer partitions than cores, and with more of them where
    few hold the rows: splits are cut by bytes, but a row group is read by one
    split whole, so a large file of few row groups yields many empty ones. The
    rows of each split are counted from the files' footers (a scan of no column).
    Round robin, not a key, so a hot key cannot concentrate rows; on a large input
    (many full splits) this is a no-op.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    if parts < n or (parts < MANY_SPLITS * n and idle(df, n)):
        return df.repartition(max(4 * n, parts))  # a few tasks per core evens out long and short texts
    return df


#: So many splits per core are taken to be full ones.
MANY_SPLITS = 16


def idle(df: DataFrame, cores: int) -> bool:
    """True where rounds of ``cores`` tasks, each as long as the largest split, take a fifth longer than an even deal."""
    per = df.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    r = per.agg(F.max("n").alias("most"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("filled")).first()
    return bool(r["all"]) and -(-r["filled"] // cores) * r["most"] * cores > 1.2 * r["all"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in SPREAD_TABLES else df


# ---------------------------------------------------------------- documents
HEADER = "    CORPORATE COMMUNICATIONS\n\n    Media Information\n    01 January 2024\n\n"
CONTACT_HEAD = "Media Contact.\nJane Doe\nPhone: +49 89 382 "
HYPHEN_TAIL = "Further infor-\nmation  about the\tproduct  follows."


def press_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents + ``title`` + boilerplate-wrapped ``raw_text`` + file ``source``."""
    d = table(spark, sf_dir, "documents")
    did = F.col("doc_id")
    sid = did.cast("string")
    title = F.substring(F.substring_index(F.col("text"), "\n", 1), 1, 60)
    subject = F.when(did % 3 == 0, F.concat(F.lit("Subject "), title, F.lit("\n\n"))).otherwise(F.lit(""))
    page = F.when(did % 2 == 0, F.concat(F.lit("Page "), (did % 9 + 1).cast("string"), F.lit("\n"))).otherwise(
        F.lit("")
    )
    digits = F.concat((did % 97 + 1).cast("string"), F.lit("\n"))
    tail = F.when(
        did % 5 == 0,
        F.concat(F.lit(CONTACT_HEAD), sid, F.lit("\nEmail: press"), sid, F.lit("@example.com\n")),
    ).otherwise(F.lit(HYPHEN_TAIL))
    raw = F.concat(F.lit(HEADER), subject, F.col("text"), F.lit("\n\n\n"), page, digits, tail)
    return d.select(
        "doc_id",
        "lang",
        F.col("source").alias("origin"),
        F.col("text"),
        title.alias("title"),
        raw.alias("raw_text"),
        F.format_string("%03d_%s.pdf", did, F.col("source")).alias("source"),
    )


def press_documents_sql() -> str:
    title = "substr(split_part(text, chr(10), 1), 1, 60)"
    return f"""
    SELECT doc_id, lang, source AS origin, text, {title} AS title,
      {sql_str(HEADER)}
      || CASE WHEN doc_id % 3 = 0 THEN 'Subject ' || {title} || chr(10) || chr(10) ELSE '' END
      || text || chr(10) || chr(10) || chr(10)
      || CASE WHEN doc_id % 2 = 0 THEN 'Page ' || CAST(doc_id % 9 + 1 AS VARCHAR) || chr(10) ELSE '' END
      || CAST(doc_id % 97 + 1 AS VARCHAR) || chr(10)
      || CASE WHEN doc_id % 5 = 0
              THEN {sql_str(CONTACT_HEAD)} || CAST(doc_id AS VARCHAR) || chr(10) || 'Email: press'
                   || CAST(doc_id AS VARCHAR) || '@example.com' || chr(10)
              ELSE {sql_str(HYPHEN_TAIL)} END AS raw_text,
      printf('%03d_%s.pdf', doc_id, source) AS source
    FROM documents"""


# -------------------------------------------------------------- press pages
ATTACHMENT_BASE = fixed.ARTICLE_URL_BASE.replace("/detail/", "/attachment/")
SECTION_TITLES = ["Press Contact.", "Author.", "Downloads.", "This article in other PressClubs", "Article Offline Attachments.", "Article Media Material."]


def press_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages whose html ends in press furniture, by ``page_id``.

    A good, a broken or no embedded link list; a detail link; an attachment
    link as text or only in an attribute; one of the six page sections; a
    date in one of three forms. All rows and all of the html are kept.
    """
    p = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    n = pid.cast("string")
    say = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    none = F.lit("")
    listed = F.when(pid % 5 == 0, say('<script>window.collectedArticles = [{"id":"T', n, 'EN","slug":"one"},{"id":"T', n, '1EN","slug":"two"}];</script>'))
    listed = listed.when(pid % 5 == 1, say('<script>window.collectedArticles = [{"id":"T', n, 'EN",];</script>')).otherwise(none)
    linked = F.when(pid % 3 == 0, say('<p><a href="/global/article/detail/T', n, 'EN/slug?x=1">more</a></p>')).otherwise(none)
    url = say(ATTACHMENT_BASE, "T", n, "EN/", n)
    attached = F.when(pid % 4 == 0, say("<h3>", url, "</h3>")).when(pid % 4 == 1, say('<a href="', url, '"></a>')).otherwise(none)
    day, month = (pid % 28 + 1).cast("string"), F.element_at(F.array(*[F.lit(m) for m in _MONTH_NAMES]), (pid % 12 + 1).cast("int"))
    dated = F.when(pid % 4 == 0, say("<h3>", day, " ", month, " 2024</h3>")).when(pid % 4 == 1, say("<h3>", day, ".", (pid % 13 + 1).cast("string"), ".2024</h3>"))
    dated = dated.when(pid % 4 == 2, say("<h3>", month, " ", day, ", 2024</h3>")).otherwise(none)
    title = F.element_at(F.array(*[F.lit(t) for t in SECTION_TITLES]), (pid % 6 + 1).cast("int"))
    section = say("<h4>", title, "</h4><p>", F.repeat(F.lit("call the desk "), 20), n, "</p><h5>after the section</h5>")
    return p.withColumn("html", F.concat("html", listed, linked, attached, dated, section))


def press_pages_sql() -> str:
    n = "CAST(page_id AS VARCHAR)"
    url = f"{sql_str(ATTACHMENT_BASE)} || 'T' || {n} || 'EN/' || {n}"
    names = lambda xs: "[" + ", ".join(sql_str(x) for x in xs) + "]"
    day, month = "CAST(page_id % 28 + 1 AS VARCHAR)", f"list_extract({names(_MONTH_NAMES)}, CAST(page_id % 12 + 1 AS INTEGER))"
    return f"""
    SELECT page_id, url, html
      || CASE page_id % 5
           WHEN 0 THEN '<script>window.collectedArticles = [{{"id":"T' || {n} || 'EN","slug":"one"}},{{"id":"T' || {n} || '1EN","slug":"two"}}];</script>'
           WHEN 1 THEN '<script>window.collectedArticles = [{{"id":"T' || {n} || 'EN",];</script>' ELSE '' END
      || CASE WHEN page_id % 3 = 0 THEN '<p><a href="/global/article/detail/T' || {n} || 'EN/slug?x=1">more</a></p>' ELSE '' END
      || CASE page_id % 4 WHEN 0 THEN '<h3>' || {url} || '</h3>' WHEN 1 THEN '<a href="' || {url} || '"></a>' ELSE '' END
      || CASE page_id % 4 WHEN 0 THEN '<h3>' || {day} || ' ' || {month} || ' 2024</h3>'
           WHEN 1 THEN '<h3>' || {day} || '.' || CAST(page_id % 13 + 1 AS VARCHAR) || '.2024</h3>'
           WHEN 2 THEN '<h3>' || {month} || ' ' || {day} || ', 2024</h3>' ELSE '' END
      || '<h4>' || list_extract({names(SECTION_TITLES)}, CAST(page_id % 6 + 1 AS INTEGER)) || '</h4><p>'
      || repeat('call the desk ', 20) || {n} || '</p><h5>after the section</h5>' AS html
    FROM pages"""


# ------------------------------------------------------------------ catalog
def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages as an article catalog: idx, article_id, url, title, date, pdf_url, scraped.

    ``idx`` is the catalog position; ``page_id`` is unique and dense from 0,
    so it is the position itself (no single-partition window needed). Empty
    strings stand in for missing values on every seventh row, as a JSON
    catalog would have them.
    """
    p = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    seg = F.element_at(F.split(F.regexp_replace(F.col("url"), r"[?#].*$", ""), "/"), -1)
    art = F.concat(F.lit("T"), pid.cast("string"), F.lit("EN"))
    blank = pid % 7 == 0
    title = F.regexp_extract(F.col("html"), r"<title>([^<]*)</title>", 1)
    return p.select(
        pid.alias("idx"),
        F.when(blank, F.lit("")).otherwise(art).alias("article_id"),
        F.col("url"),
        F.when(blank, F.lit(None).cast("string")).otherwise(title).alias("title"),
        F.when(pid % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.format_string("2024-%02d-%02dT00:00:00+00:00", pid % 12 + 1, pid % 28 + 1))
        .alias("date"),
        F.when(pid % 2 == 0, F.concat(F.lit("https://files.example.com/attachment/"), art, F.lit("/"), seg))
        .otherwise(F.when(blank, F.lit("")))
        .alias("pdf_url"),
        (pid % 4 == 0).alias("scraped"),
    )


def catalog_sql() -> str:
    seg = "list_extract(string_split(regexp_replace(url, '[?#].*$', ''), '/'), -1)"
    art = "'T' || CAST(page_id AS VARCHAR) || 'EN'"
    return f"""
    SELECT page_id AS idx,
      CASE WHEN page_id % 7 = 0 THEN '' ELSE {art} END AS article_id,
      url,
      CASE WHEN page_id % 7 = 0 THEN NULL ELSE regexp_extract(html, '<title>([^<]*)</title>', 1) END AS title,
      CASE WHEN page_id % 3 = 0 THEN NULL
           ELSE printf('2024-%02d-%02dT00:00:00+00:00', page_id % 12 + 1, page_id % 28 + 1) END AS date,
      CASE WHEN page_id % 2 = 0 THEN 'https://files.example.com/attachment/' || {art} || '/' || {seg}
           WHEN page_id % 7 = 0 THEN '' ELSE NULL END AS pdf_url,
      page_id % 4 = 0 AS scraped
    FROM pages"""


# --------------------------------------------------------------- dated text
def dated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents prefixed by a dateline in one of three forms (some impossible)."""
    d = table(spark, sf_dir, "documents")
    did = F.col("doc_id")
    months = F.array(*[F.lit(m) for m in _MONTH_NAMES])
    month = F.element_at(months, (did % 12 + 1).cast("int"))
    day = (did % 31 + 1).cast("string")
    mon = (did % 13 + 1).cast("string")
    year = (2000 + did % 25).cast("string")
    form = did % 4
    line = (
        F.when(form == 0, F.concat(day, F.lit(" "), month, F.lit(" "), year))
        .when(form == 1, F.concat(day, F.lit("."), mon, F.lit("."), year))
        .when(form == 2, F.concat(F.upper(month), F.lit(" "), day, F.lit(", "), year))
        .otherwise(F.lit("no date"))
    )
    return d.select("doc_id", F.concat(F.lit("Munich, "), line, F.lit(". "), F.col("text")).alias("content"))


_MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]


def dated_text_sql() -> str:
    months = "[" + ", ".join(sql_str(m) for m in _MONTH_NAMES) + "]"
    month = f"list_extract({months}, CAST(doc_id % 12 + 1 AS INTEGER))"
    day = "CAST(doc_id % 31 + 1 AS VARCHAR)"
    mon = "CAST(doc_id % 13 + 1 AS VARCHAR)"
    year = "CAST(2000 + doc_id % 25 AS VARCHAR)"
    return f"""
    SELECT doc_id, 'Munich, ' ||
      CASE doc_id % 4
        WHEN 0 THEN {day} || ' ' || {month} || ' ' || {year}
        WHEN 1 THEN {day} || '.' || {mon} || '.' || {year}
        WHEN 2 THEN upper({month}) || ' ' || {day} || ', ' || {year}
        ELSE 'no date' END || '. ' || text AS content
    FROM documents"""


# ---------------------------------------------------------------- responses
def responses(spark: SparkSession, sf_dir: str, by: str = "prompt") -> DataFrame:
    """embeddings as sampled responses: ``grp`` = prompt (vec_id div 8) or label."""
    e = table(spark, sf_dir, "embeddings")
    grp = F.floor(F.col("vec_id") / 8).cast("bigint") if by == "prompt" else F.col("label").cast("bigint")
    return e.select(grp.alias("grp"), F.col("vec_id").alias("rid"), "embedding")


def responses_sql(by: str = "prompt") -> str:
    grp = "CAST(vec_id // 8 AS BIGINT)" if by == "prompt" else "CAST(label AS BIGINT)"
    return f"SELECT {grp} AS grp, vec_id AS rid, embedding FROM embeddings"


# ------------------------------------------------------------ raw verdicts
def raw_verdicts_expr(doc_id, text):
    """Model-style outputs by ``doc_id % 4``: reasoning+answer, reject, plain, blank."""
    k = doc_id % 4
    return (
        F.when(k == 0, F.concat(F.lit("analysis The text reads fine. assistantfinal "), text))
        .when(k == 1, F.concat(F.lit("analysis Too short. assistantfinal REJECT: "), F.lit("too few words")))
        .when(k == 2, text)
        .otherwise(F.lit("   "))
    )


def raw_verdicts_sql(doc_id: str = "doc_id", text: str = "text") -> str:
    return f"""CASE {doc_id} % 4
        WHEN 0 THEN 'analysis The text reads fine. assistantfinal ' || {text}
        WHEN 1 THEN 'analysis Too short. assistantfinal REJECT: too few words'
        WHEN 2 THEN {text}
        ELSE '   ' END"""


# ------------------------------------------------------------------ fetches
def fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch results per catalog row: status 200/404, PDF or HTML bytes."""
    p = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    status = F.when(pid % 5 == 0, F.lit(404)).otherwise(F.lit(200))
    body = F.when(
        pid % 3 == 0, F.concat(F.lit("<html>"), F.col("html"))
    ).otherwise(F.concat(F.lit("%PDF-1.4\n"), F.col("html")))
    return p.select(
        pid.alias("idx"),
        F.col("url"),
        status.alias("status"),
        F.when(status == 200, F.encode(body, "UTF-8")).alias("content"),
    )


def fetches_sql() -> str:
    return """
    SELECT page_id AS idx, url,
      CASE WHEN page_id % 5 = 0 THEN 404 ELSE 200 END AS status,
      CASE WHEN page_id % 5 = 0 THEN NULL
           WHEN page_id % 3 = 0 THEN encode('<html>' || html)
           ELSE encode('%PDF-1.4' || chr(10) || html) END AS content
    FROM pages"""
