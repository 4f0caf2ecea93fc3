"""Queries for cleaning (X), formatting (F), splitting (T) and the two
preparation runs (I2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import fixed
from quarry.functions.regex import sql_str
from quarry.operators import clean as X
from quarry.operators import formatting as FM
from quarry.operators import splits as T
from quarry.operators import tokens as TK
from quarry.plans import sqlfrag as S
from quarry.plans import views as V
from quarry.plans.registry import query, with_views
from quarry.session import materialize

PD = V.press_documents_sql()
CAT = V.catalog_sql()


def _pd(spark, sf):
    return V.press_documents(spark, sf)


def _step(name, col_fn, sql_fn, doc):
    def build(spark, sf):
        return _pd(spark, sf).select("doc_id", col_fn("raw_text").alias("text"))

    build.__doc__ = doc
    query(name, with_views(f"SELECT doc_id, {sql_fn('raw_text')} AS text FROM pd", pd=PD))(build)


_step("fix_hyphens", X.fix_hyphens, S.fix_hyphens, "X2 hyphen repair on wrapped documents")
_step("norm_spaces", X.norm_spaces, S.norm_spaces, "X3 horizontal whitespace")
_step("trim_lines", X.trim_lines, S.trim_lines, "X4 per-line trim")
_step("norm_paragraphs", X.norm_paragraphs, S.norm_paragraphs, "X5 paragraph normalisation")
_step("drop_page_numbers", X.drop_page_numbers, S.drop_page_numbers, "X6 page-number lines")
_step("strip_boilerplate", X.strip_boilerplate, S.strip_boilerplate, "X7 all boilerplate rules")
_step("clean_text", X.clean_text, S.clean_text, "X9 full cleaning chain")


def _group(name, groups):
    rules = [r for r in fixed.BOILERPLATE_RULES if r[0] in groups]
    _step(
        name,
        lambda c: X.strip_boilerplate(c, rules),
        lambda e: S.strip_boilerplate(e, rules),
        f"X7 rule group(s) {', '.join(groups)}",
    )


_group("rules_page_markers", ["page_markers"])
_group("rules_contacts", ["contacts"])
_group("rules_web", ["web"])
_step(
    "strip_and_collapse",
    X.strip_and_collapse,
    S.strip_and_collapse,
    "X8 final strip and blank-line collapse",
)


@query("drop_empty", with_views("SELECT doc_id, source FROM pd WHERE raw_text IS NOT NULL AND raw_text <> ''", pd=PD))
def q_drop_empty(spark, sf):
    """X10 documents with extracted text"""
    return X.drop_empty(_pd(spark, sf)).select("doc_id", "source")


@query(
    "length_cap",
    with_views(
        f"SELECT doc_id, md5(c) AS text_md5 FROM (SELECT doc_id, {S.clean_text('raw_text')} AS c FROM pd) "
        f"WHERE length(c) <= {fixed.TEXT_LENGTH_THRESHOLD}",
        pd=PD,
    ),
)
def q_length_cap(spark, sf):
    """X11 cleaned texts within the length cap (cleaning runs once per row)"""
    df = X.clean_documents(_pd(spark, sf), cap=fixed.TEXT_LENGTH_THRESHOLD)
    return df.select("doc_id", F.md5("cleaned").alias("text_md5"))


@query("idx_from_name", with_views(f"SELECT source, {S.idx_from_name('source')} AS idx FROM pd", pd=PD))
def q_idx_from_name(spark, sf):
    """X12 index from the file name"""
    return _pd(spark, sf).select("source", X.idx_from_name("source").alias("idx"))


ENRICH_SQL = f"""
  SELECT pd.doc_id, pd.source, pd.raw_text, pd.lang,
    coalesce(cat.title, regexp_replace(pd.source, '\\.[^.]*$', '')) AS title,
    coalesce(cat.date, '') AS date
  FROM pd LEFT JOIN cat ON cat.idx = {S.idx_from_name('pd.source')}"""


def _enriched(spark, sf):
    docs = _pd(spark, sf).drop("title")
    return X.enrich_metadata(docs, V.catalog(spark, sf))


@query("enrich_metadata", with_views("SELECT doc_id, title, date FROM en", pd=PD, cat=CAT, en=ENRICH_SQL))
def q_enrich(spark, sf):
    """X13 catalog join on the file-name index"""
    return _enriched(spark, sf).select("doc_id", "title", "date")


@query(
    "skip_processed",
    with_views(
        "SELECT doc_id, source FROM pd WHERE regexp_replace(source, '\\.[^.]*$', '') NOT IN "
        "(SELECT regexp_replace(source, '\\.[^.]*$', '') FROM pd WHERE doc_id IN (SELECT doc_id FROM labels))",
        pd=PD,
    ),
)
def q_skip_processed(spark, sf):
    """X14 anti-join against already-written outputs (labels stand in for them)"""
    docs = _pd(spark, sf).withColumn("stem", F.regexp_replace("source", r"\.[^.]*$", ""))
    done = docs.join(V.table(spark, sf, "labels"), "doc_id", "left_semi").select("stem")
    return X.skip_processed(docs, done, "stem").select("doc_id", "source")


@query("word_count", f"SELECT doc_id, {S.word_count('text')} AS word_count FROM documents")
def q_word_count(spark, sf):
    """X15 whitespace word count"""
    return V.table(spark, sf, "documents").select("doc_id", X.word_count("text").alias("word_count"))


# ------------------------------------------------------------------ formatting
def sql_clean_title(e):
    return f"regexp_replace({S.strip_ws(e)}, '\\.+\\z', '')"


def sql_instruct(title, content):
    s, e = fixed.IM_START, fixed.IM_END
    return (
        f"{sql_str(f'{s}system' + chr(10) + fixed.SYSTEM_MESSAGE + e + chr(10) + s + 'user' + chr(10) + fixed.INSTRUCT_USER_PREFIX)}"
        f" || {sql_clean_title(title)} || {sql_str(e + chr(10) + s + 'assistant' + chr(10))} || {content} || {sql_str(e)}"
    )


def sql_article(title, content):
    return f"{sql_str(fixed.ARTICLE_HEADING_PREFIX)} || {sql_clean_title(title)} || chr(10) || chr(10) || {content}"


def sql_qa(title, content):
    s, e = fixed.IM_START, fixed.IM_END
    return (
        f"{sql_str(s + 'user' + chr(10) + fixed.QA_QUESTION_PREFIX)} || {sql_clean_title(title)} || "
        f"{sql_str('?' + e + chr(10) + s + 'assistant' + chr(10))} || split_part({content}, chr(10) || chr(10), 1) || {sql_str(e)}"
    )


def sql_style(title, content, style):
    return {"instruct": sql_instruct, "article": sql_article, "qa": sql_qa}.get(style, lambda t, c: c)(title, content)


@query("clean_title", with_views(f"SELECT doc_id, {sql_clean_title('title')} AS title FROM pd", pd=PD))
def q_clean_title(spark, sf):
    """F1 title strip and trailing-dot removal"""
    return _pd(spark, sf).select("doc_id", FM.clean_title("title").alias("title"))


def _fmt(name, style, doc):
    def build(spark, sf):
        return _pd(spark, sf).select("doc_id", FM.format_style("title", "text", style).alias("text"))

    build.__doc__ = doc
    query(name, with_views(f"SELECT doc_id, {sql_style('title', 'text', style)} AS text FROM pd", pd=PD))(build)


_fmt("format_instruct", "instruct", "F2 instruct chat markup")
_fmt("format_article", "article", "F3 article heading + content")
_fmt("format_qa", "qa", "F4 question + first paragraph")
_fmt("format_style", "plain", "F5 unknown style leaves content unchanged")


@query(
    "chat_messages",
    "SELECT conv_id, CAST(count(*) AS BIGINT) AS n_messages, string_agg(role || chr(31) || text, chr(30) ORDER BY turn) AS messages "
    "FROM conversations GROUP BY conv_id",
)
def q_chat_messages(spark, sf):
    """F6 messages array per conversation"""
    m = FM.chat_messages(V.table(spark, sf, "conversations"))
    return m.select(
        "conv_id",
        F.size("messages").cast("bigint").alias("n_messages"),
        F.array_join(F.transform("messages", lambda x: F.concat(x["role"], F.lit("\x1f"), x["content"])), "\x1e").alias("messages"),
    )


@query(
    "render_chat",
    f"SELECT conv_id, string_agg({sql_str(fixed.IM_START)} || role || chr(10) || text || {sql_str(fixed.IM_END)}, "
    f"chr(10) ORDER BY turn) || chr(10) || {sql_str(fixed.IM_START + 'assistant')} || chr(10) AS rendered "
    "FROM conversations GROUP BY conv_id",
)
def q_render_chat(spark, sf):
    """F7 chat markup with an open assistant turn"""
    m = FM.chat_messages(V.table(spark, sf, "conversations"))
    return m.select("conv_id", FM.render_chat("messages", open_assistant=True).alias("rendered"))


def sql_prompt(topic, token):
    s, e = fixed.IM_START, fixed.IM_END
    head = f"{s}system\n{fixed.SYSTEM_MESSAGE}{e}\n{s}user\n"
    return (
        f"{sql_str(head)} || {token} || {sql_str(fixed.INSTRUCT_USER_PREFIX)} || {topic} || "
        f"{sql_str(e + chr(10) + s + 'assistant' + chr(10))}"
    )


@query(
    "prompt_set",
    "SELECT item_id, m.mode, "
    + sql_prompt("b.text", "m.token")
    + " AS prompt FROM benchmark b, (VALUES ('think', "
    + sql_str(fixed.THINK_TOKEN)
    + "), ('no_think', "
    + sql_str(fixed.NO_THINK_TOKEN)
    + "), ('finetuned', '')) m(mode, token)",
)
def q_prompt_set(spark, sf):
    """F8 prompt set: benchmark items as topics, three mode tokens"""
    topics = V.table(spark, sf, "benchmark").select("item_id", F.col("text").alias("topic"))
    return FM.prompt_set(topics).select("item_id", "mode", "prompt")


# -------------------------------------------------------------- splitting
SPLIT_SQL = f"""
  SELECT doc_id, CASE WHEN rn <= floor(n * CAST({fixed.DEFAULT_TRAIN_RATIO} AS DOUBLE)) THEN 'train' ELSE 'eval' END AS split
  FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('{fixed.DEFAULT_SEED}:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
               count(*) OVER () AS n FROM documents)"""


def split_documents(spark, sf):
    d = V.table(spark, sf, "documents")
    return T.train_eval_split(d, "doc_id")


@query("train_eval_split", SPLIT_SQL)
def q_split(spark, sf):
    """T1 exact seeded split over documents"""
    return split_documents(spark, sf).select("doc_id", "split")


@query("split_counts", with_views("SELECT split, CAST(count(*) AS BIGINT) AS n FROM sp GROUP BY split", sp=SPLIT_SQL))
def q_split_counts(spark, sf):
    """T2 rows per split"""
    return T.split_counts(split_documents(spark, sf))


# ---------------------------------------------------- preparation runs
def regex_phase(spark, sf):
    """Regex phase: wrapped documents -> catalog metadata -> clean -> cap."""
    docs = _enriched(spark, sf)
    return X.clean_documents(docs).withColumn("title", FM._strip(F.col("title")))


def prepared_no_filter(spark, sf, style="instruct"):
    """Regex phase written at a phase boundary, then format and split."""
    rx = materialize(regex_phase(spark, sf).select("title", "date", "source", "cleaned"))
    ex = FM.training_examples(rx, style, content="cleaned")
    return T.train_eval_split(ex, "source_pdf")


def sql_examples(src: str, content: str, style: str = "instruct") -> str:
    return (
        f"SELECT {sql_style('title', content, style)} AS text, title, source AS source_pdf, "
        f"nullif(date, '') AS date, {S.word_count(content)} AS word_count FROM {src}"
    )


def sql_split_on(src: str, key: str) -> str:
    ratio = f"CAST({fixed.DEFAULT_TRAIN_RATIO} AS DOUBLE)"
    return f"""
  SELECT * EXCLUDE (rn, n), CASE WHEN rn <= floor(n * {ratio}) THEN 'train' ELSE 'eval' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY md5('{fixed.DEFAULT_SEED}:' || CAST({key} AS VARCHAR)), {key}) AS rn,
               count(*) OVER () AS n FROM {src})"""


REGEX_PHASE_SQL = f"""
  SELECT * REPLACE ({S.strip_ws('title')} AS title) FROM (
    SELECT *, {S.clean_text('raw_text')} AS cleaned FROM en WHERE raw_text IS NOT NULL AND raw_text <> '')"""

PREPARED_VIEWS = dict(pd=PD, cat=CAT, en=ENRICH_SQL, rx=REGEX_PHASE_SQL, ex=sql_examples("rx", "cleaned"))
PREPARED_SQL = with_views(sql_split_on("ex", "source_pdf"), **PREPARED_VIEWS)


@query("training_examples", with_views("SELECT * FROM ex", **PREPARED_VIEWS))
def q_training_examples(spark, sf):
    """F10 example projection after the regex phase"""
    return FM.training_examples(regex_phase(spark, sf), "instruct", content="cleaned")


@query("prepare_no_filter", PREPARED_SQL)
def q_prepare_no_filter(spark, sf):
    """I2 regex -> format -> split (flagship)"""
    return prepared_no_filter(spark, sf)


@query(
    "run_summary",
    with_views(
        "SELECT CAST(count(*) AS BIGINT) AS total_processed, "
        "CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train_samples, "
        "CAST(count(*) FILTER (WHERE split = 'eval') AS BIGINT) AS eval_samples, "
        "CAST(coalesce(sum(word_count), 0) AS BIGINT) AS total_words, 'instruct' AS format_style, "
        "false AS llm_filtered, CAST(0 AS BIGINT) AS rejected_count FROM sp",
        **PREPARED_VIEWS,
        sp=sql_split_on("ex", "source_pdf"),
    ),
)
def q_run_summary(spark, sf):
    """T3 run summary of the regex-only preparation"""
    return T.run_summary(prepared_no_filter(spark, sf), "instruct", llm_filtered=False)


# ---------------------------------------------------------- token windows
@query(
    "truncate_tokens",
    f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n_kept, array_to_string(t, ' ') AS kept FROM "
    f"(SELECT doc_id, regexp_extract_all(text, {sql_str(TK.TOKEN_RE2)})[1:{64}] AS t FROM documents)",
)
def q_truncate_tokens(spark, sf):
    """T4 truncate native tokens to max_length=64"""
    d = V.table(spark, sf, "documents")
    t = T.truncate_tokens(TK.tokens("text"), 64)
    return d.select("doc_id", F.size(t).cast("bigint").alias("n_kept"), F.array_join(t, " ").alias("kept"))


PACK_L = 2048


@query(
    "pack_sequences",
    f"""WITH x AS (SELECT doc_id, CAST(len(regexp_extract_all(text, {sql_str(TK.TOKEN_RE2)})) AS BIGINT) AS n FROM documents),
    y AS (SELECT *, sum(n) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS e FROM x WHERE n > 0),
    z AS (SELECT doc_id, e - n AS s, e, unnest(generate_series(CAST(floor((e - n) / {PACK_L}) AS BIGINT),
                                                   CAST(floor((e - 1) / {PACK_L}) AS BIGINT))) AS block FROM y)
    SELECT block, doc_id, CAST(least(e, (block + 1) * {PACK_L}) - greatest(s, block * {PACK_L}) AS BIGINT) AS n_tokens
    FROM z""",
)
def q_pack(spark, sf):
    """T5 sequence packing into 2048-token blocks"""
    d = V.table(spark, sf, "documents").select("doc_id", TK.token_count("text").alias("n"))
    return T.pack_sequences(d, "doc_id", "n", PACK_L)
