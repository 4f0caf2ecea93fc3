"""Queries for the content filter (L), source selection (F9) and the
filtered preparation run (I2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import fixed
from quarry.functions.regex import sql_str
from quarry.operators import filtering as L
from quarry.operators import formatting as FM
from quarry.operators import headers as H
from quarry.operators import splits as T
from quarry.plans import views as V
from quarry.plans.q_prepare import PREPARED_VIEWS, regex_phase, sql_examples, sql_split_on
from quarry.plans.registry import query, with_views
from quarry.session import materialize

PD = V.press_documents_sql()
BLANK_INPUT = " \n\t "


def sql_strip(e):
    return f"regexp_replace({e}, '\\A\\s+|\\s+\\z', '', 'g')"


# Filter inputs: wrapped documents, with every 25th text blank (never sent to a model).
FI_SQL = f"SELECT doc_id, title, source, lang, CASE WHEN doc_id % 25 = 7 THEN {sql_str(BLANK_INPUT)} ELSE raw_text END AS text FROM pd"


def filter_inputs(spark, sf):
    pd = V.press_documents(spark, sf)
    text = F.when(F.col("doc_id") % 25 == 7, F.lit(BLANK_INPUT)).otherwise(F.col("raw_text"))
    return pd.select("doc_id", "title", "source", "lang", text.alias("text"))


def sql_blank(t):
    return f"({t} IS NULL OR {sql_strip(t)} = '')"


def sql_user(title, text):
    return (
        f"{sql_str(L.USER_HEAD)} || {title} || {sql_str(L.USER_MID)} || "
        f"substr({text}, 1, {fixed.FILTER_MAX_INPUT_CHARS}) || {sql_str(L.USER_TAIL)}"
    )


def sql_parse(g_expr):
    """(reasoning, answer) SQL expressions over a subquery column ``g`` = stripped generated."""
    m, a = fixed.ANSWER_MARKER, fixed.REASONING_MARKER
    left = f"split_part(g, '{m}', 1)"
    right = f"substr(g, strpos(g, '{m}') + {len(m)})"
    reasoning = (
        f"CASE WHEN strpos(g, '{m}') > 0 THEN {sql_strip(f'CASE WHEN strpos({left}, {sql_str(a)}) > 0 THEN substr({left}, strpos({left}, {sql_str(a)}) + {len(a)}) ELSE {left} END')} END"
    )
    answer = f"CASE WHEN strpos(g, '{m}') > 0 THEN {sql_strip(right)} ELSE g END"
    return f"SELECT *, {reasoning} AS reasoning, {answer} AS answer FROM (SELECT *, {sql_strip(g_expr)} AS g FROM {{src}})"


def sql_verdicts(src: str, gen: str, head_only: bool = True) -> dict:
    """Views p (parsed) and v (verdicts) over ``src`` having columns text and ``gen``."""
    rej = f"starts_with(answer, {sql_str(fixed.REJECT_PREFIX)})"
    reason = f"CASE WHEN {rej} THEN {sql_strip(f'substr(answer, {len(fixed.REJECT_PREFIX) + 1})')} END"
    tail = f"CASE WHEN length(text) > {fixed.FILTER_MAX_INPUT_CHARS} THEN answer || substr(text, {fixed.FILTER_MAX_INPUT_CHARS + 1}) ELSE answer END" if head_only else "answer"
    blank = sql_blank("text")
    return dict(
        p=sql_parse(gen).format(src=src),
        v=f"""SELECT *, {blank} OR {rej} AS rejected,
                CASE WHEN {blank} THEN {sql_str(fixed.EMPTY_REASON)} ELSE {reason} END AS reason_,
                CASE WHEN {blank} THEN NULL ELSE reasoning END AS reasoning_,
                CASE WHEN {blank} OR {rej} THEN NULL ELSE {tail} END AS content
              FROM p""",
    )


def sql_rule_verdict(title: str, text: str, lang: str) -> dict:
    """Views rv0 (cleaned t) and rv (generated) computing L9 in SQL."""
    t0 = text
    tt = f"coalesce({title}, '')"
    t1 = f"CASE WHEN length({tt}) > 0 AND instr({t0}, {tt}) > 1 THEN substr({t0}, instr({t0}, {tt})) ELSE {t0} END"
    t = sql_strip(f"regexp_replace({t1}, {sql_str(L.HEADER_LINES)}, '', 'g')")
    words = "regexp_split_to_array(lower(t), '[^\\p{L}]+')"
    hits = {
        lang_: f"len(list_filter({words}, lambda w: list_contains([{', '.join(sql_str(x) for x in L.STOP_WORDS[lang_])}], w)))"
        for lang_ in L.LANG_ORDER
    }
    best = f"greatest({', '.join(hits.values())})"
    guess = f"CASE WHEN {best} = 0 THEN NULL " + " ".join(f"WHEN {h} = {best} THEN '{k}'" for k, h in hits.items()) + " END"
    share = "length(regexp_replace(t, '[^\\p{L}]', '', 'g')) / greatest(length(t), 1)"
    nwords = "len(regexp_extract_all(t, '\\S+'))"
    full = "list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '\\S'))"
    listed = f"list_filter({full}, lambda x: regexp_matches(x, {sql_str(L.LIST_LINE)}) OR regexp_matches(x, {sql_str(L.TABLE_LINE)}))"
    only_lists = f"(len({full}) >= {L.LIST_MIN_LINES} AND len({listed}) >= {L.LIST_SHARE} * len({full}))"
    rj = f"""CASE WHEN t = '' THEN 'empty after cleaning'
                  WHEN regexp_matches(t, '^[\\s•\\-*]*$') THEN 'only bullet points'
                  WHEN {only_lists} THEN 'only tables or lists'
                  WHEN {share} < {L.MIN_LETTER_SHARE} THEN 'garbled text'
                  WHEN {nwords} < {L.MIN_WORDS} THEN 'too few words'
                  WHEN {lang} IN ({', '.join(sql_str(x) for x in L.LANG_ORDER)}) AND ({guess}) IS NOT NULL AND ({guess}) <> {lang} THEN 'wrong language' END"""
    return dict(
        rv0=f"SELECT *, {t} AS t FROM {{src}}",
        rv=f"SELECT * EXCLUDE (t), CASE WHEN ({rj}) IS NOT NULL THEN {sql_str(fixed.REJECT_PREFIX + ' ')} || ({rj}) ELSE t END AS generated FROM rv0",
    )


# ---------------------------------------------------------------- L1-L3
@query("guard_empty", with_views(f"SELECT doc_id, {sql_blank('text')} AS blank FROM fi", pd=PD, fi=FI_SQL))
def q_guard(spark, sf):
    """L1 blank-text guard"""
    return filter_inputs(spark, sf).select("doc_id", L.is_blank("text").alias("blank"))


@query("truncate_head", with_views(f"SELECT doc_id, substr(text, 1, {fixed.FILTER_MAX_INPUT_CHARS}) AS head FROM fi", pd=PD, fi=FI_SQL))
def q_head(spark, sf):
    """L2 first 8,000 characters"""
    return filter_inputs(spark, sf).select("doc_id", L.truncate_head("text").alias("head"))


@query(
    "build_prompt",
    with_views(f"SELECT doc_id, CAST(2 AS INTEGER) AS n_messages, {sql_user('title', 'text')} AS user_content FROM fi", pd=PD, fi=FI_SQL),
)
def q_prompt(spark, sf):
    """L3 system + user messages"""
    m = filter_inputs(spark, sf).select("doc_id", L.build_prompt("title", "text").alias("m"))
    return m.select("doc_id", F.size("m").alias("n_messages"), F.col("m")[1]["content"].alias("user_content"))


# ---------------------------------------------------------------- L5-L8
RV_SQL = f"SELECT *, {V.raw_verdicts_sql('doc_id', 'text')} AS generated FROM fi"


def raw_verdicts(spark, sf):
    fi = filter_inputs(spark, sf)
    return fi.withColumn("generated", V.raw_verdicts_expr(F.col("doc_id"), F.col("text")))


@query("parse_response", with_views("SELECT doc_id, reasoning, answer FROM p", pd=PD, fi=FI_SQL, g0=RV_SQL, **{"p": sql_parse("generated").format(src="g0")}))
def q_parse(spark, sf):
    """L5 reasoning / answer split of model-style outputs"""
    p = raw_verdicts(spark, sf).select("doc_id", L.parse_response("generated").alias("p"))
    return p.select("doc_id", "p.reasoning", "p.answer")


@query(
    "route_reject",
    with_views(
        f"SELECT doc_id, starts_with(answer, 'REJECT:') AS rejected, CASE WHEN starts_with(answer, 'REJECT:') THEN {sql_strip('substr(answer, 8)')} END AS reason FROM p",
        pd=PD,
        fi=FI_SQL,
        g0=RV_SQL,
        p=sql_parse("generated").format(src="g0"),
    ),
)
def q_route(spark, sf):
    """L6 REJECT routing"""
    p = raw_verdicts(spark, sf).select("doc_id", L.route_reject(L.parse_response("generated")["answer"]).alias("r"))
    return p.select("doc_id", "r.rejected", "r.reason")


VERDICT_VIEWS = dict(pd=PD, fi=FI_SQL, g0=RV_SQL, **sql_verdicts("g0", "generated"))


@query("append_tail", with_views("SELECT doc_id, content FROM v WHERE NOT rejected", **VERDICT_VIEWS))
def q_tail(spark, sf):
    """L7 accepted answers with the untouched tail of long texts"""
    v = L.verdicts(raw_verdicts(spark, sf))
    return v.filter(~F.col("rejected")).select("doc_id", "content")


@query("split_verdicts", with_views("SELECT doc_id, rejected, reason_ AS reason, reasoning_ AS reasoning FROM v", **VERDICT_VIEWS))
def q_split_verdicts(spark, sf):
    """L8 verdict table feeding the accepted set and the reject log"""
    v = L.verdicts(raw_verdicts(spark, sf))
    return v.select("doc_id", "rejected", "reason", "reasoning")


# ---------------------------------------------------------------- L9-L11
RULE_VIEWS = dict(pd=PD, fi=FI_SQL)
RULE_VIEWS.update({k: v.format(src="fi") if k == "rv0" else v for k, v in sql_rule_verdict("title", "text", "lang").items()})
RULE_VIEWS.update(sql_verdicts("rv", "generated", head_only=False))


def rule_verdicts(spark, sf):
    fi = filter_inputs(spark, sf)
    return L.verdicts(fi.withColumn("generated", L.rule_verdict("title", "text", "lang")), head_only=False)


@query("rule_filter", with_views("SELECT doc_id, rejected, reason_ AS reason FROM v", **RULE_VIEWS))
def q_rule_filter(spark, sf):
    """L9 native rule validator as the default generator"""
    return rule_verdicts(spark, sf).select("doc_id", "rejected", "reason")


@query(
    "skip_filtered",
    with_views("SELECT doc_id, source FROM fi WHERE source NOT IN (SELECT source FROM v WHERE NOT rejected AND doc_id % 2 = 0)", **RULE_VIEWS),
)
def q_skip_filtered(spark, sf):
    """L10 skip inputs accepted by an earlier run (even doc ids); rejects are retried"""
    prev = rule_verdicts(spark, sf).filter((F.col("doc_id") % 2 == 0) & ~F.col("rejected"))
    return L.skip_filtered(filter_inputs(spark, sf), prev).select("doc_id", "source")


@query("reject_reasons", with_views("SELECT reason_ AS reason, count(*) AS n FROM v WHERE rejected GROUP BY reason_", **RULE_VIEWS))
def q_reasons(spark, sf):
    """L11 rejects per reason"""
    return L.reject_reasons(rule_verdicts(spark, sf).filter("rejected"))


# lines of at least a tenth of all documents (and three) go, before the rules
HEADER_VIEWS = dict(
    pd=PD,
    hl=f"""SELECT line, CAST(count(*) AS BIGINT) AS n_documents FROM (
             SELECT DISTINCT doc_id, trim(unnest(string_split(raw_text, chr(10))), ' ' || chr(9) || chr(13)) AS line FROM pd) WHERE line <> ''
           GROUP BY line HAVING count(*) >= greatest({H.MIN_DOCUMENTS}, (SELECT ceil(count(*) * {H.MIN_SHARE}) FROM pd))""",
    hx="""SELECT doc_id, title, source, lang, raw_text, list_filter(string_split(raw_text, chr(10)),
             lambda x: NOT list_contains(known, trim(x, ' ' || chr(9) || chr(13)))) AS kept FROM pd, (SELECT coalesce(list(line), []) AS known FROM hl)""",
    hd="SELECT doc_id, title, source, lang, array_to_string(kept, chr(10)) AS text, CAST(len(string_split(raw_text, chr(10))) - len(kept) AS BIGINT) AS n_removed FROM hx",
)


@query("line_frequencies", with_views("SELECT line, n_documents FROM hl", **{k: HEADER_VIEWS[k] for k in ("pd", "hl")}))
def q_line_frequencies(spark, sf):
    """L9 lines that stand in a tenth of all documents or more"""
    return H.line_frequencies(V.press_documents(spark, sf), "raw_text")


@query("repeated_headers", with_views("SELECT doc_id, md5(text) AS text_md5, n_removed FROM hd", **HEADER_VIEWS))
def q_repeated_headers(spark, sf):
    """L9 documents without their repeated header lines"""
    x = H.without_headers(V.press_documents(spark, sf).select("doc_id", F.col("raw_text").alias("text")))
    return x.select("doc_id", F.md5("text").alias("text_md5"), "n_removed")


HEADED_VIEWS = dict(HEADER_VIEWS)
HEADED_VIEWS.update({k: v.format(src="hd") if k == "rv0" else v for k, v in sql_rule_verdict("title", "text", "lang").items()})
HEADED_VIEWS.update(sql_verdicts("rv", "generated", head_only=False))


@query("rule_filter_headers", with_views("SELECT doc_id, rejected, reason_ AS reason, md5(content) AS content_md5 FROM v", **HEADED_VIEWS))
def q_rule_filter_headers(spark, sf):
    """L9 whole: repeated headers over the corpus, then the rules of each document"""
    pd = V.press_documents(spark, sf).select("doc_id", "title", "source", "lang", F.col("raw_text").alias("text"))
    x = H.without_headers(pd)
    v = L.verdicts(x.withColumn("generated", L.rule_verdict("title", "text", "lang")), head_only=False)
    return v.select("doc_id", "rejected", "reason", F.md5("content").alias("content_md5"))


ECHO_SQL = f"""SELECT doc_id, {sql_blank('text')} AS rejected, CASE WHEN {sql_blank('text')} THEN {sql_str(fixed.EMPTY_REASON)} END AS reason,
    CASE WHEN NOT {sql_blank('text')} THEN md5({sql_strip(f'substr(text, 1, {fixed.FILTER_MAX_INPUT_CHARS})')}
         || CASE WHEN length(text) > {fixed.FILTER_MAX_INPUT_CHARS} THEN substr(text, {fixed.FILTER_MAX_INPUT_CHARS + 1}) ELSE '' END) END AS content_md5
  FROM fi"""


@query("score_batches", with_views(ECHO_SQL, pd=PD, fi=FI_SQL))
def q_score_batches(spark, sf):
    """L4 batched generator plug-in (stand-in generator) followed by the verdict parse"""
    scored = L.score_batches(filter_inputs(spark, sf), L.echo_generator)
    return L.verdicts(scored).select("doc_id", "rejected", "reason", F.md5(F.col("content")).alias("content_md5"))


# -------------------------------------------------- F9 and the filtered run
def filtered_phase(spark, sf):
    """Regex phase output screened by the rule validator: (accepted, rejected)."""
    rx = regex_phase(spark, sf).select("title", "date", "source", "lang", F.col("cleaned").alias("text_in"))
    gen = rx.withColumn("generated", L.rule_verdict("title", "text_in", "lang"))
    v = L.verdicts(gen, text="text_in", head_only=False).drop("text_in", "generated")  # ``content`` is the text that goes on
    v = materialize(v)  # one verdict table feeds both branches
    return L.split_verdicts(v)


FILTERED_VIEWS = dict(PREPARED_VIEWS)
FILTERED_VIEWS.pop("ex")
FILTERED_VIEWS["fin"] = "SELECT * EXCLUDE (cleaned), cleaned AS text FROM rx"
FILTERED_VIEWS.update({k: v.format(src="fin") if k == "rv0" else v for k, v in sql_rule_verdict("title", "text", "lang").items()})
FILTERED_VIEWS.update(sql_verdicts("rv", "generated", head_only=False))
FILTERED_VIEWS["acc"] = "SELECT * FROM v WHERE NOT rejected"
FILTERED_VIEWS["ex"] = sql_examples("acc", "content")


@query(
    "select_source",
    with_views(
        "SELECT source, true AS llm_filtered FROM acc WHERE (SELECT count(*) FROM acc) > 0 "
        "UNION ALL SELECT source, false AS llm_filtered FROM rx WHERE (SELECT count(*) FROM acc) = 0",
        **FILTERED_VIEWS,
    ),
)
def q_select_source(spark, sf):
    """F9 prefer the filtered set when it has rows (phase 'format')"""
    acc, _ = filtered_phase(spark, sf)
    chosen, is_filtered = FM.select_source(acc, regex_phase(spark, sf), "format")
    return chosen.select("source", F.lit(is_filtered).alias("llm_filtered"))


@query("prepare_with_filter", with_views(sql_split_on("ex", "source_pdf"), **FILTERED_VIEWS))
def q_prepare_filtered(spark, sf):
    """I2 regex -> rule filter -> format -> split"""
    acc, _ = filtered_phase(spark, sf)
    ex = FM.training_examples(acc, "instruct", content="content")
    return T.train_eval_split(ex, "source_pdf")


@query(
    "run_summary_filtered",
    with_views(
        "SELECT CAST(count(*) AS BIGINT) AS total_processed, "
        "CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train_samples, "
        "CAST(count(*) FILTER (WHERE split = 'eval') AS BIGINT) AS eval_samples, "
        "CAST(coalesce(sum(word_count), 0) AS BIGINT) AS total_words, 'instruct' AS format_style, "
        "true AS llm_filtered, (SELECT CAST(count(*) AS BIGINT) FROM v WHERE rejected) AS rejected_count FROM sp",
        **FILTERED_VIEWS,
        sp=sql_split_on("ex", "source_pdf"),
    ),
)
def q_summary_filtered(spark, sf):
    """T3 run summary of the filtered preparation (with reject count)"""
    acc, rej = filtered_phase(spark, sf)
    ex = T.train_eval_split(FM.training_examples(acc, "instruct", content="content"), "source_pdf")
    return T.run_summary(ex, "instruct", llm_filtered=True, rejected=rej)
