"""Formatting (F1-F10) and the processed-text codec."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import fixed
from quarry.functions.regex import strip_space
from quarry.operators.clean import word_count


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_title(title: Column | str) -> Column:
    """strip whitespace, then drop every trailing dot."""
    return F.regexp_replace(strip_space(_c(title)), r"\.+\z", "")


def format_instruct(title: Column | str, content: Column | str, system: str = fixed.SYSTEM_MESSAGE) -> Column:
    """three-turn chat markup."""
    s, e = fixed.IM_START, fixed.IM_END
    return F.concat(
        F.lit(f"{s}system\n{system}{e}\n{s}user\n{fixed.INSTRUCT_USER_PREFIX}"),
        clean_title(title),
        F.lit(f"{e}\n{s}assistant\n"),
        _c(content),
        F.lit(e),
    )


def format_article(title: Column | str, content: Column | str, heading: str = fixed.ARTICLE_HEADING_PREFIX) -> Column:
    """heading + blank line + content."""
    return F.concat(F.lit(heading), clean_title(title), F.lit("\n\n"), _c(content))


def first_paragraph(content: Column | str) -> Column:
    return F.substring_index(_c(content), "\n\n", 1)


def format_qa(title: Column | str, content: Column | str) -> Column:
    """question about the title, answer = text before the first blank line."""
    s, e = fixed.IM_START, fixed.IM_END
    return F.concat(
        F.lit(f"{s}user\n{fixed.QA_QUESTION_PREFIX}"),
        clean_title(title),
        F.lit(f"?{e}\n{s}assistant\n"),
        first_paragraph(content),
        F.lit(e),
    )


def format_style(title: Column | str, content: Column | str, style: str) -> Column:
    """dispatch on style; an unknown style leaves the content unchanged."""
    if style == "instruct":
        return format_instruct(title, content)
    if style == "article":
        return format_article(title, content)
    if style == "qa":
        return format_qa(title, content)
    return _c(content)


def training_examples(df: DataFrame, style: str = "instruct", content: str = "content") -> DataFrame:
    """text, title, source_pdf, date (empty -> null), word_count of content."""
    return df.select(
        format_style("title", content, style).alias("text"),
        F.col("title"),
        F.col("source").alias("source_pdf"),
        F.nullif(F.col("date"), F.lit("")).alias("date"),
        word_count(content).alias("word_count"),
    )


def chat_messages(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """one ``ARRAY<STRUCT<role, content>>`` per conversation, in turn order.

    A conversation is one record, so its turns form a bounded group.
    """
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return turns.groupBy(key).agg(
        F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias(
            "messages"
        )
    )


def render_chat(messages: Column | str, open_assistant: bool = False) -> Column:
    """role-framed markup from a messages array."""
    s, e = fixed.IM_START, fixed.IM_END
    body = F.array_join(
        F.transform(_c(messages), lambda m: F.concat(F.lit(s), m["role"], F.lit("\n"), m["content"], F.lit(e))),
        "\n",
    )
    return F.concat(body, F.lit(f"\n{s}assistant\n")) if open_assistant else body


def prompt_text(topic: Column, mode: Column) -> Column:
    """F8: system + user turn with optional mode token + open assistant turn."""
    s, e = fixed.IM_START, fixed.IM_END
    return F.concat(
        F.lit(f"{s}system\n{fixed.SYSTEM_MESSAGE}{e}\n{s}user\n"),
        mode,
        F.lit(fixed.INSTRUCT_USER_PREFIX),
        topic,
        F.lit(f"{e}\n{s}assistant\n"),
    )


def prompt_set(topics: DataFrame, topic_col: str = "topic") -> DataFrame:
    """F8: every topic in the three modes (think, no-think, fine-tuned = none).

    The modes are a generator (``explode`` of a literal array), not a join.
    """
    modes = F.array(
        F.struct(F.lit("think").alias("mode"), F.lit(fixed.THINK_TOKEN).alias("token")),
        F.struct(F.lit("no_think").alias("mode"), F.lit(fixed.NO_THINK_TOKEN).alias("token")),
        F.struct(F.lit("finetuned").alias("mode"), F.lit("").alias("token")),
    )
    x = topics.select("*", F.inline(modes))
    return x.withColumn("prompt", prompt_text(F.col(topic_col), F.col("token"))).drop("token")


def select_source(filtered: DataFrame, regex_only: DataFrame, phase: str) -> tuple[DataFrame, bool]:
    """prefer the filtered set when it has rows, except in phase ``no-llm``.

    Returns the chosen DataFrame and whether it is the filtered one. The
    emptiness test is a ``LIMIT 1`` action, not a count.
    """
    if phase != "no-llm" and not filtered.isEmpty():
        return filtered, True
    return regex_only, False


# ---------------------------------------------------------- processed text
def serialize_processed(
    title: Column | str, date: Column | str, source: Column | str, content: Column | str, reasoning=None
) -> Column:
    """Delimiter-framed text; null date -> ''; reasoning block only if non-empty."""
    head = F.concat(
        F.lit(f"{fixed.METADATA_START}\nTITLE: "),
        _c(title),
        F.lit("\nDATE: "),
        F.coalesce(_c(date), F.lit("")),
        F.lit("\nSOURCE: "),
        _c(source),
        F.lit("\n"),
    )
    if reasoning is None:
        reason_block = F.lit("")
    else:
        r = _c(reasoning)
        reason_block = F.when(r.isNotNull() & (r != ""), F.concat(F.lit(f"{fixed.REASONING_START}\n"), r, F.lit("\n"))).otherwise(
            F.lit("")
        )
    return F.concat(head, reason_block, F.lit(f"{fixed.CONTENT_START}\n"), _c(content))


def _strip(c: Column) -> Column:
    return strip_space(c)


def _after(t: Column, marker: str) -> Column:
    """Text after the first occurrence of ``marker`` ('' when absent)."""
    pos = F.locate(marker, t)
    return F.when(pos > 0, t.substr(pos + len(marker), F.lit(1 << 30))).otherwise(F.lit(""))


def parse_processed(text: Column | str, file_name: Column | str) -> Column:
    """Framed text -> struct(title, date, source, content).

    Split on the first ``CONTENT_START\\n``; reasoning is dropped; for each
    header key the last line wins; a file without the delimiter falls back
    to (stem, null, file name, whole text). Content is stripped only in the
    well-formed case.
    """
    t = _c(text)
    name = _c(file_name)
    marker = fixed.CONTENT_START + "\n"
    well = F.locate(marker, t) > 0
    header = F.substring_index(F.substring_index(t, marker, 1), fixed.REASONING_START, 1)
    lines = F.split(header, "\n")

    def last(prefix: str) -> Column:
        hits = F.filter(lines, lambda ln: ln.startswith(prefix))
        value = F.element_at(hits, -1).substr(F.lit(len(prefix) + 1), F.lit(1 << 30))
        return F.when(F.size(hits) > 0, _strip(value))

    stem = F.regexp_replace(name, r"\.[^./]*$", "")
    parsed = F.struct(
        F.coalesce(last("TITLE: "), F.lit("")).alias("title"),
        F.nullif(last("DATE: "), F.lit("")).alias("date"),
        F.coalesce(last("SOURCE: "), F.lit("")).alias("source"),
        _strip(_after(t, marker)).alias("content"),
    )
    fallback = F.struct(
        stem.alias("title"),
        F.lit(None).cast("string").alias("date"),
        name.alias("source"),
        t.alias("content"),
    )
    return F.when(well, parsed).otherwise(fallback)
