"""Content filter.

The filter protocol is: build a prompt from (title, first 8,000 chars), get
a generated answer, parse optional reasoning (``analysis ... assistantfinal``),
route ``REJECT: reason`` answers to a reject log and re-append the
untouched tail of long texts to accepted answers.

The answer generator is pluggable (``score_batches``: Arrow batches of 14
rows through ``mapInPandas`` with one lazily loaded model per Python
worker). The default generator is ``rule_verdict``: the prompt's cleaning
and validation rules written as JVM expressions, so the default path never
leaves whole-stage codegen.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import fixed
from quarry.functions.regex import jre, strip_space
from quarry.operators.clean import bind


#: The user message around its two placeholders.
USER_HEAD, _, USER_MID = fixed.FILTER_USER_TEMPLATE.partition("{title}")
USER_MID, _, USER_TAIL = USER_MID.partition("{content}")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip(c: Column) -> Column:
    return strip_space(c)


# ---------------------------------------------------------------- L1-L3
def is_blank(text: Column | str) -> Column:
    """L1: null or whitespace-only text (never sent to the model)."""
    t = _c(text)
    return t.isNull() | ~t.rlike(jre(r"[^\s]", ""))


def truncate_head(text: Column | str, n: int = fixed.FILTER_MAX_INPUT_CHARS) -> Column:
    """L2: first ``n`` characters."""
    return F.substring(_c(text), 1, n)


def user_message(title: Column | str, content: Column | str) -> Column:
    return F.concat(
        F.lit(USER_HEAD),
        _c(title),
        F.lit(USER_MID),
        _c(content),
        F.lit(USER_TAIL),
    )


def build_prompt(title: Column | str, text: Column | str) -> Column:
    """L3: ``[{system}, {user}]`` messages for one document (head only)."""
    return F.array(
        F.struct(F.lit("system").alias("role"), F.lit(fixed.FILTER_SYSTEM_PROMPT).alias("content")),
        F.struct(F.lit("user").alias("role"), user_message(title, truncate_head(text)).alias("content")),
    )


# ---------------------------------------------------------------- L5-L7
def parse_response(generated: Column | str) -> Column:
    """struct(reasoning, answer) split at the first ``assistantfinal``."""
    return bind(_strip(_c(generated)), _parsed)


def _parsed(g: Column) -> Column:
    has = F.locate(fixed.ANSWER_MARKER, g) > 0
    left = F.substring_index(g, fixed.ANSWER_MARKER, 1)
    right = g.substr(F.locate(fixed.ANSWER_MARKER, g) + len(fixed.ANSWER_MARKER), F.lit(1 << 30))
    pos_a = F.locate(fixed.REASONING_MARKER, left)
    after_a = left.substr(pos_a + len(fixed.REASONING_MARKER), F.lit(1 << 30))
    reasoning = F.when(has, _strip(F.when(pos_a > 0, after_a).otherwise(left)))
    answer = F.when(has, _strip(right)).otherwise(g)
    return F.struct(reasoning.alias("reasoning"), answer.alias("answer"))


def route_reject(answer: Column | str) -> Column:
    """struct(rejected, reason) from a ``REJECT:`` answer."""
    a = _c(answer)
    rej = a.startswith(fixed.REJECT_PREFIX)
    reason = F.when(rej, _strip(a.substr(F.lit(len(fixed.REJECT_PREFIX) + 1), F.lit(1 << 30))))
    return F.struct(rej.alias("rejected"), reason.alias("reason"))


def append_tail(answer: Column | str, original: Column | str, n: int = fixed.FILTER_MAX_INPUT_CHARS) -> Column:
    """Accepted answer + the original text after the first ``n`` characters."""
    o = _c(original)
    return F.when(F.length(o) > n, F.concat(_c(answer), o.substr(F.lit(n + 1), F.lit(1 << 30)))).otherwise(_c(answer))


def verdicts(df: DataFrame, generated: str = "generated", text: str = "text", head_only: bool = True) -> DataFrame:
    """L1 + L5 + L6 + L7: one verdict per row.

    ``head_only``: the generator saw the text's head alone, so accepted
    answers get the tail back (L7); False where it read the whole text.

    Adds ``rejected``, ``reason``, ``reasoning`` and ``content`` (null when
    rejected). Blank inputs are rejected with the fixed empty-content reason
    whatever the generator said (the generator never sees them).
    """
    p = df.withColumn("_p", parse_response(generated))
    p = p.withColumn("_r", route_reject(F.col("_p.answer")))
    blank = is_blank(text)
    return p.select(
        *df.columns,
        (blank | F.col("_r.rejected")).alias("rejected"),
        F.when(blank, F.lit(fixed.EMPTY_REASON)).otherwise(F.col("_r.reason")).alias("reason"),
        F.when(blank, F.lit(None).cast("string")).otherwise(F.col("_p.reasoning")).alias("reasoning"),
        F.when(blank | F.col("_r.rejected"), F.lit(None).cast("string"))
        .otherwise(append_tail(F.col("_p.answer"), F.col(text)) if head_only else F.col("_p.answer"))
        .alias("content"),
    )


def split_verdicts(v: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) from one verdict table.

    The caller should persist ``v`` (or write it as a phase output) so the
    generator does not run twice for the two branches.
    """
    accepted = v.filter(~F.col("rejected"))
    rejected = v.filter(F.col("rejected")).select(
        F.col("source"), F.col("title"), F.col("reason"), F.col("reasoning")
    )
    return accepted, rejected


def skip_filtered(df: DataFrame, accepted: DataFrame, key: str = "source", rejects: DataFrame | None = None) -> DataFrame:
    """Drop inputs already accepted (and optionally already rejected)."""
    out = df.join(accepted.select(key).distinct(), key, "left_anti")
    if rejects is not None:
        out = out.join(rejects.select(key).distinct(), key, "left_anti")
    return out


def reject_reasons(rejected: DataFrame) -> DataFrame:
    """Rejects per reason, most frequent first."""
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason")


# ----------------------------------------------------------- L9 (default)
# Stop words per language for the language check (four languages of the corpus).
STOP_WORDS = {
    "en": ["the", "and", "of", "to", "is", "in", "it", "that", "was", "for", "with", "as", "on", "are", "this"],
    "de": ["der", "die", "und", "das", "ist", "nicht", "zu", "den", "von", "mit", "sich", "des", "auf", "ein", "eine"],
    "fr": ["le", "la", "les", "et", "des", "un", "une", "du", "est", "que", "qui", "dans", "pour", "pas", "sur"],
    "es": ["el", "los", "las", "y", "en", "una", "por", "con", "para", "es", "se", "del", "al", "lo", "como"],
}
LANG_ORDER = ["en", "de", "fr", "es"]
MIN_WORDS = 20
MIN_LETTER_SHARE = 0.5
HEADER_LINES = r"(?m)^(?:Topic|Subject|Date|Page)[ \t:][^\n]*\n?"


#: A line of a list, and one of a table (tabs, bars or wide gaps between at least three cells).
LIST_LINE = r"^[ \t]*(?:[•*\-–·▪]|\d{1,3}[.)])[ \t]"
TABLE_LINE = r"\t[^\t\n]+\t|\|[^|\n]+\||\S {2,}\S.* {2,}\S"
LIST_SHARE = 0.8
LIST_MIN_LINES = 3


def only_lists(text: Column) -> Column:
    """True where at least ``LIST_SHARE`` of three or more non-blank lines are list or table lines.

    The patterns meet only what can match: the first characters of a line after
    its indent, and lines with a tab, a bar or a wide gap.
    """

    def listing(x: Column) -> Column:
        head = F.substring(F.ltrim(x, F.lit(" \t")), 1, 5)  # the longest mark: three digits, a dot, a space
        gap = functools.reduce(operator.or_, [x.contains(w) for w in ("\t", "|", "  ")])
        return head.rlike(LIST_LINE) | (gap & x.rlike(TABLE_LINE))

    def mostly(full: Column) -> Column:
        listed = F.filter(full, listing)
        return (F.size(full) >= LIST_MIN_LINES) & (F.size(listed) >= F.lit(LIST_SHARE) * F.size(full))

    return bind(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"\S")), mostly)


def cut_before_title(text: Column, title: Column) -> Column:
    """Rule 1: drop everything before the first occurrence of the title."""
    pos = F.call_function("instr", text, title)
    return F.when((F.length(title) > 0) & (pos > 1), text.substr(pos, F.lit(1 << 30))).otherwise(text)


def stop_word_hits(words: Column, lang: str) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(STOP_WORDS[lang])))


ALL_STOP_WORDS = sorted({w for ws in STOP_WORDS.values() for w in ws})


def guessed_language(text: Column) -> Column:
    """Language with the most stop-word hits (ties in ``LANG_ORDER``); null if none.

    One pass keeps only stop words (a hash-set test per word); the four
    per-language counts then run over that short array.
    """
    words = F.split(F.lower(text), r"[^\p{L}]+")
    stops = F.filter(words, lambda w: w.isin(ALL_STOP_WORDS))

    def pick(h: Column) -> Column:
        best = F.array_max(h)
        out = F.when(best == 0, F.lit(None).cast("string"))
        for i, lang in enumerate(LANG_ORDER):
            out = out.when(h[i] == best, F.lit(lang))
        return out

    hits = bind(stops, lambda w: F.array(*[stop_word_hits(w, lang) for lang in LANG_ORDER]))
    return bind(hits, pick)


def has_words(t: Column, n: int) -> Column:
    """True where ``t`` holds ``n`` words or more; reads no further than the ``n``-th."""
    return t.rlike(rf"\A\s*+(?:\S++\s++){{{n - 1}}}\S") if n > 0 else t.isNotNull()


def _verdict(t: Column, lang: Column, min_words: int, min_letter_share: float) -> Column:
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]++", ""))
    share = letters / F.greatest(F.length(t), F.lit(1))
    reject = (
        F.when(t == "", F.lit("empty after cleaning"))
        .when(t.rlike(r"^[\s•\-*]*$"), F.lit("only bullet points"))
        .when(only_lists(t), F.lit("only tables or lists"))
        .when(share < min_letter_share, F.lit("garbled text"))
        .when(~has_words(t, min_words), F.lit("too few words"))
        .when(lang.isin(LANG_ORDER) & (guessed_language(t) != lang), F.lit("wrong language"))  # null where it has no guess
    )
    # every check stands in the plan once: inside a lambda nothing that is written twice is evaluated once
    return F.coalesce(F.concat(F.lit(fixed.REJECT_PREFIX + " "), reject), t)


def rule_verdict(
    title: Column | str,
    text: Column | str,
    lang: Column | str,
    min_words: int = MIN_WORDS,
    min_letter_share: float = MIN_LETTER_SHARE,
) -> Column:
    """The filter prompt's rules as expressions; returns a generated answer
    (cleaned text, or ``REJECT: reason`` for the first failing check).

    Rules: (1) cut everything before the title; (2) drop header/footer
    lines (Topic/Subject/Date/Page); (3) reject empty text, bullets only,
    tables or lists only, garbled text (< 50 % letters), fewer than 20 words, or a language other
    than the declared one (stop-word vote; only where that is one of the four
    the vote knows, texts declared otherwise are not judged by it). Reads the whole text. The cleaned text is bound once
    and reused by every check.
    """
    t = _strip(F.regexp_replace(cut_before_title(_c(text), F.coalesce(_c(title), F.lit(""))), HEADER_LINES, ""))
    lang_c = _c(lang)
    return bind(t, lambda x: _verdict(x, lang_c, min_words, min_letter_share))


# -------------------------------------------------------------- L4 plug-in
def score_batches(
    df: DataFrame,
    make_generator: Callable[[], Callable[[list[list[dict]]], list[str]]],
    title: str = "title",
    text: str = "text",
    batch_size: int = fixed.FILTER_BATCH_SIZE,
) -> DataFrame:
    """L4: run a user-supplied generator over prompts in batches.

    ``make_generator()`` is called once per Python worker (lazy model load)
    and returns ``generate(list_of_messages) -> list_of_answers``. Only the user
    message with the text's 8,000-character head crosses Arrow; the system
    prompt is added in the worker, and all other columns stay in the JVM.
    Blank texts are not shown to the generator; they stay, with an empty
    answer, and get their verdict (L1) downstream. Output: the input columns
    plus ``generated``.
    """

    def make_model():
        generate = make_generator()
        system = {"role": "system", "content": fixed.FILTER_SYSTEM_PROMPT}
        return lambda users: [{"generated": g} for g in generate([[system, {"role": "user", "content": u}] for u in users])]

    return score_with(df, make_model, "generated string", title, text, batch_size).withColumn("generated", F.coalesce("answer.generated", F.lit(""))).drop("answer")


def score_with(
    df: DataFrame,
    make_model: Callable[[], Callable[[list[str]], list[dict]]],
    fields: str,
    title: str = "title",
    text: str = "text",
    batch_size: int = fixed.FILTER_BATCH_SIZE,
    out: str = "answer",
) -> DataFrame:
    """L4 with any answer: ``make_model()`` -> ``answers(user messages) -> one dict of ``fields`` each``.

    Adds the struct ``out`` with the columns that ``fields`` (DDL) names, null for
    blank texts. Batches hold ``batch_size`` messages, the last of a partition
    and Arrow batch fewer; a model that returns another number of answers than
    it was asked for is an error.
    """
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import StructType

    kind = StructType.fromDDL(fields)

    def make_predict():
        model = make_model()

        def predict(users) -> dict:
            import numpy as np

            at = [i for i, u in enumerate(users) if u is not None]
            got = list(model([users[i] for i in at])) if at else []
            if len(got) != len(at):
                raise ValueError(f"{len(at)} prompts, {len(got)} answers")
            out = {n: np.full(len(users), None, object) for n in kind.names}
            for i, a in zip(at, got, strict=True):
                for n in kind.names:
                    out[n][i] = a.get(n)
            return out

        return predict

    ask = predict_batch_udf(make_predict, return_type=kind, batch_size=batch_size)
    user = F.when(~is_blank(text), user_message(F.coalesce(F.col(title), F.lit("")), truncate_head(text)))
    got = ask(user)
    return df.withColumn(out, got)


def echo_generator() -> Callable[[list[list[dict]]], list[str]]:
    """Stand-in generator: accepts every text unchanged, with a reasoning line."""
    head = USER_MID

    def generate(batch: list[list[dict]]) -> list[str]:
        out = []
        for messages in batch:
            user = messages[-1]["content"]
            body = user.split(head, 1)[1] if head in user else user
            body = body[: -len(USER_TAIL)] if body.endswith(USER_TAIL) else body
            out.append(f"{fixed.REASONING_MARKER} Looks like a clean article. {fixed.ANSWER_MARKER} {body}")
        return out

    return generate
