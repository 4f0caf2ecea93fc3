"""Text extraction and cleaning (X1-X15) as column expressions.

``clean_text`` is one projection of nested ``regexp_replace`` calls, so it
runs inside whole-stage codegen, needs no shuffle and scales with the number
of input partitions. Rules are data (``fixed.BOILERPLATE_RULES``) folded in
order; a rule can be switched off by group.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import fixed
from quarry.functions.regex import RARE_SPACE, jre, probe_text, required_words, strip_space


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fix_hyphens(c: Column | str) -> Column:
    """``beauti-\\nful`` -> ``beautiful``.

    ``(\\w)-\\n(\\w)``, but looked for by its hyphen; the letter before it must not
    be the last one of the match before (``\\G``).
    """
    return F.regexp_replace(_col(c), jre(r"-\n(?<=\w-\n)(?<!\G-\n)(\w)", ""), "$1")


def norm_spaces(c: Column | str) -> Column:
    """Runs of spaces/tabs -> one space; a single space stays as it is."""
    return F.regexp_replace(_col(c), r"[ \t](?:(?<=\t)|[ \t])[ \t]*+", " ")


def trim_lines(c: Column | str) -> Column:
    """Strip spaces/tabs at both ends of every line.

    ``^[ \t]+|[ \t]+$``, but looked for by a first space; a line's start or end is only asked for there.
    """
    return F.regexp_replace(_col(c), r"[ \t](?:(?<![^\n][ \t])[ \t]*+|[ \t]*+(?![^\n]))", "")


def norm_paragraphs(c: Column | str) -> Column:
    """Three or more newlines -> one blank line."""
    return F.regexp_replace(_col(c), r"\n{3,}", "\n\n")


def drop_page_numbers(c: Column | str) -> Column:
    """Lines made of digits only (``\\s*`` also takes following blank lines)."""
    return F.regexp_replace(_col(c), jre(r"^\d+\s*$", "md"), "")


def bind(c: Column, fn) -> Column:
    """Evaluate ``c`` once and use it several times inside ``fn``.

    ``when(guard(c), f(c)).otherwise(c)`` would copy the whole expression
    below ``c`` three times, and the copies multiply along a rule chain; a
    lambda variable refers to one evaluated value instead.
    """
    return F.element_at(F.transform(F.array(c), fn), 1)


#: Letters of European texts from frequent to rare.
FREQUENT = "etaoinsrhldcumfpgwybvkxjqz"


def quick_part(word: str, least: int = 4) -> str:
    """The part of ``word`` from its rarest letter on, at least ``least`` characters of it.

    A search compares at every place that holds the first letter, so a rare
    one is found faster; a text without the part has not the word either.
    """
    starts = range(max(1, len(word) - least + 1))
    return word[max(starts, key=lambda i: (FREQUENT.find(word[i]) if word[i] in FREQUENT else len(FREQUENT), -i)) :]


#: Steps of a rule chain, one nested in the other; the analyser takes two rounds for each, and a hundred in all.
MOST_STEPS = 30


def rule_steps(patterns: list[str]) -> list[list[str]]:
    """The patterns in order, dealt to ``MOST_STEPS`` steps at most: two to a step unless they need a word in common."""
    words = lambda p: {w for one in required_words(p) for w in one}
    steps: list[list[str]] = []
    for p in patterns:
        if steps and len(steps[-1]) < 2 and not words(p) & words(steps[-1][0]):
            steps[-1].append(p)
        else:
            steps.append([p])
    size = max(2, -(-len(patterns) // MOST_STEPS))
    return steps if len(steps) <= MOST_STEPS else [patterns[i : i + size] for i in range(0, len(patterns), size)]


def strip_boilerplate(
    c: Column | str,
    rules: Iterable[tuple[str, str]] = fixed.BOILERPLATE_RULES,
    skip_groups: Iterable[str] = (),
    guards: bool = True,
) -> Column:
    """Ordered rule table folded into one chain of ``regexp_replace``.

    With ``guards``, a rule, or two neighbouring ones, run only on a running text that holds
    the words which every match of either needs: a search in the lower-cased text, which
    is kept beside the text from rule to rule. Rules that need a word in common stand
    in steps of their own, as the first often takes what the second looks for. The
    result is the same; rules that cannot match cost a substring search, and none
    scans to the end of the text for a literal that is not there.
    """
    skip = set(skip_groups)
    patterns = [p for group, p in rules if group not in skip]

    if not guards:
        return functools.reduce(lambda x, p: F.regexp_replace(x, jre(p), ""), patterns, _col(c))

    def holds(probe: Column, p: str) -> Column:
        told = sorted(required_words(p), key=lambda one: -min(map(len, one)))  # the longest words tell most
        return functools.reduce(operator.and_, [functools.reduce(operator.or_, [probe.contains(quick_part(w)) for w in one]) for one in told], F.lit(True))

    # the running text with its probe, which is made anew only where a rule has changed the text
    state = lambda t, probe: F.struct(t.alias("t"), probe.alias("probe"))
    probed = lambda t: state(t, probe_text(t))

    def step(some: list[str]):
        def after(s: Column) -> Column:
            cut = functools.reduce(lambda x, p: F.regexp_replace(x, jre(p), ""), some, s["t"])
            return bind(cut, lambda t: F.when(t == s["t"], s).otherwise(probed(t)))

        # none can match before another has changed the text
        return lambda s: F.when(functools.reduce(operator.or_, [holds(s["probe"], p) for p in some]), after(s)).otherwise(s)

    out = bind(_col(c), probed)
    for some in rule_steps(patterns):
        out = bind(out, step(some))
    return out["t"]


def strip_and_collapse(c: Column | str) -> Column:
    """Unicode strip, then collapse blank-line runs."""
    return norm_paragraphs(strip_space(_col(c)))


def clean_text(c: Column | str, rules: Iterable[tuple[str, str]] = fixed.BOILERPLATE_RULES, **kw) -> Column:
    """X2 -> X3 -> X4 -> X5 -> X6 -> X7 -> X8, in this order."""
    t = drop_page_numbers(norm_paragraphs(trim_lines(norm_spaces(fix_hyphens(c)))))
    return strip_and_collapse(strip_boilerplate(t, rules, **kw))


def word_count(c: Column | str) -> Column:
    """Whitespace-separated token count (``len(str.split())``)."""
    rare, low = "".join(RARE_SPACE), [x for x in RARE_SPACE if x.isascii()]

    def count(t: Column) -> Column:
        # white space that Java's plain \S does not know becomes a blank first; a text of ASCII alone has as many bytes as characters
        plain = functools.reduce(lambda x, y: F.replace(x, F.lit(y), F.lit(" ")), low, t)
        plain = F.when(F.octet_length(t) == F.length(t), plain).otherwise(F.translate(t, rare, " " * len(rare)))
        # each word with the white space around it leaves its first character; counting matches would make a string of every word
        return F.length(F.regexp_replace(plain, r"\s*(?:(\S)\S*\s*|\z)", "$1"))

    return bind(_col(c), count).cast("bigint")


def idx_from_name(c: Column | str) -> Column:
    """Leading ``NNN_`` of a file name as an integer, else null."""
    digits = F.regexp_extract(_col(c), r"^(\d+)_", 1)
    return F.when(digits != "", digits.cast("bigint"))


def once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add ``expr`` as column ``name`` so that it is evaluated once per row.

    A filter on a projected alias is pushed below the projection by
    Catalyst with the expression substituted, which would run an expensive
    expression (the whole cleaning chain) twice. Generating the value keeps
    later filters above it.
    """
    return df.select("*", F.explode(F.array(expr)).alias(name))


def drop_empty(df: DataFrame, raw_col: str = "raw_text") -> DataFrame:
    """Rows without extracted text are not emitted (before cleaning)."""
    return df.filter(F.col(raw_col).isNotNull() & (F.col(raw_col) != ""))


def length_cap(df: DataFrame, col: str = "cleaned", cap: int = fixed.TEXT_LENGTH_THRESHOLD) -> DataFrame:
    """X11: drop texts longer than ``cap`` characters after cleaning."""
    return df.filter(F.length(col) <= cap)


def clean_documents(
    df: DataFrame,
    raw_col: str = "raw_text",
    out_col: str = "cleaned",
    cap: int | None = None,
    **kw,
) -> DataFrame:
    """Regex phase on a table of extracted texts: X10 -> X9, and X11 only where a cap is given."""
    df = drop_empty(df, raw_col)
    df = once(df, out_col, clean_text(raw_col, **kw))
    return df if cap is None else length_cap(df, out_col, cap)


def enrich_metadata(docs: DataFrame, catalog: DataFrame, name_col: str = "source") -> DataFrame:
    """Left join on the index taken from the file name.

    The catalog has one row per article; it is broadcast only when Spark's
    size estimate is under the broadcast threshold (AQE re-plans otherwise),
    so no unbounded side is ever broadcast. Title falls back to the file stem
    when the catalog row or its title is missing; date defaults to ''.
    """
    cat = catalog.select(
        F.col("idx").alias("_idx"), F.col("title").alias("_cat_title"), F.col("date").alias("_cat_date")
    )
    stem = F.regexp_replace(F.col(name_col), r"\.[^.]*$", "")
    # a row without an index can never match; instead of a null key (all such
    # rows would meet in one task) it gets a spread negative key that no
    # catalog position (>= 0) has
    idx = idx_from_name(name_col)
    spread_miss = -1 - F.pmod(F.xxhash64(F.col(name_col)), F.lit(1 << 16))
    joined = docs.withColumn("_idx", F.coalesce(idx, spread_miss)).join(cat, "_idx", "left")
    return joined.withColumn("title", F.coalesce(F.col("_cat_title"), stem)).withColumn(
        "date", F.coalesce(F.col("_cat_date"), F.lit(""))
    ).drop("_idx", "_cat_title", "_cat_date")


def skip_processed(df: DataFrame, done: DataFrame, key: str = "stem") -> DataFrame:
    """Anti-join against outputs that already exist."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def assemble_pages(pages: DataFrame, key: str = "source", page_no: str = "page_no", text: str = "text") -> DataFrame:
    """Join non-empty page texts in page order with a blank line.

    Input is the long table ``(source, page_no, text)`` one row per page, so
    a document's pages are one group; ``array_sort`` of structs fixes the
    order (collect_list has none). A document whose pages all failed yields ''.
    """
    parts = F.array_sort(F.collect_list(F.struct(F.col(page_no).alias("n"), F.col(text).alias("t"))))
    nonempty = F.filter(parts, lambda p: p["t"].isNotNull() & (p["t"] != ""))
    return pages.groupBy(key).agg(F.array_join(F.transform(nonempty, lambda p: p["t"]), "\n\n").alias("raw_text"))
