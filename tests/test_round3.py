"""What steps move and make, beside their results."""

import random
import re

from pyspark.sql import functions as F

from helpers import SF_SMALL
from quarry.functions import fixed
from quarry.functions.regex import RARE_SPACE, strip_space
from quarry.operators import clean as X
from quarry.operators import evaluation as E
from quarry.operators import filtering as L


def test_word_count_makes_no_string_of_every_word(spark):
    rnd = random.Random(3)
    some = [*RARE_SPACE, *" \t\n\x0b\f\r", "​", "᠎", "\0", "\x7f", "\U0001f600", "́", *"ab.$\\"]
    texts = ["", " ", "\x1c", "　", "a", None, *("".join(rnd.choice(some) for _ in range(rnd.randint(0, 12))) for _ in range(2000))]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", X.word_count("t").alias("n"))
    assert df.schema["n"].dataType.simpleString() == "bigint"
    assert all(r["n"] == (None if r["t"] is None else len(r["t"].split())) for r in df.collect())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and len(re.findall(r"\breplace\(", plan)) <= 4  # one pass for all rare white space


def test_backoff_model_moves_numbers_and_each_gram_once(spark, monkeypatch):
    import quarry.session as session

    rows = [(i, "the cat sat on the mat " * 3, "train") for i in range(20)] + [(i, "the cat sat on a dog", "eval") for i in range(30, 33)] + [(33, None, "eval"), (34, "", "eval")]
    df = spark.createDataFrame(rows, "doc_id int, text string, split string")
    written, plain = [], session.materialize
    monkeypatch.setattr(session, "materialize", lambda x, name="phase": written.append((name, x.schema)) or plain(x, name))
    got = {r["doc_id"]: r["n_tokens"] for r in E.ngram_doc_losses(df, "doc_id", "text", 3).collect()}
    assert got == {30: 6, 31: 6, 32: 6}
    assert not [(n, f.name) for n, s in written for f in s if f.dataType.simpleString() == "string"]
    # one table of n-grams per order, and none of them per document
    assert [n for n, _ in written].count("gram-counts") == 1 and [n for n, _ in written].count("gram-continuations") == 2
    asked = {r["w2"]: r["n"] for r in E.grams(df.filter("doc_id = 30"), [], "text", 3).groupBy("w2").count().withColumnRenamed("count", "n").collect()}
    assert sorted(asked.values()) == [1, 1, 1, 1, 1, 1]


def test_line_and_space_patterns_equal_the_plain_ones(spark):
    rnd = random.Random(5)
    texts = ["", " ", "\t", "\n", " a", "a ", None, *("".join(rnd.choice(" \t\nab.\r　") for _ in range(rnd.randint(0, 14))) for _ in range(3000))]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", X.trim_lines("t").alias("lines"), X.norm_spaces("t").alias("spaces"), strip_space(F.col("t")).alias("strip"), L.is_blank("t").alias("blank"), L.has_words(F.col("t"), 3).alias("three")).collect()
    for r in got:
        t = r["t"]
        if t is None:
            assert r["lines"] is None and r["spaces"] is None and r["strip"] is None and r["blank"] is True
            continue
        assert r["lines"] == re.sub(r"(?m)^[ \t]+|[ \t]+$", "", t) and r["spaces"] == re.sub(r"[ \t]+", " ", t)
        assert r["strip"] == t.strip() and r["blank"] == (t.strip() == "") and r["three"] == (len(re.findall(r"[^ \t\n\r\f\v]+", t)) >= 3)
    plan = df.select(X.trim_lines("t"), X.norm_spaces("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "^[" not in plan and "{2,}" not in plan  # neither tries a line's start or a run at every character


def test_list_lines_are_found_behind_an_indent(spark):
    lines = ["\t \t• a", "12. a", "123) a", "1234. a", "a\tb\tc", "|a|", "a  b  c", "a  b", "-a", "- a", " ", "plain words", "*\tx"]
    df = spark.createDataFrame([("\n".join([x] * 3),) for x in lines], "t string")
    plain = [len(x.strip()) > 0 and bool(re.search(L.LIST_LINE, x) or re.search(L.TABLE_LINE, x)) for x in lines]
    assert [r[0] for r in df.select(L.only_lists(F.col("t"))).collect()] == plain


def test_verdict_evaluates_each_check_once(spark):
    df = spark.createDataFrame([("a", "b", "en")], "title string, text string, lang string")
    v = L.verdicts(df.withColumn("generated", L.rule_verdict("title", "text", "lang")), head_only=False)
    plan = v._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(lower(") == 1 and plan.count("garbled text") == 1 and "regexp_extract_all" not in plan
    assert len(re.findall(re.escape(L.TABLE_LINE.split("|")[0]), plan)) == 1


def test_filtered_phase_writes_each_text_once(spark, monkeypatch):
    from quarry.plans import q_filter

    written, plain = [], q_filter.materialize
    monkeypatch.setattr(q_filter, "materialize", lambda x, *a: written.append(x.columns) or plain(x, *a))
    acc, rej = q_filter.filtered_phase(spark, SF_SMALL)
    assert len(written) == 1 and "content" in written[0] and not {"text_in", "generated"} & set(written[0])
    assert acc.count() > 0 and rej.columns == ["source", "title", "reason", "reasoning"]


def test_rules_that_need_a_word_in_common_stand_in_steps_of_their_own():
    patterns = [p for _, p in fixed.BOILERPLATE_RULES]
    steps = X.rule_steps(patterns)
    assert [p for s in steps for p in s] == patterns and len(steps) <= X.MOST_STEPS
    first = next(s for s in steps if "CORPORATE" in s[0])
    assert len(first) == 1
    assert len(X.rule_steps(["abc"] * 200)) <= X.MOST_STEPS
    assert X.quick_part("investor") == "vestor" and X.quick_part("fax") == "fax" and X.quick_part("www.") == "www."


def test_rows_of_a_large_row_group_are_spread(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from quarry.plans import views as V

    n = spark.sparkContext.defaultParallelism
    t = pa.table({"doc_id": range(40_000), "text": [f"{i} {i * 7919 % 10007}" for i in range(40_000)]})
    pq.write_table(t, tmp_path / "one.parquet")
    pq.write_table(t, tmp_path / "many.parquet", row_group_size=400)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        size = (tmp_path / "one.parquet").stat().st_size
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // (2 * n)))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        filled = lambda df: [len(p) for p in df.select("doc_id").rdd.glom().collect() if p]
        one = spark.read.parquet(str(tmp_path / "one.parquet"))
        assert one.rdd.getNumPartitions() >= n and len(filled(one)) == 1
        dealt = filled(V.spread(one))
        assert len(dealt) >= 4 * n and sum(dealt) == 40_000 and max(dealt) < 40_000 / n
        many = spark.read.parquet(str(tmp_path / "many.parquet"))
        assert V.idle(one, n) and (V.idle(many, n) or V.spread(many) is many)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
