"""Shared folders, path schemes and files that are not what they should be."""

import hashlib
import json

import pytest
from pyspark.errors import PySparkException

from quarry import session
from quarry.sources import io as S


def test_local_masters():
    assert session.is_local("local") and session.is_local("local[8]")
    assert not session.is_local("local-cluster[3,2,3000]") and not session.is_local("spark://host:7077") and not session.is_local("yarn")


def test_missing_shared_folder_is_an_error_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(session, "is_local", lambda master: False)

    class Unset:
        class sparkContext:
            master = "yarn"
            getConf = staticmethod(lambda: {})
            getCheckpointDir = staticmethod(lambda: None)

        conf: dict = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Unset(), "x")


def test_paths_without_scheme(spark, tmp_path):
    assert session.qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert session.qualified(spark, f"file://{tmp_path}") == f"file://{tmp_path}"
    files = spark.createDataFrame([("a.pdf", b"%PDF-1"), ("b.pdf", None)], "name string, content binary")
    S.write_files(files, f"{tmp_path}/pdfs", "name", "content")
    assert [r["file_name"] for r in S.read_binary(spark, f"{tmp_path}/pdfs").collect()] == ["a.pdf"]


def test_catalog_arrays(spark, tmp_path):
    (tmp_path / "ok").mkdir()
    (tmp_path / "ok" / "c.json").write_text(json.dumps([{"article_id": "T1EN"}, {"article_id": "T2EN", "idx": 7}]))
    assert {(r["idx"], r["article_id"]) for r in S.read_catalog_json_array(spark, f"{tmp_path}/ok").collect()} == {(0, "T1EN"), (7, "T2EN")}
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "c.json").write_text('[{"article_id": ')
    with pytest.raises(PySparkException, match="no JSON array"):
        S.read_catalog_json_array(spark, f"{tmp_path}/bad").collect()


def test_press_pages_exercise_every_branch(spark):
    import __spark_entry__ as entry
    from helpers import SF_SMALL

    q = lambda k: entry.queries()[k](spark, SF_SMALL)
    assert {r["src"] for r in q("link_fallback").select("src").distinct().collect()} == {"js", "embedded", "regex", "none"}
    rec = q("article_record")
    for c in ("date", "pdf_url"):
        assert not rec.filter(f"{c} is null").isEmpty() and not rec.filter(f"{c} is not null").isEmpty()
    assert not q("index_lookup").filter("idx > 0").isEmpty()


def test_processed_files_are_listed_by_the_executors(spark, tmp_path, monkeypatch):
    import __spark_entry__ as entry
    from quarry.plans import q_io

    monkeypatch.setattr(q_io, "FILES_PER_FOLDER", 10, raising=False)
    docs = [(i, f" Title {i}\nline é {i}\n", "en", "web") for i in range(100)] + [(7, " Title 7\nline é 7\n", "en", "web"), (200, None, "en", "web")]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    monkeypatch.setattr(q_io, "shared_dir", lambda spark, name: seen.append(f"{tmp_path}/{name}") or seen[-1])
    out = entry.queries()["processed_text_files"](spark, str(tmp_path))
    assert out.inputFiles() == []  # no list of the files in the driver, which grew with the rows
    folders = list((tmp_path / "processed").iterdir())
    assert all(p.is_dir() for p in folders) and 5 < len(folders) <= 11
    assert sum(len(list(p.iterdir())) for p in folders) == 100  # a name that comes twice is one file, a null text none
    want = {(f"Title {i}", None if i % 3 == 0 else "2024-01-01", f"{i:03d}_web.pdf", hashlib.md5(f"Title {i}\nline é {i}".encode()).hexdigest()) for i in range(100)}
    got = [tuple(r) for r in out.collect()]
    assert len(got) == 100 and set(got) == want


def test_text_files_as_the_reader_of_spark_gives_them(spark, tmp_path):
    files = {"a.txt": b"a", "b c%#.txt": b"x y\r\n", "empty.txt": b"", ".h.txt": b"h", "_h.txt": b"h", "_k=1.txt": b"k", "o.dat": b"o", "bad.txt": b"\xff\xfe", "in/deep/d.txt": b"d", "_no/e.txt": b"e", "k=1/f.txt": b"f" * 5_000_000}
    for name, data in files.items():
        (tmp_path / "d" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "d" / name).write_bytes(data)
    rows = lambda df: sorted((r[0], bytes(r[1])) for r in df.selectExpr("file_name", "cast(value as binary)").collect())
    plain = lambda glob: spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(f"{tmp_path}/d", wholetext=True).selectExpr("_metadata.file_name", "value")
    for glob, n in (("*.txt", 6), ("*", 7), ("{a,b*}.t[!y]t", 3), ("*.none", 0)):
        assert rows(S.read_text_files(spark, f"{tmp_path}/d", glob)) == rows(plain(glob)) and len(rows(plain(glob))) == n
    (tmp_path / "nothing").mkdir()
    assert rows(S.read_text_files(spark, f"{tmp_path}/nothing")) == []
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        S.read_text_files(spark, f"{tmp_path}/missing")
    assert rows(S.read_text_files(spark, f"{tmp_path}/d/i*")) == [("d.txt", b"d")]  # a pattern, not a folder: left to Spark
