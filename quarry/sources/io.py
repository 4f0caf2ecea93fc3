"""Sources and sinks.

Every phase hand-over is a Spark write into a fresh folder under the shared
checkpoint folder (or a caller-given path), never a local temp directory.
Per-row files (attachments, framed text files) are written by the
executors through ``pyarrow.fs`` so the same code works on local disks,
HDFS or object stores.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.discover import CATALOG_SCHEMA
from quarry.session import qualified

SCRAPED_SCHEMA = "url string, title string, date string, pdf_url string, content string, scraped_at string"


# ------------------------------------------------------------ S1, S2
def write_catalog(catalog: DataFrame, path: str) -> str:
    """Catalog snapshot as JSON lines with explicit ``idx`` (never in place)."""
    catalog.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    return path


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalog snapshot scan with a fixed schema; a missing folder is an empty catalog.

    Any other failure (unknown scheme, permission) is raised.
    """
    try:
        return spark.read.schema(CATALOG_SCHEMA).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CATALOG_SCHEMA)


def read_catalog_json_array(spark: SparkSession, path: str) -> DataFrame:
    """S1 (compatibility): catalogs stored as JSON arrays (one array per file).

    An element's ``idx`` is used when present, else its array position. A
    JSON array is one document, so each file is parsed by one task; large
    catalogs should be written as JSON lines (``write_catalog``) or as
    several array files (``write_catalog_json_arrays``). A file that holds no
    JSON array is an error, not an empty catalog.
    """
    fields = "idx:bigint,article_id:string,url:string,title:string,date:string,pdf_url:string,scraped:boolean,scraped_at:string"
    raw = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    arr = F.from_json("value", f"array<struct<{fields}>>")
    bad = F.raise_error(F.concat(F.lit("no JSON array: "), F.col("_metadata.file_path")))
    x = raw.select(F.posexplode(F.coalesce(arr, bad)).alias("pos", "a"))
    return x.select(F.coalesce(F.col("a.idx"), F.col("pos").cast("bigint")).alias("idx"), "a.article_id", "a.url",
                    "a.title", "a.date", "a.pdf_url", "a.scraped", "a.scraped_at")


def write_catalog_json_arrays(catalog: DataFrame, directory: str) -> str:
    """Catalog as JSON array files, one per partition, written by the executors.

    A path without scheme lies where Spark would look for it.
    """
    directory = qualified(catalog.sparkSession, directory)

    def run(rows: Iterator) -> None:
        import json

        from pyarrow import fs
        from pyspark import TaskContext

        items = [r.asDict() for r in rows]
        if not items:
            return
        filesystem, base = fs.FileSystem.from_uri(directory)
        filesystem.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        with filesystem.open_output_stream(f"{base}/catalog-{part:05d}.json") as out:
            out.write(json.dumps(items, ensure_ascii=False).encode("utf-8"))

    catalog.foreachPartition(run)
    return directory


# ---------------------------------------------------------------- S4
def write_scraped(records: DataFrame, path: str) -> str:
    """One JSON object per article (JSON lines, nulls kept)."""
    records.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    return path


def read_scraped(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCRAPED_SCHEMA).json(path)


# --------------------------------------------------- S5 and file writers
def write_files(df: DataFrame, directory: str, name: str, content: str, folders: int = 0) -> str:
    """Write one file per row (``name`` -> bytes or text) from the executors.

    A path without scheme lies where Spark would look for it. With ``folders``
    the files lie in so many sub-folders, by a hash of the name: a name that
    comes again is still one file, and no folder need be listed with all of them.
    """
    directory = qualified(df.sparkSession, directory)

    def run(rows: Iterator) -> None:
        import zlib

        from pyarrow import fs

        filesystem, base = fs.FileSystem.from_uri(directory)
        filesystem.create_dir(base, recursive=True)
        made = set()
        for r in rows:
            data = r[content]
            if data is None:
                continue
            payload = bytes(data) if not isinstance(data, str) else data.encode("utf-8")
            folder = f"{base}/{zlib.crc32(str(r[name]).encode('utf-8')) % folders:05d}" if folders else base
            if folders and folder not in made:
                filesystem.create_dir(folder, recursive=True)
                made.add(folder)
            with filesystem.open_output_stream(f"{folder}/{r[name]}") as out:
                out.write(payload)

    df.select(name, content).foreachPartition(run)
    return directory


def read_binary(spark: SparkSession, directory: str, glob: str = "*.pdf") -> DataFrame:
    """Binary files matching ``glob`` -> (path, file_name, length, content)."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(directory)
    return raw.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", "content")


def read_text_files(spark: SparkSession, directory: str, glob: str = "*.txt") -> DataFrame:
    """Whole text files -> (file_name, value), those of all folders below; the name as Spark gives it, in a URI's form.

    The executors list the folders and read the files, so that the driver holds
    no entry per file and the number of tasks does not grow with the files: one
    task lists ``directory``, each folder in it is listed by the task that reads
    it. What Spark's reader leaves out (hidden and empty files) is left out. A
    path that ``pyarrow.fs`` does not know as a folder is left to Spark's reader.
    """
    from pyarrow import fs

    base = qualified(spark, directory)
    try:
        filesystem, folder = fs.FileSystem.from_uri(base)
        known = filesystem.get_file_info(folder).type == fs.FileType.Directory
    except (ValueError, NotImplementedError, OSError):  # a scheme or a path of Spark's own
        known = False
    if not known:
        raw = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(directory, wholetext=True)
        return raw.select(F.col("_metadata.file_name").alias("file_name"), "value")
    wanted = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()

    def entries(filesystem, folder: str) -> Iterator[tuple[str, bool]]:
        """(path, is a folder) of what Spark's reader would not leave out."""
        import re

        from pyarrow import fs

        match = re.compile(wanted, re.DOTALL).fullmatch
        for x in filesystem.get_file_info(fs.FileSelector(folder)):
            n = x.base_name
            if n.startswith(".") or (n.startswith("_") and "=" not in n) or n.endswith("._COPYING_"):
                continue
            if x.type == fs.FileType.Directory:
                yield x.path, True
            elif x.size and match(n):
                yield x.path, False

    def top(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyarrow import fs

        for _ in batches:
            filesystem, folder = fs.FileSystem.from_uri(base)
            found = list(entries(filesystem, folder))
            for at in range(0, len(found), 10_000):
                paths, folders = zip(*found[at : at + 10_000], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(folders, pa.bool_())], ["path", "is_folder"])

    def files(batches: Iterator) -> Iterator:
        """(name, bytes) of the files at and below the given paths."""
        import re
        from urllib.parse import quote

        from pyarrow import fs

        filesystem, _ = fs.FileSystem.from_uri(base)
        # what java.net.URI quotes in a path
        odd = re.compile("[\\x00-\\x20\"#%<>?\\[\\\\\\]^`{|}\\x7f-\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
        for b in batches:
            todo = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            while todo:
                path, is_folder = todo.pop()
                if is_folder:
                    todo += entries(filesystem, path)
                    continue
                with filesystem.open_input_stream(path) as f:
                    yield odd.sub(lambda m: quote(m[0], safe=""), path.rpartition("/")[2]), f.read()

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names, texts, held = [], [], 0

        def batch():
            value = pa.array(texts, pa.binary()).view(pa.string())  # as they are: Spark's reader checks no encoding either
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), value], ["file_name", "value"])

        for name, text in files(batches):
            if names and (held + len(text) > 4_000_000 or len(names) == 10_000):
                yield batch()
                names, texts, held = [], [], 0
            names.append(name)
            texts.append(text)
            held += len(text)
        if names:
            yield batch()

    found = spark.range(0, 1, 1, 1).mapInArrow(top, "path string, is_folder boolean")
    return found.repartition(4 * spark.sparkContext.defaultParallelism).mapInArrow(read, "file_name string not null, value string")


# ------------------------------------------------------------ S8-S11
def write_splits(examples: DataFrame, path: str, split_col: str = "split") -> str:
    """Examples as Parquet partitioned by split."""
    examples.write.mode("errorifexists").partitionBy(split_col).parquet(path)
    return path


def read_split(spark: SparkSession, path: str, split: str, split_col: str = "split") -> DataFrame:
    """One split, read with partition pruning."""
    return spark.read.parquet(path).filter(F.col(split_col) == split)


def write_jsonl(examples: DataFrame, path: str, split_col: str = "split") -> str:
    """JSON lines per split, nulls kept (``date: null``), non-ASCII as is."""
    examples.write.mode("errorifexists").option("ignoreNullFields", "false").partitionBy(split_col).json(path)
    return path


def write_rejects(rejected: DataFrame, path: str, run_id: str) -> str:
    """Reject log, one partition per run (earlier runs are kept)."""
    out = rejected.withColumn("run_id", F.lit(run_id)).write.mode("append").option("ignoreNullFields", "false")
    out.partitionBy("run_id").json(path)
    return path


def write_summary(summary: DataFrame, path: str) -> str:
    """The one-row summary as a single JSON file."""
    summary.coalesce(1).write.mode("errorifexists").json(path)
    return path
