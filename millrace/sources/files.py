"""Readers and writers."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.columns import joined_lines, last_part, url_quote
from millrace.operators.jobs import Folder
from millrace.operators.keys import dense_id, position
from millrace.operators.shared import complete
from millrace.operators.split import shuffled
from millrace.sources import schemas

#: Files that ``write_documents`` puts into one folder.
FOLDER = 5000


def read_csv(spark: SparkSession, path: str, schema: StructType | str, legacy: bool = False) -> DataFrame:
    """CSV with a header and fixed types; a bad value raises.  ``legacy`` files have blanks after their commas."""
    return spark.read.csv(path, schema=schema, header=True, mode="FAILFAST", ignoreLeadingWhiteSpace=legacy, escape='"', multiLine=not legacy, enforceSchema=True)


def read_table(spark: SparkSession, folder: str, name: str, form: str = "parquet") -> DataFrame:
    """A corpus table by name, with its declared types."""
    path, schema = f"{folder}/{name}", schemas.schema(name)
    if form == "csv":
        return read_csv(spark, path, schema)
    df = spark.read.parquet(path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_tables(spark: SparkSession, folder: str, form: str = "parquet") -> dict[str, DataFrame]:
    return {name: read_table(spark, folder, name, form) for name in schemas.TABLES}


def read_video_index(spark: SparkSession, path: str) -> DataFrame:
    """The video index from a CSV with headers of its own: columns go by place, file names are quoted as in URLs."""
    df = read_csv(spark, path, schemas.schema("video_index"))
    return df.withColumn("target_video_filename", url_quote(F.col("target_video_filename")))


def write_documents(docs: DataFrame, path: str, most: int = FOLDER) -> None:
    """``docs(filename, text)`` as whole files, many to a folder: ``<path>/<folder>/<filename>``; a null text is an empty line.

    Tasks write their files straight into folders of their own of up to ``most`` files, with the mark ``_SUCCESS`` at the end; a folder
    for each file, with a commit of its own, costs far more than the files.  A task that is run again writes the same names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = FileSystem.from_uri(path)
        task, n = TaskContext.get().partitionId(), 0
        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at = f"{base}/{task:05d}-{n // most:05d}"
                if n % most == 0:
                    store.create_dir(at)
                with store.open_output_stream(f"{at}/{name}") as out:
                    out.write(f"{text or ''}\n".encode())  # empty files have no row
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    docs.select("filename", "text").mapInArrow(run, "n long").agg(F.sum("n")).collect()
    Folder(docs.sparkSession, path).write("_SUCCESS", "")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(filename, text)`` of whole files: one row each, lines stripped and concatenated; folders may hold folders."""
    df = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return df.select(last_part(F.col("path"), "/").alias("filename"), joined_lines(F.regexp_replace("value", "\r", "")).alias("text"))


def list_frames(spark: SparkSession, path: str) -> DataFrame:
    """``(video, frame, frame_path)`` of ``<video>/<n>.jpg`` files; only paths are read, frames go by number."""
    return frames_of(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jpg").load(path).select("path"))


def list_frame_folders(spark: SparkSession, path: str) -> DataFrame:
    """The same, listed by tasks: the driver reads the names of the videos' folders, each task the files of its folders.

    ``path`` must be one that tasks can open by its URI (a mounted folder, or a store that Arrow knows); ``list_frames`` goes
    through Spark's own listing, which the driver holds.  Folders without frames and other files have no rows.
    """
    names = spark.createDataFrame([(n,) for n in Folder(spark, path).names("")], "video string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = FileSystem.from_uri(path)
        for b in batches:
            for video in b.column(0).to_pylist():
                at = f"{base}/{video}"
                files = store.get_file_info(FileSelector(at)) if store.get_file_info(at).type == FileType.Directory else []
                found = [f for f in files if re.fullmatch(r"\d+\.jpg", f.base_name)]
                found.sort(key=lambda f: int(f.base_name[:-4]))
                yield pa.RecordBatch.from_arrays([pa.array([video] * len(found), pa.string()), pa.array(range(len(found)), pa.int32()), pa.array([f"{path}/{video}/{f.base_name}" for f in found], pa.string())], names=["video", "frame", "frame_path"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return names.repartition(tasks, "video").mapInArrow(run, "video string, frame int, frame_path string")


def frames_of(paths: DataFrame) -> DataFrame:
    """The same for a table of paths."""
    found = paths.select(F.regexp_extract("path", r"([^/]+)/(\d+)\.jpg$", 1).alias("video"), F.regexp_extract("path", r"([^/]+)/(\d+)\.jpg$", 2).try_cast("int").alias("_n"), F.col("path").alias("frame_path"))
    return position(found.filter("_n IS NOT NULL"), ["video"], ["_n"], "frame").select("video", "frame", "frame_path")


def write_csv(df: DataFrame, path: str, single: bool = False, mode: str = "errorifexists") -> None:
    """Quoted CSV with a header; one file only on request, since one task then writes it."""
    (df.coalesce(1) if single else df).write.mode(mode).csv(path, header=True, escape='"', emptyValue="", nullValue="\\N")


def write_table(df: DataFrame, path: str, key: list[str], mode: str = "errorifexists") -> None:
    """Distinct rows, sorted by key, as Parquet.  ``mode="ignore"`` leaves a table that was written whole as it is."""
    if mode == "ignore":
        if complete(df.sparkSession, path):
            return
        mode = "overwrite"  # what a failed write left behind
    df.distinct().orderBy(*key).write.mode(mode).parquet(path)


def write_batches(df: DataFrame, path: str, key: str, size: int, seed: str = "", epoch: int = 0) -> None:
    """Rows in a reproducible random order, another for every ``epoch``, with their ``batch`` of ``size`` rows and ``place`` in it, as Parquet.

    Batches are dealt by range and lie whole, one after the other, in one file each; ``<path>.index`` tells for every batch its
    file, its first row there and its number of rows.
    """
    drawn = shuffled(F.col(key), f"{seed}{epoch or ''}")
    placed = dense_id(df.withColumn("_r", drawn), ["_r", key], "_i")
    placed = placed.withColumns({"batch": F.floor(F.col("_i") / size), "place": (F.col("_i") % size).cast("int")}).drop("_r", "_i")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed.repartitionByRange(n, "batch").sortWithinPartitions("batch", "place").write.parquet(path)
    files = df.sparkSession.read.parquet(path).select("batch", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    index = files.groupBy("batch").agg(F.min("file").alias("file"), F.min("row").alias("first_row"), F.count("*").alias("n_rows"))
    index.orderBy("batch").coalesce(1 + n // 100).write.parquet(f"{path}.index")


def read_batch(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """One batch in order, from its file alone; a batch that isn't there is empty."""
    at = spark.read.parquet(f"{path}.index").filter(F.col("batch") == batch).first()
    rows = spark.read.parquet(f"{path}/{at['file']}" if at else path).filter(F.col("batch") == batch)
    return rows.sort("place")


def resume_batches(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """All rows from a batch on; only the files that hold them are opened, and of these row groups by their statistics."""
    names = [r["file"] for r in spark.read.parquet(f"{path}.index").filter(F.col("batch") >= batch).select("file").distinct().collect()]
    return spark.read.parquet(*[f"{path}/{n}" for n in names] or [path]).filter(F.col("batch") >= batch)
