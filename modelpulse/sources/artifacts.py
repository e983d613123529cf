"""Notebook documents, image bytes and binary artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Folders that ``write_artifact_files`` deals very many files to, so that one task lists each of them.
SHARDS = 1024

NOTEBOOK_SCHEMA = T.StructType(
    [
        T.StructField(
            "cells",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("source", T.ArrayType(T.StringType())),
                        T.StructField(
                            "outputs",
                            T.ArrayType(
                                T.StructType([T.StructField("data", T.MapType(T.StringType(), T.StringType()))])
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)


def _store(path: str):
    """File system and root of a folder that tasks can list by themselves; None for a path that only Spark's readers know."""
    import pyarrow as pa
    from pyarrow import fs

    if any(c in path for c in "*?[]{}\\"):
        return None
    try:
        return fs.FileSystem.from_uri(path)
    except (pa.ArrowException, OSError, ValueError):
        return None


def scan_files(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """Path, byte size and content of every file of a folder, listed and read by tasks; the driver holds no file names.

    One task lists the folder; what it finds is dealt to all, who list the folders below (``recursive``) and read. Hidden files
    (a leading point or underscore) are passed over. Needs a path that ``_store`` knows.
    """
    from pyarrow import fs

    def wanted(info) -> bool:
        from fnmatch import fnmatchcase

        return info.is_file and not info.base_name.startswith((".", "_")) and (pattern is None or fnmatchcase(info.base_name, pattern))

    def top(frames):
        import pandas as pd

        for frame in frames:
            for uri in frame["uri"]:
                store, root = fs.FileSystem.from_uri(uri)
                found = store.get_file_info(fs.FileSelector(root))
                for at in range(0, len(found), 10_000):
                    part = [i for i in found[at : at + 10_000] if wanted(i) or (recursive and i.type == fs.FileType.Directory)]
                    yield pd.DataFrame({"at": [i.path for i in part], "folder": [not i.is_file for i in part]})

    def read(frames):
        import pyarrow as pa

        store, _ = fs.FileSystem.from_uri(path)
        begin = "file:" if store.type_name == "local" else path.split("://")[0] + "://"

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.binary()))], ["path", "length", "content"])

        rows, held = [], 0
        for frame in frames:
            for at, folder in zip(frame["at"].to_pylist(), frame["folder"].to_pylist()):
                infos = store.get_file_info(fs.FileSelector(at, recursive=True)) if folder else [store.get_file_info(at)]
                for info in infos:
                    if not wanted(info):
                        continue
                    with store.open_input_stream(info.path) as file:
                        content = file.read()
                    rows.append((begin + info.path, len(content), content))
                    held += len(content)
                    if len(rows) >= 1_000 or held >= 8 * 1024 * 1024:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)

    found = spark.range(1, numPartitions=1).select(F.lit(path).alias("uri")).mapInPandas(top, "at string, folder boolean")
    dealt = found.repartition(max(SHARDS // 8, spark.sparkContext.defaultParallelism), "at")
    return dealt.mapInArrow(read, "path string, length bigint, content binary")


def _file_uri(path):
    """The path as the file readers' metadata have it, with what no URI may hold in percent form."""
    import re

    illegal = re.compile(r"""[\x00-\x20"%<>\\^`{|}\[\]#?]""")
    return path.map(lambda p: illegal.sub(lambda m: f"%{ord(m[0]):02X}", p))


def read_notebooks(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """One row per notebook file: its path and its cells."""
    if _store(path) is None:
        reader = spark.read.schema(NOTEBOOK_SCHEMA).option("multiLine", True).option("recursiveFileLookup", recursive)
        return reader.json(path).select(F.col("_metadata.file_path").alias("path"), "cells")
    files = scan_files(spark, path, recursive=recursive)
    # As the file reader does: a file with a list is a row per element, an empty one none, a broken one a row without cells.
    text = F.col("content").cast("string")
    parsed = files.where(text.rlike(r"\S")).select("path", F.from_json(text, T.ArrayType(NOTEBOOK_SCHEMA)).alias("_n"))
    rows = parsed.where(F.col("_n").isNull() | (F.size("_n") > 0)).select("path", F.explode_outer("_n").alias("_n"))
    return rows.select(F.pandas_udf(_file_uri, "string")("path").alias("path"), F.col("_n.cells").alias("cells"))


def read_image_bytes(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = False) -> DataFrame:
    """Path, byte size and content of every file; files of zero bytes are passed over."""
    if _store(path) is not None and not any(c in (pattern or "") for c in "[]{}\\^"):
        return scan_files(spark, path, pattern, recursive).where(F.col("length") > 0)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "content")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Images decoded inside the JVM: height, width, channels and bytes in blue-green-red order, and ``ok``.

    A file that is no readable image stays, with its origin and ``ok`` false.
    """
    images = spark.read.format("image").load(path).select("image.*")
    return images.withColumn("ok", F.coalesce((F.col("height") > 0) & (F.length("data") > 0), F.lit(False)))


def write_artifact_table(artifacts: DataFrame, path: str) -> None:
    """The scalable form of the artifact sink: names and bytes in a columnar table."""
    artifacts.write.mode("overwrite").parquet(path)


def write_artifact_files(artifacts: DataFrame, path: str, name: str = "filename", content: str = "content", folder: str | None = None, shards: int | None = None) -> None:
    """One file per row in a folder all executors share, or in the row's own ``folder`` below it; a retried task rewrites the same bytes.

    With ``shards``, these lie in so many numbered folders, by the hash of ``folder`` or name, so that no folder grows too long to list.

    A name that is empty, null, or leads out of its folder fails the job. The file systems are those of pyarrow: local, HDFS
    and the stores that it knows; for any other store write the columnar table.
    """

    def write(rows):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        made = set()
        for row in rows:
            parts = [row[c] for c in (folder, name) if c]
            for part in parts:
                if not part or part in (".", "..") or any(c in part for c in "/\\\0"):
                    raise ValueError(f"not the name of a file in a folder: {part!r}")
            here = "/".join([root, *([row["_shard"]] if shards else []), *parts[:-1]])
            if here not in made:
                store.create_dir(here, recursive=True)
                made.add(here)
            with store.open_output_stream(f"{here}/{parts[-1]}") as out:
                out.write(bytes(row[content]))

    columns = [F.col(c) for c in (folder, name, content) if c]
    if shards:
        columns.append(F.format_string("%04d", F.pmod(F.xxhash64(folder or name), F.lit(shards))).alias("_shard"))
    artifacts.select(*columns).foreachPartition(write)
