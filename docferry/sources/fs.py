"""File-system steps Spark's writers do not cover: rename, delete, small
text files. They go through Hadoop's FileSystem API, so they work the same on
local disk, HDFS or an object store the cluster is configured for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def rename(spark: SparkSession, src: str, dst: str, *, replace: bool = True) -> None:
    fs, s = _fs(spark, src)
    _, d = _fs(spark, dst)
    if replace and fs.exists(d):
        fs.delete(d, True)
    parent = d.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    if not fs.rename(s, d):
        raise OSError(f"rename {src} -> {dst} failed")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file (UTF-8) in one go, replacing it."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        jvm = spark.sparkContext._jvm
        data = jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")


def single_file(spark: SparkSession, src_dir: str, dst: str, glob: str = "part-*") -> None:
    """Move the one data file Spark wrote into ``src_dir`` to ``dst``."""
    fs, d = _fs(spark, src_dir)
    jvm = spark.sparkContext._jvm
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{src_dir}/{glob}"))
    files = [s.getPath().toString() for s in found if s.getLen() >= 0]
    if len(files) != 1:
        raise OSError(f"expected one file in {src_dir}, found {len(files)}")
    rename(spark, files[0], dst)
    fs.delete(d, True)


def input_bytes(df) -> int:
    """Bytes on disk of the files a DataFrame scans: one listing per folder
    (the folders Spark already listed), summing only this frame's files."""
    spark = df.sparkSession
    by_folder: dict[str, set[str]] = {}
    for f in df.inputFiles():
        folder, name = f.rsplit("/", 1)
        by_folder.setdefault(folder, set()).add(name)
    total = 0
    for folder, names in by_folder.items():
        fs, p = _fs(spark, folder)
        for st in fs.listStatus(p):
            if st.getPath().getName() in names:
                total += int(st.getLen())
    return total
