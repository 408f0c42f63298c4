"""What is at a path, on whatever file system it names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _locate(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _locate(spark, path)
    return files.exists(target)


def is_file(spark: SparkSession, path: str) -> bool:
    files, target = _locate(spark, path)
    return files.isFile(target)


def make_folder(spark: SparkSession, path: str) -> None:
    files, target = _locate(spark, path)
    files.mkdirs(target)


def hidden_files(spark: SparkSession, path: str, glob: str) -> list[str]:
    """Names in a directory that match `glob` but that Spark's readers pass over."""
    files, target = _locate(spark, path)
    if not files.exists(target):
        return []
    found = files.listStatus(target, spark._jvm.org.apache.hadoop.fs.GlobFilter(glob))
    names = [status.getPath().getName() for status in found if status.isFile()]
    return [name for name in names if name[0] in "._"]


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory, none if it does not exist."""
    files, target = _locate(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    files, target = _locate(spark, path)
    files.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    files, target = _locate(spark, path)
    stream = files.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place as a whole: a reader sees the old one or the new one."""
    files, target = _locate(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    part = hadoop.Path(f"{path}.part")
    stream = files.create(part, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    how = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    how[0] = hadoop.Options.Rename.OVERWRITE
    context.rename(files.makeQualified(part), files.makeQualified(target), how)
