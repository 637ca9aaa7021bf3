"""Small files and renames in whatever file system a path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none where there is no such folder."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _system(spark, path).listStatus(_path(spark, path)))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _system(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with this text, whole or not at all; False if it was there already.

    The text is written beside it and renamed. The rename never replaces a file, so of several
    writers one succeeds, where the file system renames atomically (HDFS, local disks).
    """
    jvm, system = spark.sparkContext._jvm, _system(spark, path)
    beside = f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}"
    stream = system.create(_path(spark, beside), False)
    stream.write(bytearray(text.encode()))
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, path).toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    try:
        context.rename(
            context.makeQualified(_path(spark, beside)), context.makeQualified(_path(spark, path)), options
        )
    except Exception:
        system.delete(_path(spark, beside), False)
        if not exists(spark, path):
            raise
        return False
    return True


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or a folder; its new parent is made."""
    system = _system(spark, source)
    system.mkdirs(_path(spark, target).getParent())
    if not system.rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"cannot rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)
