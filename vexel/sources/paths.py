"""File-system checks on the driver, for any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, p = _resolve(spark, path)
    return fs.getContentSummary(p).getLength()


def create_empty(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.create(p, False).close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files of a folder that are not hidden."""
    fs, p = _resolve(spark, folder)
    found = [status.getPath().getName() for status in fs.listStatus(p)]
    return [n for n in found if not n.startswith((".", "_"))]


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _resolve(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new file; an existing one is an error."""
    fs, p = _resolve(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file to a name that is not taken; False if it is."""
    jvm = spark._jvm
    old, new = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    # A FileContext refuses to replace a file, where a FileSystem may do so silently.
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), conf)
    option = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(option, 0)
    try:
        context.rename(old, new, options)
    except Exception as error:
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True
