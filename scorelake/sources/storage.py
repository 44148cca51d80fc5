"""Folder operations Spark's readers and writers lack, on any Hadoop file system."""

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _resolve(spark, path)
    return files.exists(folder)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children; empty when the folder is missing."""
    files, folder = _resolve(spark, path)
    if not files.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(folder))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    files, folder = _resolve(spark, path)
    return files.getContentSummary(folder).getLength()


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds; False when there was none."""
    files, folder = _resolve(spark, path)
    return files.delete(folder, True)


def make_temporary(spark: SparkSession, path: str) -> None:
    """Create a folder that goes, with all it holds by then, when the driver's JVM ends."""
    files, folder = _resolve(spark, path)
    files.mkdirs(folder)
    files.deleteOnExit(folder)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file; one that is there already is replaced."""
    files, file = _resolve(spark, path)
    stream = files.create(file, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()


def read_text(spark: SparkSession, path: str, whole: bool = False) -> str | None:
    """What ``write_text`` has written, None when there is no such file; 4 KB of it if not ``whole``."""
    files, file = _resolve(spark, path)
    if not files.exists(file):
        return None
    stream = files.open(file)
    text = bytes(stream.readAllBytes() if whole else stream.readNBytes(4096)).decode("utf-8")
    stream.close()
    return text


def move(spark: SparkSession, source: str, target: str) -> None:
    files, folder = _resolve(spark, source)
    _, destination = _resolve(spark, target)
    files.mkdirs(destination.getParent())
    if not files.rename(folder, destination):
        raise OSError(f"cannot move {source} to {target}")
