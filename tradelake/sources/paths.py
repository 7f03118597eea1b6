"""Files and folders through the file system that a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.mkdirs(hadoop_path)


def children(spark: SparkSession, path: str) -> list:
    """Status of each entry of a folder by name; none where there is no such folder."""
    fs, hadoop_path = file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(fs.listStatus(hadoop_path), key=lambda s: s.getPath().getName())


def move_new(spark: SparkSession, path: str, target: str) -> bool:
    """Rename a folder in one step; False where the target is there already."""
    jvm = spark._jvm
    source, to = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, target))
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(source, to, none)
    except Exception:
        if path_exists(spark, path) and path_exists(spark, target):
            return False
        raise
    return True
