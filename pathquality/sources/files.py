"""Small file-system helpers over whatever storage the session reads (shared on a cluster)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def join(*parts: str) -> str:
    return "/".join(p.rstrip("/") for p in parts)


def _open(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _open(spark, pattern)
    return [s.getPath().toString() for s in (fs.globStatus(p) or [])]


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.delete(p, True)
