"""Folders that readers see whole or not at all.

A version is written under a name of its own; then a small manifest that names it
replaces the one before by a rename.  Whoever reads goes by the manifest, so a job
that dies half-way, or two that overlap, leave the last whole version in sight.
(The rename is atomic on HDFS and local disks, as the job's shared folders are.)
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_folder(path: str, version: str) -> str:
    """A folder under ``path`` that no other writer uses."""
    return f"{path.rstrip('/')}/data/{version}-{uuid.uuid4().hex}"


def publish(spark: SparkSession, path: str, name: str, folder: str) -> None:
    """From now on ``name`` stands for ``folder``."""
    place = f"{path.rstrip('/')}/commits/{name}.json"
    draft = f"{place}.{uuid.uuid4().hex}"
    jvm, p, fs = _files(spark, draft)
    out = fs.create(p)
    try:
        out.write(bytearray(json.dumps({"name": name, "folder": folder}).encode()))
    finally:
        out.close()
    options = jvm.org.apache.hadoop.fs.Options
    over = spark.sparkContext._gateway.new_array(getattr(options, "Rename"), 1)
    over[0] = getattr(options, "Rename").OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(p, jvm.org.apache.hadoop.fs.Path(place), over)


def published(spark: SparkSession, path: str, name: str) -> str | None:
    """The folder that ``name`` stands for, or None."""
    _, p, fs = _files(spark, f"{path.rstrip('/')}/commits/{name}.json")
    if not fs.exists(p):
        return None
    line = spark.read.text(str(p.toString())).first()
    return json.loads(line[0])["folder"]
