"""Tables that a run writes once and reads back, with counts on the way.

They lie in one folder per session under ``spark.checkpoint.dir``, which all
executors share, and go when the session's process ends.  Counts are observed on
the write itself, after the last shuffle, so no second pass makes them.
"""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_made: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The session's folder under ``spark.checkpoint.dir``.  Where that is
    unset, a temporary folder is made on a local master; a cluster has no
    folder that we could guess."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="ioclake-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    folder = f"{base.rstrip('/')}/ioclake-{sc.applicationId}"
    if folder not in _made:
        _made.add(folder)
        atexit.register(_remove, sc._jvm, sc._jsc.hadoopConfiguration(), folder)
    return folder


def _remove(jvm, conf, folder: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts
    the lineage, so a lost executor costs a re-read, not a re-run."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass
class Stages:
    """Stages of one run by name: built at first use, from the stages they
    ask for.  Those in ``keep`` (None: all) are written once, with their
    counts; the others stay plans."""

    keep: set[str] | None = None
    tables: dict[str, DataFrame] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    plans: dict[str, str] = field(default_factory=dict)

    def stage(self, name: str, build, **counts: Column) -> DataFrame:
        if name not in self.tables:
            df = build()
            if self.keep is None or name in self.keep:
                df = self._land(df, name, counts)
            self.tables[name] = df
        return self.tables[name]

    def _land(self, df: DataFrame, name: str, counts: dict[str, Column]) -> DataFrame:
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        asked = {"rows": F.count(F.lit(1)), **counts}
        self.plans[name] = df._jdf.queryExecution().executedPlan().toString()
        back = written(df.observe(seen, *[c.alias(k) for k, c in asked.items()]), name)
        self.counts |= {k: int(v or 0) for k, v in seen.get.items() if k != "rows"}
        return back
