"""Session helpers: builder for local runs, shared scratch folder, conf scopes."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rollcall") -> SparkSession:
    """Session for tests and the local bench. On a cluster, use the cluster's session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of our own. On a
    cluster such a folder would be seen by one machine alone: that raises.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="rollcall-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-folder of the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/rollcall/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def conf_scope(spark: SparkSession, **confs):
    """Set SQL confs for the body; restore afterwards. Keys use ``__`` for ``.``."""
    old = {}
    try:
        for k, v in confs.items():
            key = k.replace("__", ".")
            old[key] = spark.conf.get(key, None)
            spark.conf.set(key, str(v))
        yield
    finally:
        for key, v in old.items():
            if v is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, v)


def case_sensitive(spark: SparkSession):
    """Names like ``status`` and ``Status`` are different columns inside jobs."""
    return conf_scope(spark, spark__sql__caseSensitive="true")



def written_table(spark: SparkSession, name: str = "stage"):
    """A ``materialize`` hook: write the DataFrame as parquet under the shared
    folder and continue from the written copy. One job per table (an eager
    ``checkpoint()`` computes its input twice), lineage is cut, and a lost
    executor costs a re-read, not a recompute. ``hook.cleanup()`` removes
    the tables this hook wrote (and nothing else)."""
    written: list[str] = []

    def hook(df):
        path = scratch_path(spark, name)
        df.write.parquet(path)
        written.append(path)
        return spark.read.parquet(path)

    def cleanup():
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        while written:
            p = jvm.org.apache.hadoop.fs.Path(written.pop())
            p.getFileSystem(conf).delete(p, True)

    hook.cleanup = cleanup
    hook.paths = written
    return hook
