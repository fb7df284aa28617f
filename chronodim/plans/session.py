"""Session settings, the shared work folder and size-checked broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Session settings the engine relies on.  AQE re-plans joins and coalesces
# shuffle partitions at run time; skew-join splitting covers hot keys on
# the streamed side of joins.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Upper bounds on a side the engine broadcasts (a change set): rows and
# measured bytes.  State tables are never broadcast.
BROADCAST_MAX_ROWS_CONF = "chronodim.broadcast.maxRows"
DEFAULT_BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES_CONF = "chronodim.broadcast.maxBytes"
DEFAULT_BROADCAST_MAX_BYTES = 256 * 1024 * 1024
# Tighter bounds on the change set of a store's run: each run broadcasts it
# several times, every time through the driver.
CHANGES_MAX_ROWS = 100_000
CHANGES_MAX_BYTES = 8 * 1024 * 1024


def build_session(master: str | None = None, app_name: str = "chronodim",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_session_defaults(spark)
    return spark


def apply_session_defaults(spark: SparkSession) -> None:
    """Pin the runtime settings results depend on (time zone) or that keep
    plans adaptive."""
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors for written intermediate tables.

    Taken from ``spark.checkpoint.dir`` as the cluster names it.  Only when it
    is unset (tests, local runs) is a private folder created and registered
    as the checkpoint dir; on a cluster an unset value is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        base = os.environ.get("CHRONODIM_LOCAL_DIR") or tempfile.gettempdir()
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="chronodim-", dir=base)
        spark.sparkContext.setCheckpointDir(_LOCAL_DIRS[app])
    return _LOCAL_DIRS[app]


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared dir for one run's tables."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to a new path and return a DataFrame reading it back.

    The read-back cuts lineage (a lost executor re-reads files instead of
    recomputing the plan) and freezes non-deterministic columns such as
    random keys.  Paths are never overwritten, so a table is never written
    from a plan that reads it.
    """
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def broadcast_max_rows(spark: SparkSession) -> int:
    v = spark.conf.get(BROADCAST_MAX_ROWS_CONF, None)
    return int(v) if v else DEFAULT_BROADCAST_MAX_ROWS


def broadcast_max_bytes(spark: SparkSession) -> int:
    v = spark.conf.get(BROADCAST_MAX_BYTES_CONF, None)
    return int(v) if v else DEFAULT_BROADCAST_MAX_BYTES


def changes_fit_broadcast(spark: SparkSession, rows: int, size: int) -> bool:
    """Whether a change set of so many rows and measured bytes is broadcast."""
    return rows <= min(CHANGES_MAX_ROWS, broadcast_max_rows(spark)) and size <= min(CHANGES_MAX_BYTES, broadcast_max_bytes(spark))


def _fixed_width(t) -> int:
    """Bytes of a value of a fixed-size type."""
    name = t.typeName()
    if name in ("byte", "boolean", "null"):
        return 1
    if name == "short":
        return 2
    if name in ("integer", "date", "float"):
        return 4
    if name == "decimal":
        return 8 if t.precision <= 18 else 16
    return 8  # long, double, timestamps, intervals


def row_bytes(df: DataFrame) -> F.Column:
    """Measured size of a row: bytes of text and binary values, fixed widths
    for fixed-size types, JSON length for nested values."""
    from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (StructType, ArrayType, MapType)):
            parts.append(F.coalesce(F.length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(_fixed_width(f.dataType)))
    total = F.lit(0)
    for p in parts:
        total = total + p
    return total.cast("long")


def probe_size(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None,
               extra: dict | None = None) -> tuple[bool, dict]:
    """``(small, values)``: whether ``df`` is proven small enough to broadcast
    (at most ``max_rows`` rows and ``max_bytes`` measured bytes), plus the
    ``extra`` aggregates computed in the same job.

    One distributed aggregate (partial per task, one final combine): no
    rows are funnelled into a single task, and the driver receives one row
    of numbers."""
    spark = df.sparkSession
    max_rows = broadcast_max_rows(spark) if max_rows is None else max_rows
    max_bytes = broadcast_max_bytes(spark) if max_bytes is None else max_bytes
    aggs = [F.count(F.lit(1)).alias("__n"), F.sum(row_bytes(df)).alias("__b")]
    aggs += [c.alias(k) for k, c in (extra or {}).items()]
    r = df.agg(*aggs).first()
    values = {k: r[k] for k in (extra or {})}
    return r["__n"] <= max_rows and (r["__b"] or 0) <= max_bytes, values


def fits_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """True when ``df`` is proven small enough to broadcast (see
    :func:`probe_size`)."""
    return probe_size(df, max_rows, max_bytes)[0]


def broadcast_if_small(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Broadcast hint for ``df`` only when its size is proven small;
    otherwise the plain frame (shuffle join, AQE may still convert)."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df
