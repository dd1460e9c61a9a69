"""Spark session helpers and the shared scratch location.

Everything the library writes for itself (ordinal checkpoints, stream
checkpoints, round-trip tables) goes below the folder that the cluster names
in ``spark.checkpoint.dir``. That folder is read from the session; only a
local-mode session without the setting gets a private temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(
    app: str = "synthtext",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings this library is tuned for.

    AQE stays on so shuffle partitions coalesce at run time and skewed join
    partitions are split; Arrow carries the Python stages.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Rows per Arrow batch into the Python stages: bounds worker memory when
        # texts are long (the generation stage joins them to whole batches).
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
        # Larger generated methods are not compiled by the JVM's JIT; operators then run
        # with their own generated projections, which are cut into small methods.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session. A local session without
    it gets a temporary folder; a cluster session without it is an error,
    because a machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    root = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                f"{_CKPT_KEY} is not set; point it at a folder shared by all executors"
            )
        root = tempfile.mkdtemp(prefix="synthtext-ckpt-")
        spark.conf.set(_CKPT_KEY, root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique folder name below the checkpoint root."""
    root = checkpoint_root(spark)
    path = f"{root}/synthtext/{kind}/{uuid.uuid4().hex}"
    if path.startswith("/"):
        os.makedirs(os.path.dirname(path), exist_ok=True)
    return path


#: Inputs above this estimated size have splits enough for any cluster.
SPREAD_BYTES = 1 << 30
#: Bytes of input for each partition of a spread input.
SPREAD_SPLIT = 1 << 20


def spread(df: DataFrame, split: int = SPREAD_SPLIT) -> DataFrame:
    """Round-robin a small ``df`` (up to ``SPREAD_BYTES``) over partitions of
    about ``split`` bytes (fewer where a row's work is large for its bytes).

    CPU-heavy row stages (regular expressions over whole texts, model calls) run
    once per row; a small file that cannot be split (one Parquet row group, one
    JSON document) would run them in a handful of tasks. The decision reads the
    plan's size estimate: no job is run, and a large input gets no shuffle
    whatever the number of cores.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size > SPREAD_BYTES:
        return df
    return df.repartition(max(1, -(-size // split)))


def small_methods(spark: SparkSession) -> None:
    """Plans after this run with their operators' own generated projections, which are cut
    into small methods, where one method for all would be too large for the JVM's JIT."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > 8000:
        spark.conf.set(name, "8000")


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on every Python worker.

    Python stages (the generation stage, user tokenizers) run functions of
    this package in worker processes that do not share the driver's
    ``sys.path``. The package's ``.py`` files are zipped once per application
    (a path fixed by the application id, so a repeated call adds the same
    file) and added with ``addPyFile``; Spark's file server ships the zip to
    the executors, so only the driver reads the local file.
    """
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    with _SHIP_LOCK:
        if key in _SHIPPED:
            return
        pkg_dir = os.path.dirname(os.path.abspath(__file__))
        base = os.path.dirname(pkg_dir)
        folder = os.path.join(tempfile.gettempdir(), f"synthtext-py-{key}")
        zpath = os.path.join(folder, "synthtext.zip")
        if not os.path.exists(zpath):
            os.makedirs(folder, exist_ok=True)
            tmp = zpath + f".{os.getpid()}.part"
            with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as z:
                for dirpath, _dirs, files in os.walk(pkg_dir):
                    for f in files:
                        if f.endswith(".py"):
                            full = os.path.join(dirpath, f)
                            z.write(full, os.path.relpath(full, base))
            os.replace(tmp, zpath)
        try:
            sc.addPyFile(zpath)
        except Exception as e:  # noqa: BLE001 - already registered by an earlier import
            if "already" not in str(e).lower():
                raise
        _SHIPPED.add(key)
