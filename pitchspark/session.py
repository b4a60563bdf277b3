"""Session helpers: one place for the settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library should carry. AQE re-plans joins
# from runtime sizes and splits skewed shuffle partitions; UTC keeps
# timestamps comparable with other engines.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "pitchspark") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.ui.showConsoleProgress", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only a local session may do without: it gets a scratch folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="pitchspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    try:
        spark.conf.set("spark.checkpoint.dir", local)
    except Exception:  # core settings may be read-only at runtime; the context setting is what counts
        pass
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of the session."""
    import uuid

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str):
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage like ``checkpoint()``, survives executor loss, and the
    re-read table carries its real size (a checkpoint keeps the statistics of
    the plan it replaced).
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``pitchspark`` importable in Python workers (grouped-map folds).

    Equivalent to ``--py-files``: the package is zipped once per
    application and added with ``SparkContext.addPyFile``, which serves it
    to every executor. The zip goes to the checkpoint folder when that is a
    local path, else to a driver scratch folder (Spark copies it out).
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    ckpt = ensure_checkpoint_dir(spark)
    base = ckpt[len("file:"):] if ckpt.startswith("file:") else ckpt
    if "://" in base or not os.path.isdir(base):
        base = tempfile.mkdtemp(prefix="pitchspark-pkg-")
    target = os.path.join(base, f"pitchspark-{app}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in root:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(target)
    _SHIPPED.add(app)
