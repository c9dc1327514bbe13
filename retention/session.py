"""Session helpers: shared scratch folders and standard settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from retention.params import SESSION_CONF


def app_key(spark: SparkSession) -> str:
    """A key for per-application memos that also works where ``sparkContext`` is not
    exposed (a Spark Connect session)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return spark.conf.get("spark.app.id", None) or f"session-{id(spark)}"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the pipeline's runtime SQL settings to an existing session."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only a local master, where all tasks share the machine,
    gets one of its own when it is unset. On a cluster that is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="retention-ckpt-")
        sc.setCheckpointDir(root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/retention/{name}-{uuid.uuid4().hex[:12]}"


def local_session(app: str = "retention", cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests and the bench (local mode, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def materialize(df):
    """Cut lineage by writing ``df`` to the shared checkpoint folder (reliable
    checkpoint: survives lost executors, unlike a local checkpoint)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``retention`` importable on Python workers before a ``mapInPandas`` that
    calls our code.

    On a cluster the package is shipped at submit time (``--py-files retention.zip``)
    and nothing happens here. When the shared checkpoint folder is on the local file
    system (local mode, tests) the package is zipped into it and added with
    ``addPyFile``, once per application.
    """
    import os
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    target = scratch_path(spark, "pyfiles")
    if "://" in target and not target.startswith("file:"):
        return
    local = target[len("file:"):] if target.startswith("file:") else target
    os.makedirs(local, exist_ok=True)
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    zpath = os.path.join(local, "retention.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(zpath)
