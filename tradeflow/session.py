"""Session helpers: a local session for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tradeflow") -> SparkSession:
    """A local session for tests and benchmarks (cluster jobs get theirs from spark-submit)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and every executor can reach it.
    Only where it is unset (local tests) a new folder is created and set.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root and not sc.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="tradeflow-ckpt-")
        sc.setCheckpointDir(root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder below the shared checkpoint folder (not created; writers create it)."""
    return f"{checkpoint_root(spark)}/tradeflow/{label}-{uuid.uuid4().hex[:12]}"


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers, unless they start in its folder or have it on their path.

    The archive is code that the driver serves to executors itself; no data passes through it.
    """
    on_path = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    context = spark.sparkContext
    if context.applicationId in _SHIPPED or _ROOT in on_path or os.getcwd() == _ROOT:
        return
    name = f"{tempfile.mkdtemp(prefix='tradeflow-code-')}/tradeflow_package"
    context.addPyFile(shutil.make_archive(name, "zip", _ROOT, "tradeflow"))
    _SHIPPED.add(context.applicationId)


__all__ = ["ship_package", "local_session", "checkpoint_root", "scratch_dir"]
