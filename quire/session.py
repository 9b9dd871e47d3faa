"""Session settings the library counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive plans size partitions at run time; skewed joins are split; UTC keeps times comparable.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, app: str = "quire", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()


def find_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, wherever they are started.
    On a cluster whose executors don't have that folder, install the package or use addPyFile."""
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, named by spark.checkpoint.dir. Only a local master may do without:
    then a temporary folder is made."""
    import atexit
    import shutil
    import tempfile

    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="quire-")
        atexit.register(shutil.rmtree, base[7:], True)
        context.setCheckpointDir(base)
    return base.rstrip("/")
