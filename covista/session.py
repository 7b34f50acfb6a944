"""Session and materialisation helpers shared by every operator."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "covista", **conf) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("COVISTA_DRIVER_MEMORY", "8g"))
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the session names none and runs on this machine alone is a
    temporary folder taken; on a cluster a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="covista-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return it read back.

    Cuts the lineage with a table that survives the loss of executors, and lets
    several consumers share one computation with column pruning.
    """
    spark = df.sparkSession
    path = f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_run_folders: dict[str, str] = {}


def _run_folder(spark: SparkSession) -> str:
    """The folder of this application's tables in the shared folder. It is removed when the driver ends, for nobody else reads them."""
    app = spark.sparkContext.applicationId
    if app not in _run_folders:
        _run_folders[app] = f"{shared_dir(spark)}/covista/{app}"
        path = spark._jvm.org.apache.hadoop.fs.Path(_run_folders[app])
        atexit.register(_remove, path, spark._jsc.hadoopConfiguration())
    return _run_folders[app]


def _remove(path, conf) -> None:
    try:
        path.getFileSystem(conf).delete(path, True)
    except Exception:  # the JVM may be gone before us; what is left is named by its application
        pass


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once an application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="covista-")  # of the driver alone: addPyFile copies the package to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    file = Path(folder) / "covista_package.zip"
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(file))
    _shipped.add(app)
