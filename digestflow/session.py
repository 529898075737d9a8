"""Session set-up, table access and lineage cutting shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
BATCH_ROWS = 2_000


def build_session(app: str = "digestflow", master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings the operators expect (UTC, AQE, Arrow)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of the data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()


def _folder(spark: SparkSession) -> str:
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return f"{configured.rstrip('/')}/digestflow-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="digestflow-")
        atexit.register(shutil.rmtree, _LOCAL[app], True)
    return _LOCAL[app]


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write a frame to the shared checkpoint folder and read it back: lineage ends there, so lost executors cost no recomputation."""
    path = f"{_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def fresh_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder, not yet made, beside the cut tables."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"


def discard(df: DataFrame) -> None:
    """Delete the files of a frame that cut() wrote and that nothing reads any more."""
    path = getattr(df, "_cut_path", None)
    if path:
        spark = df.sparkSession
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, so their Python workers can import it.

    Arrow batches of default size are made smaller: rows hold whole texts, and several Python workers share an executor.
    """
    context = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="digestflow-package-")) / "digestflow_package.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for path in sorted(root.rglob("*.py")):
                archive.write(path, path.relative_to(root.parent))
        context.addPyFile(str(target))
        _SHIPPED.add(context.applicationId)
