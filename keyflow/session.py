"""Session helpers: a tuned builder for tests and benches, and the shared folder.

On a cluster the session is created by the platform; the library only reads
settings from it. ``build_session`` is for local runs (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings every keyflow job relies on.  AQE re-plans joins and coalesces
# shuffle partitions at runtime; skew-join splitting covers hot join keys.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python state calls of transformWithStateInPandas go through a unix
    # domain socket instead of a TCP port.
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "keyflow") -> SparkSession:
    """Local session for tests and benches (UI off, UTC, AQE on)."""
    master = master or os.environ.get("KEYFLOW_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("KEYFLOW_SHUFFLE_PARTITIONS", "8"))
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(parts))
               .config("spark.driver.memory", os.environ.get("KEYFLOW_DRIVER_MEMORY", "16g")))
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Make ``keyflow`` importable on the executors' Python workers.

    Stateful processors and pandas functions are pickled by reference, so
    workers import them.  The package is zipped once per driver process and
    handed to ``SparkContext.addPyFile``, which distributes it with the job.
    """
    _pickle_by_value()
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    zip_path = _SHIPPED.get("_zip")
    if zip_path is None or not os.path.exists(zip_path):
        zip_path = os.path.join(tempfile.mkdtemp(prefix="keyflow-pkg-"), "keyflow.zip")
        with zipfile.ZipFile(zip_path, "w", zipfile.ZIP_DEFLATED) as zf:
            for root, _, files in os.walk(pkg_dir):
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(root, name)
                        zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
        _SHIPPED["_zip"] = zip_path
    sc.addPyFile(zip_path)
    _SHIPPED[app] = zip_path


def _pickle_by_value() -> None:
    """Serialise keyflow's worker-side code with the task instead of importing it.

    Covers Python processes that do not see ``addPyFile`` (e.g. the driver-side
    process that pre-initialises ``transformWithState`` state schemas).
    """
    from pyspark import cloudpickle

    import keyflow.operators.accumulate as accumulate
    import keyflow.streaming.stateful as stateful
    import keyflow.streaming.timed as timed
    for module in (stateful, timed, accumulate):
        try:
            cloudpickle.register_pickle_by_value(module)
        except ValueError:  # already registered
            pass


def apply_recommended_conf(spark: SparkSession) -> None:
    """Set the runtime-modifiable recommended settings on an existing session."""
    for key, value in RECOMMENDED_CONF.items():
        try:
            spark.conf.set(key, value)
        except AnalysisException:  # static conf on a running session: keep the platform's value
            pass
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "GMT"):
        raise RuntimeError("results are defined in UTC: set spark.sql.session.timeZone to UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (HDFS/object-store) folder and is
    only read.  Only when it is unset in local mode (tests) a private folder is
    made; elsewhere executors would not see it, and a RuntimeError says so.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="keyflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, *parts: str, fresh: bool = False) -> str:
    """A path under the shared checkpoint folder; ``fresh`` adds a unique leaf."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = "/".join(p.strip("/") for p in parts)
    if fresh:
        leaf = f"{leaf}/{uuid.uuid4().hex}" if leaf else uuid.uuid4().hex
    return f"{base}/keyflow/{leaf}"
