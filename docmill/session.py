"""Session settings and the shared scratch folder."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: str = "*", partitions: int = 8, app: str = "docmill") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return tune(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.files.maxPartitionBytes", "1m")
        .config("spark.sql.files.openCostInBytes", "128k")
        .getOrCreate()
    )


#: What the jobs here rely on; what the session has set itself stays.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
    # rows hold whole texts: batches for Python of fewer rows keep its memory small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set what the session leaves open, and send the package to its workers."""
    given = spark.conf.getAll
    for key, value in _DEFAULTS.items():
        if key not in given:
            spark.conf.set(key, value)
    return ship(spark)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the workers, once for each application.

    Python steps import it there (streams with state, sections), and a worker knows
    neither the driver's path nor its working directory.
    """
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
            for folder, _, names in os.walk(package):
                for name in sorted(n for n in names if n.endswith(".py")):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(package)))
        path = f"{scratch_root(spark)}/docmill.zip"
        stream = _file_system(spark, path)[0].create(_file_system(spark, path)[1])
        stream.write(data.getvalue())
        stream.close()
        sc.addPyFile(path)
        _SHIPPED.add(sc.applicationId)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share, for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. A local session without
    one gets a temporary folder; a cluster session without one is an error,
    because a folder on one machine would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="docmill-"))
        current = sc.getCheckpointDir()
    return current


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(sc._jsc.hadoopConfiguration()), place


_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared one; it goes when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        root = f"{checkpoint_dir(spark).rstrip('/')}/docmill-{uuid.uuid4().hex}"
        files, place = _file_system(spark, root)
        files.mkdirs(place)
        files.deleteOnExit(place)
        _ROOTS[app] = root
    return _ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table whose last reader is done."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds; nothing where there is none."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def cut(df: DataFrame, name: str = "rows") -> DataFrame:
    """The rows, written once to the shared folder and read from there: lineage ends,
    and what several steps read is computed once and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
