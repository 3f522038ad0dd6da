"""Session helpers: building a local session for tests / bench, and the
shared folder used to cut lineage (``spark.checkpoint.dir``)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "mailspark") -> SparkSession:
    """A local session for tests and the bench. On a cluster use the session
    the platform gives you; nothing in the library depends on this one."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.mailspark.spreadSmallScans", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster sets it. A local session without it (tests, bench) gets a
    temporary folder; on a cluster an unset folder is an error.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="mailspark-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001 - no SparkContext access (e.g. Spark Connect)
        pass
    return path


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/mailspark/{name}-{uuid.uuid4().hex}"


def hadoop_path_exists_dir(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and is a directory, checked through the
    Hadoop FileSystem API so it works for any cluster file system."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return bool(fs.exists(p) and fs.getFileStatus(p).isDirectory())


def _path_and_fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file unless one of that name is there; False if so. The
    file system decides between writers who try at once."""
    p, fs = _path_and_fs(spark, path)
    try:
        out = fs.create(p, False)
    except Exception as e:  # noqa: BLE001 - a Java exception
        if fs.exists(p):
            return False
        raise e
    out.write(bytearray(text.encode()))
    out.close()
    return True


def small_files(spark: SparkSession, path: str) -> dict[str, str]:
    """Names and contents (up to 4 KB) of the files of a folder that holds a
    few small ones; none where there is no folder."""
    p, fs = _path_and_fs(spark, path)
    found = {}
    if fs.exists(p):
        for status in fs.listStatus(p):
            stream = fs.open(status.getPath())
            try:
                found[status.getPath().getName()] = bytes(stream.readNBytes(4096)).decode()
            finally:
                stream.close()
    return found


__all__ = [
    "create_file",
    "small_files",
    "local_session",
    "ensure_checkpoint_dir",
    "scratch_table_path",
    "hadoop_path_exists_dir",
]
