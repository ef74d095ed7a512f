"""Where jobs keep written tables, stream checkpoints and managed databases.

On a cluster this is the shared folder named by ``spark.checkpoint.dir``, which every executor
sees and which outlives any one of them. Only a local session without that setting gets a
temporary folder of its own.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}
_databases: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder of this application inside the shared folder; removed when the JVM ends."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if base is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="tablework-")
        _roots[app] = f"{base.rstrip('/')}/tablework-{uuid.uuid4().hex}"
        _delete_at_exit(spark, _roots[app])
    return _roots[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has written to yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def remove_table(table: DataFrame) -> None:
    """Delete the folder of a table in the shared folder, once nothing is going to read it again."""
    spark = table.sparkSession
    for folder in {x.rsplit("/", 1)[0] for x in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        if path.getParent().getName() != shared_root(spark).rsplit("/", 1)[1]:
            raise ValueError(f"not a table of this run: {folder}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_name(label: str) -> str:
    """A view or table name nobody else uses."""
    return f"{label}_{uuid.uuid4().hex}"


def run_database(spark: SparkSession) -> str:
    """Database of this application, located in the shared folder and dropped at exit."""
    app = spark.sparkContext.applicationId
    if app not in _databases:
        name = fresh_name("tablework")
        create_database(spark, name, f"{shared_root(spark)}/{name}.db")
        _databases[app] = name
        atexit.register(_drop_database, spark, name)
    return _databases[app]


def create_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Create a database unless it exists. Callers qualify table names; the session's current
    database stays as it is."""
    quoted = location.replace("\\", "\\\\").replace("'", "\\'") if location else None
    at = f" LOCATION '{quoted}'" if quoted else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{at}")
    return name


def _drop_database(spark: SparkSession, name: str) -> None:
    try:
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
    except Exception:  # the session may be gone already; its catalog then is too
        pass


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.mkdirs(hadoop_path)
    file_system.deleteOnExit(hadoop_path)
