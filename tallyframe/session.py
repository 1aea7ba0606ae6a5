"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Work folders made so far, by application.
_MADE: dict[str, list[str]] = {}

# Settings every job relies on: UTC day boundaries, AQE for runtime
# re-planning (partition coalescing, skew-join splitting, broadcast
# conversion), ANSI casts (operators use try_cast where input may be bad).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE coalesces small shuffles into very few partitions; per-row work
    # after them (JSON parsing, regex rules, SHA-256) then runs in one task.
    # A small floor keeps such stages parallel; on large data partitions are
    # far above it and the setting has no effect.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "tallyframe", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions),
                       **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    directory = spark.sparkContext.getCheckpointDir()
    if directory:
        return directory
    return spark.conf.get("spark.checkpoint.dir", None) or None


def work_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder of the cluster's shared checkpoint folder.

    The shared folder comes from ``spark.checkpoint.dir``.  Only a local
    session without that setting (tests, a laptop) gets its own folder.
    """
    root = _checkpoint_dir(spark)
    if root is None:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="tallyframe-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    path = f"{root.rstrip('/')}/{name or 'work'}-{uuid.uuid4().hex[:12]}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches (glob allowed); errors of the file system are not hidden."""
    fs, path = _file_system(spark, pattern)
    found = fs.globStatus(path)
    return found is not None and len(found) > 0


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, path = _file_system(spark, old)
    if not fs.rename(path, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"cannot rename {old} to {new}")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder if it is there."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def file_bytes(spark: SparkSession, path: str, suffix: str = "") -> int:
    """Bytes of the files under ``path`` whose names end in ``suffix`` (from the file listing)."""
    fs, at = _file_system(spark, path)
    files, total = fs.listFiles(at, True), 0
    while files.hasNext():
        f = files.next()
        if f.getPath().getName().endswith(suffix):
            total += f.getLen()
    return total


def work_count(spark: SparkSession) -> int:
    """Number of work folders made so far (see ``release_work``)."""
    return len(_MADE.get(spark.sparkContext.applicationId, []))


def release_work(spark: SparkSession, since: int = 0, but: tuple[str, ...] = ()) -> int:
    """Delete the work folders this application made; frames that read them cannot be used any more.

    ``since``: only those made after so many; ``but``: names that stay.
    """
    made = _MADE.get(spark.sparkContext.applicationId, [])
    paths = [p for p in made[since:] if p.rsplit("/", 1)[1].rsplit("-", 1)[0] not in but]
    for p in paths:
        fs, path = _file_system(spark, p)
        fs.delete(path, True)
    made[since:] = [p for p in made[since:] if p not in set(paths)]
    return len(paths)


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the shared work folder and read it back.

    Cuts the lineage like a reliable checkpoint, but computes the input once
    (``Dataset.checkpoint`` runs it twice unless cached), stores it columnar,
    and survives executor loss.
    """
    path = work_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
