"""Tables written on the way: reports, and staged inputs of iterative fits."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDER: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A session on a cluster must name one. In a local session all tasks run in the driver's process,
    so one that names none gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _LOCAL_FOLDER:
        _LOCAL_FOLDER.append(tempfile.mkdtemp(prefix="casewise-"))
    return _LOCAL_FOLDER[0]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back.

    Iterative fits read their input many times. A written table is computed once, costs no
    executor memory, and survives the loss of executors, which cached blocks do not.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_for_rounds(df: DataFrame, name: str) -> DataFrame:
    """``df`` staged in files of the size that adaptive execution aims at, for fits that go round many times.

    Every round pays for each partition it schedules; a small table is one file.
    """
    return staged(df.hint("rebalance"), name)


def drop_staged(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files behind a staged table that is no longer needed."""
    folder = shared_folder(spark)
    hadoop = spark._jvm.org.apache.hadoop.fs
    for path in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        place = hadoop.Path(path)
        if hadoop.Path(place.toUri().getPath()).getParent().equals(hadoop.Path(hadoop.Path(folder).toUri().getPath())):
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _manifests(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{path.rstrip('/')}/_manifests")
    return hadoop, folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def report_versions(spark: SparkSession, path: str) -> list[str]:
    """The versions that were committed, the newest first."""
    _, folder, files = _manifests(spark, path)
    if not files.exists(folder):
        return []
    names = sorted((status.getPath().getName() for status in files.listStatus(folder)), reverse=True)
    return [name.split("=")[1] for name in names if "=" in name]


def write_report(df: DataFrame, path: str, keep: int = 2) -> DataFrame:
    """Write the table behind a figure as a new version and give it back as read from the files.

    A version is read once it is committed: its name is in a manifest, which is made in one step after all files are
    whole. So a write that fails, at whatever point, leaves the version before as it was. The newest ``keep`` versions stay, as
    someone may be reading the one before.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    df.write.parquet(f"{path.rstrip('/')}/{version}")
    hadoop, folder, files = _manifests(spark, path)
    before = report_versions(spark, path)
    files.mkdirs(folder)
    # the number orders versions; of two writers at a time both commit, and the name of the version decides
    number = 1 + max([int(status.getPath().getName().split("=")[0]) for status in files.listStatus(folder)], default=0)
    files.createNewFile(hadoop.Path(folder, f"{number:012d}={version}"))
    for old in before[keep - 1 :]:
        for status in files.listStatus(folder):
            if status.getPath().getName().endswith(f"={old}"):
                files.delete(status.getPath(), False)
        files.delete(hadoop.Path(f"{path.rstrip('/')}/{old}"), True)
    return spark.read.schema(df.schema).parquet(f"{path.rstrip('/')}/{version}")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version of a report."""
    versions = report_versions(spark, path)
    if not versions:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path.rstrip('/')}/{versions[0]}")
