"""Session settings the library is meant to run with, and the shared work folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Days and text times are read in one fixed zone; otherwise day borders move. Text that is no
# number or time fails a query, instead of turning into nulls.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Facts from this size on are filtered by a Bloom filter of a filtered list before they are shuffled to meet it.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    # Tables sorted by session are known to be sorted, so that following sessions needs no sort.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}

# Running counts are never dropped by default, so their state must not live on the heap.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; ``settings`` are further Spark options."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SESSION_SETTINGS, **STREAM_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else built; they stay on it for good.

    The registered queries call it, as their results depend on zone and ANSI mode. Library functions
    never do: a caller who wants other settings uses those.
    """
    for key, value in {**SESSION_SETTINGS, **STREAM_SETTINGS}.items():
        spark.conf.set(key, value)
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for checkpoints and written tables, below ``spark.checkpoint.dir``; it goes when the application ends.

    That folder is shared by all executors. Where the setting is absent, only a local session
    gets a temporary folder; on a cluster a machine-local folder would lose data.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.gettempdir()
    return f"{_application_folder(spark, shared.rstrip('/'))}/{name}-{uuid.uuid4().hex}"


# The folder of each application, made at its first use.
_FOLDERS: dict[tuple[str, str], str] = {}


def _application_folder(spark: SparkSession, shared: str) -> str:
    key = spark.sparkContext.applicationId, shared
    if key not in _FOLDERS:
        folder = f"{shared}/shoptrail-{uuid.uuid4().hex}"
        system, place = _file_system(spark, folder)
        system.mkdirs(place)
        system.deleteOnExit(place)
        _FOLDERS[key] = folder
    return _FOLDERS[key]


def remove_work_folders(spark: SparkSession) -> None:
    """Remove all that this application has put below the shared folder; call it before ``spark.stop()`` where the process
    goes on. Results that are read from there are lost."""
    own = spark.sparkContext.applicationId
    for key in [k for k in _FOLDERS if k[0] == own]:
        delete_folder(spark, _FOLDERS.pop(key))


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds; nothing happens if there is none."""
    system, place = _file_system(spark, path)
    system.delete(place, True)

