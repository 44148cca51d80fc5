"""Sessions for local work, and the folder that shared intermediate tables go to."""

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

from scorelake.sources import storage


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="scorelake-")


def local_session(cpus: int | str = "*", app_name: str = "scorelake") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", f"{_local_folder()}/warehouse")
        .getOrCreate()
    )


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    It is deleted when the driver ends. Only a local session may go without that setting;
    it gets a temporary folder of its machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_folder()
    folder = f"{shared.rstrip('/')}/scorelake/{name}-{uuid.uuid4().hex}"
    storage.make_temporary(spark, folder)
    return folder
