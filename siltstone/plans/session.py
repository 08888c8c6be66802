"""Session settings the library relies on."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import SparkSession

SHARED_DIR_CONF = "spark.checkpoint.dir"

# Class mappings compute some forty columns at once.  Fused into one generated method
# they pass the size up to which the JVM compiles a method (8000 bytes of bytecode), and
# would run interpreted; above this limit Spark generates smaller methods instead.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings mappings are written for; all can change at run time."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach, as the cluster names it.

    Only a session that names none, as in tests, gets a folder of this machine.
    """
    named = spark.conf.get(SHARED_DIR_CONF, None) or spark.sparkContext.getConf().get(SHARED_DIR_CONF)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR_CONF} to a folder shared by all executors")
    return tempfile.gettempdir() + "/siltstone"


_ENDINGS: list[Callable[[], None]] = []


def at_end(action: Callable[[], None]) -> None:
    """Run ``action`` when the driver process ends, the latest first; frames may read until then."""
    if not _ENDINGS:
        atexit.register(_end)
    _ENDINGS.append(action)


def _end() -> None:
    while _ENDINGS:
        # The session, or Java itself, may be gone by now; the other endings still count.
        with contextlib.suppress(Exception):
            _ENDINGS.pop()()


def delete(path: str) -> None:
    """Remove a file or folder of any file system Spark reaches."""
    jvm = SparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(hadoop_path, True)


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A folder name in the shared folder that no other run uses; it goes when the driver ends."""
    path = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    at_end(lambda: delete(path))
    return path
