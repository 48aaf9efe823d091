"""Tables derived once per application and written to the cluster's shared folder.

The written copy cuts lineage, survives lost executors and gives later plans file
statistics and column pruning. It is deleted when the application ends.
"""

import hashlib
import re
import tempfile
import threading
from collections import defaultdict

_written = {}
_local_root = {}
_locks = defaultdict(threading.RLock)
_guard = threading.Lock()


def shared_root(spark):
    """Folder named by ``spark.checkpoint.dir``; where it is unset, a temporary one if the whole
    session is one process, and None on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
        app = spark.conf.get("spark.app.id")
        if app not in _local_root:
            _local_root[app] = tempfile.TemporaryDirectory(prefix="basketlens-")
        return _local_root[app].name
    return None


def _place(spark, path):
    """The path and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def fingerprint(spark, paths):
    """State of the source tables: bytes, files and time of change, on any file system.

    The file system sums up a folder itself; no list of files comes to this process.
    """
    marks = []
    for path in paths:
        place, system = _place(spark, path)
        total = system.getContentSummary(place)
        marks.append(f"{path}:{total.getLength()}:{total.getFileCount()}:"
                     f"{system.getFileStatus(place).getModificationTime()}")
    return "|".join(marks)


def tasks_for(spark, path, size, least=None):
    """Tasks that take about ``size`` bytes each of a table's files, and ``least`` or one per core at least."""
    place, system = _place(spark, path)
    return max(least or spark.sparkContext.defaultParallelism, -(-system.getContentSummary(place).getLength() // size))


def stage_path(spark, source, name):
    """Place of a staged table, or None where the cluster names no shared folder."""
    root = shared_root(spark)
    if root is None:
        return None
    app = spark.conf.get("spark.app.id")
    mark = hashlib.sha1(source.encode()).hexdigest()[:12]
    return f"{root}/basketlens/{app}/{mark}/{name}"


def staged(spark, source, name, build, partition_by=()):
    """Write ``build()`` once per application and source, then read it back.

    Without a shared folder the plan is returned unwritten. Different tables are written side by
    side; whoever asks for a table that is being written waits for it.
    """
    path = stage_path(spark, source, name)
    if path is None:
        return build()
    with _guard:
        lock = _locks[path]
    with lock:
        if path not in _written:
            writer = build().write.mode("overwrite")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            writer.parquet(path)
            place, system = _place(spark, path)
            system.deleteOnExit(place)
            _written[path] = spark.read.parquet(path).schema
    return spark.read.schema(_written[path]).parquet(path)


def forget(source=None):
    """Drop the memory of staged tables, so that changed sources are read again."""
    with _guard:
        if source is None:
            _written.clear()
            return
        mark = hashlib.sha1(source.encode()).hexdigest()[:12]
        for path in [p for p in _written if f"/{mark}/" in p]:
            del _written[path]
