"""Small files and folders of any Hadoop file system, from the driver."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Listed:
    """A file; ``below`` is its path below the folder that was listed."""

    path: str
    below: str
    bytes: int
    modified: float


class Files:
    """Reads, writes, lists and publishes by the Hadoop API, so that a path may lie in any
    store that Spark itself reaches."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """A new file; one that is there is an error."""
        fs, p = self._at(path)
        stream = fs.create(p, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> bool:
        """The whole file or nothing, by a rename that never replaces: False if the name is
        taken."""
        aside = f"{path}.{uuid.uuid4().hex}.tmp"
        self.write(aside, text)
        hadoop = self._jvm.org.apache.hadoop.fs
        _, source = self._at(aside)
        fs, target = self._at(path)
        none = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0
        )
        try:
            hadoop.FileContext.getFileContext(fs.getUri(), self._conf).rename(source, target, none)
            return True
        except Exception as e:
            fs.delete(source, False)
            if "FileAlreadyExists" in str(e) or fs.exists(target):
                return False
            raise

    def list(self, folder: str, deep: bool = False) -> list[Listed]:
        """The files of a folder; none where it is missing."""
        fs, p = self._at(folder)
        if not fs.exists(p):
            return []
        out, found = [], fs.listFiles(p, deep)
        skip = len(fs.makeQualified(p).toUri().getPath()) + 1
        while found.hasNext():
            s = found.next()
            path, below = s.getPath().toString(), s.getPath().toUri().getPath()[skip:]
            out.append(Listed(path, below, s.getLen(), s.getModificationTime() / 1000))
        return out

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)


_LEFT: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in
    ``spark.checkpoint.dir``; checkpoints, models and scratch tables go there. Only a local
    master, whose executor is the driver, may go without: it gets a folder of its own."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="dayscout-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, which goes when the application ends, or by
    ``clean_scratch`` before."""
    path = f"{shared_dir(spark)}/scratch/{name}-{uuid.uuid4().hex}"
    remember(spark, path)
    return path


def remember(spark: SparkSession, path: str) -> None:
    """Name a folder that ``clean_scratch`` deletes, at the end of the application at last."""
    if not _LEFT:
        atexit.register(clean_scratch)
    _LEFT.append((spark, path))


def clean_scratch() -> None:
    """Delete the scratch folders of this process. Frames that read from them are of no use
    any more, so call it once the results are written."""
    while _LEFT:
        spark, path = _LEFT.pop()
        with contextlib.suppress(Exception):  # the session may be gone, and its folder too
            Files(spark).delete(path)
