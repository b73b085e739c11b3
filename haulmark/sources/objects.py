"""One object-store interface over any Hadoop file system.

The base URI (``file:``, ``hdfs:``, ``s3a:`` ...) is the only setting that differs between
a laptop and a cloud bucket; credentials come from the Hadoop configuration.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ObjectStore:
    def __init__(self, spark: SparkSession, base_uri: str) -> None:
        self.spark = spark
        self.base_uri = base_uri.rstrip("/")
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def uri(self, key: str = "") -> str:
        return f"{self.base_uri}/{key}" if key else self.base_uri

    def _path(self, key: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.uri(key))
        return path, path.getFileSystem(self._conf)

    def exists(self, key: str) -> bool:
        path, files = self._path(key)
        return files.exists(path)

    def list_objects(self, prefix: str = "") -> DataFrame:
        """Keys below a prefix with size and time, listed recursively.

        The listing is a frame, so a zone with millions of objects never becomes a
        driver-side list; the ``content`` column is pruned and no file is opened.
        """
        folder = prefix.rpartition("/")[0]
        files = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(self.uri(folder))
            .select("path", "length", "modificationTime")
        )
        base = "/" + self.base_uri.split(":", 1)[-1].strip("/") + "/"
        start = F.instr("path", F.lit(base)) + len(base)
        return files.select(
            F.substring("path", start, F.length("path")).alias("key"),
            F.col("length").alias("bytes"),
            F.col("modificationTime").alias("modified_at"),
        ).filter(F.col("key").startswith(prefix))

    def upload_bytes(self, key: str, data: bytes, replace: bool = True) -> None:
        """Write one small object; readers see it whole or not at all.

        ``replace=False``: an object of that name is an error and stays as it is.
        """
        target, files = self._path(key)
        partial, _ = self._path(f"{key}.{uuid.uuid4().hex}.partial")
        stream = files.create(partial, True)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
        java = self.spark._jvm
        rename = java.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE if replace else rename.NONE
        context = java.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        try:
            context.rename(
                context.makeQualified(partial), context.makeQualified(target), options
            )
        except Py4JJavaError as error:
            files.delete(partial, False)
            if not replace and files.exists(target):
                raise FileExistsError(self.uri(key)) from error
            raise

    def download_bytes(self, key: str) -> bytes:
        """Read one small object in the driver, without a job."""
        path, files = self._path(key)
        if not files.exists(path):
            raise FileNotFoundError(self.uri(key))
        stream = files.open(path)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def upload_file(self, key: str, local_path: str) -> None:
        target, files = self._path(key)
        files.copyFromLocalFile(self.spark._jvm.org.apache.hadoop.fs.Path(local_path), target)

    def names(self, folder: str) -> list[str]:
        """Direct children of one folder that the engine itself keeps small."""
        path, files = self._path(folder)
        if not files.exists(path):
            return []
        return sorted(status.getPath().getName() for status in files.listStatus(path))

    def remove(self, key: str) -> None:
        path, files = self._path(key)
        files.delete(path, True)

    def move(self, source: str, target: str) -> None:
        """Move a folder or object to a place that nothing else takes."""
        path, files = self._path(source)
        goal = self._path(target)[0]
        files.mkdirs(goal.getParent())
        if files.exists(goal) or not files.rename(path, goal):
            raise OSError(f"cannot move {self.uri(source)} to {self.uri(target)}")
