"""The few file-system calls that publishing needs, on any Hadoop file system."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def hidden_sibling(path: str, kind: str) -> str:
    parent, slash, name = path.rstrip("/").rpartition("/")
    return f"{parent}{slash}.{name}.{kind}"


class Folder:
    """A folder or file that Spark can reach, whether it exists or not."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self._at = self._Path(self.path)
        self._fs = self._at.getFileSystem(spark._jsc.hadoopConfiguration())

    def within(self, name: str) -> Folder:
        return Folder(self.spark, f"{self.path}/{name}")

    def beside(self, kind: str) -> Folder:
        """A hidden sibling: on the same file system, skipped by scans."""
        return Folder(self.spark, hidden_sibling(self.path, kind))

    def exists(self) -> bool:
        return self._fs.exists(self._at)

    def delete(self) -> None:
        self._fs.delete(self._at, True)

    def move_to(self, to: Folder) -> None:
        self._fs.mkdirs(to._at.getParent())
        if to.exists() or not self._fs.rename(self._at, to._at):
            raise OSError(f"could not move {self.path} to {to.path}")

    def size(self) -> int:
        """Bytes in all files below; 0 if there is nothing."""
        return self._fs.getContentSummary(self._at).getLength() if self.exists() else 0

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._at)]

    def make(self) -> None:
        self._fs.mkdirs(self._at)

    def files(self) -> list[str]:
        """All files below, as paths from here; hidden ones are left out."""
        start = len(self._fs.makeQualified(self._at).toUri().getPath().rstrip("/")) + 1
        found, listed = [], self._fs.listFiles(self._at, True)
        while listed.hasNext():
            name = listed.next().getPath().toUri().getPath()[start:]
            if not any(part[0] in "._" for part in name.split("/")):
                found.append(name)
        return sorted(found)

    def put(self, text: str) -> None:
        """Make this a file that holds `text`, whole or not at all."""
        part = self._Path(f"{self.path}.part")
        out = self._fs.create(part, True)
        out.writeBytes(text)
        out.close()
        if not self._fs.rename(part, self._at):
            raise OSError(f"could not write {self.path}")

    def create(self, text: str) -> bool:
        """Make this a file that holds `text`, unless there is one: of several writers one does.

        The file is complete when it appears. Local disks link it into place and others
        rename without overwriting, which HDFS does in one step; an object store has to
        refuse a target that exists.
        """
        part = Folder(self.spark, f"{self.path}.{uuid.uuid4().hex}")
        out = self._fs.create(part._at, True)
        out.writeBytes(text)
        out.close()
        try:
            if self._fs.getScheme() == "file":
                target, source = (
                    self.spark._jvm.java.io.File(at.toUri().getPath()).toPath()
                    for at in (self._fs.makeQualified(self._at), self._fs.makeQualified(part._at))
                )
                self.spark._jvm.java.nio.file.Files.createLink(target, source)
            else:
                options = self.spark.sparkContext._gateway.new_array(
                    self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0
                )
                context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                    self._fs.getUri(), self.spark._jsc.hadoopConfiguration()
                )
                context.rename(part._at, self._at, options)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            return False
        finally:
            part.delete()
        return True

    def overwrite(self, text: str) -> None:
        out = self._fs.create(self._at, True)
        out.writeBytes(text)
        out.close()

    def text(self) -> str:
        stream = self._fs.open(self._at)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
