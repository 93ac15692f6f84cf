"""Names and small texts in shared folders, by the file systems that Spark itself reads."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class SharedFiles:
    """A few calls on whatever file system a path belongs to."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def exists(self, path: str) -> bool:
        system, where = self._at(path)
        return system.exists(where)

    def names(self, folder: str) -> list[str]:
        """What stands in a folder; nothing where there is none."""
        system, where = self._at(folder)
        if not system.exists(where):
            return []
        return sorted(status.getPath().getName() for status in system.listStatus(where))

    def delete(self, path: str) -> None:
        system, where = self._at(path)
        system.delete(where, True)

    def text(self, path: str) -> str:
        system, where = self._at(path)
        stream = system.open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def first_line(self, path: str) -> str | None:
        """The first line of a file, or of the first file with any in a folder; None where there is none."""
        system, where = self._at(path)
        if not system.exists(where):
            return None
        if system.getFileStatus(where).isDirectory():
            lines = (self.first_line(f"{path}/{n}") for n in self.names(path) if not n.startswith(("_", ".")))
            return next((line for line in lines if line is not None), None)
        codec = self._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(self._conf).getCodec(where)
        stream = system.open(where)
        try:
            plain = codec.createInputStream(stream) if codec is not None else stream
            return self._jvm.java.io.BufferedReader(self._jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        system, where = self._at(path)
        stream = system.create(where, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename_new(self, path: str, target: str) -> bool:
        """Move a file to a name that must be free; False where it is taken."""
        system, where = self._at(path)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), self._conf)
        none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        wanted = self._jvm.java.lang.reflect.Array.newInstance(none.getClass(), 1)
        wanted[0] = none
        try:
            context.rename(where, self._jvm.org.apache.hadoop.fs.Path(target), wanted)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def replace(self, path: str, target: str) -> None:
        """Move a folder to a name, in place of what stands there."""
        system, where = self._at(path)
        to = self._jvm.org.apache.hadoop.fs.Path(target)
        system.delete(to, True)
        system.mkdirs(to.getParent())
        if not system.rename(where, to):
            raise OSError(f"{path} cannot be moved to {target}")
