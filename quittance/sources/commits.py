"""Numbered commits: of two runs that end at the same time, one wins and the other knows.

A commit is a small file whose name is a number and whose lines name the folders that make up
a table as of that commit. It is written whole under another name and then put in place by an
operation that fails if the number is taken: a hard link on a local disk, a rename that does
not overwrite elsewhere, which HDFS does atomically. A store without such an operation must
serialise its runs.

A run reads the newest commit, prepares a folder nobody reads yet, and commits the next
number. If it loses, it reads again, prepares what is still right, and tries the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from quittance.sources.exports import file_system

#: Digits of a commit's name, so that names sort like numbers.
WIDTH = 12


class CommitLog:
    """The commits below one folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def state(self) -> tuple[int, list[str]]:
        """The newest commit's number and lines; 0 and nothing before the first."""
        system, pattern = file_system(self.spark, f"{self.folder}/{'[0-9]' * WIDTH}")
        names = [s.getPath().getName() for s in system.globStatus(pattern) or []]
        if not names:
            return 0, []
        newest = max(names)
        _, path = file_system(self.spark, f"{self.folder}/{newest}")
        stream = system.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return int(newest), text.split()

    def commit(self, number: int, lines: Sequence[str]) -> bool:
        """Make ``lines`` the commit of this number; False if another run was faster."""
        jvm = self.spark.sparkContext._jvm
        draft = f"{self.folder}/.draft-{uuid.uuid4().hex}"
        system, source = file_system(self.spark, draft)
        stream = system.create(source, False)
        stream.write(bytearray("\n".join(lines).encode("utf-8")))
        stream.close()
        _, target = file_system(self.spark, f"{self.folder}/{number:0{WIDTH}d}")
        try:
            if system.getScheme() == "file":
                place = lambda path: jvm.java.nio.file.Paths.get(path.toUri().getPath(), self._none())
                jvm.java.nio.file.Files.createLink(place(target), place(source))
            else:
                hadoop = jvm.org.apache.hadoop.fs
                context = hadoop.FileContext.getFileContext(
                    target.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
                )
                options = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
                options[0] = hadoop.Options.Rename.NONE
                context.rename(source, target, options)
            return True
        except Py4JJavaError as problem:
            if "AlreadyExists" in problem.java_exception.getClass().getName():
                return False
            raise
        finally:
            system.delete(source, False)

    def _none(self):
        """The empty rest of a Java call with any number of arguments."""
        return self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.java.lang.String, 0)
