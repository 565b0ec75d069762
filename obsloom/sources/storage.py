"""Small files in the store that Spark writes to: listing, and files that only one writer can create."""

from __future__ import annotations

import json
import os
import re
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


class Storage:
    """File operations by the driver, on any file system that Hadoop knows."""

    def __init__(self, spark: SparkSession):
        self._context = spark.sparkContext
        self._jvm = spark.sparkContext._jvm

    def _at(self, path: str):
        """The file system of ``path`` and the path in its terms."""
        folder = self._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self._context._jsc.hadoopConfiguration()), folder

    def exists(self, path: str) -> bool:
        system, place = self._at(path)
        return system.exists(place)

    def names(self, path: str) -> list[str]:
        """Names in a folder; none if it is absent."""
        system, place = self._at(path)
        return [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []

    def modified(self, path: str) -> float:
        system, place = self._at(path)
        return system.getFileStatus(place).getModificationTime() / 1000

    def size(self, path: str) -> tuple[int, int]:
        """Number of files under a folder, and their bytes."""
        system, place = self._at(path)
        summary = system.getContentSummary(place)
        return summary.getFileCount(), summary.getLength()

    def delete(self, path: str) -> None:
        system, place = self._at(path)
        system.delete(place, True)

    def read_text(self, path: str) -> str:
        system, place = self._at(path)
        stream = system.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_once(self, path: str, text: str) -> bool:
        """Create a file with all its text at once; False if it exists, which one of several writers at most can avoid.

        The text is written beside it and then given the name: by a hard link in local and mounted folders, elsewhere by a
        rename that does not replace. An object store needs a file system layer with such a rename.
        """
        draft = f"{path}.{uuid.uuid4().hex}"
        system, place = self._at(draft)
        out = system.create(place, True)
        out.write(text.encode())
        out.close()
        try:
            if system.getUri().getScheme() == "file":
                os.link(_local(draft), _local(path))
            else:
                options = self._jvm.org.apache.hadoop.fs.Options
                plain = self._context._gateway.new_array(options.Rename, 1)
                plain[0] = options.Rename.NONE
                files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), self._context._jsc.hadoopConfiguration())
                files.rename(place, self._jvm.org.apache.hadoop.fs.Path(path), plain)
        except FileExistsError:
            return False
        except Exception:
            if self.exists(path):
                return False
            raise
        finally:
            system.delete(place, False)
        return True


def _local(path: str) -> str:
    return unquote(urlparse(path).path) if path.startswith("file:") else path


class CommitLog:
    """Numbered records 1, 2, ... of a folder. Each number is given once, so of two writers one takes the next number."""

    def __init__(self, spark: SparkSession, path: str):
        self.storage, self.path = Storage(spark), path

    def _file(self, number: int) -> str:
        return f"{self.path}/{number:012d}.json"

    def numbers(self) -> list[int]:
        found = (re.fullmatch(r"(\d{12})\.json", name) for name in self.storage.names(self.path))
        return sorted(int(m.group(1)) for m in found if m)

    def newest(self) -> int:
        """The greatest number; 0 before the first record."""
        return max(self.numbers(), default=0)

    def read(self, number: int) -> dict:
        return json.loads(self.storage.read_text(self._file(number)))

    def add(self, number: int, record: dict) -> bool:
        """Whether ``number`` was free and now holds ``record``."""
        return self.storage.create_once(self._file(number), json.dumps(record, sort_keys=True))

    def append(self, record: dict) -> int:
        """Add a record under the next free number."""
        number = self.newest() + 1
        while not self.add(number, record):
            number += 1
        return number

    def written(self, number: int) -> float:
        return self.storage.modified(self._file(number))

    def remove(self, number: int) -> None:
        self.storage.delete(self._file(number))
