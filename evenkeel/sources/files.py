"""Files of a stored parquet table, through the file system that Spark uses for it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from evenkeel.errors import ConfigError

_GLOB = re.compile(r"([\\{}\[\]*?])")
#: What a partition folder is called whose value is null.
_NULL = "__HIVE_DEFAULT_PARTITION__"


class Folder:
    """A folder that holds a table: data files under folders of partition values; names that start with ``_`` or ``.``
    are not part of it."""

    def __init__(self, spark: SparkSession, path: str):
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        root = self._hadoop.Path(path.rstrip("/"))
        self.fs = root.getFileSystem(self._conf)
        self.root = self.fs.makeQualified(root).toString()

    def at(self, relative: str = ""):
        return self._hadoop.Path(f"{self.root}/{relative}" if relative else self.root)

    def exists(self, relative: str = "") -> bool:
        return self.fs.exists(self.at(relative))

    def data_files(self) -> list[str]:
        """Relative names of all data files."""
        return sorted(self._walk("")) if self.exists() else []

    def _walk(self, inside: str) -> Iterator[str]:
        for status in self.fs.listStatus(self.at(inside)):
            name = status.getPath().getName()
            if name.startswith(".") or (name.startswith("_") and "=" not in name):
                continue
            relative = f"{inside}/{name}" if inside else name
            if status.isDirectory():
                yield from self._walk(relative)
            else:
                yield relative

    def names(self, relative: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(relative))) if self.exists(relative) else []

    def relative(self, file_path: str) -> str:
        """The relative name of a ``_metadata.file_path``."""
        full = self.fs.makeQualified(self._hadoop.Path(unquote(file_path))).toString()
        if not full.startswith(self.root + "/"):
            raise ConfigError(f"{full} is not in {self.root}")
        return full[len(self.root) + 1 :]

    def move(self, before: str, after: str) -> None:
        """Rename, unless it is done already."""
        if not self.exists(before):
            if self.exists(after):
                return
            raise ConfigError(f"{before} is gone from {self.root}")
        self.fs.mkdirs(self.at(after).getParent())
        if not self.fs.rename(self.at(before), self.at(after)):
            raise ConfigError(f"cannot rename {before} to {after} in {self.root}")

    def delete(self, relative: str) -> None:
        self.fs.delete(self.at(relative), True)

    def write_text(self, relative: str, text: str) -> None:
        """Write a small file at once: it is there whole or not at all."""
        out = self.fs.create(self.at(relative + ".tmp"), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(relative + ".tmp", relative)

    def read_text(self, relative: str) -> str:
        stream = self.fs.open(self.at(relative))
        try:
            size = self.fs.getFileStatus(self.at(relative)).getLen()
            return bytes(stream.readNBytes(int(size))).decode()
        finally:
            stream.close()


def partition_columns(files: list[str]) -> list[str]:
    """Names of the partition columns, from the folders of the data files, which must agree."""
    found = {tuple(unquote(part.split("=", 1)[0]) for part in f.split("/")[:-1]) for f in files}
    if any("=" not in part for f in files for part in f.split("/")[:-1]) or len(found) > 1:
        raise ConfigError(f"folders that are no partitions, or of different ones: {sorted(found)[:5]}")
    return list(found.pop()) if found else []


def partition_folder(column: str, value: str | None) -> str:
    return f"{column}={_NULL if value is None else quote(value, safe=' !$()+,-.;@_&~|<>')}"


def read_files(spark: SparkSession, folder: Folder, files: list[str], schema: T.StructType) -> DataFrame:
    """Some files of a table, with its partition columns."""
    paths = [_GLOB.sub(r"\\\1", f"{folder.root}/{f}") for f in files]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", folder.root).parquet(*paths)
