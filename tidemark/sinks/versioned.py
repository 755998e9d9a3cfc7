"""Full replace of Parquet folders that readers only ever see whole."""

from __future__ import annotations

import json
import logging
import re
import uuid
from collections.abc import Sequence
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions import named
from tidemark.sinks.layout import laid_out

log = logging.getLogger(__name__)

COMMITTER = "mapreduce.fileoutputcommitter.algorithm.version"
COMMIT_FILE = re.compile(r"(\d{10})\.json")
DATA_FOLDER = re.compile(r"(\d{10})-[0-9a-f]+")


class MissingTable(LookupError):
    """No version of the table was ever published."""


class ConcurrentPublish(RuntimeError):
    """Another publisher committed the same version first."""


class VersionedStore:
    """Named tables under a root folder, each a series of complete versions.

    Layout: ``<root>/<name>/data/<version>-<id>/`` holds Parquet files and
    ``<root>/<name>/commits/<version>.json`` makes that folder a version. The commit
    file appears by a rename that never overwrites, after all data is written. A write
    that fails, or a driver that dies, therefore leaves the old version in place, and
    a table may be replaced by a query that reads it.

    The newest ``keep`` versions stay, so a query that started on the one before
    the newest can end; older ones, and what dead drivers left, are deleted after a
    commit. The root must be a file system all nodes share.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        if keep < 1:
            raise ValueError("keep must be at least 1")
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep

    def publish(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> str:
        """Replace the table with ``df`` and return the new version's folder.

        A partitioned table is first laid out by its partition columns, see
        :func:`~tidemark.sinks.layout.laid_out`. They may not be strings. Tasks move their own
        files into place, which is safe here: a folder without a commit file is never read.
        """
        version = max(self._versions(name), default=0) + 1
        folder = f"data/{version:010d}-{uuid.uuid4().hex}"
        target = f"{self.root}/{name}/{folder}"
        texts = [c for c in partition_by if isinstance(df.schema[c].dataType, T.StringType)]
        if texts:
            raise ValueError(f"partition columns {texts} are strings: '' would be read as null")
        try:
            writer = laid_out(df, partition_by).write.partitionBy(*partition_by)
            writer.option(COMMITTER, 2).parquet(target)
        except Exception:
            self._delete(target)
            raise
        try:
            self._commit(name, version, {"data": folder, "schema": df.schema.jsonValue()})
        except ConcurrentPublish:
            self._delete(target)
            raise
        # After any other commit error the data stays: the commit may have come through.
        try:
            self._clean_up(name, version)
        except Py4JJavaError as error:
            log.warning("%s: old versions not removed: %s", name, error.java_exception)
        return target

    def read(self, name: str) -> DataFrame:
        """The newest version, with the schema it was published with."""
        versions = self._versions(name)
        if not versions:
            raise MissingTable(f"no table {name!r} under {self.root}")
        commit = self._load_commit(name, max(versions))
        schema = T.StructType.fromJson(commit["schema"])
        columns = [named(c) for c in schema.fieldNames()]
        data = self.spark.read.schema(schema).parquet(f"{self.root}/{name}/{commit['data']}")
        return data.select(*columns)

    # The few file-system calls below are the ones Spark's reader and writer lack.

    def _path(self, path: str) -> Any:
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: Any) -> Any:
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _commit_path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/commits/{version:010d}.json"

    def _versions(self, name: str) -> list[int]:
        names = self._list(f"{self.root}/{name}/commits")
        return [int(found.group(1)) for n in names if (found := COMMIT_FILE.fullmatch(n))]

    def _list(self, path: str) -> list[str]:
        folder = self._path(path)
        fs = self._fs(folder)
        if not fs.exists(folder):
            return []
        return [status.getPath().getName() for status in fs.listStatus(folder)]

    def _load_commit(self, name: str, version: int) -> dict[str, Any]:
        path = self._path(self._commit_path(name, version))
        stream = self._fs(path).open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            return json.loads(text)
        finally:
            stream.close()

    def _commit(self, name: str, version: int, content: dict[str, Any]) -> None:
        jvm = self.spark._jvm
        final = self._path(self._commit_path(name, version))
        draft = self._path(f"{self.root}/{name}/commits/.{uuid.uuid4().hex}")
        stream = self._fs(draft).create(draft, False)
        try:
            stream.write(bytearray(json.dumps(content), "utf-8"))
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs(draft).getUri(), self.spark._jsc.hadoopConfiguration()
        )
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        modes = self.spark.sparkContext._gateway.new_array(rename, 1)
        modes[0] = rename.NONE
        try:
            context.rename(draft, final, modes)
        except Py4JJavaError as error:
            self._fs(draft).delete(draft, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                raise ConcurrentPublish(f"{name}: version {version} exists") from error
            raise

    def _clean_up(self, name: str, newest: int) -> None:
        """Delete commits beyond ``keep`` and older folders no commit names.

        Such a folder is an expired version, or was left by a driver that died. A
        publisher still writing one couldn't commit it any more.
        """
        versions = sorted(self._versions(name))
        for old in versions[: -self.keep]:
            self._delete(self._commit_path(name, old))
        named_folders = {self._load_commit(name, v)["data"] for v in versions[-self.keep :]}
        for folder in self._list(f"{self.root}/{name}/data"):
            found = DATA_FOLDER.fullmatch(folder)
            if found and int(found.group(1)) < newest and f"data/{folder}" not in named_folders:
                self._delete(f"{self.root}/{name}/data/{folder}")

    def _delete(self, path: str) -> None:
        target = self._path(path)
        self._fs(target).delete(target, True)
