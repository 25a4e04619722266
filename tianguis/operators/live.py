"""Which files of a table are live: numbered pointer files, of which the newest counts.

A load writes its files into a folder of its own and then commits a pointer with the next number, in one rename that fails
if another load has taken the number. Readers see the table of one pointer, whole; a load that dies leaves files that no
pointer names. On object stores without a rename that refuses to overwrite, loads of a table have to take turns.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

POINTERS = "_live"
#: Pointers, and the files they name, that stay for readers who are still on them.
KEPT_POINTERS = 2


class ConcurrentLoad(RuntimeError):
    """Another load of the table has committed since this one began."""


@dataclass(frozen=True)
class Live:
    """The state of a table that one pointer names."""

    number: int = 0
    folders: dict[str, str] = field(default_factory=dict)  # partition value ("" for a whole table) -> load
    rows: dict[str, int] = field(default_factory=dict)  # partition value -> rows
    index: dict[str, str] = field(default_factory=dict)  # bucket of keys -> load
    built_from: dict[str, str] = field(default_factory=dict)  # of a rollup: partition value of its source -> load
    whole: str = ""  # the load that wrote every partition and no other, if there is one
    columns: str = ""  # every column the table has had, as the JSON of a schema

    def loads(self) -> set[str]:
        return {*self.folders.values(), *self.index.values()}

    def replacing(self, gone: list[str], load: str, written: dict[str, int]) -> "Live":
        """The same table, where the partitions ``gone`` give way to those ``written`` by a load."""
        gone = set(gone)
        keep = lambda old: {k: v for k, v in old.items() if k not in gone}
        folders = keep(self.folders) | dict.fromkeys(written, load)
        return replace(self, folders=folders, rows=keep(self.rows) | written, whole=load if written and folders.keys() == written.keys() else "")


class Files:
    """A folder on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _conf(self):
        return self.spark._jsc.hadoopConfiguration()

    def fs(self):
        return self.path().getFileSystem(self._conf())

    def names(self, *parts: str) -> list[str]:
        path = self.path(*parts) if parts else self.path()
        return sorted(s.getPath().getName() for s in self.fs().listStatus(path)) if self.fs().exists(path) else []

    def exists(self, *parts: str) -> bool:
        return self.fs().exists(self.path(*parts))

    def make(self, *parts: str) -> None:
        self.fs().mkdirs(self.path(*parts))

    def drop(self, *parts: str) -> None:
        self.fs().delete(self.path(*parts), True)

    def text(self, *parts: str) -> str:
        stream = self.fs().open(self.path(*parts))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, text: str, *parts: str) -> bool:
        """A new file, whole or not at all; False if there is one already."""
        jvm, target = self.spark._jvm, self.path(*parts)
        draft = self.path(*parts[:-1], f".{parts[-1]}-{uuid.uuid4().hex}")
        stream = self.fs().create(draft)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf()).rename(draft, target, options)
        except Py4JJavaError:
            self.fs().delete(draft, False)
            if self.exists(*parts):
                return False
            raise
        return True


class Pointers:
    """The pointers of one table."""

    def __init__(self, files: Files, table: str):
        self.files, self.table = files, table

    def _numbers(self) -> list[int]:
        return [int(n) for n in self.files.names(self.table, POINTERS) if n.isdigit()]

    def _read(self, number: int) -> Live:
        return Live(**json.loads(self.files.text(self.table, POINTERS, f"{number:012d}")))

    def live(self) -> Live:
        numbers = self._numbers()
        return self._read(max(numbers)) if numbers else Live()

    def new_load(self, before: Live) -> str:
        """The name of a load that began from a state."""
        return f"{before.number:012d}-{uuid.uuid4().hex}"

    def commit(self, before: Live, after: Live) -> None:
        """``after`` becomes the state of the table, if that is still ``before``."""
        after = replace(after, number=before.number + 1)
        if not self.files.put(json.dumps(asdict(after)), self.table, POINTERS, f"{after.number:012d}"):
            raise ConcurrentLoad(f"{self.table}: another load has committed since this one began; run it again")
        self._clean()

    def _clean(self) -> None:
        """Drop old pointers, and files that no pointer names and no load can name any more."""
        numbers = sorted(self._numbers())
        kept = numbers[-KEPT_POINTERS:]
        named = set().union(*[self._read(n).loads() for n in kept])
        for number in numbers[:-KEPT_POINTERS]:
            self.files.drop(self.table, POINTERS, f"{number:012d}")
        for name in self.files.names(self.table):
            load = name.partition("=")[2]
            # A load that began from an earlier state than the newest cannot commit any more.
            if name.startswith(("_load=", "_index=")) and load not in named and int(load.partition("-")[0]) < kept[-1]:
                self.files.drop(self.table, name)
