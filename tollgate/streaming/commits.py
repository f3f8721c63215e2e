"""Commits of micro-batches: all outputs of a batch become visible together, and once.

An attempt at a batch writes its outputs to a folder of its own. One small file, the intent, then names
the attempt that counts; it is created by a rename that fails if another attempt was first. The folders
of that attempt are renamed into place, one rename for each output, and the manifest, created like the
intent, ends the commit. Whoever finds an intent without a manifest finishes what it says and computes
nothing, so a crash at any point leads to the same files.

A reader of tables takes the batches that have a manifest. A file stream may follow an output's folder:
each folder of a batch appears by a single rename, complete, and is never replaced. Stores without an
atomic rename of folders need a file system layer that offers one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tollgate.session import path_exists

_BATCH = "batch_id"


def _nothing(step: str) -> None:
    pass


class Commits:
    """The commits below one folder.

    reached is called with the name of each step done: "staged <output>", "intended",
    "published <output>", "committed". It is there for logs, and for tests that stop there.
    """

    def __init__(self, spark: SparkSession, root: str, reached: Callable[[str], None] | None = None):
        self._spark, self._root, self._reached = spark, root.rstrip("/"), reached or _nothing
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def done(self, batch_id: int) -> bool:
        return path_exists(self._spark, self._file("commits", batch_id))

    def commit(self, batch_id: int, make: Callable[[], dict[str, DataFrame]]) -> bool:
        """Commit the outputs of a batch by name. False if an earlier attempt's were taken, and make not called."""
        if self.done(batch_id):
            return False
        intent, made = self._file("intents", batch_id), False
        if not path_exists(self._spark, intent):
            self._create(intent, self._stage(batch_id, make()))
            made = True
            self._reached("intended")
        # what counts is the intent in place: it may be a faster attempt's
        text = self._spark.read.text(intent, wholetext=True).first()[0]
        for name, output in json.loads(text)["outputs"].items():
            self._publish(output["staged"], f"{self._root}/{name}/{_BATCH}={batch_id}")
            self._reached(f"published {name}")
        self._create(self._file("commits", batch_id), text)
        self._reached("committed")
        attempts = self._path(self._attempts(batch_id))
        attempts.getFileSystem(self._conf).delete(attempts, True)
        return made

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """Rows of an output in committed batches."""
        if not path_exists(self._spark, f"{self._root}/commits"):
            return self._spark.createDataFrame([], schema)
        manifests = self._spark.read.schema(f"{_BATCH} bigint").json(f"{self._root}/commits")
        fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
        stored = T.StructType([*fields, T.StructField(_BATCH, T.LongType())])
        rows = self._spark.read.schema(stored).parquet(f"{self._root}/{name}")
        return rows.join(manifests, _BATCH, "left_semi").select(*schema.fieldNames())

    def remove(self, name: str, batch_id: int) -> None:
        """Remove an output that no reader needs any more."""
        folder = self._path(f"{self._root}/{name}/{_BATCH}={batch_id}")
        folder.getFileSystem(self._conf).delete(folder, True)

    def _file(self, folder: str, batch_id: int) -> str:
        return f"{self._root}/{folder}/{batch_id:012d}.json"

    def _attempts(self, batch_id: int) -> str:
        return f"{self._root}/attempts/{_BATCH}={batch_id}"

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _stage(self, batch_id: int, outputs: dict[str, DataFrame]) -> str:
        """Write an attempt's outputs; gives the text of its intent, which names every file."""
        attempt, named = f"{self._attempts(batch_id)}/{uuid.uuid4().hex}", {}
        for name, df in outputs.items():
            staged = f"{attempt}/{name}"
            df.write.parquet(staged)
            folder = self._path(staged)
            listed = folder.getFileSystem(self._conf).listStatus(folder)
            files = sorted(one.getPath().getName() for one in listed)
            named[name] = {"staged": staged, "files": [f for f in files if not f.startswith(("_", "."))]}
            self._reached(f"staged {name}")
        return json.dumps({_BATCH: batch_id, "outputs": named})

    def _create(self, path: str, text: str) -> None:
        """Create a file with that text unless there is one: it appears complete, by a rename."""
        part = self._path(f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        stream = part.getFileSystem(self._conf).create(part, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self._rename(part, path):
            part.getFileSystem(self._conf).delete(part, False)

    def _publish(self, staged: str, final: str) -> None:
        target = self._path(final)
        if path_exists(self._spark, final):
            return
        target.getFileSystem(self._conf).mkdirs(target.getParent())
        self._rename(self._path(staged), final)

    def _rename(self, source, final: str) -> bool:
        """Rename unless the target exists; False if it does, by then at the latest."""
        options = self._jvm.org.apache.hadoop.fs
        gateway = self._spark.sparkContext._gateway
        plain = gateway.new_array(getattr(options, "Options$Rename"), 0)
        context = options.FileContext.getFileContext(self._conf)
        try:
            context.rename(source, self._path(final), plain)
            return True
        except Exception:
            if path_exists(self._spark, final):
                return False
            raise
