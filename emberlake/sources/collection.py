"""One collection of climate documents for loads, streams and queries.

The collection is a folder of Parquet documents (``schema.DOCUMENT``) and a
log of manifests.  A manifest lists the committed folders with a key each; a reader takes
the newest manifest and reads those folders only, so it sees whole commits, and a
load or micro-batch that fails before its commit leaves no trace.

* ``reload`` swaps all documents for new ones (a full overwrite, S9).
* ``append`` adds a folder under a key, or replaces the folder of that key: a retried or
  completed batch takes the place of what it had written.
* A manifest is renamed into place without overwriting, so of two writers one
  starts again on the other's manifest.
* ``compact`` rewrites the documents of all keys with a prefix as one folder;
  ``vacuum`` deletes folders that only old manifests list.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from emberlake import schema as S


class DocumentCollection:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _fs(self):
        return self._path("log").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """The numbers of the committed manifests, ascending."""
        fs, log = self._fs(), self._path("log")
        if not fs.exists(log):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(log)]
        return sorted(int(n[:-len(".json")]) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, version: int | None = None) -> dict[str, str]:
        """Folder by key, of one version or the newest."""
        if version is None:
            version = max(self.versions(), default=None)
        if version is None:
            return {}
        stream = self._fs().open(self._path(f"log/{version:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The documents of a committed version (default: the newest)."""
        folders = sorted(set(self.manifest(version).values()))
        if not folders:
            return self.spark.createDataFrame([], S.DOCUMENT)
        return self.spark.read.schema(S.DOCUMENT).parquet(*[f"{self.path}/{f}" for f in folders])

    def _write(self, docs: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        # A local sort (no shuffle) gives every row group a narrow date range.
        (docs.select(*S.DOCUMENT.names).sortWithinPartitions("date", "doc_id", "part")
             .write.mode("errorifexists").parquet(f"{self.path}/{folder}"))
        return folder

    def _commit(self, change) -> int:
        """Write the next manifest, ``change`` of the newest one; again on
        the manifest of another writer that was faster."""
        jvm, fs = self.spark._jvm, self._fs()
        fs.mkdirs(self._path("log"))
        no_overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        no_overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.makeQualified(self._path("log")).toUri(), self.spark._jsc.hadoopConfiguration())
        while True:
            newest = max(self.versions(), default=0)
            new = change(self.manifest(newest) if newest else {})
            draft, final = self._path(f"log/.{uuid.uuid4().hex}"), self._path(f"log/{newest + 1:012d}.json")
            out = fs.create(draft, False)
            out.write(bytearray(json.dumps(new, sort_keys=True).encode("utf-8")))
            out.close()
            if not fs.exists(final):
                try:
                    files.rename(fs.makeQualified(draft), fs.makeQualified(final), no_overwrite)
                    return newest + 1
                except Exception:
                    if not fs.exists(final):  # not a lost race
                        raise
            fs.delete(draft, False)

    def reload(self, docs: DataFrame, key: str = "historic") -> int:
        folder = self._write(docs)
        return self._commit(lambda old: {key: folder})

    def append(self, docs: DataFrame, key: str) -> int:
        folder = self._write(docs)
        return self._commit(lambda old: {**old, key: folder})

    def append_each(self, docs: DataFrame, column: str, prefix: str) -> int:
        """One commit that adds or replaces ``prefix/<value>`` for each value
        of ``column`` (the batches of a micro-batch).  A part of a value lies in
        one file: its size is bounded, and a file for each task and value makes many small ones."""
        folder = f"data/{uuid.uuid4().hex}"
        docs.select(column, *S.DOCUMENT.names).repartition(column, "part").write.mode("errorifexists").partitionBy(column).parquet(f"{self.path}/{folder}")
        parts = [f.getPath().getName() for f in self._fs().listStatus(self._path(folder))]
        new = {f"{prefix}/{p.split('=', 1)[1]}": f"{folder}/{p}" for p in parts if p.startswith(f"{column}=")}
        return self._commit(lambda old: {**old, **new})

    def compact(self, prefix: str) -> int:
        """The folders of all keys below ``prefix`` rewritten as one under
        ``prefix``.  Keys that a stream may still replace must not be compacted;
        ones that change meanwhile stay as they are and the commit is given up."""
        old = {k: v for k, v in self.manifest().items() if k == prefix or k.startswith(f"{prefix}/")}
        folder = self._write(self.spark.read.schema(S.DOCUMENT).parquet(*[f"{self.path}/{f}" for f in sorted(set(old.values()))]))

        def swap(now: dict[str, str]) -> dict[str, str]:
            if any(now.get(k) != v for k, v in old.items()):
                raise RuntimeError(f"documents below {prefix} changed while they were compacted")
            return {**{k: v for k, v in now.items() if k not in old}, prefix: folder}

        return self._commit(swap)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete the manifests below the newest ``keep`` and the folders that
        only those list; folders of writers at work are in no manifest and stay."""
        versions = self.versions()
        old, kept = versions[:-keep], versions[-keep:]
        used = {f for v in kept for f in self.manifest(v).values()}
        gone = sorted({f for v in old for f in self.manifest(v).values()} - used)
        fs = self._fs()
        for f in gone:
            fs.delete(self._path(f), True)
        for v in old:
            fs.delete(self._path(f"log/{v:012d}.json"), False)
        return gone


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Stored documents: a collection's newest version, or a plain folder."""
    collection = DocumentCollection(spark, path)
    return collection.read() if collection.versions() else spark.read.parquet(path)
