"""Tables whose merges rewrite only the files they touch.

A table is a folder with data files that never change and a manifest for each version,
which names the version's files and schema. A write adds files and then its manifest, by
a rename that fails if the version is there already. So readers see the old version or
the new one, at any moment, a write that is cut off leaves the table as it was, and of two
writers that began at one version the second gets ``TableChanged`` and loses nothing.

A merge finds the files that hold rows it changes by ``_metadata.file_path``, from the key
columns alone; it reads and writes those, and the rows it adds. What the driver holds is
the list of the table's files, as Spark does for any table it reads.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimflow.functions.dates import open_end
from dimflow.operators import merge


class TableChanged(RuntimeError):
    """Another writer has published the next version."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    # -- versions ------------------------------------------------------------

    def versions(self) -> list[int]:
        """Numbers of the published versions, ascending."""
        folder = self._at("versions")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def version(self) -> int:
        """The newest version; 0 before the first write."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"files": [], "schema": StructType().jsonValue()}
        stream = self._fs.open(self._at(f"versions/{version:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or an older one that ``vacuum`` has left."""
        found = self.manifest(version)
        return self._rows(found["files"], StructType.fromJson(found["schema"]))

    def _rows(self, files: list[str], schema: StructType) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in files])

    def _add(self, df: DataFrame) -> list[str]:
        """Write rows as new files, one a partition; their names."""
        folder = f"data/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        names = [f.getPath().getName() for f in self._fs.listStatus(self._at(folder))]
        return [f"{folder}/{n}" for n in sorted(names) if n.endswith(".parquet")]

    def _publish(self, base: int, files: list[str], schema: StructType) -> int:
        made = self._at(f"versions/.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(made, False)
        out.write(bytearray(json.dumps({"files": files, "schema": schema.jsonValue()}).encode()))
        out.close()
        context = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        kind = getattr(self._hadoop, "Options$Rename")
        keep_other = self.spark.sparkContext._gateway.new_array(kind, 1)
        keep_other[0] = kind.NONE
        try:
            context.rename(made, self._at(f"versions/{base + 1:012d}.json"), keep_other)
        except Exception as e:
            self._fs.delete(made, False)
            if self.version() > base:
                raise TableChanged(f"{self.path} has gone on from version {base}") from e
            raise
        return base + 1

    # -- writes --------------------------------------------------------------

    def overwrite(self, df: DataFrame) -> int:
        base = self.version()
        return self._publish(base, self._add(df), df.schema)

    def append(self, df: DataFrame) -> int:
        base = self.version()
        if not base:
            return self.overwrite(df)
        old, new = merge.align_schema(self.read(base), df)
        touched = self._touched(base, old, lambda rows: rows.limit(0))
        return self._replace(base, old.schema, touched, lambda rows: rows.unionByName(new))

    def upsert(self, source: DataFrame, keys: list[str], *, check: bool = True, **how) -> int:
        """``merge_upsert`` into the table."""
        base = self.version()
        if not keys or not base:
            return self.append(source)
        if check:
            merge.require_unique(source, keys)
        target, aligned = merge.align_schema(self.read(base), source)
        touched = self._touched(base, target, lambda rows: rows.join(aligned.select(*keys), keys, "left_semi"))
        # A key of the table is in a touched file, so the other source rows are new.
        return self._replace(base, target.schema, touched, lambda old: merge.merge_upsert(old, aligned, keys, check=False, **how))

    def delete_insert(self, source: DataFrame, keys: list[str]) -> int:
        """``delete_insert`` into the table."""
        base = self.version()
        if not base:
            return self.append(source)
        target, aligned = merge.align_schema(self.read(base), source)
        touched = self._touched(base, target, lambda rows: rows.join(aligned.select(*keys), keys, "left_semi"))
        return self._replace(base, target.schema, touched, lambda old: merge.delete_insert(old, aligned, keys))

    def scd2(
        self,
        source: DataFrame,
        keys: list[str],
        *,
        hash_col: str = "dbt_hash",
        source_eff: str = "rpt_eff_dt",
        disc: str = "disc_dt",
        current: str = "is_current",
        check: bool = True,
    ) -> int:
        """``scd2_merge`` into the table; only files with a version that is closed are written again."""
        base = self.version()
        if check:
            merge.require_unique(source, keys)
        if not base:
            return self.append(source)
        target, aligned = merge.align_schema(self.read(base), source)
        arriving = aligned.select(*keys, F.col(hash_col).alias("__hash"))

        def closed(rows: DataFrame) -> DataFrame:
            return rows.filter(F.col(disc) == open_end()).join(arriving, keys).filter(F.col("__hash") != F.col(hash_col))

        how = dict(hash_col=hash_col, disc=disc)
        # Whether a version stands is asked of the whole table, but of few of its columns.
        added = merge.new_versions(target, aligned, keys, **how)
        return self._replace(
            base,
            target.schema,
            self._touched(base, target, closed),
            lambda old: merge.close_versions(old, aligned, keys, source_eff=source_eff, current=current, **how).unionByName(added),
        )

    def _touched(self, base: int, target: DataFrame, hits) -> list[str]:
        """Files with a row among the ``hits``; all files, where a column's type changes."""
        found = self.manifest(base)
        was = {f.name: f.dataType for f in StructType.fromJson(found["schema"])}
        if any(f.name in was and was[f.name] != f.dataType for f in target.schema):
            return found["files"]
        rows = self._rows(found["files"], target.schema)
        if not found["files"]:
            return []
        rows = rows.select("*", F.col("_metadata.file_path").alias("__file"))
        names = {"/".join(r[0].split("/")[-2:]) for r in hits(rows).select("__file").distinct().collect()}
        return [f for f in found["files"] if "/".join(f.split("/")[-2:]) in names]

    def _replace(self, base: int, schema: StructType, touched: list[str], change) -> int:
        """Publish the version in which ``touched`` files are replaced by what ``change`` makes of their rows."""
        found = self.manifest(base)
        gone = set(touched)
        # Old files are read in the types they were written in.
        old = self._rows(touched, StructType.fromJson(found["schema"]))
        old = old.select([(F.col(f.name) if f.name in old.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
        rows = change(old) if callable(change) else change
        kept = [f for f in found["files"] if f not in gone]
        # Files of the size that adaptive execution aims at.
        return self._publish(base, kept + self._add(rows.select(*schema.names).hint("rebalance")), schema)

    # -- clean-up ------------------------------------------------------------

    def vacuum(self, keep: int = 1) -> int:
        """Delete the files that none of the ``keep`` newest versions names; how many folders went.

        Not to be run while another writer or a reader of an older version is at work.
        """
        versions = self.versions()
        for version in versions[: max(0, len(versions) - keep)]:
            self._fs.delete(self._at(f"versions/{version:012d}.json"), False)
        used = {f for v in versions[-keep:] for f in self.manifest(v)["files"]} if versions else set()
        folders = {f.rsplit("/", 1)[0] for f in used}
        gone = 0
        if self._fs.exists(self._at("data")):
            for at in self._fs.listStatus(self._at("data")):
                name = f"data/{at.getPath().getName()}"
                if name not in folders:
                    gone += bool(self._fs.delete(at.getPath(), True))
                    continue
                for file in self._fs.listStatus(at.getPath()):
                    if file.getPath().getName().endswith(".parquet") and f"{name}/{file.getPath().getName()}" not in used:
                        self._fs.delete(file.getPath(), False)
        return gone
