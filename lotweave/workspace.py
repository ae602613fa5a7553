"""Where staging layers and application tables live.

Staging layers are Parquet folders per state and layer. Application tables are
numbered snapshots: a refresh writes the next number, readers use the highest
finished one, so a lost executor or a failed job never damages a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotweave.session import durable
from lotweave.sources.export import Contract, violations


class Workspace:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def staging_path(self, state: str, layer: str) -> str:
        return f"{self.root}/staging/{layer}/state={state}"

    def staging(self, state: str, layer: str) -> DataFrame:
        return self.spark.read.parquet(self.staging_path(state, layer))

    def has_staging(self, state: str, layer: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.staging_path(state, layer))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def write_staging(self, df: DataFrame, state: str, layer: str, mode: str = "error") -> None:
        """``error`` when the layer exists, ``overwrite`` or ``append`` on request."""
        df.write.mode(mode).option("compression", "zstd").parquet(self.staging_path(state, layer))

    def write_pages(self, df: DataFrame, state: str, layer: str, mode: str = "error") -> None:
        """A staging layer in one folder for each value of ``_page``."""
        df.write.mode(mode).partitionBy("_page").option("compression", "zstd").parquet(self.staging_path(state, layer))

    def replace_pages(self, df: DataFrame, state: str, layer: str, pages: list[int]) -> None:
        """Put ``df`` in the place of the named pages; files of other pages are not touched.

        Pages that have rows are replaced by one commit; those left without rows go afterwards.
        """
        path = self.staging_path(state, layer)
        rows = durable(df.where(F.col("_page").isin(pages)))
        held = {r[0] for r in rows.select("_page").distinct().collect()}  # some of ``pages``
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_page").option("compression", "zstd").parquet(path)
        jvm = self.spark._jvm
        for page in sorted(set(pages) - held):
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/_page={page}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)

    def _finished(self, table: str) -> list[int]:
        jvm = self.spark._jvm
        base = jvm.org.apache.hadoop.fs.Path(f"{self.root}/app/{table}")
        files = base.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(base):
            return []
        folders = [s.getPath() for s in files.listStatus(base)]
        done = [p for p in folders if files.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().split("=")[1]) for p in done)

    def app_table(self, table: str) -> DataFrame | None:
        """Current snapshot, or None before the first build."""
        numbers = self._finished(table)
        if not numbers:
            return None
        return self.spark.read.parquet(f"{self.root}/app/{table}/snapshot={numbers[-1]}")

    def write_app_table(self, df: DataFrame, table: str, key: list[str], contract: Contract | None = None) -> str:
        """Write the next snapshot with a surrogate id derived from the natural key.

        A snapshot that breaks its contract loses its success mark, so that no
        reader takes it, and the broken rules are raised.
        """
        number = (self._finished(table) or [0])[-1] + 1
        path = f"{self.root}/app/{table}/snapshot={number}"
        columns = [c for c in df.columns if c != "id"]
        rows = df.select(F.xxhash64(*key).alias("id"), *columns)
        rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
        if contract is not None:
            broken = violations(self.spark.read.parquet(path), contract).where("violations > 0").collect()
            if broken:
                mark = self.spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
                mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(mark, False)
                raise ValueError(f"{table}: " + ", ".join(f"{r.rule} {r.column}: {r.violations} rows" for r in broken))
        return path
