"""Helpers the operators share: reading, folds, and tables written to the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sluice.session import new_folder

#: Bytes that part words: space and the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """Remainder of crc32 over the id's decimal text: the fold a document is in."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def whole_text(text: Column) -> Column:
    """Null counts as empty."""
    return F.coalesce(text, F.lit(""))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


class Stage:
    """Tables written to the shared folder and read back.

    They cut lineage: a lost executor re-reads files instead of recomputing what came before.
    ``clear`` removes those that nothing reads any more; the last ones stay for the lazy result.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self._tables: list[tuple[DataFrame, str]] = []

    def write(self, df: DataFrame, narrow: bool = False) -> DataFrame:
        """``narrow``: rows of a few numbers; two files per core are enough for them."""
        path = new_folder(self.spark, self.name)
        written = df.coalesce(2 * self.spark.sparkContext.defaultParallelism) if narrow else df
        written.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._tables.append((out, path))
        return out

    def clear(self, *keep: DataFrame) -> None:
        """Remove all tables but those to keep."""
        kept = [(df, path) for df, path in self._tables if any(df is k for k in keep)]
        for df, path in self._tables:
            if not any(df is k for k in keep):
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self._tables = kept
