"""Versioned evidence tables behind one alias: build, grade, promote, prune."""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class PromotedMeanwhile(RuntimeError):
    """Another writer took this step of the promotion log first."""


class EvidenceIndex:
    """Chunk tables under `root`, one partition folder per version, and a promotion log.

    A version is written whole before it can be promoted, and a reader resolves the alias
    to one version first, so nothing half-built is ever served.
    """

    def __init__(self, spark: SparkSession, root: str, alias: str = "corpus") -> None:
        self.spark, self.root, self.alias = spark, root, alias

    def _table(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def build(self, corpus: DataFrame, stamp: str | None = None) -> str:
        stamp = stamp or datetime.now(UTC).strftime("%Y%m%d-%H%M%S")
        version = f"{self.alias}-{stamp}"
        corpus.write.mode("errorifexists").parquet(
            f"{self.root}/versions/index_version={version}")
        return version

    def versions(self) -> DataFrame:
        """(index_version), read from the partition column alone."""
        table = self._table("versions")
        if table is None:
            return self.spark.createDataFrame([], "index_version string")
        return table.select("index_version").distinct()

    def _log(self) -> DataFrame | None:
        """(alias, index_version, number) of all promotions."""
        try:
            return self.spark.read.schema("alias string, index_version string, number long").json(f"{self.root}/promotions")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def current(self) -> str | None:
        log = self._log()
        if log is None:
            return None
        row = log.where(F.col("alias") == self.alias).agg(
            F.max_by("index_version", "number").alias("v")).first()
        return row["v"]

    def promote(self, version: str) -> str | None:
        """Points the alias at `version`; returns what it pointed at before.

        Each promotion is a file of its own, named by its step. It is written under another name and
        then given its own, which the file system does at once and only if nobody has it: of two
        writers that read the same log exactly one wins, and the other gets PromotedMeanwhile.
        """
        if not self.versions().where(F.col("index_version") == version).limit(1).count():
            raise ValueError(f"No version {version} to promote")
        number = self._next_number()
        previous = self.current()
        self._claim(number, version)
        return previous

    def _next_number(self) -> int:
        log = self._log()
        last = None if log is None else log.agg(F.max("number")).first()[0]
        return 0 if last is None else last + 1

    def _claim(self, number: int, version: str) -> None:
        jvm = self.spark._jvm
        fs_of = jvm.org.apache.hadoop.fs
        folder = f"{self.root}/promotions"
        made, own = (fs_of.Path(f"{folder}/{n}") for n in (f".{uuid.uuid4().hex}", f"step-{number:012d}.json"))
        conf = self.spark._jsc.hadoopConfiguration()
        fs = made.getFileSystem(conf)
        out = fs.create(made, False)
        out.write(bytearray(json.dumps({"alias": self.alias, "index_version": version, "number": number}).encode()))
        out.close()
        try:
            if fs.getScheme() == "file":  # its rename replaces; a link doesn't
                at = [jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri()) for p in (own, made)]
                jvm.java.nio.file.Files.createLink(*at)
            else:
                kept = self.spark.sparkContext._gateway.new_array(getattr(fs_of, "Options$Rename"), 1)
                kept[0] = getattr(fs_of, "Options$Rename").NONE
                fs_of.FileContext.getFileContext(made.toUri(), conf).rename(made, own, kept)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                raise PromotedMeanwhile(f"Step {number} of {self.alias} is taken") from error
            raise
        finally:
            fs.delete(made, False)

    def build_and_promote(self, corpus: DataFrame, gates, stamp: str | None = None) -> str | None:
        """Promotes the new version only if every gate passes on what was written."""
        version = self.build(corpus, stamp)
        failed = gates(self.read(version)).where(~F.col("passed")).limit(1).count()
        if failed:
            return None
        self.promote(version)
        return version

    def read(self, version: str | None = None) -> DataFrame:
        version = version or self.current()
        if version is None:
            raise ValueError(f"No version of {self.alias} is promoted")
        return self._table("versions").where(F.col("index_version") == version).drop(
            "index_version")

    def removable(self, keep: int = 2) -> DataFrame:
        """Oldest versions beyond the newest `keep`, the live one never among them."""
        return removable(self.versions(), self.current(), keep)

    def prune(self, keep: int = 2) -> list[str]:
        names = [r[0] for r in self.removable(keep).orderBy("index_version").collect()]
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for name in names:
            path = hadoop.Path(f"{self.root}/versions/index_version={name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return names


def removable(versions: DataFrame, live: str | None, keep: int) -> DataFrame:
    """Of a small table of version names (a name sorts by time), those to delete."""
    surplus = F.greatest(F.count("*").over(Window.partitionBy()) - keep, F.lit(0))
    counted = versions.withColumn("surplus", surplus).where(
        ~F.col("index_version").eqNullSafe(F.lit(live)))
    place = F.row_number().over(Window.partitionBy().orderBy("index_version"))
    return counted.withColumn("place", place).where(
        F.col("place") <= F.col("surplus")).select("index_version")
