"""Shared helpers: table access, written stages, text folding."""

from __future__ import annotations

import re
import tempfile
import unicodedata
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table ``name`` below ``sf_dir`` (a file or a folder)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder stage tables go to: the one that ``spark.checkpoint.dir`` names.

    Where it is unset, a folder of this machine serves a local session; a cluster
    without one is refused, as executors would not find each other's files.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quillmesh-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


class Stages:
    """Tables written to the shared folder by one operator.

    A written table cuts the lineage: a lost executor costs a re-read, and later
    plans read only the columns they need.  :meth:`clear` removes the tables that
    nothing refers to any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.made = spark, f"{shared_folder(spark)}/quillmesh-{uuid.uuid4().hex}", 0

    def cut(self, df: DataFrame) -> DataFrame:
        """``df`` as a written table."""
        self.made += 1
        path = f"{self.root}/{self.made}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._stage_path = path
        return out

    def drop(self, df: DataFrame | None) -> None:
        """Remove one table of :meth:`cut`."""
        if df is not None and hasattr(df, "_stage_path"):
            _delete(self.spark, df._stage_path)

    def clear(self, keep: DataFrame | None = None) -> None:
        """Remove all tables but ``keep``, which the caller still reads."""
        for k in range(1, self.made + 1):
            if keep is None or getattr(keep, "_stage_path", None) != f"{self.root}/{k}":
                _delete(self.spark, f"{self.root}/{k}")


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a written table of its own."""
    return Stages(df.sparkSession).cut(df)


def fold(text: str) -> str:
    """Lower case without accents; ligatures and stroked letters spelt out."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", _LIGATURE.sub(lambda m: _SPELT[m.group()], text.casefold()))
    return _COMBINING.sub("", text)


# Letters that Unicode decomposition leaves whole (fixed values).
_SPELT = {"ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "æ": "ae", "œ": "oe", "ı": "i"}
_LIGATURE = re.compile("[" + "".join(_SPELT) + "]")
_COMBINING = re.compile("[̀-ͯ᪰-᫿᷀-᷿⃐-⃿︠-︯]+")


def blank(c: Column) -> Column:
    """True for null and for values of nothing but white space."""
    return ~F.coalesce(c.rlike(r"[^\s\p{Z}]"), F.lit(False))
