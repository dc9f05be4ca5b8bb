"""What the operators share: scans, white space, digests."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.sources.tables import load

# The white space and word patterns of all operators.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


_SHIPPED: set[str] = set()


def with_workers(spark: SparkSession) -> SparkSession:
    """The session, once its Python workers can import this package wherever they run."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="roadweave-")) / "roadweave.zip"  # Spark hands it to the executors
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(with_workers(spark), sf_dir, "documents")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(with_workers(spark), sf_dir, "pages")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(with_workers(spark), sf_dir, "embeddings")


def text_of(column: str = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def pieces(rows: int, size: int) -> int:
    """How many pieces of about ``size`` rows; grows with the input."""
    return max(1, -(-rows // size))


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file on this machine; every worker has the same one."""
    import public_tokenizers

    return public_tokenizers.path(name)
