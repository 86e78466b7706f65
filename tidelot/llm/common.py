"""What several training-data operators share: the shared folder, words, and span digests."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tidelot
from tidelot.sources.fs import write_bytes

#: White space that ends a word: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; where that is unset (tests), one of the session's own is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = tempfile.mkdtemp(prefix="tidelot-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for a Spark context; executors need no copy of their own."""
    context = spark.sparkContext
    if getattr(context, "_tidelot_shipped", False):
        return
    root = Path(tidelot.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    path = f"{shared_path(spark, 'code')}/tidelot.zip"
    write_bytes(spark, path, packed.getvalue())
    context.addPyFile(path)
    context._tidelot_shipped = True


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several jobs read to the shared folder and read it back, which also cuts its lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """The text; null is the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def word_list(text: Column) -> Column:
    """Words of a text as an array, in order."""
    return F.array_remove(F.split(text, BLANKS), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % folds


def one_label(labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """One 0/1 label per id, ``(key, label)``: the majority of its rows, a tie counts as 1; null ids and labels are left out."""
    return (
        labels.select(F.col(doc_id).alias("key"), F.col(label).cast("double").alias("label")).dropna()
        .groupBy("key").agg((F.avg("label") >= 0.5).cast("double").alias("label"))
    )


def label_sample(labels: DataFrame, label: str, rows: int, doc_id: str = "doc_id", allowed: Column | None = None) -> DataFrame:
    """:func:`one_label` of about ``rows`` ids at most, picked by a hash of the id; small enough to broadcast.

    ``allowed`` is a condition on the id column ``key``.
    """
    known = one_label(labels, label, doc_id)
    known = saved(known if allowed is None else known.where(allowed), f"labels-{label}")
    slots = 1 << 30
    kept = min(slots, max(1, slots * rows // max(1, known.count())))
    return F.broadcast(known.where(F.pmod(F.xxhash64("key"), F.lit(slots)) < kept))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
