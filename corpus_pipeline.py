"""The corpus pipeline: quality, near copies, personal data, mixture, packing.

Each stage takes ``(spark, docs, sf_dir)``; what it returns is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelot.llm import mixing, nearcopies, packing, pii, quality, simhash
from tidelot.llm.common import saved, shared_path
from tidelot.llm.queries import LEAST_SCORE, table, tokenizer_path

#: No stage has an equal in SQL: the first is a trained model, the last is a tokenizer.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    A null text is judged as the empty text; very long texts are read whole; equal texts, repeated rows too, get one verdict, and
    each row is kept or goes by itself. An empty table stays empty; without labels the model scores every text alike.
    """
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.where(F.col("__quality_score") >= LEAST_SCORE).select(*docs.columns)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a unique row number, and the name of its column, which no column of ``docs`` has.

    They are written to the shared folder so that every reading sees the same numbers.
    """
    name = "__row"
    while name in docs.columns:
        name += "_"
    return saved(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def first_of_groups(rows: DataFrame, row: str, groups: DataFrame, columns: list[str]) -> DataFrame:
    """One row of each group of ``groups (row, root)``: the smallest id, a null id last; then by text and row number."""
    slim = rows.select(F.col(row).alias("row"), "doc_id", F.xxhash64("text").alias("digest")).join(groups, "row")
    first = slim.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id"), "doc_id", "digest", "row")).alias("least"))
    return rows.join(first.select(F.col("least.row").alias(row)), row, "left_semi").select(*columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies by op10's digest: three-word shingles, two bits. Rows as in :func:`drop_similar`."""
    rows, row = numbered(docs)
    groups = simhash.near_groups(rows, doc_id=row).select(F.col("doc_id").alias("row"), F.col("component_id").alias("root"))
    return first_of_groups(rows, row, groups, docs.columns)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: SimHash and five-word shingles with a Jaccard similarity of 0.8 or more.

    Rows count, not ids: rows with a null or shared id are apart unless their texts are near copies. Null, empty and
    blank texts are one group, of which one stays. Of equal rows one stays, whichever; very long texts are compared whole.
    """
    rows, row = numbered(docs)
    return first_of_groups(rows, row, nearcopies.near_groups(rows, row), docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes its kind in brackets; the number of characters follows.

    A null text stays as it is, texts without personal data are unchanged, equal texts are masked alike, and every row stays.
    """
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return clean.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    A null source is a source; null and empty texts have no words and are taken with the complete epochs of their source alone;
    repeated rows are taken one by one.
    """
    mixed = mixing.mix(mixing.sized(docs, docs.columns), docs.count())
    return mixed.where("__mix_copies > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies").cast("int")))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    A null or empty text is one piece of the closing token; longer documents than a sequence are cut; each of equal rows is packed.
    """
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", keep_quality), ("near-dedup", drop_similar), ("PII", mask_personal_data),
    ("mixing sources to target weights", mix_sources), ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = shared_path(spark, f"stage-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
