"""The cleaning pipeline over ``documents``: every stage reads what the one before it wrote.

Decisions are found on narrow tables and reach the texts by a join on the document's key:
the decided keys are broadcast as long as they are few, else both sides are shuffled. The
key is doc_id if it names one text. For texts that share a doc_id it is a number from doc_id
and text, so that each is decided by itself, and for a document without one a number from its
text, so that equal texts without an id are decided alike. Columns other than the tables' own
are carried along.

==========  ===================================================================
toxicity    documents scored toxic go (model learned from ``labels``)
near_dedup  one document of each group of near-duplicates stays (five-word
            shingles, similarity 0.8), one whose doc_id is its own before others; of
            rows equal in doc_id and text one stays, different texts stay all
decontam    documents of which a twentieth or more is benchmark text go
mixture     documents stay as often as their source's target asks: 0 to 2 times
sharding    ``(doc_id, size, text_crc32, shard, slot)`` of every row
==========  ===================================================================
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import decontaminate, mixture, near_dedup, sharding, toxicity
from tallymart.session import stage

BROADCAST_KEYS = 2_000_000
SHARDS = 8

# SQL can't fit or apply the classifier; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def _free(docs: DataFrame, name: str) -> str:
    """``name``, or one like it that is no column of ``docs``."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def _columns(docs: DataFrame) -> list:
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key column, and its name."""
    key, mark = _free(docs, "_key"), _free(docs, "_shared")
    low = (1 << 61) - 1
    text = F.coalesce("text", F.lit(""))
    named = docs.filter("doc_id IS NOT NULL").select("doc_id", F.xxhash64(text).alias("digest"))
    named = named.groupBy("doc_id").agg(F.min("digest").alias("least"), F.max("digest").alias("most"))
    shared, n = stage(named.filter("least <> most").select("doc_id", F.lit(True).alias(mark)), "shared")
    of_text = F.xxhash64(text).bitwiseAND(low) + (low + 1)
    own = F.coalesce(F.col("doc_id").cast("long"), of_text)
    if not n:
        return docs.withColumn(key, own), key
    of_both = F.xxhash64(F.col("doc_id"), text).bitwiseAND(low) + (low + 1)
    marked = docs.join(_small(shared, n), "doc_id", "left")
    return marked.select(*_columns(docs), F.when(F.col(mark), of_both).otherwise(own).alias(key)), key


def _narrow(keyed: DataFrame, key: str, *columns: str) -> DataFrame:
    return keyed.select(F.col(key).alias("doc_id"), "text", *columns)


def _small(table: DataFrame, n: int) -> DataFrame:
    return F.broadcast(table) if n <= BROADCAST_KEYS else table


def _without(keyed: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    gone, n = stage(gone.select(F.col("doc_id").alias(key)).distinct(), "gone")
    return keyed.join(_small(gone, n), key, "left_anti")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = _free(docs, "toxicity")  # a column of that name keeps its values
    scored = toxicity.score(docs.withColumnRenamed("toxicity", held), model)
    kept = scored.filter(F.col("toxicity") < toxicity.THRESHOLD).drop("toxicity")
    return kept.withColumnRenamed(held, "toxicity").select(*_columns(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed, key = _keyed(docs)
    found = near_dedup.near_duplicates(_narrow(keyed, key), width=5, percent=80)
    kept = _without(keyed, key, found.filter("NOT kept"))
    again, n = stage(keyed.groupBy(key).count().filter("count > 1").select(key), "again")
    if not n:
        return kept.select(*_columns(docs))
    once = kept.join(_small(again, n), key, "left_anti")
    rest = F.to_json(F.struct(*(c for c, name in zip(_columns(docs), docs.columns, strict=True) if name != "text"), F.lit(0)))
    first = kept.join(_small(again, n), key, "left_semi").groupBy(key)
    first = first.agg(F.min_by(F.struct(*_columns(docs)), F.struct(F.xxhash64("text"), rest)).alias("first"))
    return once.select(*_columns(docs)).union(first.select("first.*"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed, key = _keyed(docs)
    index = decontaminate.positional_index(_narrow(keyed, key))
    found = decontaminate.contamination(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(keyed, key, found.filter(decontaminate.is_contaminated())).select(*_columns(docs))


def mixture_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed, key = _keyed(docs)
    mixed = mixture.mix(_narrow(keyed, key, "source")).filter("copies > 0")
    # Equal rows were merged before; should any be left, each gets the most copies.
    copies, n = stage(mixed.groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").cast("int").alias("copies")), "copies")
    number = _free(keyed, "_copies")
    rows = keyed.join(_small(copies.select(key, F.col("copies").alias(number)), n), key)
    return rows.select(*_columns(docs), F.explode(F.sequence(F.lit(1), number)).alias(_free(docs, "_copy"))).select(*_columns(docs))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.assign(docs, SHARDS).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixture", mixture_stage),
    ("sharding", sharding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs, _ = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
