"""CSV feeds: text columns by header name, checked against the feed's contract."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart import schemas as S
from tallymart.functions.clock import as_timestamp
from tallymart.functions.parsing import na_to_null
from tallymart.session import stage

_RECORD = "_malformed_record"
# Beside the payload of records that may have line breaks: the place of the first line, and
# whether the record's quotes are never closed.
_LINE, _UNCLOSED = "_line", "_unclosed"
# A comma outside quotes: an even number of quotes follows it.
_SEPARATOR = r',(?=(?:[^"]*"[^"]*")*[^"]*\z)'


class FeedContractError(ValueError):
    """A feed has columns its table does not know."""


def read_csv(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False
) -> DataFrame:
    """All columns as text under the header's own names, plus the record text of odd rows.

    ``enforceSchema=False`` makes every file's header match, so files that order their
    columns differently fail instead of being read by position. ``multi_line`` allows line
    breaks inside quotes; files are read in splits all the same.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if multi_line:
        return _read_records(spark, paths)
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
    )
    header = reader.csv(paths).schema
    return (
        reader.schema(header.add(_RECORD, "string"))
        .option("columnNameOfCorruptRecord", _RECORD)
        .csv(paths)
    )


def _placed_lines(lines: DataFrame) -> DataFrame:
    """Lines ``(file, split, n, value, odd)`` with the line their record begins at, and whether
    that record is closed.

    A line begins inside quotes if an odd number of quotes stand before it in its file. Each
    split counts its own, XOR over the splits before gives how it begins; only this small table
    is ordered by file. Within a split the same is done line by line.
    """
    in_split = Window.partitionBy("file", "split").orderBy("n")
    earlier = in_split.rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file").orderBy("split")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "split").agg((F.sum("odd") % 2).alias("parity"))
    splits = splits.select("file", "split", (F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2).alias("open"))
    lines = lines.join(splits, ["file", "split"])
    lines = lines.withColumn("inside", (F.col("open") + F.coalesce(F.sum("odd").over(earlier), F.lit(0))) % 2)
    start = F.when(F.col("inside") == 0, F.col("n"))
    lines, _ = stage(lines.withColumn("own", F.last(start, ignorenulls=True).over(in_split)), "placed")
    last = lines.groupBy("file", "split").agg(F.max("own").alias("last"), F.max_by(F.col("inside") + F.col("odd"), "n").alias("ends"))
    last = last.select(
        "file", "split", F.last("last", ignorenulls=True).over(before).alias("carried"),
        F.max("last").over(Window.partitionBy("file")).alias("final"),
        (F.max_by("ends", "split").over(Window.partitionBy("file")) % 2).alias("unclosed"),
    )
    record = F.coalesce("own", "carried")
    return lines.join(last, ["file", "split"]).select(
        "file", "n", "value", ((F.col("inside") == 1) | (F.col("odd") == 1)).alias("several"), record.alias("record"),
        ((F.col("unclosed") == 1) & (record == F.col("final"))).alias(_UNCLOSED),
    )


def _read_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Records of CSV files whose quoted texts may hold line breaks, each file in many tasks.

    Lines are stored once, so that both passes see the same splits. Where no line has an odd
    number of quotes, every line is a record. Lines of a quote that is never closed stay apart.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("n"), "value",
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines, _ = stage(lines.withColumn("odd", quotes % 2), "lines")
    first = lines.filter("split = 0").groupBy("file").agg(F.min("n").alias("n"))
    header = F.regexp_replace("value", "^\ufeff|\r$", "")
    headers = [r[0] for r in lines.join(first, ["file", "n"]).select(header).distinct().limit(2).collect()]
    if len(headers) > 1:
        raise FeedContractError(f"files of one load differ in their columns: {headers}")
    if lines.filter("odd = 1").isEmpty():
        records = lines.select("file", "n", "value", F.lit(False).alias(_UNCLOSED))
    else:
        placed, _ = stage(_placed_lines(lines), "records")
        whole = placed.filter(~F.col("several") | F.col(_UNCLOSED)).select("file", "n", "value", _UNCLOSED)
        parts = F.transform(F.sort_array(F.collect_list(F.struct("n", "value"))), lambda x: x.value)
        joined = placed.filter(F.col("several") & ~F.col(_UNCLOSED)).groupBy("file", F.col("record").alias("n")).agg(
            F.array_join(parts, "\n").alias("value")
        )
        records = whole.unionByName(joined.withColumn(_UNCLOSED, F.lit(False)))
    records = records.join(first.withColumn("header", F.lit(True)), ["file", "n"], "left")
    records = records.filter("header IS NULL").withColumn("value", F.regexp_replace("value", "\r\\z", "")).filter("value <> ''")
    names = next(csv.reader(headers), []) if headers else []
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in (*names, _RECORD))
    parsed = F.from_csv("value", schema, {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RECORD})
    row = F.when(~F.col(_UNCLOSED), parsed).alias("row")
    fields = [F.col(f"row.`{c.replace('`', '``')}`").alias(c) for c in names]
    return records.select("value", row, F.col("n").alias(_LINE), _UNCLOSED, F.struct(F.col("file").alias("file_path")).alias("_metadata")).select(
        *fields, F.when(F.col(_UNCLOSED), F.col("value")).otherwise(F.col(f"row.{_RECORD}")).alias(_RECORD), _LINE, _UNCLOSED, "_metadata"
    )


def payload_columns(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c not in (_RECORD, _LINE, _UNCLOSED, "_metadata")]


def unknown_columns(raw: DataFrame, feed: str) -> list[str]:
    return [c for c in payload_columns(raw) if c not in S.FEED_COLUMNS[feed]]


def has_extra_fields(raw: DataFrame) -> Column:
    """True for records with more fields than the header, and for lines of a quote that is never
    closed; shorter records are filled with NULL."""
    fields = F.size(F.split(F.col(_RECORD), _SEPARATOR))
    extra = F.when(F.col(_RECORD).isNull(), F.lit(False)).otherwise(
        fields > len(payload_columns(raw))
    )
    return extra | F.col(_UNCLOSED) if _UNCLOSED in raw.columns else extra


def has_open_quote(raw: DataFrame) -> Column:
    """True for odd records with an odd number of quotes: a piece of a quoted text that has a
    line break. Of the pieces of a record at least one is such a record."""
    quotes = F.length(_RECORD) - F.length(F.replace(F.col(_RECORD), F.lit('"')))
    return F.coalesce(quotes % 2 == 1, F.lit(False))


def to_bronze(raw: DataFrame, feed: str, batch_id: str, as_of=None) -> DataFrame:
    """Contract columns (missing ones NULL), NA tokens as NULL, provenance and defaults.

    ``_id`` is unique within its batch and is frozen when the batch is written.
    """
    extra = unknown_columns(raw, feed)
    if extra:
        raise FeedContractError(f"{feed}: unknown columns {extra}")
    payload = [
        (na_to_null(F.col(f"`{c}`")) if c in raw.columns else F.lit(None).cast("string")).alias(c)
        for c in S.FEED_COLUMNS[feed]
    ]
    flags = [
        F.lit(False).alias("_is_quarantined"),
        F.lit(None).cast("string").alias("_quarantine_reason"),
    ]
    return raw.select(
        (F.col(_LINE) if _LINE in raw.columns else F.monotonically_increasing_id()).alias("_id"),
        as_timestamp(as_of).alias("_ingested_at"),
        F.col("_metadata.file_path").alias("_source_file"),
        *([] if feed == "raw_stores" else flags),
        *payload,
        F.lit(batch_id).alias("_batch_id"),
    )


def rejected_records(
    raw: DataFrame, feed: str, batch_id: str, reason: str, as_of=None
) -> DataFrame:
    """Whole records as JSON text with the reason they were not loaded."""
    fields = [F.col(f"`{c}`") for c in payload_columns(raw)]
    return raw.select(
        F.lit(feed).alias("source_table"),
        F.col("_metadata.file_path").alias("_source_file"),
        as_timestamp(as_of).alias("_rejected_at"),
        F.lit(reason).alias("_quarantine_reason"),
        F.coalesce(F.col(_RECORD), F.to_json(F.struct(*fields))).alias("record"),
        F.lit(batch_id).alias("_batch_id"),
    )
