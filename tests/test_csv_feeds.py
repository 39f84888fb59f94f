"""CSV reading: names, NA tokens, quotes, odd records and mixed headers."""

from __future__ import annotations

import csv
import io
import random

import pytest

from tallymart import schemas as S
from tallymart.plans import medallion
from tallymart.sources import csv_feeds
from tallymart.sources.tables import LayerStore

AS_OF = "2024-02-01 00:00:00"


def load(spark, tmp_path, feed, *texts, **kw):
    paths = []
    for i, text in enumerate(texts):
        path = tmp_path / f"{feed}-{i}.csv"
        path.write_text(text)
        paths.append(str(path))
    store = LayerStore(spark, str(tmp_path / "lake"))
    loaded = medallion.ingest_feed(store, feed, paths, "b1", AS_OF, **kw)
    return loaded, store.read(f"bronze/{feed}"), store.read("quarantine/rejected_records")


def test_columns_by_name_missing_ones_null(spark, tmp_path):
    text = "store_name,store_id\nNorth,1\nSouth,2\n"
    loaded, bronze, _ = load(spark, tmp_path, "raw_stores", text)
    assert loaded == 2
    assert {(r.store_id, r.store_name, r.city) for r in bronze.collect()} == {
        ("1", "North", None), ("2", "South", None),
    }
    assert bronze.columns[:3] == ["_id", "_ingested_at", "_source_file"]


def test_na_tokens_and_quotes(spark, tmp_path):
    names = [f'"{t}"' for t in S.NA_TOKENS] + ['"a ""b"", c"', " NA ", "Null"]
    text = "store_id,store_name\n" + "".join(f"{i},{n}\n" for i, n in enumerate(names))
    _, bronze, _ = load(spark, tmp_path, "raw_stores", text)
    got = {int(r.store_id): r.store_name for r in bronze.collect()}
    assert all(got[i] is None for i in range(len(S.NA_TOKENS)))
    assert [got[i] for i in range(len(S.NA_TOKENS), len(names))] == ['a "b", c', " NA ", "Null"]


def test_short_records_are_filled_and_long_ones_set_aside(spark, tmp_path):
    text = 'store_id,store_name,city\n1,North\n2,South,Rome,extra\n3,"East, far",Lund\n4,W,\n'
    loaded, bronze, rejects = load(spark, tmp_path, "raw_stores", text)
    assert loaded == 3
    assert {(r.store_id, r.store_name, r.city) for r in bronze.collect()} == {
        ("1", "North", None), ("3", "East, far", "Lund"), ("4", "W", None),
    }
    assert [(r.record, r.source_table) for r in rejects.collect()] == [
        ("2,South,Rome,extra", "raw_stores")
    ]


def test_flags_default_and_ids_are_unique(spark, tmp_path):
    header = ",".join(S.FEED_COLUMNS["raw_inventory"])
    part = header + "\n" + "1,2,3,4,2024-01-01,5\n" * 50
    loaded, bronze, _ = load(spark, tmp_path, "raw_inventory", part, part)
    assert loaded == bronze.select("_id").distinct().count() == 100
    flags = bronze.select("_is_quarantined", "_quarantine_reason", "_ingested_at").distinct()
    assert [(r[0], r[1], str(r[2])) for r in flags.collect()] == [(False, None, AS_OF)]
    assert bronze.select("_source_file").distinct().count() == 2


def test_files_with_other_column_order_fail(spark, tmp_path):
    with pytest.raises(Exception, match="header"):
        load(
            spark, tmp_path, "raw_stores",
            "store_id,store_name\n1,North\n", "store_name,store_id\nSouth,2\n",
        )


def test_line_breaks_inside_quotes(spark, tmp_path):
    text = 'store_id,store_name\n1,"North\nEnd"\n'
    loaded, bronze, _ = load(spark, tmp_path, "raw_stores", text, multi_line=True)
    assert loaded == 1 and bronze.first().store_name == "North\nEnd"


def test_names_differ_in_case_are_unknown(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("Store_ID,store_name\n1,North\n")
    raw = csv_feeds.read_csv(spark, str(path))
    assert csv_feeds.unknown_columns(raw, "raw_stores") == ["Store_ID"]


# --- quoted line breaks over splits ------------------------------------------


def by_python(text: str) -> list[tuple]:
    """Records by Python's own reader, without the header and empty lines."""
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r]
    return [tuple(x or None for x in r) for r in rows[1:]]


@pytest.mark.parametrize("split", ["64", "500", "1000000"])
def test_records_over_splits_equal_a_plain_reader(spark, tmp_path, split):
    rng = random.Random(int(split))
    words = ["a", "b c", "", 'say ""x""', "line\nbreak", "two\n\nbreaks", "comma, in", "é", "r\r\nn", "\n", "x" * 90]
    rows = ["store_id,store_name,city"]
    for i in range(400):
        fields = [f'"{w}"' if set(w) & set(',"\n\r') else w for w in (rng.choice(words), rng.choice(words))]
        rows.append(",".join([str(i), *fields]))
    paths = []
    for name, some in (("one", rows), ("two", rows[:1] + rows[50:90]), ("no", rows[:1])):
        path = tmp_path / f"{name}.csv"
        path.write_bytes(("\n".join(some) + "\n").encode())
        paths.append(str(path))
    keys = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        raw = csv_feeds.read_csv(spark, paths, multi_line=True)
        got = raw.select("store_id", "store_name", "city", csv_feeds._LINE, "_metadata.file_path").collect()
        tasks = spark.read.option("lineSep", "\n").text(paths).rdd.getNumPartitions()
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert tasks > (100 if split == "64" else 20 if split == "500" else 0)
    want = [r for some in (rows, rows[:1] + rows[50:90]) for r in by_python("\n".join(some) + "\n")]
    clean = lambda r: tuple(None if x in (None, "") else x for x in r)
    assert sorted(clean(r[:3]) for r in got) == sorted(map(clean, want))
    assert len({r[3] for r in got}) == len(got)
    in_file = [r[0] for r in sorted(got, key=lambda r: r[3]) if r[4].endswith("one.csv")]
    assert sorted(in_file, key=int) == [str(i) for i in range(400)]


def test_a_quote_that_is_never_closed_sets_its_lines_aside(spark, tmp_path):
    text = 'store_id,store_name\n1,"North\nEnd"\n2,South\n3,"Open\n4,Lost\n5,Lost too\n'
    path = tmp_path / "s.csv"
    path.write_text(text)
    raw = csv_feeds.read_csv(spark, str(path), multi_line=True)
    extra = csv_feeds.has_extra_fields(raw)
    assert sorted(r.store_name for r in raw.filter(~extra).collect()) == ["North\nEnd", "South"]
    assert [r[0] for r in raw.filter(extra).select(csv_feeds._RECORD).collect()] == ['3,"Open', "4,Lost", "5,Lost too"]


def test_headers_of_one_load_must_agree_with_line_breaks_too(spark, tmp_path):
    for name, text in (("a", "store_id,store_name\n1,x\n"), ("b", "store_name,store_id\ny,2\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    with pytest.raises(csv_feeds.FeedContractError, match="differ"):
        csv_feeds.read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], multi_line=True)
