import gzip
import hashlib
import io
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.operators import contract
from quern.sources import csv, ingest, literal, tables
from test_contract import FOUR, SCHEMA, changed


def write(path, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "a.csv"), "w") as file:
        file.write(text)
    return str(path)


def test_broken_lines_are_kept_apart(spark, tmp_path):
    path = write(tmp_path / "t", "id,v,w\n1,2.5,a\n2,bad,b\n3,1.0,c,extra\n4,,d\n")
    schema = spark.createDataFrame([], "id int, v double, w string").schema
    good, bad = csv.scan_csv_tolerant(spark, path, schema)
    assert rows(good.select("id")) == [(1,), (4,)]
    assert rows(good.select("w")) == [("a",), ("d",)]
    assert bad.count() == 2


def test_typed_scan(spark, tmp_path):
    path = write(tmp_path / "t", "id,v\n1,2.5\n2,NaN\n")
    df = csv.scan_csv_typed(spark, path, "id int, v double", ["v"])
    assert rows(df) == [(2.5,), (None,)]
    assert rows(csv.scan_csv_typed(spark, path, "v double, id int"), "id", "v") == [(1, 2.5), (2, None)]
    assert dict(csv.scan_csv_inferred(spark, path).dtypes) == {"id": "int", "v": "double"}


def test_typed_scan_follows_each_header(spark, tmp_path):
    path = write(tmp_path / "t", "b,a,x\n1,2,3\n")
    (tmp_path / "t" / "c.csv").write_text("a,b\n5,6\n*,7\n")
    df = csv.scan_csv_typed(spark, path, "a int, b int")
    assert rows(df, "a", "b") == sorted([(2, 1), (5, 6), (None, 7)], key=str)
    with pytest.raises(ValueError, match="lacks"):
        csv.scan_csv_typed(spark, path, "a int, x int")


def test_years_are_matched_by_header(spark, tmp_path):
    paths = {
        2019: write(tmp_path / "y1", "id,amount\n1,10\n"),
        2020: write(tmp_path / "y2", "amount,other,id\n20,x,2\n*,x,3\n"),
    }
    df = csv.scan_csv_yearly_union(spark, paths, {"id": "int", "amount": "double"})
    assert rows(df, "id", "amount", "year") == [(1, 10.0, 2019), (2, 20.0, 2020), (3, None, 2020)]
    with pytest.raises(ValueError, match="lacks"):
        csv.scan_csv_yearly_union(spark, paths, {"id": "int", "other": "string"})


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    folder = tmp_path / "many files"
    folder.mkdir()
    for i in range(60):
        (folder / f"part {i}.csv").write_text("id,v\n" + f"{i},1\n" if i % 2 else "v,id\n" + f"2,{i}\n")
    (folder / "empty.csv").write_text("")
    (folder / "blank.csv").write_text("\n  \n")
    with gzip.open(folder / "packed.csv.gz", "wt") as file:
        file.write("id,v\n60,3\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    df = csv.scan_csv_typed(spark, str(folder), "id int, v int")
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setJobGroup("after", "after")
    assert jobs <= 4  # a shuffle map stage may run as a job of its own, a listing of many paths too
    assert rows(df) == sorted([(i, 1 if i % 2 else 2) for i in range(60)] + [(60, 3)], key=str)


def test_headers_with_quoted_line_breaks(spark, tmp_path):
    path = write(tmp_path, '\ufeff\n"a\nb","c ""d""",e,e,C\n1,2,3,4,5\n')
    df = csv.scan_csv_typed(spark, path, "`a\nb` int, C int")
    assert rows(df) == [(1, 5)]
    with pytest.raises(ValueError, match="more than once"):
        csv.scan_csv_typed(spark, path, "e int")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet='ab ,\n"', max_size=5), min_size=1, max_size=4), st.integers(1, 7))
def test_first_record_does_not_depend_on_blocks(fields, size):
    record = ",".join('"' + f.replace('"', '""') + '"' for f in fields)
    stream = io.BytesIO(("\n \n" + record + '\r\nx,"y\nz"\n').encode())
    assert csv.first_record(lambda: stream.read(size)) == record


def test_line_numbers_over_many_splits(spark, tmp_path):
    path = write(tmp_path / "t", "id,pad\n" + "".join(f"{i},{'x' * 50}\n" for i in range(2, 5_002)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = spark.read.schema("id long, pad string").option("header", True).csv(path)
        numbered = csv.with_line_number(raw)
        assert raw.rdd.getNumPartitions() > 5
        assert numbered.count() == 5_000
        assert numbered.where("source_row_number <> id").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_parts(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.scan_parquet_parts(spark, str(tmp_path / "none"))
    path = str(tmp_path / "p")
    tables.sink_parquet_parts(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)exist"):
        tables.sink_parquet_parts(spark.range(3), path)
    tables.sink_parquet_parts(spark.range(5), path, overwrite=True)
    assert tables.scan_parquet_parts(spark, path, ["id"]).count() == 5


def test_manifest(spark, tmp_path):
    path = write(tmp_path / "t", "hello\n")
    digest = hashlib.sha256(b"hello\n").hexdigest()
    known = ingest.source_manifest(spark, f"{path}/*.csv", {"a.csv": digest})
    assert rows(known, "sha256", "ok") == [(digest, True)]
    ingest.require_known_sources(known)
    for expected in ({"a.csv": "0" * 64}, {}):
        with pytest.raises(RuntimeError):
            ingest.require_known_sources(ingest.source_manifest(spark, f"{path}/*.csv", expected))


def flagged(spark, data):
    return contract.flag_transactions(spark.createDataFrame(data, SCHEMA))


def test_batches(spark, tmp_path):
    root = str(tmp_path / "lake")
    data = [*FOUR, changed(FOUR[0], source_row_number=9, amount=-1.0)]
    assert ingest.ingest_batch(flagged(spark, data), "s", "1" * 64, root) == 1
    with pytest.raises(ValueError, match="before"):
        ingest.ingest_batch(flagged(spark, data), "s", "1" * 64, root)
    broken = flagged(spark, data).withColumn("rejection_reason", F.raise_error(F.lit("x")).cast("string"))
    with pytest.raises(Exception):
        ingest.ingest_batch(broken, "s", "2" * 64, root)
    state = ingest.batch_state(spark, root)
    assert rows(state, "ingestion_id", "status", "accepted_rows", "rejected_rows") == [
        (1, "completed", 4, 1), (2, "failed", None, None),
    ]
    loaded = ingest.completed_rows(spark, root, "raw/transactions")
    assert loaded.count() == 4 and loaded.where("length(row_fingerprint) = 16").select("row_fingerprint").distinct().count() == 4
    assert ingest.completed_rows(spark, root, "audit/rejected_rows").count() == 1


def test_repeated_content_is_refused_before_it_is_published(spark, tmp_path):
    root = str(tmp_path / "lake")
    ingest.ingest_batch(flagged(spark, FOUR), "s", "1" * 64, root)
    again = [changed(r, source_row_number=100 - i) for i, r in enumerate(FOUR)]  # other file, other lines, same rows
    with pytest.raises(RuntimeError, match="same rows"):
        ingest.ingest_batch(flagged(spark, again), "s", "2" * 64, root)
    twice = spark.createDataFrame([*FOUR, changed(FOUR[0], source_row_number=50)], SCHEMA).withColumn("rejection_reason", F.lit(""))
    with pytest.raises(RuntimeError, match="1 rows repeat"):
        ingest.ingest_batch(twice, "s", "3" * 64, root)
    assert rows(ingest.batch_state(spark, root), "ingestion_id", "status") == [(1, "completed"), (2, "failed"), (3, "failed")]
    assert ingest.completed_rows(spark, root, "raw/transactions").count() == 4
    assert os.listdir(f"{root}/raw/transactions") == ["ingestion_id=1"]
    # Batches without accepted rows hold no content that could repeat.
    for digest in ("4", "5"):
        ingest.ingest_batch(flagged(spark, [changed(FOUR[0], amount=-1.0)]), "s", digest * 64, root)


def test_loads_side_by_side(spark, tmp_path):
    """Two sources get two ids; of two loads of one source one is refused."""
    root = str(tmp_path / "lake")
    sources = [("1", FOUR[:2]), ("2", FOUR[2:]), ("3", [changed(FOUR[0], amount=7.5)]), ("3", [changed(FOUR[0], amount=7.5)])]

    def load(source):
        try:
            return ingest.ingest_batch(flagged(spark, source[1]), "s", source[0] * 64, root)
        except ValueError:
            return None

    with ThreadPoolExecutor(4) as pool:
        ids = list(pool.map(load, sources))
    assert ids.count(None) == 1 and None in ids[2:] and sorted(i for i in ids if i) == [1, 2, 3]
    assert ingest.completed_rows(spark, root, "raw/transactions").count() == 5


def test_one_of_many_claims_succeeds(spark, tmp_path):
    for path in (f"{tmp_path}/a/one", f"file://{tmp_path}/a/two"):
        with ThreadPoolExecutor(8) as pool:
            assert sum(pool.map(lambda _: ingest.claim(spark, path), range(16))) == 1


def test_published_names(spark):
    df = literal.values_table(spark, [("1", None)], "a int, b date")
    assert literal.publish_view("quern_test_view", df).dtypes == [("a", "int"), ("b", "date")]
    assert rows(tables.describe_schema(df)) == [("a", "int", 1), ("b", "date", 0)]
