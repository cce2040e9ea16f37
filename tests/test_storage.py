"""Archives, tables, rolling files, reports and the stream."""

import os
import re
import shutil
import tracemalloc
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from webstrata import (
    assign_files, bytes_written, frame_record, output_text, parse_records, running_bytes, scan_archive,
    publish_files, scan_documents, scan_multi, scan_pages, scan_split, scan_table, sink_archive, sink_documents, sink_rolling, sink_split,
    sink_table, stored_compression, stream_filter, stream_ingest, stream_rows, stream_written, write_open_files,
)
from webstrata.functions import bytesview as B
from webstrata.operators import assemble
from webstrata.plans.page_crawl import crawl, raw_crawl
from webstrata.plans.page_queries import QUERIES
from webstrata.schema import MAGIC, RAW
from webstrata.sources import archive, documents, task_files
from webstrata.sources.archive import archive_patterns, finished_files_glob


@pytest.fixture(scope="module")
def raw(spark):
    sizes = [0, 1, 100, 122, 123, 124, 127, 128, 250, 255, 256, 65_535, 65_536, 70_000, 20_000_000]
    rows = [(f"http://é.com/{'x' * (n % 200)}{n}", bytearray(os.urandom(n))) for n in sizes]
    return spark.createDataFrame(rows, "uri string, doc binary")


def as_set(df):
    return {(r["uri"], bytes(r["doc"])) for r in df.select("uri", "doc").collect()}


@pytest.mark.parametrize("kind", ["NONE", "BLOCK", "DEFAULT"])
def test_archive_round_trip(spark, raw, tmp_path, kind):
    path = str(tmp_path / "a")
    sink_archive(raw, path, kind)
    assert as_set(scan_archive(spark, path)) == as_set(raw)
    head = open(next(str(p) for p in (tmp_path / "a").glob("part-*")), "rb").read(300)
    assert head.startswith(b"SEQ\x06") and head.count(b"org.apache.hadoop.io.Text") == 2
    # version, two class names with one length byte each, then the compression flags
    flags = head[4 + 2 * 26 :][:2]
    assert flags == (b"\x00\x00" if kind == "NONE" else b"\x01\x01")


@pytest.mark.parametrize("kind", ["NONE", "RECORD", "BLOCK"])
@pytest.mark.parametrize("limit", [1, 200, 70_000, 1 << 40])
def test_archives_roll_in_their_tasks(spark, raw, tmp_path, kind, limit):
    path = str(tmp_path / "a")
    sizes = [[len(r["doc"]) + 4 for r in rows] for rows in raw.rdd.glom().collect()]
    written = sink_archive(raw, path, kind, limit)
    assert written == (len(as_set(raw)), sum(map(sum, sizes)))
    assert as_set(scan_archive(spark, path)) == as_set(raw)
    assert {r.compression for r in stored_compression(spark, path).collect()} == {kind}
    names = sorted(p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith("."))
    want = [f"part-{task:05d}-{n:05d}" for task, own in enumerate(sizes) if own for n in range(greedy(own, limit)[-1] + 1)]
    assert names == ["_SUCCESS", *want]


@pytest.mark.parametrize("kind", ["NONE", "BLOCK"])
@pytest.mark.parametrize("reached", [True, False])
def test_archives_of_one_file_per_task(spark, raw, tmp_path, monkeypatch, kind, reached):
    if not reached:  # Hadoop writes
        monkeypatch.setattr(archive, "is_reached", lambda uri: False)
    path, tasks = str(tmp_path / "a"), [len(rows) for rows in raw.rdd.glom().collect()]
    assert sink_archive(raw, path, kind, -1) == (raw.count(), raw.agg(F.sum(F.octet_length("doc") + 4)).first()[0])
    assert as_set(scan_archive(spark, path)) == as_set(raw)
    assert {r.compression for r in stored_compression(spark, path).collect()} == {kind}
    names = sorted(p.name for p in (tmp_path / "a").iterdir() if not p.name.startswith("."))
    want = [f"part-{k:05d}-00000" for k, n in enumerate(tasks) if n] if reached else [f"part-r-{k:05d}" for k in range(len(tasks))]
    assert names == ["_SUCCESS", *want]


def test_file_systems_that_python_reaches(tmp_path):
    assert task_files.is_reached(f"file:{tmp_path}/none") and not task_files.is_reached("nosuch://host/a")


def test_archive_options(spark, raw, tmp_path):
    with pytest.raises(ValueError, match="RECORD"):
        sink_archive(raw, str(tmp_path / "r"), "RECORD", max_bytes=-1)
    with pytest.raises(ValueError):
        sink_archive(raw, str(tmp_path / "r"), "GZIP")
    for size in (0, -2):
        with pytest.raises(ValueError):
            sink_archive(raw, str(tmp_path / "r"), max_bytes=size)
        with pytest.raises(ValueError):
            assign_files(raw, size)
    small = raw.where(F.octet_length("doc") < 1000)
    sink_archive(small, str(tmp_path / "s"), max_bytes=200)
    with pytest.raises(FileExistsError):
        sink_archive(small, str(tmp_path / "s"))
    assert sink_archive(raw.where("false"), str(tmp_path / "none")) == (0, 0)
    assert scan_archive(spark, str(tmp_path / "none")).count() == 0


def test_a_lost_write_leaves_nothing_to_read(spark, raw, tmp_path):
    path = str(tmp_path / "a")
    manifest = write_open_files(raw, path)
    assert all(p.name.endswith(".open") for p in (tmp_path / "a").iterdir())
    with pytest.raises(FileNotFoundError):
        scan_archive(spark, path)
    first = manifest.first()
    os.rename(tmp_path / "a" / first.part, tmp_path / "a" / first.file)  # published by a task that was lost afterwards
    assert publish_files(manifest, path).records == raw.count() and as_set(scan_archive(spark, path)) == as_set(raw)


def test_names_with_the_signs_of_patterns(spark, raw, tmp_path):
    odd = ["a, b", "{c}", "[d]*", "e?", "back\\slash", "f^g", "é 1", "crawl-1"]
    small = raw.where(F.octet_length("doc") < 1000).repartition(1)
    for name in odd:
        sink_archive(small, str(tmp_path / "root" / name / "x, {y} 1"))
        shutil.copy(next((tmp_path / "root" / name / "x, {y} 1").glob("part*")), tmp_path / "root" / name / "f{1},[2]")
    for name in ("crawl-2.open", "_crawl-3"):  # not to be read, though they look like crawl-1
        sink_archive(small, str(tmp_path / "root" / name))
    n = small.count()
    assert scan_archive(spark, str(tmp_path / "root")).count() == 2 * n * len(odd)
    paths = [str(tmp_path / "root" / name) for name in odd]
    found = {r["crawl_dir"]: r["count"] for r in scan_multi(spark, paths).groupBy("crawl_dir").count().collect()}
    assert found == {p: 2 * n for p in paths}
    assert scan_archive(spark, [str(tmp_path / "root"), *paths]).count() == 2 * n * len(odd)  # no file twice


def test_many_files_share_a_pattern(spark, raw, tmp_path):
    root = tmp_path / "root"
    small = raw.where(F.octet_length("doc") < 1000)
    sink_archive(small.repartition(7), str(root / "job-1"), max_bytes=1)
    sink_archive(small.repartition(1), str(root / "job-1" / "part-00009-00009"))  # a folder that looks like a file
    sink_archive(small.repartition(2), str(root / "job-2"), max_bytes=1)
    sink_archive(small.repartition(2), str(root / "deep" / "job-1"), max_bytes=1)
    (root / "job-2" / "part-00000-00000.open").write_bytes(b"half a file")
    (root / "job-1" / "part-00009-00009" / "x.invalid").write_bytes(b"half a file")
    patterns = archive_patterns(spark, [f"file:{root}"])
    files = 3 * small.count() + 1
    assert sum(p.count("[0-9]") > 9 for p in patterns) == 2 and files > len(patterns)
    assert scan_archive(spark, str(root)).count() == 4 * small.count()
    sink_archive(small.repartition(4), str(tmp_path / "flat"), max_bytes=1)
    assert archive_patterns(spark, [f"file:{tmp_path}/flat"]) == [f"file:{tmp_path}/flat/part-{'[0-9]' * 5}-{'[0-9]' * 5}"]


def test_hadoop_text_bytes(spark):
    # length -> bytes of a Hadoop variable-length int
    want = {0: "00", 1: "01", 127: "7F", 128: "8F80", 255: "8FFF", 256: "8E0100", 65536: "8D010000"}
    df = spark.createDataFrame([(n, bytearray(n)) for n in want], "n int, b binary")
    got = df.select("n", F.hex(B.to_text_writable(F.col("b"))).alias("x"), B.from_text_writable(B.to_text_writable(F.col("b"))).alias("y"), "b")
    for r in got.collect():
        assert r.x == want[r.n] + "00" * r.n and r.y == r.b


def test_several_directories_and_unfinished_files(spark, raw, tmp_path):
    for k, name in enumerate(("one", "two")):
        sink_archive(raw.where(F.octet_length("doc") % 2 == k), str(tmp_path / name))
    part = sorted(p for p in (tmp_path / "two").glob("part-*") if p.stat().st_size > 500)[0]
    data = part.read_bytes()
    for name in ("x.open", "y.invalid", "_hidden"):
        (tmp_path / "one" / name).write_bytes(data[: len(data) // 2])
    paths = [str(tmp_path / "one"), str(tmp_path / "two")]
    assert as_set(scan_archive(spark, paths)) == as_set(raw)
    both = scan_multi(spark, paths)
    assert as_set(both) == as_set(raw) and {r[0] for r in both.select("crawl_dir").distinct().collect()} == set(paths)
    with pytest.raises(ValueError):
        scan_archive(spark, [])


def test_glob_of_finished_files(spark, tmp_path):
    names = [
        "a", "n", "en", "pen", "open", ".open2", "a.open", "aopen", "b.opens", "x.invalid", "invalid", "xinvalid", "lid",
        "d", "part-00000", "a.open.gz", "a.invalid.open", "z.ope", "crawl-20240111024623-00000-host", "crawl-1-0-host.open",
    ]
    for n in names:
        (tmp_path / n).write_text("x")
    df = spark.read.format("binaryFile").option("pathGlobFilter", finished_files_glob()).load(str(tmp_path))
    got = {r[0].rsplit("/", 1)[1] for r in df.select("path").collect()}
    assert got == {n for n in names if not n.endswith((".open", ".invalid")) and not n.startswith(".")}
    assert finished_files_glob(()) == "*"


def test_single_documents(spark, tmp_path):
    doc = MAGIC + b"URL: http://a.com/\r\n\r\nGET /\r\n\r\nHTTP/1.0 200 OK\r\n\r\nbody"
    framed = len(doc).to_bytes(4, "big") + doc
    (tmp_path / "whole").write_bytes(framed)
    (tmp_path / "longer").write_bytes(framed + b"tail")
    (tmp_path / "cut").write_bytes(framed[:-1])
    (tmp_path / "busy.open").write_bytes(framed)
    docs = scan_documents(spark, str(tmp_path))
    got = {r.uri.rsplit("/", 1)[1]: r for r in parse_records(docs).collect()}
    assert sorted(got) == ["cut", "longer", "whole"]
    assert bytes(got["longer"].body) == bytes(got["whole"].body) == b"body"
    assert got["cut"].error == "document truncated"
    assert {len(r.body) for r in scan_pages(spark, str(tmp_path)).collect()} == {len(framed) - 1, len(framed), len(framed) + 4}


def test_documents_of_many_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(documents, "FOLDER_FILES", 7)
    raw = spark.range(0, 500, numPartitions=3).selectExpr("'u' || id uri", "unhex(repeat('ab', cast(id as int))) doc")
    path = str(tmp_path / "d")
    written = sink_documents(raw, path)
    assert written == (500, sum(i + 4 for i in range(500)))
    folders = [p for p in (tmp_path / "d").iterdir() if p.is_dir()]
    assert not [p for p in folders if p.name.endswith(".open")] and {len(list(p.iterdir())) for p in folders} <= {7, 167 % 7, 166 % 7}
    with pytest.raises(FileExistsError):
        sink_documents(raw, path)
    (tmp_path / "d" / "part-00009-00000.x.open").mkdir()
    (tmp_path / "d" / "part-00009-00000.x.open" / "0").write_bytes(b"unfinished")
    docs = scan_documents(spark, f"{path}/{documents.FOLDERS}")
    assert sorted(bytes(r.doc) for r in docs.collect()) == [b"\xab" * i for i in range(500)]
    assert docs.rdd.getNumPartitions() <= documents.TASKS_PER_CORE * spark.sparkContext.defaultParallelism  # not by the number of files
    sink_documents(raw.where("id < 0"), str(tmp_path / "none"))
    assert scan_documents(spark, str(tmp_path / "none" / documents.FOLDERS)).count() == 0


@pytest.mark.parametrize("kind", ["NONE", "RECORD", "BLOCK"])
def test_archive_writer_holds_few_rows(tmp_path, monkeypatch, kind):
    monkeypatch.setattr(archive, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    batches = [
        pa.record_batch({"key": [b"k"] * 4000, "value": [os.urandom(10) * 1000] * 4000, "size": [10_000] * 4000}) for _ in range(2)
    ]
    tracemalloc.start()
    try:
        (manifest,) = archive._writer(f"file:{tmp_path}", kind, 5_000_000)(iter(batches))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(manifest.column("records").to_pylist()) == 8000 and manifest.num_rows == 16
    assert peak < 15_000_000  # a batch has 40 MB


def test_archive_writer_without_limit(tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    batches = [pa.record_batch({"key": [b"k"] * 300, "value": [b"v" * 9] * 300, "size": [9] * 300}) for _ in range(2)]
    (manifest,) = archive._writer(f"file:{tmp_path}", "NONE", -1)(iter(batches))
    assert [(r["file"], r["records"], r["bytes"]) for r in manifest.to_pylist()] == [("part-00003-00000", 600, 5400)]


def test_one_file_per_task_gets_small_batches(spark, tmp_path, monkeypatch):
    def noted(folder, kind, max_bytes):
        def run(batches):
            yield archive.manifest_batch([["p", "f", b.num_rows, int(b.num_rows > task_files.SLICE_ROWS)] for b in batches])

        return run

    monkeypatch.setattr(archive, "_writer", noted)
    raw = spark.range(0, 3000, numPartitions=1).selectExpr("'u' || id uri", "cast('x' as binary) doc")
    assert sink_archive(raw, str(tmp_path / "a"), max_bytes=-1) == (3000, 0)


def test_writers_get_small_batches(spark, tmp_path, monkeypatch):
    sizes, key = str(tmp_path / "sizes"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)

    def noted(folder, kind, max_bytes):
        def run(batches):
            yield archive.manifest_batch([["p", str(b.num_rows), 1, 0] for b in batches])

        return run

    monkeypatch.setattr(archive, "_writer", noted)
    raw = spark.range(0, 3000, numPartitions=1).selectExpr("'u' || id uri", "cast('x' as binary) doc")
    found = [int(r.file) for r in write_open_files(raw, sizes).collect()]
    assert sum(found) == 3000 and max(found) <= task_files.SLICE_ROWS and spark.conf.get(key) == before


def test_table(spark, sf_dir, tmp_path):
    path = str(tmp_path / "t")
    captures = parse_records(raw_crawl(spark, sf_dir))
    sink_table(captures, path)
    back = scan_table(spark, path)
    plain = [F.map_entries("fields").alias("fields") if c == "fields" else c for c in captures.columns]
    assert back.select(*plain).exceptAll(captures.select(*plain)).isEmpty()
    assert captures.select(*plain).exceptAll(back.select(*plain)).isEmpty()
    plan = back.where("crawl_date = date'2024-01-01'").groupBy("charset").count()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(crawl_date" in plan and "ReadSchema: struct<charset:string>" in plan
    assert back.count() == captures.count()


def test_table_query_reads_every_day(spark, sf_dir):
    rows = QUERIES["scan_table"](spark, sf_dir).collect()
    assert {r.crawl_date for r in rows} == {f"2024-01-0{k}" for k in range(1, 8)}
    assert len(rows) == spark.read.parquet(f"{sf_dir}/pages.parquet").where("page_id % 20 > 1").count()


def test_split_table_in_one_pass(spark, sf_dir, tmp_path):
    path = str(tmp_path / "t")
    captures = parse_records(raw_crawl(spark, sf_dir))
    written = sink_split(captures, path, 3000)
    kept, rejected = scan_split(spark, path), scan_split(spark, path, "rejected")
    assert {k: v.records for k, v in written.items()} == {"written": kept.count(), "rejected": rejected.count()}
    sizes = [len(r.body) for r in captures.select("body").collect()]
    assert written["written"].bytes == sum(n for n in sizes if n <= 3000) and written["rejected"].bytes == sum(n for n in sizes if n > 3000)
    assert set(captures.columns) <= set(kept.columns) and kept.where("octet_length(body) > 3000").isEmpty()
    assert "body" not in rejected.columns and {r.annotation for r in rejected.collect()} == {"unwritten:size"}
    plan = rejected._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(disposition" in plan


def test_conditions_reach_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "raw")
    raw = raw_crawl(spark, sf_dir).withColumn("day", F.expr("date'2024-01-01' + cast(crc32(uri) % 5 as int)")).withColumn("size", F.octet_length("doc"))
    raw.write.partitionBy("day").parquet(path)
    table = spark.read.parquet(path)
    where = ["day >= date'2024-01-02' AND status = 200 AND size > 2000", F.col("uri").startswith("http"), "charset = 'UTF-8' OR size < 0"]
    got = parse_records(table, where=where)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*day#\d+ >= 2024-01-02", plan) and "GreaterThan(size,2000)" in plan and "StringStartsWith(uri,http)" in plan
    filters = [line for line in plan.splitlines() if "Filter (" in line]
    assert len(filters) == 2 and all("substring_index" not in line and "regexp" not in line for line in filters)
    all_rows = parse_records(table)
    want = all_rows.where("day >= date'2024-01-02' AND status = 200 AND size > 2000 AND uri LIKE 'http%' AND (charset = 'UTF-8' OR size < 0)")
    assert sorted(r.uri for r in got.collect()) == sorted(r.uri for r in want.collect()) != []
    assert parse_records(table, where="day = date'2024-01-01'").columns == all_rows.columns


def greedy(sizes, limit):
    out, file_no, used = [], 0, 0
    for n in sizes:
        if used > limit:
            file_no, used = file_no + 1, 0
        used += n
        out.append(file_no)
    return out


def test_rolling(spark, tmp_path):
    df = spark.range(0, 3000, numPartitions=3).selectExpr("id", "unhex(repeat('ab', cast(pmod(id * 7919, 311) as int))) as doc")
    shown = df.withColumn("task", F.spark_partition_id()).collect()
    numbered = assign_files(df, 5000).withColumn("task", F.spark_partition_id())
    assert numbered.columns == ["id", "doc", "file_no", "task"]
    got = {(r.task, r.id): r.file_no for r in numbered.collect()}
    for task in range(3):
        mine = [r for r in shown if r.task == task]
        assert [got[task, r.id] for r in mine] == greedy([len(r.doc) for r in mine], 5000)
    assert {r.file_no for r in assign_files(df, -1).collect()} == {0}
    sink_rolling(df, str(tmp_path / "r"), 5000)
    back = spark.read.parquet(str(tmp_path / "r"))
    assert back.count() == 3000 and back.select("id").distinct().count() == 3000


def test_running_bytes(spark):
    # One shard holds most rows, many of them equal in the order.
    df = spark.range(4000).selectExpr(
        "case when id % 10 = 0 then 's' || id % 3 else 'big' end as shard",
        "cast(id % 100 as int) as t",
        "unhex(repeat('ab', cast(id % 17 as int))) as doc",
    )
    got = running_bytes(df, "shard", ("t",), blocks=8).collect()
    assert len(got) == 4000
    for shard in {r.shard for r in got}:
        mine = sorted((r for r in got if r.shard == shard), key=lambda r: r.position)
        total = 0
        for r in mine:
            total += r.bytes
            assert r.position == total
        assert [r.t for r in mine] == sorted(r.t for r in mine)
    want = {r.shard: r.bytes for r in bytes_written(df, "shard").collect()}
    assert want == {s: max(r.position for r in got if r.shard == s) for s in want}
    assert bytes_written(df).first()["records"] == 4000


def test_positions_of_repeated_urls_follow_the_crawl(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumn("url", F.expr("'http://a.com/' || page_id % 3"))
    sizes = assemble.encode_record(crawl(pages), keep=("page_id",)).selectExpr("uri", "page_id", "octet_length(doc) + 4 n").orderBy("uri", "page_id")
    want, at = [], 0
    for r in sizes.collect():
        at += r.n
        want.append(("http", r.uri, at, 50))
    for n in (1, 7):  # however the pages lie in files
        pages.orderBy(F.desc("page_id")).repartition(n).write.parquet(str(tmp_path / f"{n}" / "pages.parquet"))
        got = QUERIES["bytes_written"](spark, str(tmp_path / f"{n}"))
        assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == want


def test_report_file(spark, tmp_path):
    df = spark.createDataFrame([("UTF-8", 3), ("ISO-8859-1", 5), (None, 1)], "charset string, documents long")
    output_text(df, str(tmp_path / "out"), "charset")
    parts = list((tmp_path / "out").glob("part-*"))
    assert len(parts) == 1 and parts[0].read_text() == "ISO-8859-1\t5\nUTF-8\t3\nnull\t1\n"


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    raw = raw_crawl(spark, sf_dir)
    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    raw.repartition(3).write.parquet(source)

    counted = []

    def ingest():
        rows = stream_rows(spark, source, max_files=1)
        query = stream_ingest(rows, target, state, transform=lambda df: stream_filter(df, 5000))
        query.awaitTermination()
        counted.append(stream_written(query).records)
        return scan_table(spark, target)

    columns = ["uri", "status", "content_type", "charset", "body", "fields"]
    plain = [F.map_entries("fields").alias("fields") if c == "fields" else c for c in columns]
    want = stream_filter(parse_records(raw), 5000).select(*plain)
    assert 0 < want.count() < raw.count()
    got = ingest().select(*plain)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    # A second run takes in only what is new.
    passing = want.orderBy("uri").first()["uri"]
    more = raw.where(F.col("uri") == passing).limit(1).withColumn("uri", F.lit("http://new/"))
    more.write.mode("append").parquet(source)
    again = ingest()
    assert counted == [want.count(), 1]
    assert again.count() == want.count() + 1 and again.where("uri = 'http://new/'").count() == 1


def test_frame(spark, raw):
    framed = frame_record(raw)
    for r in framed.collect():
        assert int.from_bytes(bytes(r.doc)[:4], "big") == len(r.doc) - 4
    assert as_set(framed.withColumn("doc", B.unframe(F.col("doc")))) == as_set(raw)


def test_unfinished_files_are_skipped_at_every_depth(spark, tmp_path):
    raw = spark.createDataFrame([(f"http://a.com/{i}", bytearray(b"x" * i)) for i in range(5)], RAW).coalesce(1)
    for job in ("job1", "job2"):
        folder = tmp_path / job
        sink_archive(raw, str(folder))
        done = next(p for p in folder.iterdir() if p.name.startswith("part-"))
        (folder / "x.open").write_bytes(done.read_bytes()[:40])
        (folder / "y.invalid").write_bytes(done.read_bytes())
    assert scan_archive(spark, str(tmp_path)).count() == 10
    assert scan_archive(spark, str(tmp_path / "job1")).count() == 5
    (tmp_path / "top").write_bytes(done.read_bytes())
    (tmp_path / "z.open").write_bytes(b"")
    assert scan_archive(spark, str(tmp_path)).count() == 15
