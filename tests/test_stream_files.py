import json

import pytest
from pyspark.sql import functions as F

from webloom import schema as S
from webloom.operators import bench_tables
from webloom.sources import bench_files, crawl_events, lake
from webloom.streaming import ingest

EVENT = {
    "url": "https://a.es/x?q=1",
    "timestamp": "2025-01-02T10:00:00.123456789Z",
    "content": {
        "links": {"http": None, "https": ["https://b.es/"], "files": None, "internal": ["/y"]},
        "metadata": {"charset": ["utf-8"], "logo": None, "scripts": None, "styles": None,
                     "title": ["X"], "other": {}},
        "imgs": {"imgs": None},
        "texts": {"h1": ["X"], "h2": None, "p": ["about us"]},
    },
}


def run(spark, base, sink="pages"):
    source = ingest.file_source(spark, f"{base}/in")
    if sink == "pages":
        q = ingest.to_lake(source, f"{base}/lake", f"{base}/state", available_now=True)
    else:
        q = ingest.rejects_to_files(source, f"{base}/bad", f"{base}/bad_state", available_now=True)
    q.awaitTermination()


def test_stream_to_lake(spark, tmp_path):
    (tmp_path / "in").mkdir()
    first = tmp_path / "in" / "1.json"
    first.write_text(json.dumps(EVENT) + "\nnot json\n\n")
    run(spark, tmp_path)
    run(spark, tmp_path)
    rows = lake.scan(spark, f"{tmp_path}/lake").collect()
    assert [(r.domain, r.real_path, r.path, r.date, r.tags) for r in rows] == [
        ("a.es", "/x", "_x", "2025-01-02", ["empresa", "sitio_seguro"])
    ]
    assert rows[0].content.texts.h2 is None
    (tmp_path / "in" / "2.json").write_text(json.dumps({**EVENT, "url": "https://b.es/"}) + "\n")
    run(spark, tmp_path)
    assert lake.scan(spark, f"{tmp_path}/lake").count() == 2
    folders = lake.read_partitioned(spark, f"{tmp_path}/lake")
    assert folders.where("domain_p = 'b.es'").count() == 1
    run(spark, tmp_path, "rejects")
    assert [r.value for r in spark.read.text(f"{tmp_path}/bad").collect()] == ["not json", ""]


def test_event_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([EVENT | {"timestamp": None}], S.CRAWL_EVENT).drop("timestamp")
    pages.write.json(f"{tmp_path}/pages")
    stream = spark.readStream.schema(pages.schema).json(f"{tmp_path}/pages")
    ingest.event_file_sink(
        stream, F.lit("2025-01-02T10:00:00Z"), f"{tmp_path}/out", f"{tmp_path}/st", available_now=True
    ).awaitTermination()
    lines = spark.read.text(f"{tmp_path}/out")
    back = crawl_events.good_events(crawl_events.decode(lines)).first()
    assert back.url == EVENT["url"]
    assert back.content.asDict(True)["texts"]["p"] == ["about us"]
    assert back.timestamp is not None


def test_avro_is_optional(spark):
    assert lake.has_format(spark, "parquet")
    assert lake.has_format(spark, "avro") in (True, False)


def test_result_files(spark, tmp_path):
    head = "Timestamp,Test_Type,File_Size_MB,Duration_Sec,Throughput_MB_s\n"
    (tmp_path / "M2_hdfs_2025-01-01_1_namenode.csv").write_text(
        head + "10:00:00,WRITE,10,1.00,10.00\n10:00:01,READ,10,0.50,20.00\n"
    )
    (tmp_path / "M2_hdfs_2025-01-02_2_namenodes.csv").write_text(head + "10:00:00,WRITE,10,2.00,5.00\n")
    rows = bench_files.read_results(spark, f"{tmp_path}/M2_hdfs_*.csv", bench_files.STORAGE)
    got = {(r.File_Size_MB, r.config): r.mean_mb_s for r in bench_tables.mean_throughput(rows).collect()}
    assert got == {(10, "1_namenode"): 15.0, (10, "2_namenodes"): 5.0}


def test_throughput_floor(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 2.0)], "s double, d double")
    got = [r[0] for r in df.select(bench_tables.throughput(F.col("s"), F.col("d"))).collect()]
    assert got == [1000.0, 5.0]


def test_perf_lines(spark):
    df = spark.createDataFrame(
        [("5000 records sent, 49.5 records/sec (4.70 MB/sec), 2.0 ms avg latency, "
          "9.0 ms max latency, 1 ms 50th, 8 ms 95th, 9 ms 99th, 9 ms 99.9th.",), ("noise",)],
        "value string",
    )
    assert [tuple(r) for r in bench_files.parse_perf_lines(df).collect()] == [
        (5000, 49.5, 4.7, 2.0, 9.0, 1.0)
    ]


def test_result_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "M2_spark_d_1_a.csv").write_text(
        "Timestamp,Load_Level,Iterations,Real_Execution_Time_sec\nt1,low,25,7\n"
    )
    (tmp_path / "M2_spark_d_1_b.csv").write_text(
        '"Iterations",Load_Level,Extra,Real_Execution_Time_sec,Timestamp\n50,"hi, gh",x,8,t2\n'
    )
    rows = bench_files.read_results(spark, f"{tmp_path}/*.csv", bench_files.COMPUTE).collect()
    assert sorted(map(tuple, rows)) == [("t1", "low", 25, 7, "1_a"), ("t2", "hi, gh", 50, 8, "1_b")]
    (tmp_path / "M2_spark_d_1_c.csv").write_text("Timestamp,Load_Level\nt1,low\n")
    with pytest.raises(ValueError, match="1_c"):
        bench_files.read_results(spark, f"{tmp_path}/*.csv", bench_files.COMPUTE)


def test_perf_lines_with_exponents(spark):
    line = "5000 records sent, 1.0E7 records/sec (4.7 MB/sec), 2.0 ms avg latency, 9.0e-1 ms max latency, 1 ms 50th, x"
    row = bench_files.parse_perf_lines(spark.createDataFrame([(line,), ("other",)], "value string")).first()
    assert (row.records_per_sec, row.max_latency_ms, row.p50_latency_ms) == (1e7, 0.9, 1.0)
