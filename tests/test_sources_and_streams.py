import json

from pyspark.sql import functions as F

from tessera.sources import readers, writers
from tessera.streaming import events

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_readers(spark, tmp_path):
    (tmp_path / "a.rrf").write_text("1|x||\n2|y|z|\nbad|line\n")
    assert rows(readers.delimited(spark, str(tmp_path / "a.rrf"), ["a", "b", "c"])) == [("1", "x", None), ("2", "y", "z")]
    (tmp_path / "b.csv").write_text("k,v\n1,a\n ,b\n,c\n2,\n")
    assert rows(readers.table_with_header(spark, str(tmp_path / "b.csv"), ["k"])) == [("1", "a"), ("2", None)]
    (tmp_path / "s.json").write_text(json.dumps({"version": 1, "synonyms": [{"id": "g", "synonyms": ["p", "q"]}]}, indent=1))
    assert rows(readers.synonym_groups(spark, str(tmp_path / "s.json"))) == [("g", 0, "p"), ("g", 1, "q")]
    (tmp_path / "c.jsonl").write_text('{"k":"a","t":1}\n{"k":"a","t":3}\n{"k":"b"\n{"k":"c","t":null}\n')
    assert rows(readers.latest_lines(spark, str(tmp_path / "c.jsonl"), "k string, t long", "k", "t")) == [("a", 3), ("c", None)]
    (tmp_path / "l.log").write_text("INFO set A -> B1\nnoise\nINFO set C -> D2\n")
    assert rows(readers.log_lines(spark, str(tmp_path / "l.log"), r"set (\w+) -> (\w+)", ["k", "v"])) == [("A", "B1"), ("C", "D2")]


def test_writers(spark, tmp_path):
    df = spark.range(50).withColumn("x", F.col("id") * 2)
    writers.write_batches(df, str(tmp_path / "batches"), "id", 4)
    back = spark.read.text(str(tmp_path / "batches"))
    assert back.count() == 50 and back.select("batch").distinct().count() == 4
    audit = str(tmp_path / "audit")
    writers.append_audit(df, audit, "r1", "dry_run")
    writers.append_audit(df, audit, "r1", "dry_run")
    writers.append_audit(df.limit(3), audit, "r2", "full")
    got = spark.read.parquet(audit)
    assert got.count() == 53 and writers.has_dry_run(got) and not writers.has_dry_run(got.filter("run_id = 'r2'"))
    nodes = spark.createDataFrame([("drug", "1", "a"), ("drug", "1", "b")], "label string, id string, props string")
    edges = spark.createDataFrame([("1", "2", "t", "x"), ("1", "2", "t", "x")], "src string, dst string, type string, props string")
    writers.graph_tables(nodes, edges, str(tmp_path / "g"))
    assert rows(spark.read.parquet(str(tmp_path / "g/nodes")).select("id", "props")) == [("1", "b")]
    assert spark.read.parquet(str(tmp_path / "g/edges")).count() == 1


def test_stream_equals_batch(spark, tmp_path):
    source = spark.read.parquet(f"{SMALL}/events.parquet")
    folder = str(tmp_path / "in")
    source.write.parquet(folder)
    schema = ", ".join(f"{n} {t}" for n, t in source.dtypes)
    args = (spark, folder, schema, lambda d: d.filter("value > 10").select("event_id", "value"), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    events.ingest(*args).awaitTermination()
    events.ingest(*args).awaitTermination()  # nothing new: nothing twice
    want = source.filter("value > 10").select("event_id", "value")
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(want)
    q = events.windowed_counts(spark.readStream.schema(schema).parquet(folder)).writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("counts")) == rows(events.windowed_counts(source))
