from pyspark.sql import functions as F

from cellspark.streaming.ingest import ingest


def test_ingest_sees_each_file_once(spark, tmp_path):
    src, sink, state = (str(tmp_path / n) for n in ("src", "sink", "state"))
    schema = "prefix string, mapq int"
    keep = lambda d: d.where(F.col("mapq") >= 30)
    for part in ([("a", 30), ("a", 10)], [("b", 60)]):
        spark.createDataFrame(part, schema).write.mode("append").parquet(src)
        ingest(spark, src, schema, sink, state, keep)
    ingest(spark, src, schema, sink, state, keep)
    assert sorted((r.prefix, r.mapq) for r in spark.read.parquet(sink).collect()) == [("a", 30), ("b", 60)]
