from parley.streaming.ingest import read_ingested, start_ingest


def test_stream_ingest_latest_wins(spark, tmp_path):
    src, table, ckpt = str(tmp_path / "src"), str(tmp_path / "table"), str(tmp_path / "ckpt")
    batches = [["1\tfirst", "2\tkeep"], ["1\tsecond", "3\tnew", "dummy"]]
    for lines in batches:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(src)
        start_ingest(spark, src, table, ckpt).awaitTermination()
    got = {r["doc_id"]: (r["text"], r["batch_id"]) for r in read_ingested(spark, table).collect()}
    assert got == {"MARCO_1": ("second", 2), "MARCO_2": ("keep", 1), "MARCO_3": ("new", 2)}
    # a run with nothing new leaves the table as it is
    start_ingest(spark, src, table, ckpt).awaitTermination()
    assert read_ingested(spark, table).count() == 3
