from quarry.operators.boolean import NO_RESULTS
from quarry.operators.index import build_index
from quarry.streaming.search import read_stream_results, start_search_stream


def test_stream_restart_is_idempotent(spark, tmp_path):
    docs = spark.createDataFrame([("a/1", "a", "1", "x y z"), ("a/2", "a", "2", "x z"), ("b/1", "b", "1", "y")],
                                 "doc_key string, block string, file string, text string")
    build_index(docs).write(str(tmp_path / "index"))
    qdir = tmp_path / "queries"
    qdir.mkdir()
    (qdir / "q1.txt").write_text("x z\n\ny\n")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    start_search_stream(spark, str(qdir), str(tmp_path / "index"), out, ck).awaitTermination()
    first = sorted(map(tuple, read_stream_results(spark, out).select("query", "doc_name").collect()))
    assert first == [("x z", "a/1"), ("x z", "a/2"), ("y", "a/1"), ("y", "b/1")]
    # restart on the same checkpoint: nothing is re-answered or duplicated
    start_search_stream(spark, str(qdir), str(tmp_path / "index"), out, ck).awaitTermination()
    assert sorted(map(tuple, read_stream_results(spark, out).select("query", "doc_name").collect())) == first
    # a new file is answered in a new epoch
    (qdir / "q2.txt").write_text("w\n")
    start_search_stream(spark, str(qdir), str(tmp_path / "index"), out, ck).awaitTermination()
    got = sorted(map(tuple, read_stream_results(spark, out).select("query", "doc_name").collect()))
    assert got == sorted(first + [("w", NO_RESULTS)])
