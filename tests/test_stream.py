import datetime as dt

from spindrel.streaming import quality_stream

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def test_a_stream_goes_on_where_it_ended(spark, tmp_path):
    data, folder = tmp_path / "in", str(tmp_path / "run")
    at = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    put = lambda rows: spark.createDataFrame([(i, at(h), 1, "view", v) for i, h, v in rows], SCHEMA).coalesce(1).write.mode("append").parquet(str(data))
    run = lambda: {(r["window_start"].hour, r["n"], r["total"]) for r in quality_stream.run_to_table(spark, f"{data}/*.parque" + "t", spark.createDataFrame([], SCHEMA).schema, "1 hour", "2 hours", folder).collect()}
    put([(1, 0.1, 1.0), (2, 0.2, 2.0), (3, 1.5, 5.0)])
    assert run() == {(0, 2, 3.0), (1, 1, 5.0)}
    put([(4, 1.7, 1.0), (5, 9.0, 7.0)])
    assert run() == {(0, 2, 3.0), (1, 2, 6.0), (9, 1, 7.0)}
    assert run() == {(0, 2, 3.0), (1, 2, 6.0), (9, 1, 7.0)}
    put([(6, 0.3, 9.0), (7, 9.5, 1.0)])  # the first is behind the watermark by now
    assert run() == {(0, 2, 3.0), (1, 2, 6.0), (9, 2, 8.0)}
