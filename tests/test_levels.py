"""The sink that doesn't grow: levels, replays, newest rows."""

import os

from pyspark.sql import functions as F

from tierwise.streaming import counters, levels


def batch(spark, epoch, n=3):
    return spark.createDataFrame([(f"k{(epoch + i) % 5}", epoch) for i in range(n)], "key string, v long")


def test_after_100_batches_a_read_touches_a_bounded_number_of_folders(spark, tmp_dir):
    sink, want = counters.keyed_sink(f"{tmp_dir}/s", ["key"]), {}
    for e in range(100):
        b = spark.createDataFrame([("k", e), (f"k{e % 4}", e)], "key string, v long")
        sink.write(b, e)
        want |= {"k": e, f"k{e % 4}": e}
        if e in (7, 8, 40, 63, 64, 99):
            got = {r.key: r.v for r in counters.latest_by_key(spark, f"{tmp_dir}/s", ["key"]).collect()}
            assert got == want
        assert len(levels.cover(levels.runs(spark, f"{tmp_dir}/s"))) <= 3 * (levels.FAN - 1)
    assert levels.cover(levels.runs(spark, f"{tmp_dir}/s")) == [(0, 63), (64, 71), (72, 79), (80, 87), (88, 95), (96, 96), (97, 97), (98, 98), (99, 99)]
    assert len(os.listdir(f"{tmp_dir}/s")) <= 2 * 3 * levels.FAN


def test_replays_write_the_same(spark, tmp_dir):
    keyed, plain = levels.Sink(f"{tmp_dir}/k", lambda df: levels.newest(df, ["key"]), fan=2), levels.Sink(f"{tmp_dir}/p", fan=2)
    for e in range(6):
        for _ in range(2):                      # each batch twice, also those that merge
            keyed.write(batch(spark, e), e)
            plain.write(batch(spark, e), e)
    assert sorted(plain.read(spark).groupBy("v").count().collect()) == [(e, 3) for e in range(6)]
    want = {}
    for e in range(6):
        want |= {f"k{(e + i) % 5}": e for i in range(3)}
    assert {r.key: r.v for r in levels.newest(keyed.read(spark), ["key"]).collect()} == want


def test_a_run_without_its_mark_is_not_read(spark, tmp_dir):
    sink = levels.Sink(f"{tmp_dir}/p", fan=2)
    for e in range(4):
        sink.write(batch(spark, e), e)
    assert levels.runs(spark, f"{tmp_dir}/p")[-1] == (3, 3) and (0, 3) in levels.runs(spark, f"{tmp_dir}/p")
    os.remove(f"{tmp_dir}/p/run-0-3/_SUCCESS")          # died while merging: the parts are still there
    assert levels.cover(levels.runs(spark, f"{tmp_dir}/p")) == [(0, 1), (2, 3)]
    sink.write(batch(spark, 3), 3)
    assert sorted(sink.read(spark).groupBy("v").agg(F.count("*")).collect()) == [(e, 3) for e in range(4)]


def test_cover_takes_the_widest():
    assert levels.cover([(0, 0), (0, 7), (1, 1), (8, 8), (7, 7)]) == [(0, 7), (8, 8)]
