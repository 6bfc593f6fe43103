"""Where a stream of landing files starts, and what it does about files that have gone."""

import datetime as dt
import glob
import os

import pytest

from velolake import schemas
from velolake.sources.envelope import first_start, read_landing
from velolake.streaming import layers as L
from velolake.streaming.lake import TOPICS, Lake
from velolake.streaming.sinks import batch_sink, run_layer

RIDES = TOPICS["rides"]


def publish(spark, lake, *texts):
    rows = [(bytearray(t.encode()), dt.datetime(2024, 1, 1)) for t in texts]
    for topic in TOPICS.values():
        L.publish(spark.createDataFrame(rows, schemas.ENVELOPE).coalesce(1), lake, topic)


def ingest(spark, lake, **how):
    run_layer(L.start_bronze(spark, lake, **how))
    return sorted(r.raw_json for r in lake.read(spark, "bronze", RIDES).collect())


def test_latest_leaves_out_what_was_there_before_the_first_start_only(spark):
    lake = Lake.fresh(spark, "t-latest")
    publish(spark, lake, "old")
    assert ingest(spark, lake, starting="latest") == []
    publish(spark, lake, "a", "b")
    assert ingest(spark, lake, starting="latest") == ["a", "b"]
    publish(spark, lake, "c")
    assert ingest(spark, lake, starting="latest") == ["a", "b", "c"]
    assert ingest(spark, lake, starting="latest") == ["a", "b", "c"]


def test_a_first_start_on_an_empty_folder_misses_nothing(spark):
    lake = Lake.fresh(spark, "t-empty")
    mark = f"{lake.root}/bronze/starts/{RIDES}"
    assert first_start(spark, lake.landing(RIDES), mark) is None
    publish(spark, lake, "a")
    assert first_start(spark, lake.landing(RIDES), mark) is None  # the first start's answer stays
    assert ingest(spark, lake, starting="latest") == ["a"]


def test_earliest_reads_everything_and_other_words_are_refused(spark):
    lake = Lake.fresh(spark, "t-earliest")
    publish(spark, lake, "old")
    assert ingest(spark, lake) == ["old"]
    with pytest.raises(ValueError, match="starting must be"):
        read_landing(spark, lake.landing(RIDES), starting="newest")
    with pytest.raises(ValueError, match="first start"):
        read_landing(spark, lake.landing(RIDES), starting="latest")


def files(lake):
    path = lake.landing(RIDES)
    return set(glob.glob((path[path.index("/"):] if path.startswith("file:") else path) + "/*.parquet"))


def two_files(spark, lake):
    publish(spark, lake, "a")
    here = files(lake)
    publish(spark, lake, "b")
    (second,) = files(lake) - here
    return second


@pytest.mark.parametrize("fail", [True, False])
def test_a_file_that_goes_while_its_batch_runs(spark, fail):
    lake = Lake.fresh(spark, "t-loss")
    second = two_files(spark, lake)
    got = []

    def write(df, batch_id):
        if batch_id == 1:
            os.remove(second)  # the batch is planned by now
        got.extend(r.raw_json for r in df.collect())

    def run():
        run_layer([batch_sink(read_landing(spark, lake.landing(RIDES), 1, fail_on_data_loss=fail), write, lake.checkpoint("bronze", RIDES))])

    if fail:
        with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
            run()
    else:
        run()
        publish(spark, lake, "c")
        run()
    assert got == (["a"] if fail else ["a", "c"])


def test_a_file_that_has_gone_before_its_batch_is_left_out(spark):
    lake = Lake.fresh(spark, "t-gone")
    second = two_files(spark, lake)
    got = []

    def write(df, batch_id):
        if os.path.exists(second):
            os.remove(second)
        got.extend(r.raw_json for r in df.collect())

    run_layer([batch_sink(read_landing(spark, lake.landing(RIDES), 1, fail_on_data_loss=False), write, lake.checkpoint("bronze", RIDES))])
    assert got == ["a"]
