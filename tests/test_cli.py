from velolake.__main__ import main
from velolake.streaming.lake import Lake


def test_cli_publish_ingest_run_validate(spark, capsys):
    lake = Lake.fresh(spark, "t-cli")
    assert main(["publish", "--lake", lake.root, "--events", "/root/testdata/sf0.001/events.parquet"]) == 0
    assert main(["run", "--lake", lake.root, "--layers", "bronze,silver,gold,mart", "--window", "1 hour",
                 "--exact"]) == 0
    assert lake.read(spark, "mart", "mart_revenue_hourly").count() > 0
    assert main(["validate", "--lake", lake.root]) == 0
    out = capsys.readouterr().out
    assert "Overall: " in out and out.count("PASS") + out.count("WARN") == 9
