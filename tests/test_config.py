import datetime as dt

import pytest

from meetmart.config import RunConfig
from meetmart.session import sized_for


def test_arguments():
    cfg = RunConfig.from_args(
        ["run_date=2025-07-10", "--gold_path=s3://b/x?a=1=2", "multiline=false"]
    )
    assert cfg.gold_path == "s3://b/x?a=1=2" and cfg.multiline is False
    assert cfg.run_date == "2025-07-10"


def test_run_date_defaults_to_yesterday():
    yesterday = dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)
    assert RunConfig.from_args([]).run_date == yesterday.isoformat()


def test_large_runs_start_with_many_shuffle_partitions():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert RunConfig.from_args(["input_gb=100000"]).input_gb == 100_000
    assert sized_for(1)[key] == "200" and sized_for(5_000)[key] == "10000"
    assert sized_for(100_000)[key] == "200000"


@pytest.mark.parametrize("bad", ["bronze=x", "gold_path", "run_date=10.07.2025", "multiline=si"])
def test_bad_arguments_are_rejected(bad):
    with pytest.raises(ValueError):
        RunConfig.from_args([bad])
