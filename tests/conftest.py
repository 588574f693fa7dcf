from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checkpoints-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from claimlake.sources.driver_tables import ClaimsTables

    return ClaimsTables(spark, SF_DIR)


@pytest.fixture()
def sample_fact_data(spark):
    return spark.createDataFrame(
        [
            ("C1", "M1", 1000.0, 100.0, 900.0, "IP", "2024-01-01", "Approved", 1),
            ("C2", "M2", 2000.0, 200.0, 1800.0, "OP", "2024-01-02", "Pending", 2),
            ("C3", "M3", 3000.0, 300.0, 2700.0, "IP", "2024-01-03", "Rejected", 3),
        ],
        "claimid string, memberid string, gross double, patientshare double, "
        "netclaim double, encountertype string, bill_finalized_date string, "
        "claim_status string, center_id bigint",
    )


@pytest.fixture()
def sample_master_data(spark):
    return spark.createDataFrame(
        [
            (1, "Center A", "CA", "CTY1", "ST1", "CN1"),
            (2, "Center B", "CB", "CTY2", "ST2", "CN2"),
            (3, "Center C", "CC", "CTY3", "ST3", "CN3"),
        ],
        "center_id bigint, center_name string, center_code string, city_id string, "
        "state_id string, country_id string",
    )
