import duckdb
import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )


@pytest.fixture(scope="session")
def con():
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con
