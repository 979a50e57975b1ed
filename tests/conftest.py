import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "6g")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def apply(spark):
    """Values of a Column function over a list of texts."""
    from pyspark.sql import functions as F

    def run(fn, values, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r[0] for r in rows.orderBy("i").select(fn(F.col("v")).alias("out")).collect()]

    return run
