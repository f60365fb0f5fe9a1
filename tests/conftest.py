import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("weblode-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Evaluate a column expression over texts."""

    def run(texts, expression, kind="string"):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {kind}")
        from pyspark.sql import functions as F

        return [r["y"] for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]

    return run
