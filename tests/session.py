"""A local session for tests."""

from pyspark.sql import SparkSession

from opinion_engine.session import configure


def local_session() -> SparkSession:
    builder = (SparkSession.builder.master("local[8]").appName("opinion-engine-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "8g")
               .config("spark.sql.maxMetadataStringLength", "1000")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
