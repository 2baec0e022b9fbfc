"""Written intermediates leave no shuffle files behind."""

from pyspark.sql import functions as F

from tillwise import workspace


def shuffles(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(f.getName().startswith("shuffle_") for f in (files.apply(i) for i in range(files.size())))


def test_shuffles_of_a_written_table_are_dropped(spark):
    spark.sparkContext._jvm.System.gc()
    rows = spark.range(5_000).groupBy((F.col("id") % 900).alias("k")).agg(F.sum("id").alias("n")).repartition(5, "n")
    before = shuffles(spark)
    made = workspace.materialise(rows, "dropped")
    assert shuffles(spark) <= before
    # The frame itself can still be read, and so can what was written.
    assert rows.count() == made.count() == 900
    assert made.agg(F.sum("n")).first()[0] == 5_000 * 4_999 // 2


def test_a_sessions_own_setting_is_kept(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(name, None) is None
    workspace.materialise(spark.range(3), "kept")
    assert spark.conf.get(name, None) is None
    spark.conf.set(name, "false")
    try:
        workspace.materialise(spark.range(3), "kept")
        assert spark.conf.get(name) == "false"
    finally:
        spark.conf.unset(name)
