"""Tables in a folder of a test."""


def benchmark_at(spark, folder, items):
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
