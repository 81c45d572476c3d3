from pyspark.sql import functions as F

from turnlake.session import new_folder
from turnlake.sources import records


def test_parts_are_split_as_they_grow(spark):
    rows = spark.range(0, 4000, 1, 8).select(F.col("id").cast("string").alias("conversation_id"), F.sha2(F.col("id").cast("string"), 256).alias("prompt_text"))
    small, large = new_folder(spark, "small"), new_folder(spark, "large")
    assert records.write_parts(rows.limit(40), small, 3, "conversation_id") == 3
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        files = records.write_parts(rows, large, 3, "conversation_id")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert files > 3
    back = records.read_records(spark, large).select("conversation_id", "prompt_text")
    assert back.count() == 4000 and back.exceptAll(rows).isEmpty()
    most = back.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert most < 1000
