from pyspark.sql import functions as F

from quarry.session import materialize, shared_dir
from quarry.streaming import incremental as I


def test_rerun_without_new_files_adds_nothing(spark):
    df = spark.createDataFrame([(i, f"{i:03d}_x.pdf", f"Text {i}\n\n\nPage 2") for i in range(20)], "doc_id bigint, source string, raw_text string")
    inbox, out, ckpt = shared_dir(spark, "t-inbox"), shared_dir(spark, "t-out"), shared_dir(spark, "t-ckpt")
    df.filter(F.col("doc_id") < 10).write.parquet(f"{inbox}/b=1")
    I.run_incremental_clean(spark, inbox, df.schema, out, ckpt)
    assert I.read_output(spark, out).count() == 10
    I.run_incremental_clean(spark, inbox, df.schema, out, ckpt)  # restart, nothing new
    assert I.read_output(spark, out).count() == 10
    df.filter(F.col("doc_id") >= 10).write.parquet(f"{inbox}/b=2")
    I.run_incremental_clean(spark, inbox, df.schema, out, ckpt)
    got = I.read_output(spark, out)
    assert got.count() == 20 and got.select("doc_id").distinct().count() == 20
    assert got.filter(F.col("doc_id") == 3).first()["cleaned"] == "Text 3"


def test_phase_outputs_live_in_the_checkpoint_folder(spark):
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(base.rstrip("/") + "/quarry/")
    df = materialize(spark.range(5), "t-phase")
    assert df.count() == 5 and base in df.inputFiles()[0]
