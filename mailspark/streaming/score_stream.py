"""ST1: scoring raw text on a stream.

The scorer is stateless, so no watermark or state is needed: each
micro-batch goes through the same batch scorer in ``foreachBatch`` (the
broadcast join to the model table and the per-document sum stay batch
operators). Each batch is written to its own ``batch_id=`` folder in
overwrite mode, so a replayed batch after a failure replaces its own output
instead of duplicating it. A commit record, written once a batch's rows are
all there, makes them visible to ``read_scores``. Checkpoints live under
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailspark.operators.model import TextModel
from mailspark.plans.train import score_docs
from mailspark.session import hadoop_path_exists_dir, scratch_table_path
from mailspark.sources.mail_format import register

COMMITS = "_commits"


def mail_folder_stream(spark: SparkSession, path: str, log_path: str | None = None) -> DataFrame:
    """Streaming twin of S1: ``(doc_id, file_name, text)`` per new ``*.txt``
    file, empty ones too. ``log_path`` keeps which files each batch has; a
    query that is to go on after a restart needs the same one again, next to
    its checkpoint."""
    register(spark)
    return spark.readStream.format("mails").option("log", log_path or scratch_table_path(spark, "mail-log")).load(path)


def start_scoring(
    stream: DataFrame,
    model: TextModel,
    out_path: str,
    keep=("doc_id",),
    checkpoint: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
):
    """Start the scoring query; returns the ``StreamingQuery``."""
    spark = stream.sparkSession
    keep = tuple(keep)

    def batch(df: DataFrame, batch_id: int):
        score_docs(df, model, keep=keep).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        done = df.sparkSession.createDataFrame([(batch_id,)], "batch BIGINT")
        done.coalesce(1).write.mode("overwrite").parquet(f"{out_path}/{COMMITS}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint or scratch_table_path(spark, "score-stream-ckpt"))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_scores(spark: SparkSession, out_path: str, schema=None) -> DataFrame:
    """The rows of all committed batches with their ``batch_id``. A batch that
    was being written when its query stopped is not among them. ``schema``: of
    the rows, needed where no batch may be committed yet."""
    commits = f"{out_path}/{COMMITS}"
    ids = []
    if hadoop_path_exists_dir(spark, commits):
        ids = [r["batch"] for r in spark.read.parquet(commits).select("batch").collect()]  # one row a batch
    if not ids:
        if schema is None:
            raise ValueError(f"no batch is committed in {out_path}")
        return spark.createDataFrame([], schema).withColumn("batch_id", F.lit(None).cast("int"))
    r = spark.read.option("basePath", out_path)
    return (r.schema(schema) if schema else r).parquet(*[f"{out_path}/batch_id={i}" for i in sorted(ids)])
