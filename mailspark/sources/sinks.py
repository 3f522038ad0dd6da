"""Sinks: prediction lines, quality report, grid results."""

from __future__ import annotations

from pyspark.sql import DataFrame

from mailspark.functions.text import prediction_line


def prediction_lines(pred: DataFrame, name_col: str = "file_name") -> DataFrame:
    """One ``<label>, "<name>"`` line per scored document."""
    return pred.select(prediction_line("prediction", name_col).alias("value"))


def write_prediction_lines(pred: DataFrame, path: str, name_col: str = "file_name") -> None:
    """Text files of prediction lines, overwritten (one file per task;
    no single-writer bottleneck)."""
    prediction_lines(pred, name_col).write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Quality report or grid results as Parquet or JSON."""
    df.write.mode("overwrite").format(fmt).save(path)


def report_lines(report: DataFrame, ridge: float, words_to_keep: int, vectorizer: str = "TF_IDF", confusion: DataFrame | None = None) -> DataFrame:
    """S6 as text: ``(n, value)`` lines of a quality report, the settings
    first, then accuracy, kappa, weighted F and per-class precision, recall
    and F, and the four cells of the ``confusion`` matrix where it is given.
    ``report`` is the long ``(class, metric, value)`` frame (a few rows)."""
    from pyspark.sql import functions as F

    order = {("accuracy", None): 2, ("kappa", None): 3, ("weighted_f", None): 4}
    per = {"precision": 0, "recall": 1, "f": 2}
    head = report.sparkSession.createDataFrame(
        [(0, "=== QUALITY ESTIMATE ==="), (1, f"settings: ridge={ridge}, words_to_keep={words_to_keep}, {vectorizer}")],
        "n INT, value STRING",
    )
    pos = F.coalesce(
        *[F.when((F.col("metric") == m) & F.col("class").isNull(), F.lit(o)) for (m, _), o in order.items()],
        F.when(F.col("class") == "ham", F.lit(10)).otherwise(F.lit(20))
        + F.coalesce(*[F.when(F.col("metric") == m, F.lit(o)) for m, o in per.items()]),
    )
    label = F.when(F.col("class").isNull(), F.col("metric")).otherwise(F.concat_ws(" ", "class", "metric"))
    body = report.select(pos.cast("int").alias("n"), F.concat(label, F.lit(": "), F.coalesce(F.col("value").cast("string"), F.lit("NULL"))).alias("value"))
    out = head.unionByName(body)
    if confusion is not None:
        n = 30 + 2 * (F.col("label") == "spam").cast("int") + (F.col("prediction") == "spam").cast("int")
        out = out.unionByName(confusion.select(n.alias("n"), F.concat(F.col("label"), F.lit(" classified as "), F.col("prediction"), F.lit(": "), F.col("n")).alias("value")))
    return out


def write_quality_report(report: DataFrame, path: str, ridge: float, words_to_keep: int, vectorizer: str = "TF_IDF", confusion: DataFrame | None = None) -> None:
    """One small text file (the report has a fixed number of lines, so a
    single ordered partition is a proven bound)."""
    report_lines(report, ridge, words_to_keep, vectorizer, confusion).orderBy("n").coalesce(1).select("value").write.mode("overwrite").text(path)
