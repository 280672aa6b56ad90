"""op8: main text of web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.html_pages import example_pages
from fleetspark.llm.html_text import train, with_main_text
from fleetspark.llm.registry import query, table


@query("op8_html_text")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = train(spark.createDataFrame([(p,) for p in example_pages()], "html string"))
    texts = with_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"), model)
    return texts.select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )
