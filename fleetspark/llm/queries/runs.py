"""op13: periodic runs of words, over texts of which every tenth is made to repeat itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.registry import query, table
from fleetspark.llm.word_runs import with_runs

WHITE = r"[\x20\x09-\x0D]+"


def looped(text: str, key: str) -> Column:
    """The text; where its id says so, with the words from some place on replaced by a loop over the first of them."""
    words = F.filter(F.split(text, WHITE), lambda w: w != "")
    h = F.crc32(F.col(key).cast("string"))
    g = F.floor(h / 10)

    def loop(row: Column) -> Column:
        # One struct, so that the words and their number are made once.
        w, n = row["words"], F.size(row["words"])
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        rest = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, 1, a), rest), " "))

    made = F.transform(F.array(F.struct(words.alias("words"))), loop)
    return F.when(h % 10 == 0, F.coalesce(F.get(made, 0), F.lit(""))).otherwise(F.col(text))


def digest(docs: DataFrame) -> DataFrame:
    """The figures of the runs of every row of ``docs`` (doc_id, text)."""
    found = with_runs(docs.select("doc_id", "text"))

    def stronger(x: Column, y: Column) -> Column:
        """The run of the greater length / period; of equals the earlier one, runs being in order."""
        return F.when(y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x)

    best = F.when(F.size("runs") > 0, F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), F.get("runs", 0), stronger))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_word_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return digest(docs.select("doc_id", looped("text", "doc_id").alias("text")))
