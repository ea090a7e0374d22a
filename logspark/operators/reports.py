"""Reports over summaries and encoded events: totals, top lists, distributions, volume reduction, charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logspark.functions.scalar import bar, compression_pct, dimension_name, is_numeric, ratio, truncate_dimension


def tenth(x: Column) -> Column:
    """Rounded to one digit, halves up."""
    return F.floor(x * 10 + F.lit(0.5)) / 10


def report_totals(summaries: DataFrame, encoded: DataFrame) -> DataFrame:
    """A10. Bytes in and encoded, per cent saved, events, patterns and templates."""
    s = summaries.agg(F.sum("summaryBytes").alias("input_bytes"), F.sum("summaryVolume").alias("events"), F.count_distinct("message_pattern").alias("patterns"))
    e = encoded.agg(F.sum(F.octet_length("encoded")).alias("encoded_bytes"), F.count_distinct("template_hash").alias("templates"))
    both = s.join(F.broadcast(e))  # one row each
    return both.withColumn("compression", tenth(compression_pct("encoded_bytes", "input_bytes")))


def with_share(df: DataFrame, value: str, partition: str | None = None, out: str = "share") -> DataFrame:
    """W9. Per cent of the total, or of the group's total, to one digit; 0 where the total is 0."""
    keys = [partition] if partition else []
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    held = df.join(totals, keys) if keys else df.join(F.broadcast(totals))  # one row
    return held.withColumn(out, F.when(F.col("_total") > 0, tenth(F.col(value) * 100 / F.col("_total"))).otherwise(0.0)).drop("_total")


def distributions(summaries: DataFrame, fields: list[str]) -> DataFrame:
    """A11, C22, C23. Bytes and volume of each value of each dimension, and its share of the dimension's bytes."""
    cut = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.trim(F.col(f).cast("string")).alias("value")) for f in fields]))
    rows = summaries.select("summaryBytes", "summaryVolume", cut.alias("d")).where("d.value <> ''")
    named = rows.select(dimension_name("d.field").alias("dimension"), truncate_dimension("d.value", dimension_name("d.field")).alias("value"), "summaryBytes", "summaryVolume")
    sums = named.groupBy("dimension", "value").agg(F.sum("summaryBytes").alias("bytes"), F.sum("summaryVolume").alias("volume"))
    return with_share(sums, "bytes", "dimension")


def sort_distribution(dist: DataFrame) -> DataFrame:
    """T4."""
    return dist.orderBy("dimension", F.desc("bytes"), "value")


def top_n(df: DataFrame, value: str, n: int, tie: str) -> DataFrame:
    """T2."""
    return df.orderBy(F.desc(value), tie).limit(n)


def with_rank(df: DataFrame, value: str, tie: str) -> DataFrame:
    """W10. Rank of the rows of a top list; use it after top_n, as all rows come together."""
    return df.withColumn("rank", F.row_number().over(W.orderBy(F.desc(value), tie)))


def top_patterns(summaries: DataFrame, n: int = 10, service: str = "user_service") -> DataFrame:
    """T3. Patterns by bytes with their share of all bytes."""
    sums = summaries.groupBy("message_pattern", F.col(service).alias("user_service")).agg(F.sum("summaryBytes").alias("bytes"), F.sum("summaryVolume").alias("volume"))
    cut = with_share(sums, "bytes").orderBy(F.desc("bytes"), "message_pattern", "user_service").limit(n)
    return cut.select(F.left("message_pattern", F.lit(200)).alias("pattern"), F.left("user_service", F.lit(40)).alias("service"), "bytes", "volume", "share")


def template_volume(encoded: DataFrame) -> DataFrame:
    """A12. Events, encoded bytes, their average and the reduction ratio of each template."""
    sums = encoded.groupBy("template_hash").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("encoded")).alias("bytes"), F.min_by("template", "seq").alias("template"))
    return sums.withColumn("average", F.col("bytes") / F.col("n")).withColumn("ratio", ratio(F.length("template"), F.col("average")))


def top_templates(volume: DataFrame, n: int = 10) -> DataFrame:
    """T5. Templates of two or more events by ratio times count."""
    return volume.where("n >= 2").withColumn("score", F.col("ratio") * F.col("n")).orderBy(F.desc(F.round("score", 6)), "template_hash").limit(n)


def volume_reduction(encoded: DataFrame, templates: int = 10) -> DataFrame:
    """A19. Bytes before and after over the chosen templates."""
    top = top_templates(template_volume(encoded), templates)
    return top.agg(F.count(F.lit(1)).alias("templates"), F.sum("n").alias("events"), F.sum(F.length("template") * F.col("n")).alias("orig_bytes"), F.sum("bytes").alias("enc_bytes"))


def first_n_per_key(df: DataFrame, key: str, order: str, n: int) -> DataFrame:
    """W5."""
    return df.withColumn("_rank", F.row_number().over(W.partitionBy(key).orderBy(order))).where(F.col("_rank") <= n).drop("_rank")


def chart(df: DataFrame, name: str, value: str, n: int = 10, width: int = 40) -> DataFrame:
    """T2, T8, W10, P15. Top rows with rank, bar and whole per cent of the total; rows whose value isn't a number are left out."""
    rows = df.where(is_numeric(value)).select(F.col(name).alias("name"), F.col(value).cast("long").alias("value"))
    total = rows.agg(F.sum("value").alias("total"))  # one row
    top = with_rank(top_n(rows, "value", n, "name"), "value", "name").join(F.broadcast(total))
    return top.select("rank", "name", "value", F.when(F.col("total") > 0, F.floor(F.col("value") * 100 / F.col("total"))).otherwise(0).cast("long").alias("pct"), bar("value", "total", width).alias("bar"))
