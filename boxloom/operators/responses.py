"""From raw model responses to accepted tags and captions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.functions import text as T


def parse_responses(responses: DataFrame) -> DataFrame:
    """Tags and caption of each response and whether each is acceptable."""
    read = responses.withColumn("tags", T.parse_tags(F.col("response"))).withColumn("caption", T.parse_caption(F.col("response")))
    return read.withColumn("tags_valid", T.tags_valid(F.col("tags"))).withColumn(
        "caption_valid", T.caption_valid(F.col("caption"))).withColumn("valid", F.col("tags_valid") & F.col("caption_valid"))


def retry_merge(parsed: DataFrame, images: DataFrame, attempts: int = 2) -> DataFrame:
    """The first acceptable response among the first ``attempts`` of each image; images without one failed.
    ``attempt`` counts from 0."""
    good = parsed.where(F.col("valid") & (F.col("attempt") < attempts))
    first = good.groupBy("image_id").agg(F.min_by(F.struct("attempt", "tags", "caption"), "attempt").alias("r"))
    return images.select("image_id").join(first, "image_id", "left").select(
        "image_id", F.when(F.col("r").isNotNull(), "ok").otherwise("failed").alias("status"), "r.attempt", "r.tags", "r.caption")
