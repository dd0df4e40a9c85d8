"""Tweet filtering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import matches_any_keyword


def tweet_filter(tweets: DataFrame, keywords: list[str], lang: str = "en") -> DataFrame:
    """Tweets in ``lang`` that match a keyword; with no keywords the language alone decides."""
    kept = tweets.where(F.col("lang") == lang)
    return kept.where(matches_any_keyword("text", keywords)) if keywords else kept
