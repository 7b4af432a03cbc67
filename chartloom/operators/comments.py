"""Comment rows out of captured payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.payloads import legacy_comments, modern_comments
from chartloom.functions.values import comment_limit
from chartloom.operators.changes import dedup_with_id
from chartloom.operators.keyed import top_n


def payload_comments(payloads: DataFrame, keys: list[str]) -> DataFrame:
    """One row per comment of a payload (string column ``payload``).

    Both layouts are read, the modern one first; an id counts once per payload
    and rows without an id are all kept.  Unparsable payloads give no rows.
    """
    parsed = payloads.select(*keys, F.try_parse_json("payload").alias("__v"))
    both = F.concat(modern_comments(F.col("__v")), legacy_comments(F.col("__v")))
    rows = parsed.select(*keys, F.posexplode(both).alias("idx", "__c")).select(*keys, "idx", "__c.*")
    return dedup_with_id(rows, keys, "comment_id", ["idx"])


def numbered(comments: DataFrame, video: list[str], page: str, limit: int) -> DataFrame:
    """Positions running over the pages of a video, up to the comment limit."""
    return top_n(comments, video, [page, "idx"], comment_limit(limit), into="position")


def pick_candidate(comments: DataFrame, video: str, candidate: str, tries: int = 4) -> DataFrame:
    """Comments of the first of ``tries`` candidates that has any."""
    first = comments.filter(F.col(candidate) < tries).groupBy(video).agg(F.min(candidate).alias(candidate))
    return comments.join(first, [video, candidate], "left_semi")
