"""Declared input and output shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.functions.values import nan_to_null

# ---- fixed values -----------------------------------------------------------
N_MFCC = 20
CLIP_PAIRS = (
    "chroma_stft", "rms", "spectral_centroid", "spectral_bandwidth", "rolloff",
    "zero_crossing_rate", "harmony", "perceptr",
)
AUDIO_FIELDS = (
    ["length"]
    + [f"{name}_{stat}" for name in CLIP_PAIRS for stat in ("mean", "var")]
    + ["tempo"]
    + [f"mfcc{i}_{stat}" for i in range(1, N_MFCC + 1) for stat in ("mean", "var")]
)
FEATURE_HEADER = ["filename", *AUDIO_FIELDS, "label"]
FEATURE_BASE_COLUMNS = ("year", "place", "name", "artist", "link", "popularity")
CATALOGUE_KEY_COLUMNS = ("year", "place", "name", "artist", "link", "spotify_track_id", "popularity")
# -----------------------------------------------------------------------------

AUDIO_STRUCT = "struct<" + ",".join(f"{f}:{'bigint' if f == 'length' else 'double'}" for f in AUDIO_FIELDS) + ">"
CHART_ROWS = "name string, artist string, year string, place string, link string"
CATALOGUE_IDS = CHART_ROWS + ", spotify_track_id string, popularity bigint"
SONGS = CATALOGUE_IDS + ", lyrics string, genius_status string, genius_pageviews bigint, genius_release_date string"
AUDIO_SONGS = (
    SONGS + f", audio_metadata {AUDIO_STRUCT}, audio_metadata_status string, audio_preview_url string,"
    " audio_metadata_source string"
)
VIDEO_LINKS = (
    "youtube_id string, youtube_url string,"
    " youtube_candidates array<struct<youtube_id:string,youtube_url:string>>, name string, artist string, year string"
)
COMMENTS = (
    "track_key string, track_name string, artist string, youtube_id string, comment_id string, author string,"
    " text string, like_count string, published_at string, position int"
)
AWARDS = "track_key string, track_name string, artist string, year string, source string, awards array<string>"


def require(df: DataFrame, *columns: str) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing column(s): {', '.join(absent)}")
    return df


def with_columns(df: DataFrame, ddl: dict[str, str]) -> DataFrame:
    """Add the absent columns as typed NULLs."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in ddl.items() if c not in df.columns})


def audio_struct(source: dict[str, Column]) -> Column:
    """The fixed 58-field struct; fields the source lacks are NULL."""
    return F.struct(
        *[
            source.get(f, F.lit(None)).cast("bigint" if f == "length" else "double").alias(f)
            for f in AUDIO_FIELDS
        ]
    )


def ordered_values(struct: Column, header: list[str]) -> Column:
    """Values as an array in header order."""
    return F.array(*[struct[f].cast("double") for f in header])

def clean_nans(df: DataFrame) -> DataFrame:
    """NaN -> NULL in every float, those in structs and arrays included; run after each read."""
    return df.withColumns({f.name: without_nan(F.col(f.name), f.dataType) for f in df.schema.fields if has_floats(f.dataType)})


def has_floats(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return has_floats(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(has_floats(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.DoubleType, T.FloatType))


def without_nan(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(c)
    if isinstance(kind, T.ArrayType) and has_floats(kind):
        return F.transform(c, lambda x: without_nan(x, kind.elementType))
    if isinstance(kind, T.StructType) and has_floats(kind):
        return F.when(c.isNotNull(), F.struct(*[without_nan(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    return c
