"""One schema per table; ``sources.tables.load_table`` checks files against them."""

from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in columns.items()])


_LONG, _TEXT, _DATE, _DOUBLE = T.LongType(), T.StringType(), T.DateType(), T.DoubleType()
_EVENTS = _struct(user_id=_LONG, track_id=_LONG, listen_count=_LONG, last_listen=_DATE)
_MATRIX = _struct(user_idx=T.IntegerType(), item_idx=T.IntegerType(), weight=T.FloatType())

SCHEMAS = {
    # raw input
    "tracks": _struct(
        track_id=_LONG,
        albums=T.ArrayType(_LONG),
        artists=T.ArrayType(_LONG),
        genres=T.ArrayType(_LONG),
    ),
    "catalog_names": _struct(id=_LONG, type=_TEXT, name=_TEXT),
    "interactions": _struct(
        user_id=_LONG, track_id=_LONG, track_seq=_LONG, started_at=T.TimestampType()
    ),
    # preprocessed
    "items": _struct(
        track_id=_LONG,
        artist_id=_LONG,
        album_id=_LONG,
        genre_id=_LONG,
        track_clean=_TEXT,
        track_group_id=_LONG,
        artist_clean=_TEXT,
        album_clean=_TEXT,
        genre_clean=_TEXT,
    ),
    "tracks_catalog_clean": _struct(
        track_id=_LONG,
        track_clean=_TEXT,
        track_group_id=_LONG,
        artist_id=_LONG,
        album_id=_LONG,
        genre_id=_LONG,
    ),
    "events": _EVENTS,
    "train_events": _EVENTS,
    "test_events": _EVENTS,
    "user_encoder": _struct(user_id=_LONG, user_idx=T.IntegerType()),
    "item_encoder": _struct(track_id=_LONG, item_idx=T.IntegerType()),
    "train_matrix": _MATRIX,
    "test_matrix": _MATRIX,
    # results
    "popularity_track_scores": _struct(track_id=_LONG, popularity_score=_DOUBLE),
    "top_popular": _struct(
        track_id=_LONG,
        popularity_score=_DOUBLE,
        track_clean=_TEXT,
        artist_id=_LONG,
        track_group_id=_LONG,
    ),
    "personal_als": _struct(
        user_id=_LONG, track_id=_LONG, score=T.FloatType(), rank=T.IntegerType()
    ),
    "similar": _struct(
        track_id=_LONG, similar_track_id=_LONG, similarity_score=_DOUBLE, rank=T.IntegerType()
    ),
    "recommendations": _struct(
        user_id=_LONG,
        track_id=_LONG,
        als_score=_DOUBLE,
        popularity_score=_DOUBLE,
        genre_popularity=_DOUBLE,
        artist_popularity=_DOUBLE,
        track_group_size=_DOUBLE,
        target=T.ByteType(),
        score=_DOUBLE,
        rank=T.IntegerType(),
    ),
}
