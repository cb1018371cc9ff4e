"""Schemas, column names and the table-name catalog shared by writers and readers."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the reference's behaviour) -------------------
# Chart rows (the batch jobs' CSV input); every column is read as text.
CHART_COLUMNS = [
    "country", "track_name", "uri", "streams", "release_date",
    "artist_genre", "artist_individual", "artist_id", "danceability", "energy",
]

# Event message fields, in order, with their types (all nullable).
EVENT_FIELD_TYPES = [
    ("event_id", "string"),
    ("user_id", "string"),
    ("track_id", "string"),
    ("artist_id", "string"),
    ("created_at", "string"),
    ("tweet_text_entities", "string"),
    ("tweet_language", "string"),
    ("user_language", "string"),
    ("time_zone", "string"),
    ("coordinates_geojson", "string"),
    ("place_geojson", "string"),
    ("geo_geojson", "string"),
    ("music_instrumentalness", "double"),
    ("music_liveness", "double"),
    ("music_speechiness", "double"),
    ("music_danceability", "double"),
    ("music_valence", "double"),
    ("music_loudness", "double"),
    ("music_tempo", "double"),
    ("music_acousticness", "double"),
    ("music_energy", "double"),
    ("music_mode", "string"),
    ("music_key", "string"),
]

# Source CSV column -> event message field (the simulator's rename map).
EVENT_SOURCE_RENAMES = [
    ("id", "event_id"),
    ("user_id", "user_id"),
    ("track_id", "track_id"),
    ("artist_id", "artist_id"),
    ("created_at", "created_at"),
    ("entities", "tweet_text_entities"),
    ("tweet_language", "tweet_language"),
    ("user_lang", "user_language"),
    ("time_zone", "time_zone"),
    ("coordinates", "coordinates_geojson"),
    ("place", "place_geojson"),
    ("geo", "geo_geojson"),
    ("instrumentalness", "music_instrumentalness"),
    ("liveness", "music_liveness"),
    ("speechiness", "music_speechiness"),
    ("danceability", "music_danceability"),
    ("valence", "music_valence"),
    ("loudness", "music_loudness"),
    ("tempo", "music_tempo"),
    ("acousticness", "music_acousticness"),
    ("energy", "music_energy"),
    ("mode", "music_mode"),
    ("key", "music_key"),
]

PROCESSING_TIME_COLUMN = "processing_timestamp_utc"

# Result table names; one catalog used by publishers and readers alike.
TOP_SONGS_ALL_TIME = "top_songs_all_time"
TOP_SONG_2020 = "top_song_2020"
TOP_GENRE_ALL_TIME = "top_genre_all_time"
TOP_ARTIST_PER_GENRE = "top_artist_per_genre"
ENERGY_PER_COUNTRY = "energy_per_country"
DAILY_CHARTS = "daily_charts"
ALL_COUNTRIES = "All Countries"

# Live feed columns (one row per received event).
FEED_TRACK_ID = "track ID"
FEED_TRACK_NAME = "track name"
FEED_TIME = "timestamp"

# Nested chart document (one JSON object per landing file line).
CHART_DOCUMENT_SCHEMA = T.StructType([
    T.StructField("chartEntryViewResponses", T.ArrayType(T.StructType([
        T.StructField("entries", T.ArrayType(T.StructType([
            T.StructField("chartEntryData", T.StructType([
                T.StructField("currentRank", T.LongType(), True),
            ]), True),
            T.StructField("trackMetadata", T.StructType([
                T.StructField("trackName", T.StringType(), True),
                T.StructField("artists", T.ArrayType(T.StructType([
                    T.StructField("name", T.StringType(), True),
                ])), True),
            ]), True),
        ])), True),
    ])), True),
])

# Result tables and their columns.
REFERENCE_RESULT_SCHEMAS = {
    TOP_SONGS_ALL_TIME: "country string, track_name string, uri string, total_streams bigint",
    TOP_SONG_2020: "country string, track_name string, total_streams bigint",
    TOP_GENRE_ALL_TIME: "country string, genre string, total_streams bigint",
    TOP_ARTIST_PER_GENRE: "genre string, artist string, artist_id string, total_streams bigint",
    ENERGY_PER_COUNTRY: "country string, avg_danceability double, avg_energy double",
    DAILY_CHARTS: "Rank bigint, Artist string, TrackName string",
}
# ---------------------------------------------------------------------------

# Live "now playing" table of the T7 stream (this library's own name).
NOW_PLAYING = "now_playing"

RESULT_SCHEMAS = {
    **REFERENCE_RESULT_SCHEMAS,
    NOW_PLAYING: f"event_id string, `{FEED_TRACK_ID}` string, created_at string",
}

EVENT_SCHEMA = T.StructType([
    T.StructField(n, T.DoubleType() if t == "double" else T.StringType(), True)
    for n, t in EVENT_FIELD_TYPES])

EVENT_FIELDS = [n for n, _ in EVENT_FIELD_TYPES]
EVENT_DOUBLE_FIELDS = [n for n, t in EVENT_FIELD_TYPES if t == "double"]

CHART_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in CHART_COLUMNS])

