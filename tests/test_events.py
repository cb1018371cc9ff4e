"""Event encode/decode semantics (X3, X4, X7, R11, R12) and batch/stream parity."""

import json

from pyspark.sql import functions as F

from tunelake.schema import EVENT_FIELDS
from tunelake.streaming.events import decode_events, encode_events, enrich, to_values

LINES = ['{bad', '[]', 'null', '', None,
         '{"event_id": 5}',                        # number in a string field
         '{"event_id": "e", "music_tempo": "fast"}',  # text in a double field
         '{"track_id": {"a": 1}}',                 # object in a string field
         '{"event_id": "e2", "unknown": 1}']       # unknown key ignored


def _decoded(spark, on_bad="keep"):
    df = spark.createDataFrame([(v,) for v in LINES], "value string")
    return decode_events(df, on_bad=on_bad)


def test_malformed_lines_keep_all_null_rows(spark):
    rows = _decoded(spark).collect()
    assert len(rows) == len(LINES)
    all_null = [r for r in rows if all(r[c] is None for c in EVENT_FIELDS)]
    assert len(all_null) == 5


def test_field_level_failures(spark):
    rows = [r for r in _decoded(spark).collect() if any(r[c] is not None for c in EVENT_FIELDS)]
    by = {(r.event_id, r.track_id): r for r in rows}
    assert ("5", None) in by                      # number kept as its text
    assert by[("e", None)].music_tempo is None     # bad double -> null field only
    assert json.loads(by[(None, '{"a":1}')].track_id) == {"a": 1}
    assert ("e2", None) in by


def test_drop_mode_removes_only_all_null_rows(spark):
    assert _decoded(spark, "drop").count() == len(LINES) - 5


def test_encode_omits_null_and_nan(spark):
    df = spark.createDataFrame([("1", float("nan"), 0.5), ("2", None, None)],
                               "event_id string, music_energy double, music_tempo double")
    vals = [json.loads(r.value) for r in encode_events(df).collect()]
    assert vals == [{"event_id": "1", "music_tempo": 0.5}, {"event_id": "2"}]


def test_enrich_stamps_one_value_per_batch(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("event_id"))
    out = enrich(df)
    assert out.select("processing_timestamp_utc").distinct().count() == 1
    # an all-null row encodes to the stamp only
    one = to_values(enrich(_decoded(spark).limit(1))).collect()[0].value
    assert list(json.loads(one)) == ["processing_timestamp_utc"]
