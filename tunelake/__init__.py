"""tunelake: music-trend analytics as plain Spark DataFrame operators.

Operators take and return ``DataFrame``s (lazy); sinks return where they wrote
(snapshot paths) and stream starters the ``StreamingQuery``. Library functions never create or stop
a ``SparkSession``; callers pass one in (only ``tunelake.cli`` and the test/bench
helper ``tunelake.session.local_session`` build one).

The names below are the public surface; the sub-packages hold the same
functions grouped by kind (``sources``, ``operators``, ``functions``,
``sinks``, ``streaming``, ``plans``).
"""

from tunelake.functions.format import (
    export_date, streams_label, thousands, time_of_day, two_decimals, with_default,
)
from tunelake.functions.text import (
    has_prefix, is_plain_number, not_plain_number, to_count, to_feature,
)
from tunelake.operators.clean import (
    CleanRules, clean, clean_chart_rows, count_rows, feature_rules, top_artist_rules,
    top_genre_rules, top_track_all_time_rules, top_track_by_year_rules,
)
from tunelake.operators.daily import (
    current_documents, flatten_chart, newest_chart, newest_documents, sorted_by_rank,
)
from tunelake.operators.position import positioned
from tunelake.operators.profile import mean_by
from tunelake.operators.rank import sum_by, top_n, top_n_per_group
from tunelake.operators.views import (
    country_options, country_slice, dashboard_view, energy_view, has_rows, headline,
    hierarchy_totals, metric_labels, metric_long, metric_pick, preview,
)
from tunelake.plans.jobs import (
    artist_genre_totals, feature_means_by_country, top_artist_by_genre, top_genre_by_country,
    top_track_all_time, top_track_by_year,
)
from tunelake.plans.refresh import refresh_results, result_tables, save_daily_chart
from tunelake.sinks.export import (
    append_messages, export_dated_csv, read_dated_csv, write_kafka, write_messages,
)
from tunelake.sinks.publish import publish, read_published, snapshot_dirs
from tunelake.sources.charts import (
    read_chart_csv, read_chart_documents, read_lenient_csv, read_lookup,
)
from tunelake.streaming.compact import compact_epochs, read_epochs
from tunelake.streaming.events import (
    decode_events, encode_events, enrich, index_lookup, keyed_pick, latest, now_playing_rows,
    random_key, rename_source_columns, store_lookup, to_values, with_key,
)
from tunelake.streaming.runner import (
    drop_replays, epoch_writer, message_writer, read_topic, run_to_end, run_until, start_append,
    start_decode, start_enrich, start_latest,
)

__version__ = "0.1.0"

__all__ = [
    # sources
    "read_chart_csv", "read_lenient_csv", "read_lookup", "read_chart_documents",
    "read_published", "read_topic", "read_epochs",
    # cleaning and column functions
    "CleanRules", "clean", "clean_chart_rows", "count_rows", "feature_rules", "top_artist_rules",
    "top_genre_rules", "top_track_all_time_rules", "top_track_by_year_rules",
    "is_plain_number", "not_plain_number", "has_prefix", "to_count", "to_feature",
    "export_date", "streams_label", "thousands", "time_of_day", "two_decimals", "with_default",
    # aggregation and ranking
    "sum_by", "top_n", "top_n_per_group", "mean_by",
    # batch jobs and publishing
    "top_track_all_time", "top_track_by_year", "top_genre_by_country", "top_artist_by_genre",
    "feature_means_by_country", "artist_genre_totals", "result_tables", "refresh_results",
    "save_daily_chart", "publish", "snapshot_dirs", "export_dated_csv",
    "read_dated_csv", "write_messages", "append_messages", "write_kafka",
    # charts and views
    "flatten_chart", "newest_chart", "newest_documents", "current_documents",
    "positioned", "sorted_by_rank", "country_options", "country_slice",
    "headline", "hierarchy_totals", "metric_pick", "metric_long", "metric_labels", "preview",
    "energy_view", "dashboard_view", "has_rows",
    # events and streams
    "rename_source_columns", "encode_events", "decode_events", "enrich", "to_values",
    "index_lookup", "keyed_pick", "random_key", "now_playing_rows", "latest",
    "store_lookup", "with_key", "message_writer", "drop_replays", "compact_epochs", "run_until",
    "epoch_writer", "start_decode", "start_enrich", "start_append", "start_latest", "run_to_end",
]
