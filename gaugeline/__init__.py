"""Exact per-key minimum, mean and maximum over very large measurement files."""

from gaugeline.operators.compare import diff_by_position, diff_by_station, diff_summary
from gaugeline.operators.generate import city_integers, generate_measurements, measurement_ids
from gaugeline.operators.leaderboard import leaderboard, upper_median
from gaugeline.operators.names import estimate_file_size, name_limits, station_names
from gaugeline.operators.order import with_position
from gaugeline.operators.parse import measurements, parse_lines, reject_counts
from gaugeline.operators.stats import (
    aggregate_state,
    finalize,
    frame_rejects,
    frame_stats,
    measurement_state,
    merge_states,
    report,
    state_text,
    station_state,
    summarize_lines,
)
from gaugeline.session import drop_intermediate
from gaugeline.sources.files import (
    csv_fields,
    read_csv_measurements,
    read_lines,
    read_report,
    read_state,
    write_measurements,
    write_report,
    write_state,
)

__all__ = [
    "aggregate_state",
    "city_integers",
    "csv_fields",
    "diff_by_position",
    "diff_by_station",
    "diff_summary",
    "drop_intermediate",
    "estimate_file_size",
    "finalize",
    "frame_rejects",
    "frame_stats",
    "generate_measurements",
    "leaderboard",
    "measurement_ids",
    "measurement_state",
    "measurements",
    "merge_states",
    "name_limits",
    "parse_lines",
    "read_csv_measurements",
    "read_lines",
    "read_report",
    "read_state",
    "reject_counts",
    "report",
    "state_text",
    "station_names",
    "station_state",
    "summarize_lines",
    "upper_median",
    "with_position",
    "write_measurements",
    "write_report",
    "write_state",
]
