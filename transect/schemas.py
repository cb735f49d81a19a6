"""Fixed schemas; nothing is inferred."""

from __future__ import annotations

INDEX = "set_id string, relative_path string, start_frame double, end_frame double"
PROFILE = "set_id string, relative_path string, row_index int, header binary, intensity binary, raw_heights array<int>"
SIDE = (
    "struct<depth:double,rut_x:double,rut_y:double,bar_elevation:double,bar_slope:double,left_contact_x:double,left_contact_y:double,"
    "right_contact_x:double,right_contact_y:double,support_points:int,footprint_points:int,measurement_x:double,measurement_y:double,width:double>"
)
SIDE_FIELDS = [f.split(":")[0] for f in SIDE[7:-1].split(",")]
RESULT = (
    "set_id string, relative_path string, row_index int, n_points int, is_noisy boolean, valid_fraction double, cs_percent double, cs_degrees double, "
    f"cs_intercept double, cs_r2 double, cs_points int, cs_error string, left {SIDE}, right {SIDE}, state string, row_error string, file_error string"
)
#: One row for each image file.
FILE_RESULT = (
    "set_id string, relative_path string, file_name string, start_frame double, end_frame double, left_average double, right_average double, overall_average double, "
    "cs_percent double, cs_degrees double, severity int, rows_total bigint, rows_ok bigint, rows_error bigint, rows_noisy bigint, left_count bigint, right_count bigint, "
    "cs_count bigint, cs_error_count bigint, error_samples array<string>, status string, file_error string"
)
#: Order of the columns of an exported row.
EXPORT_COLUMNS = [
    "set", "file_name", "relative_path", "starting_frame_number", "latitude", "longitude", "heading", "averaged_left_rut", "averaged_right_rut", "averaged_rut",
    "cross_slope_average_percent", "cross_slope_average_angle_degrees", "cross_slope_count", "cross_slope_error_count", "severity", "preview_png",
]
