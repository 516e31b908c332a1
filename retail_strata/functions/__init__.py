from retail_strata.functions.dates import date_folder, parse_run_date, run_date_column, run_stamp
from retail_strata.functions.text import object_bucket, object_prefix, refined_name

__all__ = [
    "date_folder",
    "object_bucket",
    "object_prefix",
    "parse_run_date",
    "refined_name",
    "run_date_column",
    "run_stamp",
]
