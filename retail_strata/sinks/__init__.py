from retail_strata.sinks.files import preview, write_csv, write_fanout
from retail_strata.sinks.tables import new_run_id, publish, write_dated, write_layer

__all__ = ["new_run_id", "preview", "publish", "write_csv", "write_dated", "write_fanout", "write_layer"]
