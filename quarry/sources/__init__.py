from quarry.sources.layouts import publish_bucketed, publish_by_month
from quarry.sources.sinks import (export_folder, month_partitions, preview, read_csv,
                                  write_by_month, write_csv, write_parquet)
from quarry.sources.tables import SCHEMAS, Tables, load, register_views, table_path

__all__ = ["SCHEMAS", "Tables", "load", "register_views", "table_path", "write_csv",
           "write_parquet", "read_csv", "export_folder", "preview", "write_by_month",
           "month_partitions",
           "publish_bucketed", "publish_by_month"]
