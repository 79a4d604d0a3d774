from shoplens.sinks.running import RunningTable  # noqa: F401
from shoplens.sinks.writers import (append_jdbc, append_parquet,  # noqa: F401
                                    read_jdbc, replace_table, tag_run)
