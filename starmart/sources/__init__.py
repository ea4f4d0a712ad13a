from starmart.sources.calendar import date_dimension  # noqa: F401
from starmart.sources.csv import (  # noqa: F401
    BAD_LINE,
    OPEN_QUOTE,
    ROW_ORDER,
    count_bad_lines,
    read_csv,
    read_csv_lines,
    source_order,
)
from starmart.sources.tables import (  # noqa: F401
    FOLDERS,
    Warehouse,
    current_root,
    in_folders,
    load_metrics,
    publish,
    read_folders,
    read_table,
    write_folders,
    write_table,
)
