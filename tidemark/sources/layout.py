"""Where things live under a lake root the caller chooses (path templates are fixed values)."""


def snapshot_root(root: str, database: str, folder: str, table: str) -> str:
    return f"{root}/{database}/{folder}/{table}"


def transform_counts_root(root: str, database: str) -> str:
    return f"{root}/{database}/metrics/transform_counts"


def sql_errors_root(root: str, database: str) -> str:
    return f"{root}/{database}/metrics/sql_errors"


def table_status_root(root: str, database: str) -> str:
    return f"{root}/{database}/metrics/table_status"


def metrics_export_path(root: str, as_of_date: str, batch_type: str) -> str:
    return f"{root}/as_of_date={as_of_date}/{batch_type}"
