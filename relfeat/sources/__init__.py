from relfeat.sources.tables import (
    columns_by_pattern,
    columns_by_range,
    columns_by_type,
    nan_to_null,
    scan_table,
    table_shape,
    write_feature_matrix,
    write_predictions,
)

__all__ = [
    "columns_by_pattern",
    "columns_by_range",
    "columns_by_type",
    "nan_to_null",
    "scan_table",
    "table_shape",
    "write_feature_matrix",
    "write_predictions",
]
