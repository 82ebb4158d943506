from encore.sources.attributes import (
    ATTRIBUTE_TYPES,
    attribute_types,
    read_attributes,
    read_feature_set,
    read_feature_sets,
    schema_from_attributes,
)
from encore.sources.counts import line_counts, row_counts
from encore.sources.delimited import read_delimited, write_delimited
from encore.sources.logs import parse_correction_log, read_log_lines

__all__ = [
    "ATTRIBUTE_TYPES",
    "attribute_types",
    "line_counts",
    "parse_correction_log",
    "read_attributes",
    "read_delimited",
    "read_feature_set",
    "read_feature_sets",
    "read_log_lines",
    "row_counts",
    "schema_from_attributes",
    "write_delimited",
]
