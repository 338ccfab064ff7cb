"""Sources and sinks (S1-S11) and the fixtures derived from the driver tables."""

from centrix.sources.csv import read_history, write_history
from centrix.sources.dataset import Dataset, list_datasets, load_dataset
from centrix.sources.tables import clear_table, replace_table
from centrix.sources.text import (check_dims, clean_text, load_labels, load_output,
                                  load_points, with_row_id, write_output, write_points)

__all__ = [
    "load_points", "load_labels", "with_row_id", "write_points", "write_output", "load_output",
    "clean_text", "check_dims", "load_dataset", "list_datasets", "Dataset",
    "read_history", "write_history", "replace_table", "clear_table",
]
