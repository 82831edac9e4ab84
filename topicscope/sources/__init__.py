"""Sources: record files, raw lines, segment catalogues, driver tables."""

from .gkg import (gkg_like, gkg_like_lines, gkg_like_table, gkg_line_records,
                  gkg_records, gkg_tsv_path, read_gkg, read_lines)
from .tables import TABLES, load_table

__all__ = ["gkg_like", "gkg_like_lines", "gkg_like_table", "gkg_line_records", "gkg_records",
           "gkg_tsv_path", "read_gkg", "read_lines", "TABLES", "load_table"]
