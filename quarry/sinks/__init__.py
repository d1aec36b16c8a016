"""Writers for result DataFrames (SNK1–SNK6)."""

from quarry.sinks.publish import publish, published_folder, read_published, versions
from quarry.sinks.writers import (format_line, preview, write_quoted_csv, write_report,
                                  write_sorted_lines, write_tsv)

__all__ = ["format_line", "preview", "publish", "published_folder", "read_published", "versions",
           "write_quoted_csv", "write_report", "write_sorted_lines", "write_tsv"]
