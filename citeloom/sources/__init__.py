"""Sources and sinks."""

from citeloom.sources.readers import (explode_users, publications_from_json_lines, read_csv,
                                      read_jdbc, read_json_documents, read_parquet,
                                      read_publications)
from citeloom.sources.sinks import (claim_load, create_tables, current_load, publish_load, published_loads,
                                    read_current, read_rejected, release_claim, row_counts, write_jdbc,
                                    write_staging)

__all__ = [
    "claim_load", "create_tables", "current_load", "explode_users", "publications_from_json_lines",
    "publish_load", "published_loads", "read_csv", "read_current", "read_jdbc", "read_json_documents",
    "read_parquet", "read_publications", "read_rejected", "release_claim", "row_counts", "write_jdbc", "write_staging",
]
