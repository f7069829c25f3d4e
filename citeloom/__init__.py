"""citeloom: publication records and sensor messages -> analysis-ready tables, on Spark."""

from citeloom.plans import (clean_publications, index_share, load_star, normalize_publications,
                            publications_per_year, quartile_changes, top_authors)
from citeloom.session import build_session, scratch_path, shared_root

__all__ = [
    "build_session", "clean_publications", "index_share", "load_star", "normalize_publications",
    "publications_per_year", "quartile_changes", "scratch_path", "shared_root", "top_authors",
]
