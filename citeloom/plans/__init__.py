"""Job-level plans: clean (E1), normalize (E2), star load (E3), reports."""

from citeloom.plans.analyses import (index_share, publications_per_year, quartile_changes,
                                     top_authors)
from citeloom.plans.clean import clean_publications
from citeloom.plans.integrity import split_orphans
from citeloom.plans.normalize import ARTICLE_COLUMNS, normalize_publications
from citeloom.plans.star import load_star

__all__ = [
    "ARTICLE_COLUMNS", "clean_publications", "index_share", "load_star", "normalize_publications",
    "publications_per_year", "quartile_changes", "split_orphans", "top_authors",
]
