"""Fixed values that results depend on.

FIXED VALUES — these must stay exactly as written for results to match the
publication pipeline this library re-implements (labels stored in the
warehouse, prefixes removed from source fields). They are data, not logic.
"""

# Prefix put in front of the title to form the journal line.
JOURNAL_LINE_PREFIX = "Published in: "

# Prefix removed from publication dates before parsing ("%d %B %Y").
DATE_PREFIX = "Date of Publication: "

# Default for a missing Quartils field, and the marker looked for in it.
QUARTILS_DEFAULT = "Journal pas indexé Scopus"
NOT_INDEXED_MARKER = "pas indexé"

# Placeholder stored when an ISSN or a quartile is unknown.
NOT_AVAILABLE = "Non disponible"

# Journal flag values.
INDEXED = "indexe"
NOT_INDEXED = "pas indexe"

# Keys of a quartile item.
YEAR_KEY = "année"
QUARTILE_KEY = "quartil"
ELECTRONIC_ISSN_KEY = "Electronic ISSN"

# CiteScore thresholds -> quartile label (>= 4 Q1, >= 2 Q2, >= 1 Q3, else Q4).
CITESCORE_BANDS = ((4.0, "Q1"), (2.0, "Q2"), (1.0, "Q3"))
LOWEST_BAND = "Q4"

# English month names, as accepted by a "%B" date field.
MONTHS = ("January", "February", "March", "April", "May", "June", "July",
          "August", "September", "October", "November", "December")
