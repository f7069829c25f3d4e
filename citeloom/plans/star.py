"""E3: load articles into the star schema, set-based.

Per output table:

* ``dim_journal``        lookup-or-insert, first writer (load order) wins
* ``journal_quartile``   MERGE on (annee, id_journal), last writer wins
* ``fact_publication``   append (optionally idempotent on title + DOI)
* ``dim_author``         lookup-or-insert of author names
* ``publication_author`` bridge rows, distinct
* ``dim_date``           dates of the loaded publications
* ``quarantine``         rejected articles with their reason

Surrogate keys continue after the current maximum and follow first
appearance in load order (dates follow the calendar).
"""

from __future__ import annotations

import threading
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.functions.dates import date_parts
from citeloom.operators.dimension import lookup_or_insert
from citeloom.operators.facts import bridge_rows, not_loaded, resolve_key
from citeloom.operators.keys import assign_keys
from citeloom.operators.upsert import merge_last_wins, merge_touched
from citeloom.schemas import FACT_PUBLICATION, STAR_TABLES, empty_table
from citeloom.session import written
from citeloom.sources.sinks import bucket_of


#: Identifies an article's row while a load runs; fixed when the articles are written.
ROW_ID = "__row_id"


class _Current(Mapping):
    """The tables before a load; missing ones are empty. Tables are asked for one at a time, so
    that a ``StarLoad`` given as the current state builds only those that are needed."""

    def __init__(self, spark, tables: Mapping[str, DataFrame] | None):
        self._spark, self._tables = spark, tables or {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in STAR_TABLES:
            raise KeyError(name)
        return self._tables[name] if name in self._tables else empty_table(self._spark, name)

    def __iter__(self):
        return iter(STAR_TABLES)

    def __len__(self) -> int:
        return len(STAR_TABLES)


def journal_candidates(articles: DataFrame) -> DataFrame:
    """Articles that reach journal creation (no failure before it)."""
    return articles.where(F.col("reject_stage").isNull() | (F.col("reject_stage") == "after_journal"))


def _matcher(journal_match: str):
    """How journal names are compared: 'exact' (binary) or 'lower' (case-insensitive)."""
    if journal_match == "exact":
        return None
    if journal_match == "lower":
        return F.lower
    raise ValueError(f"unknown journal_match {journal_match!r}")


def load_journals(articles: DataFrame, dim_journal: DataFrame, journal_match: str = "exact") -> DataFrame:
    return insert_journals(articles, dim_journal, journal_match)[0]


def insert_journals(articles: DataFrame, dim_journal: DataFrame, journal_match: str = "exact"
                    ) -> tuple[DataFrame, DataFrame]:
    """(the dimension after the load, the rows the load adds)."""
    cands = journal_candidates(articles).select(
        F.col("journal_name").alias("journal_main"), "issn",
        F.col("journal_flag").alias("quartils"), "load_order")
    return lookup_or_insert(dim_journal, cands, "journal_main", "journal_id", order_by=["load_order"],
                            match=_matcher(journal_match))


def quartile_source(articles: DataFrame, dim_journal: DataFrame, salt_buckets: int | None = None,
                    journal_match: str = "exact") -> DataFrame:
    items = (journal_candidates(articles)
             .select("journal_name", "load_order", F.explode("quartile_items").alias("it"))
             .select("journal_name", "load_order", F.col("it.pos").alias("pos"),
                     F.col("it.annee").alias("annee"), F.col("it.quartil").alias("quartil")))
    return (resolve_key(items, dim_journal, "journal_name", "journal_main", "journal_id",
                        salt_buckets=salt_buckets, salt_by="load_order", match=_matcher(journal_match))
            .withColumnRenamed("journal_id", "id_journal"))


def load_quartiles(articles: DataFrame, dim_journal: DataFrame, journal_quartile: DataFrame,
                   salt_buckets: int | None = None, journal_match: str = "exact") -> DataFrame:
    return merge_last_wins(journal_quartile, quartile_source(articles, dim_journal, salt_buckets, journal_match),
                           keys=["annee", "id_journal"], values=["quartil"],
                           order_by=["load_order", "pos"], key_col="quartil_id")


def keyed_publications(articles: DataFrame, dim_journal: DataFrame, fact_publication: DataFrame,
                       idempotent: bool = False, salt_buckets: int | None = None,
                       journal_match: str = "exact") -> DataFrame:
    """New publications with their surrogate key (and their author list). ``articles`` are written
    rows with their ``ROW_ID``."""
    good = articles.where(F.col("reject_reason").isNull())
    # Only the order and the journal's key travel through the joins, the range shuffle and the
    # checkpoint; titles, abstracts and authors are read and join their keys afterwards. The row id
    # parts repeated and missing load orders.
    narrow = good.select(ROW_ID, "load_order", "journal_name", *(("title", "doi") if idempotent else ()))
    rows = resolve_key(narrow, dim_journal, "journal_name", "journal_main", "journal_id",
                       salt_buckets=salt_buckets, salt_by="load_order", match=_matcher(journal_match))
    new = not_loaded(rows, fact_publication, ["title", "doi"]) if idempotent else rows
    keys = assign_keys(new.select(ROW_ID, "load_order", "journal_id"), "publication_id", ["load_order", ROW_ID],
                       after=fact_publication)
    return good.join(keys.select(ROW_ID, "publication_id", "journal_id"), ROW_ID).select(
        "load_order", "title", "doi", "publication_date", "link", "abstract", "journal_id",
        F.col("last_quartil").alias("quartils"), "authors", "publication_id")


def load_authors(keyed: DataFrame, dim_author: DataFrame) -> DataFrame:
    return insert_authors(keyed, dim_author)[0]


def insert_authors(keyed: DataFrame, dim_author: DataFrame) -> tuple[DataFrame, DataFrame]:
    names = (keyed.select("load_order", F.posexplode("authors").alias("pos", "author_name"))
             .select("author_name", F.lit(None).cast("string").alias("affiliation"),
                     F.lit(None).cast("string").alias("country"), "load_order", "pos"))
    return lookup_or_insert(dim_author, names, "author_name", "author_id", order_by=["load_order", "pos"])


def insert_dates(new_facts: DataFrame, dim_date: DataFrame) -> tuple[DataFrame, DataFrame]:
    dates = (new_facts.select(F.col("publication_date").alias("full_date"))
             .where(F.col("full_date").isNotNull()).distinct()
             .select("full_date", *date_parts("full_date")))
    return lookup_or_insert(dim_date, dates, "full_date", "date_id")


def written_articles(articles: DataFrame) -> DataFrame:
    """The articles as a written table with their ``ROW_ID``: several loads of them decode them once."""
    return written("articles", articles.withColumn(ROW_ID, F.monotonically_increasing_id()))


def touched_quartiles(articles: DataFrame, dim_journal: DataFrame, journal_quartile: DataFrame,
                      salt_buckets: int | None = None, journal_match: str = "exact") -> DataFrame:
    """The rows after the merge of those buckets of the quartile table that the articles touch."""
    # The merge reads its source three times: for the buckets, the changed rows and the new ones.
    source = written("quartiles", quartile_source(articles, dim_journal, salt_buckets, journal_match))
    return merge_touched(journal_quartile, source,
                         keys=["annee", "id_journal"], values=["quartil"], order_by=["load_order", "pos"],
                         key_col="quartil_id", bucket=lambda: bucket_of(F.col("id_journal")))


class StarLoad(Mapping):
    """The tables of one load, each computed when first asked for.

    Keys are assigned (and the keyed rows checkpointed) only for the tables a
    caller reads, plus the ones they depend on: asking for ``dim_journal``
    alone runs one key assignment, publishing everything runs all five.
    """

    NAMES = ("dim_author", "dim_date", "dim_journal", "journal_quartile", "fact_publication",
             "publication_author", "quarantine")

    def __init__(self, articles: DataFrame, current: Mapping[str, DataFrame] | None, idempotent: bool,
                 salt_buckets: int | None = None, journal_match: str = "exact"):
        _matcher(journal_match)
        self._match = journal_match
        self._source = articles
        self._cached: DataFrame | None = None
        self._cur = _Current(articles.sparkSession, current)
        self._idempotent = idempotent
        self._salt = salt_buckets
        self._done: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.Lock] = {}
        self._guard = threading.Lock()

    @property
    def _articles(self) -> DataFrame:
        """The articles, written to the shared folder on first use: every keyed
        table reads them again (only the columns it needs), and recomputing
        the decode for each would repeat the whole upstream plan. (The
        quarantine alone reads them once, unwritten.)"""
        with self._guard:
            if self._cached is None:
                self._cached = self._source if ROW_ID in self._source.columns else written_articles(self._source)
            return self._cached

    def _get(self, name: str, build) -> DataFrame:
        # One lock per table; tables depend on each other as a DAG and locks
        # are taken along it, so concurrent builders cannot deadlock.
        with self._guard:
            lock = self._locks.setdefault(name, threading.Lock())
        with lock:
            if name not in self._done:
                self._done[name] = build()
        return self._done[name]

    def build_all(self, parallel: bool = True, added: bool = False) -> "StarLoad":
        """Build every table now (with ``added``, only the rows it adds). Independent tables are
        built concurrently (one Spark job stream per thread), in dependency waves."""
        waves = [["dim_journal"], ["journal_quartile", "fact_publication"],
                 ["dim_author", "dim_date", "quarantine"], ["publication_author"]]
        build = self.added if added else self.__getitem__
        for wave in waves:
            if parallel and len(wave) > 1:
                with ThreadPoolExecutor(max_workers=len(wave)) as pool:
                    list(pool.map(build, wave))
            else:
                for name in wave:
                    build(name)
        return self

    def _keyed(self) -> DataFrame:
        # Written: facts, authors, dates, the bridge and the integrity check all read them.
        return self._get("__keyed", lambda: written("keyed", keyed_publications(
            self._articles, self["dim_journal"], self._cur["fact_publication"], self._idempotent, self._salt,
            self._match)))

    def _new_facts(self) -> DataFrame:
        return self._keyed().select(*FACT_PUBLICATION.fieldNames())

    def _inserted(self, name: str) -> tuple[DataFrame, DataFrame]:
        """A dimension after the load, and the rows the load adds to it."""
        build = {
            "dim_journal": lambda: insert_journals(self._articles, self._cur["dim_journal"], self._match),
            "dim_author": lambda: insert_authors(self._keyed(), self._cur["dim_author"]),
            "dim_date": lambda: insert_dates(self._new_facts(), self._cur["dim_date"])}[name]

        def stored() -> tuple[DataFrame, DataFrame]:
            # Written: of a join's sides the dimension then counts with its size, not as unknown, and
            # Spark broadcasts it rather than the facts (whose files are small, too, before names are exploded).
            new = written(name, build()[1])
            return self._cur[name].unionByName(new), new

        return self._get("__pair_" + name, stored)

    def _new_bridge(self) -> DataFrame:
        return self._get("__bridge", lambda: bridge_rows(
            self._keyed(), "publication_id", "authors", self["dim_author"], "author_name", "author_id",
            salt_buckets=self._salt))

    def added(self, name: str) -> DataFrame:
        """The rows this load adds to a table (where rows change in place, the touched buckets whole)."""
        if name == "journal_quartile":
            # Made from the table that they will be written into: kept apart from it meanwhile.
            return self._get("__touched", lambda: written("touched-quartiles", touched_quartiles(
                self._articles, self["dim_journal"], self._cur["journal_quartile"], self._salt, self._match)))
        if name in ("dim_journal", "dim_author", "dim_date"):
            return self._inserted(name)[1]
        if name == "fact_publication":
            return self._new_facts()
        if name == "publication_author":
            # Written: the integrity check reads them beside the load.
            return self._get("__added_bridge", lambda: written("bridge", self._new_bridge()))
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        builders = {
            "dim_journal": lambda: self._inserted("dim_journal")[0],
            "journal_quartile": lambda: load_quartiles(self._articles, self["dim_journal"],
                                                       self._cur["journal_quartile"], self._salt, self._match),
            "fact_publication": lambda: self._cur["fact_publication"].unionByName(self._new_facts()),
            "dim_author": lambda: self._inserted("dim_author")[0],
            "publication_author": lambda: self._cur["publication_author"].unionByName(self._new_bridge()),
            "dim_date": lambda: self._inserted("dim_date")[0],
            "quarantine": lambda: (self._cached if self._cached is not None else self._source)
            .where(F.col("reject_reason").isNotNull()).drop(ROW_ID),
        }
        if name not in builders:
            raise KeyError(name)
        return self._get(name, builders[name])

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)


def load_star(articles: DataFrame, current: Mapping[str, DataFrame] | None = None,
              idempotent: bool = False, salt_buckets: int | None = None,
              journal_match: str = "exact") -> StarLoad:
    """Articles (from ``normalize_publications``) + current tables -> new tables
    (a mapping; see ``StarLoad``). ``salt_buckets`` salts the fact-to-dimension
    joins explicitly (default: AQE skew-join handling). ``journal_match="lower"``
    matches journal names case-insensitively (default: binary equality)."""
    return StarLoad(articles, current, idempotent, salt_buckets, journal_match)
