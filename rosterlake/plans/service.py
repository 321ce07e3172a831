"""Search requests against the serving table and its index."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.barrier import computed
from ..functions.parsing import read_double, strict_long
from ..operators.around import within_radius, within_radius_many
from ..operators.bounded import BROADCAST_ROWS
from ..operators.clauses import clause_reason, search_many
from ..operators.facets import BUCKETS, facet_dates, facet_terms, facet_tokens, facet_values
from ..operators.fields import is_period, match_date, match_dates_many, match_number, match_numbers_many
from ..operators.requests import DEFAULT_SIZE, DEFAULT_SKIP, answered, asked_once, normalise
from ..operators.scoring import EARLY_CUT, check_page, deep_pages, page, page_after, page_deep, page_per_query, total_hits
from ..operators.search import match, match_many, search
from ..operators.suggest import suggest
from ..operators.textindex import EVERYTHING, TextIndex, combined
from ..schema import INTEGER_FIELDS, SERVING, TEXT_FIELDS

NUMBER_FIELDS = ["id", *INTEGER_FIELDS]
DEEP = 10_000  # rows from which counting the rows before a page is less work than ranking them
SEARCHED_FIELDS = [*TEXT_FIELDS, EVERYTHING]


def text_fields() -> dict:
    """Indexed fields of a profile: each text field, and all searchable fields together."""
    fields = {name: F.col(name) for name in TEXT_FIELDS}
    fields[EVERYTHING] = combined(
        [f.name for f in SERVING if not isinstance(f.dataType, T.StructType)])
    return fields


class ProfileSearch:
    """Answers the requests of a profile search page.

    ``profiles`` is the serving table, with a ``bucket`` column if it is stored in buckets; ``index``
    covers :func:`text_fields`; ``prefixes`` is the n-gram index of the nicknames; ``buckets`` is the
    bucket count of the serving table.
    """

    def __init__(self, profiles: DataFrame, index: TextIndex, prefixes: TextIndex | None = None,
                 buckets: int | None = None):
        self.profiles = profiles
        self.buckets = buckets
        self.index = index
        self.prefixes = prefixes

    def _filtered(self, field: str, query: str, distance: str, lat: str, lon: str) -> DataFrame | None:
        """Profiles with score for the requests that are a filter on the serving table."""
        if distance:
            east, north = read_double(lon), read_double(lat)
            return within_radius(self.profiles, north, east, read_double(distance))
        if field in NUMBER_FIELDS:
            return match_number(self.profiles, field, query)
        if field == "dob":
            return match_date(self.profiles, field, query)
        return None

    def users(self, field: str = "", query: str = "", distance: str = "", lat: str = "", lon: str = "",
              size: int = DEFAULT_SIZE, skip: int = DEFAULT_SKIP, clause=None,
              after: tuple[float, int] | None = None) -> tuple[DataFrame, DataFrame]:
        """One page of profiles with their score, in rank order, and the total number of hits.

        ``after`` names the last row of the page before by its score and id: the page then costs the same at any
        depth. A large ``skip`` without it is found by histograms.
        A distance takes precedence over the text. ``clause`` is what a wildcard request asks for;
        without one it looks for any of the words, which is the plain match.
        """
        check_page(size, skip)
        if not query and not distance and clause is None:
            raise ValueError("query and distance can't both be empty")
        field, query = field or EVERYTHING, query.lower()
        columns = [*SERVING.fieldNames(), "score"]
        found = self._filtered(field, query, distance, lat, lon)
        if found is not None:
            return self._page(found, size, skip, after).select(*columns), total_hits(found)
        if field not in SEARCHED_FIELDS:
            raise ValueError(f"unknown field: {field!r}")
        hits = match(self.index, field, query) if clause is None else search(self.index, field, clause)
        hits = hits.withColumnRenamed("doc_id", "id")
        rows = self._with_profiles(self._page(hits, size, skip, after), size)
        return rows.select(*columns).orderBy(F.desc("score"), "id"), total_hits(hits)

    @staticmethod
    def _page(hits: DataFrame, size: int, skip: int, after: tuple[float, int] | None) -> DataFrame:
        if after is not None:
            return page_after(hits, *after, size, key="id")
        return page_deep(hits, size, skip, key="id") if skip > DEEP else page(hits, size, skip, key="id")

    def _with_profiles(self, wanted: DataFrame, rows: int) -> DataFrame:
        """Profiles of a page; their bucket narrows the scan to the directories that hold them."""
        keys = ["id"]
        if self.buckets:
            wanted = wanted.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("int"))
            keys = ["bucket", "id"]
        return self.profiles.join(F.broadcast(wanted) if rows <= BROADCAST_ROWS else wanted, keys)

    def answer_many(self, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Pages for a whole table of requests (``query_id`` and the request parameters as text).

        Returns (query_id, rank, id, score), and the refused requests with a reason. Requests of one
        kind share one pass over the index or the serving table, whatever their number; those beyond rank
        1000 share another. A request cannot make others fail. Wildcard requests bring their clause tree in a
        ``clause`` column (see :mod:`..operators.clauses`); without the column they are refused.
        """
        checked = normalise(requests)
        refused_clause = clause_reason(F.col("clause")) if "clause" in checked.columns else F.lit("clauses_not_supported")
        number, date = F.col("field").isin(NUMBER_FIELDS), F.col("field") == "dob"
        text = F.col("field").isin(SEARCHED_FIELDS)
        by_text = F.col("mode") != "geo"
        reason = (
            F.when(F.col("reason").isNotNull(), F.col("reason"))
            .when(by_text & number & strict_long(F.col("query")).isNull(), F.lit("not_a_number"))
            .when(by_text & date & ~is_period(F.col("query")), F.lit("not_a_date"))
            .when(by_text & ~number & ~date & ~text, F.lit("unknown_field"))
            .when((F.col("mode") == "clauses") & ~number & ~date & refused_clause.isNotNull(), refused_clause)
        )
        checked = computed(checked, reason.alias("_reason")).drop("reason").withColumnRenamed("_reason", "reason")
        good = checked.where(F.col("reason").isNull()).withColumn(
            "last", F.col("size").cast("bigint") + F.col("skip").cast("bigint"))
        # Requests for a deep page are ranked by themselves, so they cost the others nothing.
        near, deep = good.where(F.col("last") <= EARLY_CUT), good.where(F.col("last") > EARLY_CUT)
        # Requests that differ in their page at most are matched and ranked once, as deep as the deepest of them all.
        once, whose = asked_once(near.drop("size", "skip", "last", "reason", *self._unread(near)))
        depth = near.agg(F.max("last")).first()[0] or 0
        ranked = answered(page_per_query(self._hits(once), depth, key="id"), whose)
        hits = ranked.join(near.select("query_id", "skip", "last"), "query_id")
        pages = hits.unionByName(deep_pages(self._hits(deep), deep.select("query_id", "skip", "last"), key="id"))
        return (
            pages.where((F.col("rank") > F.col("skip")) & (F.col("rank") <= F.col("last")))
            .select("query_id", "rank", "id", "score"),
            checked.where(F.col("reason").isNotNull()).select("query_id", "reason"),
        )

    @staticmethod
    def _unread(requests: DataFrame) -> list[str]:
        """Columns of checked requests that do not say what is asked."""
        read = {"query_id", "field", "query", "distance_km", "lat", "lon", "size", "skip", "mode", "reason", "last", "clause"}
        return [c for c in requests.columns if c not in read]

    def _hits(self, good: DataFrame) -> DataFrame:
        """(query_id, id, score) of accepted requests of all kinds."""
        number, date = F.col("field").isin(NUMBER_FIELDS), F.col("field") == "dob"
        text, by_text = F.col("field").isin(SEARCHED_FIELDS), F.col("mode") != "geo"
        asked = good.where(by_text)
        trees = (F.col("mode") == "clauses") & text
        circles = good.where(~by_text).select("query_id", "lat", "lon", F.col("distance_km").alias("radius_km"))
        words = match_many(self.index, None, asked.where(text & ~trees))
        if "clause" in good.columns:
            for field in SEARCHED_FIELDS:
                words = words.unionByName(search_many(self.index, field, asked.where(trees & (F.col("field") == field))))
        return (
            words.withColumnRenamed("doc_id", "id")
            .unionByName(match_numbers_many(self.profiles, "id", NUMBER_FIELDS, asked.where(number)))
            .unionByName(match_dates_many(self.profiles, "id", "dob", asked.where(date)))
            .unionByName(within_radius_many(self.profiles, circles).select("query_id", "id", "score"))
        )

    def nicks(self, nick: str) -> DataFrame:
        if self.prefixes is None:
            raise ValueError("no nickname prefixes were indexed")
        return suggest(self.prefixes, "nickname", nick, self.profiles, "id", "nickname")

    def aggregations(self, field: str, size: int = BUCKETS, by_token: bool = False) -> DataFrame:
        if not field:
            raise ValueError("the field must not be empty")
        if field == "dob":
            return facet_dates(self.profiles, field, size)
        if by_token:
            if field in (self.index.known or {}):
                return facet_terms(self.index.term_stats.where(F.col("field") == field), size)
            return facet_tokens(self.profiles, field, size)
        return facet_values(self.profiles, field, size)
