"""Typed document searches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbflow.functions import predicates as p
from curbflow.operators import clean
from curbflow.operators import search as s
from curbflow.plans import common
from curbflow.plans.spatial import CENTRE, RADIUS_M, sql_haversine
from curbflow.functions.geo import within_distance
from curbflow.session import scratch_path
from curbflow.sinks.text_index import index_texts, search_texts
from curbflow.sources.tables import read_table, register_views, trips

TEXT_QUERY = "ALL about The search"
# The pattern depends on parameters alone, so it is built and compiled once.
TEMPLATE = """SELECT doc_id FROM documents WHERE lower(text) RLIKE concat(
  :word_start, btrim(regexp_replace(lower(:query_string), :token_break, '|'), '|'), :word_end)
  AND btrim(regexp_replace(lower(:query_string), :token_break, '|'), '|') <> ''"""
TEMPLATE_QUERY = "all about and search"


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def text_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.search(_docs(spark, sf_dir), p.match_text("text", TEXT_QUERY), fields=["doc_id"])


def template_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search as a SQL text with named parameters."""
    register_views(spark, sf_dir, ["documents"])
    args = {
        "query_string": TEMPLATE_QUERY,
        "token_break": p.TOKEN_BREAK,
        "word_start": p.WORD_START,
        "word_end": p.WORD_END,
    }
    return s.run_template(spark, TEMPLATE, args)


def bool_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two text matches, an exact term and a range, all required."""
    both = p.bool_query(
        must=[p.match_text("text", "the"), p.match_text("text", "search and")],
        filters=[p.term("lang", "en"), p.value_range("n_chars", gte=500)],
    )
    return s.search(_docs(spark, sf_dir), both, fields=["doc_id", "lang", "n_chars"])


def event_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exact term and a date range; both reach the scan."""
    events = read_table(spark, sf_dir, "events")
    since = clean.timestamp_literal(events, "ts", common.NOW.replace(day=15))
    wanted = p.bool_query(filters=[p.term("event_type", "purchase"), p.value_range("ts", gte=since)])
    return s.search(events, wanted, fields=["event_id", "value"])


def script_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = read_table(spark, sf_dir, "events").select("event_id", F.col("value").alias("num1"))
    return clean.where_expr(numbered, "num1 > 1")


def field_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.search(trips(spark, sf_dir), p.exists("pickup_latitude"), fields=["trip_id"])


def last_7_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = clean.last_days(trips(spark, sf_dir), "ts", 7, common.NOW)
    return recent.select("trip_id", "topic")


def search_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three hits of a distance search."""
    near = within_distance("pickup_latitude", "pickup_longitude", CENTRE, RADIUS_M)
    return s.search(trips(spark, sf_dir), near, ["trip_id"], 3, ["trip_id", "topic"])


def search_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the id of every document."""
    docs = _docs(spark, sf_dir).withColumnRenamed("doc_id", "_id")
    return s.search(docs, p.match_all(), fields=["_id"])


def search_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.search_total(trips(spark, sf_dir), p.match_all())


def sample_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 1,000 records, where the replay stops."""
    return s.search(trips(spark, sf_dir), order=["trip_id"], size=1000, fields=["trip_id", "topic"])


def get_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents looked up by the ids of a table."""
    found = s.get_by_ids(_docs(spark, sf_dir), read_table(spark, sf_dir, "labels"), "doc_id")
    return found.select("doc_id", "lang", "source", "n_chars")


def _indexed(spark: SparkSession, sf_dir: str) -> str:
    """An index of all documents, half of them first with another text that was replaced since."""
    path, docs = scratch_path(spark, "text-index"), _docs(spark, sf_dir).withColumn("version", F.lit(2))
    outdated = F.when(F.col("doc_id") % 2 == 0, F.concat_ws(" ", F.lit("Search and"), F.reverse("text"))).otherwise(F.col("text"))
    index_texts(spark, path, docs.withColumn("text", outdated).withColumn("version", F.lit(1)), "doc_id", ["version"], buckets=16, batch=("load", 0))
    index_texts(spark, path, docs, "doc_id", ["version"], buckets=16, batch=("load", 1))
    return path


def indexed_text_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text match on a stored index, from its tokens alone."""
    return search_texts(spark, _indexed(spark, sf_dir), [TEXT_QUERY], fields=["doc_id"])


def indexed_bool_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two text matches, an exact term and a range on a stored index."""
    filters = p.bool_query(filters=[p.term("lang", "en"), p.value_range("n_chars", gte=500)])
    return search_texts(spark, _indexed(spark, sf_dir), ["the", "search and"], filters, ["doc_id", "lang", "n_chars"])


QUERIES = {
    f.__name__: f
    for f in (
        indexed_text_match,
        indexed_bool_query,
        text_match,
        template_match,
        bool_query,
        event_range,
        script_filter,
        field_exists,
        last_7_days,
        search_top3,
        search_projection,
        search_total,
        sample_cap,
        get_by_ids,
    )
}


def _sql_match(column: str, query: str) -> str:
    tokens = ", ".join(f"'{t}'" for t in p.query_tokens(query))
    return f"list_has_any(string_split_regex(lower({column}), '[^\\p{{L}}\\p{{N}}]+'), [{tokens}])"


ORACLES = {
    "text_match": f"SELECT doc_id FROM documents WHERE {_sql_match('text', TEXT_QUERY)}",
    "template_match": f"SELECT doc_id FROM documents WHERE {_sql_match('text', TEMPLATE_QUERY)}",
    "bool_query": f"""SELECT doc_id, lang, n_chars FROM documents
WHERE {_sql_match('text', 'the')} AND {_sql_match('text', 'search and')} AND lang = 'en' AND n_chars >= 500""",
    "event_range": """SELECT event_id, value FROM events
WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-15 00:00:00'""",
    "script_filter": "SELECT event_id, value AS num1 FROM events WHERE value > 1",
    "field_exists": f"WITH {common.SQL_TRIPS} SELECT trip_id FROM trips WHERE pickup_latitude IS NOT NULL",
    "last_7_days": f"""WITH {common.SQL_TRIPS} SELECT trip_id, topic FROM trips
WHERE ts >= {common.SQL_NOW} - INTERVAL 7 DAY AND ts <= {common.SQL_NOW}""",
    "search_top3": f"""WITH {common.SQL_TRIPS} SELECT trip_id, topic FROM trips
WHERE {sql_haversine('pickup_latitude', 'pickup_longitude')} <= {RADIUS_M!r} ORDER BY trip_id LIMIT 3""",
    "search_projection": "SELECT doc_id AS _id FROM documents",
    "search_total": "SELECT count(*) AS total FROM events",
    "sample_cap": f"WITH {common.SQL_TRIPS} SELECT trip_id, topic FROM trips ORDER BY trip_id LIMIT 1000",
    "get_by_ids": """SELECT doc_id, lang, source, n_chars FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels)""",
}
ORACLES["indexed_text_match"] = ORACLES["text_match"]
ORACLES["indexed_bool_query"] = ORACLES["bool_query"]
