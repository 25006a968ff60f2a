"""Registered queries: passages and summaries by corpus statistics, sketches, and a table function."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.sketches import COUNT_ERROR, RANK_ERROR, daily_states, over_range
from tarmac.plans import gold
from tarmac.plans.passages import LENGTH_SHARE, SATURATION, answers, question_terms, salient_sentences
from tarmac.plans.sql_surface import register_table_functions
from tarmac.registry.base import ORACLES, query
from tarmac.registry.binding import NOW, bind, driver
from tarmac.registry.models import SENTENCES_SQL, WORDS_SQL
from tarmac.registry.oracle import oracle
from tarmac.session import scratch_path
from tarmac.tables import dated_between

QUESTION = "How long was the wait, and what did they do with that refund?"
TERMS = question_terms(QUESTION)
SENTENCES = f"""
    SELECT doc_id, i, trim(sentence, ' ') AS sentence, list_filter({WORDS_SQL.format('sentence')}, lambda w: w <> '') AS said FROM (
      SELECT doc_id, unnest(parts) AS sentence, generate_subscripts(parts, 1) AS i
      FROM (SELECT doc_id, {SENTENCES_SQL.format('text')} AS parts FROM documents))"""


@query("answer_passage", oracle("doc_id:i answer:s score:r", """
    SELECT doc_id, CASE WHEN score > 0 THEN sentence END AS answer, CASE WHEN score > 0 THEN score END AS score
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS rank FROM scored) WHERE rank = 1
    UNION ALL SELECT doc_id, NULL, NULL FROM documents WHERE text IS NULL""",
    sentence_words=SENTENCES,
    counted=f"""SELECT doc_id, i, sentence, len(said) AS size, {', '.join(
        f"CAST(len(list_filter(said, lambda w: w = '{t}')) AS DOUBLE) AS tf{n}" for n, t in enumerate(TERMS))} FROM sentence_words""",
    told=f"SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(size) AS DOUBLE) / count(*) AS mean, {', '.join(
        f'count(*) FILTER (WHERE tf{n} > 0) AS df{n}' for n in range(len(TERMS)))} FROM counted",
    scored=f"""SELECT doc_id, i, sentence, round({' + '.join(
        f"ln(1 + (n - df{k} + 0.5::DOUBLE) / (df{k} + 0.5::DOUBLE)) * tf{k} * ({SATURATION}::DOUBLE + 1) / (tf{k} + {SATURATION}::DOUBLE"
        f" * (1 - {LENGTH_SHARE}::DOUBLE + {LENGTH_SHARE}::DOUBLE * size / greatest(mean, 1e-9::DOUBLE)))" for k in range(len(TERMS)))}, 6) AS score
      FROM counted, told"""))
def answer_passage(spark: SparkSession, sf: str) -> DataFrame:
    """The best passage of every document for a free question."""
    return answers(driver(spark, sf, "documents"), "doc_id", "text", QUESTION)


@query("salient_sentence", oracle("doc_id:i summary:s", """
    SELECT doc_id, sentence AS summary
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS rank FROM scored) WHERE rank = 1
    UNION ALL SELECT doc_id, NULL FROM documents WHERE text IS NULL""",
    sentence_words=SENTENCES,
    tf="SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest(said) AS w FROM sentence_words) GROUP BY 1, 2",
    weight="""SELECT doc_id, w, tf * (ln(((SELECT count(*) FROM documents WHERE text IS NOT NULL) + 1)::DOUBLE / (df + 1)) + 1) AS weight
      FROM tf JOIN (SELECT w, count(*) AS df FROM tf GROUP BY 1) USING (w)""",
    scored="""SELECT s.doc_id, s.i, any_value(s.sentence) AS sentence,
        round(coalesce(sum(weight ORDER BY u.w), 0) / greatest(count(u.w), 1), 6) AS score
      FROM sentence_words s LEFT JOIN (SELECT doc_id, i, unnest(list_distinct(said)) AS w FROM sentence_words) u ON u.doc_id = s.doc_id AND u.i = s.i
      LEFT JOIN weight t ON t.doc_id = u.doc_id AND t.w = u.w GROUP BY 1, 2"""))
def salient_sentence(spark: SparkSession, sf: str) -> DataFrame:
    """The most salient sentence of every document."""
    return salient_sentences(driver(spark, sf, "documents"), "doc_id", "text")


@query("feature_table_function", ORACLES["passenger_feature_rows"])
def feature_table_function(spark: SparkSession, sf: str) -> DataFrame:
    """Seven rows per passenger out of SQL alone, by LATERAL VIEW."""
    register_table_functions(spark)
    gold.passenger_risk(bind(spark, sf), NOW, literal=False).createOrReplaceTempView("passenger_risk_rows")
    return spark.sql("""
        SELECT r.passenger_key, f.feature_name, f.feature_value FROM (SELECT passenger_key, passenger_features(
            loyalty_tier, bookings_last_90d, ytd_segments, days_since_last_booking, revenue_last_90d, avg_sentiment_90d,
            CAST(negative_feedback_count AS DOUBLE), CAST(major_delays_experienced AS DOUBLE), lifetime_miles, ytd_miles
          ) AS features FROM passenger_risk_rows) r LATERAL VIEW inline(r.features) f AS feature_name, feature_value""")


FIRST, LAST = 20010101, 20010331
NEAR = 4  # a result is asked to be within so many standard errors


@query("sketch_ranges", oracle("route_key:i rows:i passengers:i near_count:b near_median:b", f"""
    SELECT route_key, count(*) AS rows, count(DISTINCT passenger_key) AS passengers, true AS near_count, true AS near_median
    FROM booking WHERE flight_date_key BETWEEN {FIRST} AND {LAST} GROUP BY 1"""))
def sketch_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Ninety days of bookings by route out of daily states, held against the exact count and ranks."""
    path = scratch_path(spark, "states")
    t = bind(spark, sf)
    daily_states(t.booking, ["route_key"], "flight_date_key", ["passenger_key"], ["total_amount"]).write.parquet(path)
    told = over_range(
        spark.read.parquet(path), ["route_key"], "flight_date_key", FIRST, LAST, ["passenger_key"], {"median": ("total_amount", 0.5)}
    ).withColumnRenamed("passenger_key", "about")
    rows = dated_between(t.booking, "flight_date_key", "2001-01-01", "2001-03-31").join(told, "route_key")
    exact = rows.groupBy("route_key", "rows", "about").agg(
        F.count_distinct("passenger_key").alias("passengers"),
        F.avg((F.col("total_amount") < F.col("median")).cast("double")).alias("below"), F.avg((F.col("total_amount") <= F.col("median")).cast("double")).alias("upto"),
    )
    near = F.abs(F.col("about") - F.col("passengers")) <= F.greatest(F.lit(1.0), F.col("passengers") * (NEAR * COUNT_ERROR))
    median = (F.col("below") <= 0.5 + RANK_ERROR) & (F.col("upto") >= 0.5 - RANK_ERROR)
    return exact.select("route_key", "rows", "passengers", near.alias("near_count"), median.alias("near_median"))
