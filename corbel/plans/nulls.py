"""Null-handling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corbel.plans.registry import query
from corbel.plans.tables import nullable_events, with_evn


@query("null_coalesce", with_evn("SELECT event_id, coalesce(score, rating * 10) AS best FROM evn"))
def null_coalesce(spark, sf_dir):
    best = F.coalesce("score", F.col("rating") * 10)
    return nullable_events(spark, sf_dir).select("event_id", best.alias("best"))


@query(
    "null_functions",
    with_evn("""SELECT event_id, coalesce(score, rating * 10) AS if_null,
         coalesce(score, rating * 10) AS nvl, nullif(score, 5) AS null_if,
         CASE WHEN score IS NOT NULL THEN rating * 10 ELSE 0.0 END AS nvl2 FROM evn"""),
)
def null_functions(spark, sf_dir):
    tenfold = F.col("rating") * 10
    return nullable_events(spark, sf_dir).select(
        "event_id",
        F.ifnull("score", tenfold).alias("if_null"),
        F.nvl("score", tenfold).alias("nvl"),
        F.nullif("score", F.lit(5)).alias("null_if"),
        F.nvl2("score", tenfold, F.lit(0.0)).alias("nvl2"),
    )


@query("null_is_null", with_evn("SELECT event_id, genre, score FROM evn WHERE rating IS NULL"))
def null_is_null(spark, sf_dir):
    events = nullable_events(spark, sf_dir).where(F.col("rating").isNull())
    return events.select("event_id", "genre", "score")


@query(
    "null_is_not_null",
    with_evn("""SELECT event_id, genre, rating FROM evn
       WHERE genre IS NOT NULL AND rating IS NOT NULL AND score IS NOT NULL"""),
)
def null_is_not_null(spark, sf_dir):
    return (
        nullable_events(spark, sf_dir)
        .filter(F.col("genre").isNotNull())
        .filter(F.col("rating").isNotNull())
        .filter(F.col("score").isNotNull())
        .select("event_id", "genre", "rating")
    )


@query(
    "null_safe_eq",
    with_evn("""SELECT event_id, genre IS NOT DISTINCT FROM 'view' AS is_view FROM evn
       WHERE genre IS NOT DISTINCT FROM NULL OR genre IS NOT DISTINCT FROM 'view'"""),
)
def null_safe_eq(spark, sf_dir):
    genre = F.col("genre")
    return (
        nullable_events(spark, sf_dir)
        .filter(genre.eqNullSafe(F.lit(None)) | genre.eqNullSafe("view"))
        .select("event_id", genre.eqNullSafe("view").alias("is_view"))
    )


@query(
    "null_drop",
    with_evn("""SELECT event_id, rating, score FROM evn
       WHERE rating IS NOT NULL AND score IS NOT NULL"""),
)
def null_drop(spark, sf_dir):
    return nullable_events(spark, sf_dir).select("event_id", "rating", "score").na.drop()


@query(
    "null_fill",
    with_evn("""SELECT event_id, genre, coalesce(rating, 0.0) AS rating,
         coalesce(score, 0) AS score FROM evn"""),
)
def null_fill(spark, sf_dir):
    return nullable_events(spark, sf_dir).na.fill(0, ["rating", "score"])


@query(
    "null_fill_map",
    with_evn("""SELECT event_id, coalesce(genre, 'Unknown') AS genre,
         coalesce(rating, 0.0) AS rating, coalesce(score, 10) AS score FROM evn"""),
)
def null_fill_map(spark, sf_dir):
    defaults = {"rating": 0, "score": 10, "genre": "Unknown"}
    return nullable_events(spark, sf_dir).na.fill(defaults)


@query(
    "case_when",
    with_evn("""SELECT event_id, CASE WHEN rating IS NULL THEN 'none' WHEN rating > 100 THEN 'high'
         WHEN rating > 10 THEN 'middle' ELSE 'low' END AS band FROM evn"""),
)
def case_when(spark, sf_dir):
    rating = F.col("rating")
    band = (
        F.when(rating.isNull(), "none")
        .when(rating > 100, "high")
        .when(rating > 10, "middle")
        .otherwise("low")
    )
    return nullable_events(spark, sf_dir).select("event_id", band.alias("band"))
