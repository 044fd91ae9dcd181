"""Parameterised SQL over the star tables (the SQL-text form of a query).

``execute_query(spark, star, text, params)`` registers the star tables as
temporary views and runs ``spark.sql`` with named parameters (``:cid``,
arrays for IN-lists), so values are bound, never spliced into the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Season totals of one team, written as SQL with bound parameters.
TEAM_SEASONS = """
SELECT r.year AS season, SUM(res.points) AS total_points,
       COUNT(*) FILTER (WHERE res.position = 1) AS wins,
       COUNT(*) AS total_races
FROM results res JOIN races r ON res.race_id = r.race_id
WHERE res.constructor_id = :cid
GROUP BY r.year
"""

DRIVERS_OF_TEAMS = """
SELECT DISTINCT res.driver_id
FROM results res JOIN constructors c ON res.constructor_id = c.constructor_id
WHERE array_contains(:refs, c.constructor_ref)
"""


def execute_query(spark: SparkSession, star, text: str, params: dict | None = None,
                  prefix: str = "") -> DataFrame:
    star.register(prefix)
    return spark.sql(text, args=params or {})


