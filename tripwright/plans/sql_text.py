"""Named questions as Spark SQL over the catalog tables (``sources.sql``), with
``:name`` parameters."""

# In which regions does a datasource have trips?
REGIONS_OF_DATASOURCE = """
SELECT region
FROM trips.dim_region
WHERE region_id IN (
  SELECT region_id FROM trips.fact_trips
  WHERE datasource_id IN (SELECT datasource_id FROM trips.dim_datasource WHERE datasource = :datasource))
"""

# What is the latest datasource of the busiest regions?  One pass over the fact
# into a row per region and datasource answers all of it.
LATEST_DATASOURCE_TOP = """
WITH pair AS (
  SELECT region_id, datasource_id, count(*) AS trips, max(event_timestamp) AS seen
  FROM trips.fact_trips
  GROUP BY ALL),
busy AS (
  SELECT region_id, sum(trips) AS trips, max(struct(seen, datasource)) AS newest
  FROM pair JOIN trips.dim_datasource USING (datasource_id)
  GROUP BY region_id
  ORDER BY trips DESC, region_id
  LIMIT :k)
SELECT region, newest.datasource AS datasource, newest.seen AS event_timestamp
FROM busy JOIN trips.dim_region USING (region_id)
"""

# How many trips does a region see in an average ISO week?
WEEKLY_AVG_TRIPS = """
WITH per_week AS (
  SELECT region_id, weekofyear(event_date) AS week, sum(number_of_trips) AS trips
  FROM trips.fact_group_trips
  GROUP BY ALL)
SELECT region, avg(trips) AS avg_weekly_trips
FROM per_week JOIN trips.dim_region USING (region_id)
GROUP BY region
"""

# Which daily boxes cover a position?
CHECK_POSITION = """
WITH covering AS (
  SELECT region_id, CAST(CAST(event_date AS DATE) AS STRING) AS event_date, number_of_trips
  FROM trips.fact_group_trips
  WHERE :x BETWEEN box_coord.x0 AND box_coord.x1 AND :y BETWEEN box_coord.y0 AND box_coord.y1)
SELECT region, event_date, number_of_trips
FROM covering JOIN trips.dim_region USING (region_id)
"""

LIST_REGIONS = "SELECT * FROM trips.dim_region"

# What did the pipeline do last?
LAST_LOG_EVENT = """
SELECT newest.* FROM (
  SELECT max_by(struct(event, event_type, CAST(execution_date_time AS STRING) AS execution_date_time), log_id) AS newest
  FROM logs.trips_log)
"""
