"""Questions about taxi trips."""

from pyspark.sql import functions as F

from corvane.catalogue.registry import query
from corvane.catalogue.views import Views
from corvane.plans import trips

HOUR_SQL = "CAST(hour(tpep_pickup_datetime) AS INTEGER)"


@query(
    "taxi_zone_pickups",
    """SELECT PULocationID, count(*) AS totalTrips, Borough, Zone FROM trips JOIN zones ON PULocationID = LocationID
       GROUP BY PULocationID, Borough, Zone""",
    "trips zones",
)
def zone_pickups(v: Views):
    return trips.zone_pickups(v.trips(), v.zones())


@query(
    "taxi_borough_pickups",
    "SELECT Borough, count(*) AS totalTrips FROM trips JOIN zones ON PULocationID = LocationID GROUP BY Borough",
    "trips zones",
)
def borough_pickups(v: Views):
    return trips.borough_pickups(v.trips(), v.zones())


@query("taxi_hours", f"SELECT {HOUR_SQL} AS hour_of_day, count(*) AS totalTrips FROM trips GROUP BY 1", "trips")
def hours(v: Views):
    return trips.pickups_by_hour(v.trips())


@query(
    "taxi_distance_stats",
    """SELECT count(*) AS count, 30 AS threshold, round(avg(trip_distance), 4) AS mean,
         round(stddev_samp(trip_distance), 4) AS stddev, min(trip_distance) AS min, max(trip_distance) AS max
       FROM trips""",
    "trips",
)
def distances(v: Views):
    return trips.distance_statistics(v.trips()).withColumns(
        {"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)}
    )


@query("taxi_length_split", "SELECT trip_distance >= 30 AS isLong, count(*) AS count FROM trips GROUP BY 1", "trips")
def lengths(v: Views):
    return trips.trips_by_length(v.trips())


@query(
    "taxi_hours_by_length",
    f"""SELECT {HOUR_SQL} AS hour_of_day, trip_distance >= 30 AS isLong, count(*) AS totalTrips FROM trips
        GROUP BY 1, 2""",
    "trips",
)
def hours_by_length(v: Views):
    return trips.pickups_by_hour_and_length(v.trips())


_PAIRS_SQL = """SELECT p.Zone AS Pickup_Zone, d.Zone AS Dropoff_Zone, count(*) AS totalTrips
    FROM trips JOIN zones p ON PULocationID = p.LocationID JOIN zones d ON DOLocationID = d.LocationID
    WHERE {} GROUP BY PULocationID, DOLocationID, p.Zone, d.Zone"""


@query("taxi_pair_popularity", _PAIRS_SQL.format("trip_distance >= 30"), "trips zones")
def pairs(v: Views):
    return trips.pair_popularity(v.trips(), v.zones(), F.col("isLong"))


@query(
    "taxi_pair_popularity_top3",
    _PAIRS_SQL.format("NOT trip_distance >= 30")
    + " ORDER BY totalTrips DESC, Pickup_Zone, Dropoff_Zone LIMIT 3",
    "trips zones",
)
def top_pairs(v: Views):
    return trips.pair_popularity(v.trips(), v.zones(), ~F.col("isLong"), top=3)


@query("taxi_ratecode", "SELECT RatecodeID, count(*) AS totalTrips FROM trips GROUP BY 1", "trips")
def ratecodes(v: Views):
    return trips.ratecode_distribution(v.trips())


@query(
    "taxi_ratecode_daily",
    """SELECT strftime(tpep_pickup_datetime, '%Y-%m-%d') AS pickup_day, RatecodeID, count(*) AS totalTrips
       FROM trips GROUP BY 1, 2""",
    "trips",
)
def daily_ratecodes(v: Views):
    daily = trips.ratecode_by_day(v.trips())
    return daily.withColumn("pickup_day", F.col("pickup_day").cast("string"))


_SLOT_SQL = "CAST(floor((epoch({}) + 150) / 300) AS BIGINT)"
_ATTEMPTS_SQL = f"""SELECT PULocationID, {_SLOT_SQL.format("tpep_pickup_datetime")} AS slot, count(*) AS total_trips,
    round(sum(total_amount), 2) AS total_amount, Borough, Zone
    FROM trips JOIN zones ON PULocationID = LocationID WHERE passenger_count < 3
    GROUP BY PULocationID, slot, Borough, Zone"""


@query(
    "taxi_group_attempts",
    f"""SELECT PULocationID, total_trips, total_amount, Borough, Zone,
          strftime(make_timestamp(slot * 300000000), '%Y-%m-%d %H:%M:%S') AS approximate_datetime
        FROM ({_ATTEMPTS_SQL})""",
    "trips zones",
)
def attempts(v: Views):
    return trips.group_attempts(v.trips(), v.zones()).withColumn("total_amount", F.round("total_amount", 2))


@query(
    "taxi_economic_impact",
    f"""SELECT round(sum(total_trips * 0.05::DOUBLE * 0.3::DOUBLE * (0.6::DOUBLE * mean - 5)
          + total_trips * 0.05::DOUBLE * 0.7::DOUBLE * 2), 0) AS total
        FROM ({_ATTEMPTS_SQL}), (SELECT avg(total_amount) AS mean FROM trips)""",
    "trips zones",
)
def impact(v: Views):
    return trips.economic_impact(v.trips(), v.zones()).select(F.round("total", 0).alias("total"))


@query(
    "taxi_economic_impact_job",
    f"""SELECT round(sum(n * 0.05::DOUBLE * 0.3::DOUBLE * (0.6::DOUBLE * mean - 5)
          + n * 0.05::DOUBLE * 0.7::DOUBLE * 2), 0) AS total
        FROM (SELECT count(*) * (289623.0::DOUBLE / 331893) AS n FROM trips JOIN zones ON PULocationID = LocationID),
          (SELECT avg(total_amount) AS mean FROM trips)""",
    "trips zones",
)
def impact_of_history(v: Views):
    return trips.economic_impact_of_history(v.history_trips(), v.zones()).select(F.round("total", 0).alias("total"))
