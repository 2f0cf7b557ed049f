"""Composite answers for riders: busiest corridors, stops, direct trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.functions.geo import METERS_PER_DEGREE, bucket, equirect_m
from headway.functions.labels import DEFAULT_CORRIDOR_COLOR, default_if_blank
from headway.functions.times import departure_hour, gtfs_seconds
from headway.operators.latest import distinct_on
from headway.operators.quality import filter_route
from headway.operators.ranges import BOX_LAT, BOX_LON, RADIUS_M, covering
from headway.operators.schedule import PROFILE_HOURS

# Fixed value: hours after the asked one.
HOURS_ON = 2
# Stands for the hour of a call without one, of which no request asks.
NO_HOUR = -(1 << 31)
# Ends of a request; axes of its search box.
SIDES, AXES = ("origin", "dest"), {"y": ("lat", BOX_LAT), "x": ("lon", BOX_LON)}
# More than a float is off by, in degrees of latitude or longitude.
FLOAT_DEGREES = 2e-5
ALIGHT = [f"__alight.{c}" for c in ("alight_time", "alight_stop", "alight_lat", "alight_lon")]


def top_corridors(
    stop_times: DataFrame, serving_routes: DataFrame, hour: int, n: int = 10
) -> DataFrame:
    """The ``n`` busiest routes of an hour with geometry and hourly profile.

    Calls are read once and reduced to one row per trip and hour, and per stop
    in the asked hour, so no count needs a distinct.
    """
    at, trips = F.col("hour"), F.col("trips")
    named = stop_times.filter(F.col("route_short_name").isNotNull()).select(
        F.col("route_short_name").alias("route"), "route_id", "trip_id", "stop_id", "shape_id",
        departure_hour(F.col("departure_time")).alias("hour"),
    )
    trip = F.struct(F.lit(True).alias("is_trip"), F.col("trip_id").alias("id"))
    stop = F.struct(F.lit(False).alias("is_trip"), F.col("stop_id").alias("id"))
    counted = F.explode(F.when(at == hour, F.array(trip, stop)).otherwise(F.array(trip)))
    hourly = (
        named.select("route", "route_id", "hour", "shape_id", counted.alias("counted"))
        .groupBy("route", "route_id", "hour", "counted")
        .agg(F.min("shape_id").alias("shape_id"))
        .groupBy("route", "route_id", "hour")
        .agg(
            F.count_if(F.col("counted.is_trip")).alias("trips"),
            F.count_if(~F.col("counted.is_trip") & F.col("counted.id").isNotNull()).alias("stops"),
            F.min("shape_id").alias("shape_id"),
        )
    )
    shown = F.when(at.between(*PROFILE_HOURS), F.struct("hour", "trips"))
    busiest = (
        hourly.groupBy("route", "route_id")
        .agg(
            F.max(F.when(at == hour, trips)).alias("trips_per_hour"),
            F.max(F.when(at == hour, F.col("stops"))).alias("stops_served"),
            F.max(F.when(at == hour, F.col("shape_id"))).alias("sample_shape_id"),
            F.sort_array(F.collect_list(shown)).alias("hourly_profile"),
        )
        .filter(F.col("trips_per_hour").isNotNull())
        .orderBy(F.desc("trips_per_hour"), "route", "route_id")
        .limit(n)
    )
    geometry = distinct_on(
        serving_routes.select(
            F.col("shape_id").alias("sample_shape_id"), "route_short_name", "route_long_name",
            "route_color", "coordinates",
        ),
        ["sample_shape_id"], ["route_short_name", "route_long_name", "route_color"],
    ).drop("route_short_name")
    return (
        busiest.join(geometry, "sample_shape_id", "left")
        .select(
            "route", "route_id", "trips_per_hour", "stops_served",
            F.coalesce("route_long_name", F.lit("")).alias("long_name"),
            default_if_blank(F.col("route_color"), DEFAULT_CORRIDOR_COLOR).alias("color"),
            "coordinates", "hourly_profile",
        )
    )


def stops_served_by(stops: DataFrame, stop_times: DataFrame, route: str) -> DataFrame:
    """Stops that a route calls at."""
    return stops.join(filter_route(stop_times, route).select("stop_id"), "stop_id", "left_semi")


def frequency_for(
    frequency: DataFrame, hour: int, stop_times: DataFrame | None = None, route: str | None = None
) -> DataFrame:
    """Trips per stop in one hour, optionally only at the stops of a route."""
    chosen = frequency.filter(F.col("hour_of_day") == hour)
    return chosen if route is None else stops_served_by(chosen, stop_times, route)


def _is_near(lat: Column, lon: Column, stop_lat: Column, stop_lon: Column, radius_m: float, slack: float = 0.0) -> Column:
    """Less than ``radius_m`` away and inside the search box, both wider by ``slack`` degrees."""
    inside = (F.abs(stop_lat - lat) < BOX_LAT + slack) & (F.abs(stop_lon - lon) < BOX_LON + slack)
    return inside & (equirect_m(lat, lon, stop_lat, stop_lon) < radius_m + slack * 2 * METERS_PER_DEGREE)


def _cell(axis: str) -> Column:
    """Twice the reach of the search box wide; two of them side by side are a place where requests meet links."""
    return bucket(F.col(f"stop_{axis}"), 2 * {"lat": BOX_LAT, "lon": BOX_LON}[axis])


def _links(legs: DataFrame) -> DataFrame:
    """Cells that trips go from and to: per trip, hour and boarding cell, each cell it calls at later.

    A trip's calls are first reduced to the earliest one of a cell and hour and the last one of a cell, with
    the box around the stops called at there (for most trips the stop itself), as its middle and half its
    width in floats. So a trip of however many calls has no more links than pairs of cells.
    """
    cell = ["trip_id", "__hour", _cell("lat").alias("__y"), _cell("lon").alias("__x")]

    def box(side: str) -> list[Column]:
        return [f(c).alias(f"{side}_{n}_{c[5:]}") for c in ("stop_lat", "stop_lon") for n, f in (("min", F.min), ("max", F.max))]

    def middles(side: str) -> list[Column]:
        ends = [(d, F.col(f"{side}_min_{d}"), F.col(f"{side}_max_{d}")) for d in ("lat", "lon")]
        middle = [((low + high) / 2).cast("float").alias(f"{side}_mid_{d}") for d, low, high in ends]
        return middle + [((high - low) / 2).cast("float").alias(f"{side}_half_{d}") for d, low, high in ends]

    sequence = F.col("stop_sequence")
    # A call without a number comes before all others and is reached from none.
    first = F.when(F.count(sequence) == F.count(F.lit(1)), F.min(sequence)).alias("__first")
    boardings = legs.groupBy(*cell).agg(first, *box("origin")).withColumnsRenamed({"__y": "origin_y", "__x": "origin_x"})
    # By hour first here too: both sides then read one and the same shuffle.
    by_hour = legs.groupBy(*cell).agg(F.max(sequence).alias("__last"), *box("dest"))
    extremes = [getattr(F, n)(f"dest_{n}_{d}").alias(f"dest_{n}_{d}") for d in ("lat", "lon") for n in ("min", "max")]
    arrivals = by_hour.groupBy("trip_id", F.col("__y").alias("dest_y"), F.col("__x").alias("dest_x")).agg(
        F.max("__last").alias("__last"), *extremes
    )
    later = F.col("__last").isNotNull() & (F.col("__first").isNull() | (F.col("__first") < F.col("__last")))
    places = [F.floor(F.col(f"{side}_{axis}") / 2).alias(f"{side}_{axis}") for side in SIDES for axis in AXES]
    return boardings.join(arrivals, "trip_id").filter(later).select(
        "trip_id", "__hour", *places, *middles("origin"), *middles("dest")
    )


def _trips_met(legs: DataFrame, requests: DataFrame, radius_m: float, hours_on: int) -> DataFrame:
    """Requests with the trips that go from near their origin to near their destination, a few too many.

    Requests meet the links of trips by both places and the hours at once, so calls near one end only
    are never formed. Requests are copied to at most 2 places per axis (1.5 on average) and 2 runs of
    hours, links stay single; what grows faster than the tables are only the trips found. Both sides
    are shuffled by one number made of places and hours: where two of them share it, the look at the
    boxes tells them apart.
    """
    span = hours_on + 1
    asked = requests.select("request_id", "hour", "origin_lat", "origin_lon").distinct().join(
        requests.select("request_id", "dest_lat", "dest_lon").distinct(), "request_id"
    )
    spread = asked.withColumn(
        "__run", F.explode(F.sequence(F.floor(F.col("hour") / span), F.floor((F.col("hour") + hours_on) / span)))
    )
    met = F.col("__hour").between(F.col("hour"), F.col("hour") + hours_on)
    for side in SIDES:
        for axis, (degrees, reach) in AXES.items():
            spread = spread.withColumn(f"{side}_{axis}", F.explode(covering(F.col(f"{side}_{degrees}"), reach, 4 * reach)))
        lat, lon = F.col(f"{side}_lat"), F.col(f"{side}_lon")
        nearest = []
        for d, at in (("lat", lat), ("lon", lon)):
            middle, half = (F.col(f"{side}_{n}_{d}").cast("double") for n in ("mid", "half"))
            nearest.append(F.least(F.greatest(at, middle - half), middle + half))
        met &= _is_near(lat, lon, *nearest, radius_m, FLOAT_DEGREES)
    places = [f"{side}_{axis}" for side in SIDES for axis in AXES]
    meet = F.hash("__run", *(F.col(c).cast("bigint") for c in places)).alias("__meet")
    ends = [f"{side}_{degrees}" for side in SIDES for degrees in ("lat", "lon")]
    asking = spread.withColumn("__run", F.col("__run").cast("bigint")).select(meet, "request_id", "hour", *ends)
    run = F.coalesce(F.floor(F.col("__hour") / span), F.lit(NO_HOUR)).cast("bigint")
    links = _links(legs).withColumn("__run", run).withColumn("__meet", meet).drop("__run", *places)
    found = asking.join(links, "__meet").filter(met).select("trip_id", "request_id", "hour", *ends)
    return found.repartition("trip_id").distinct()


def _rides(
    stop_times: DataFrame,
    stops: DataFrame,
    requests: DataFrame,
    serving_routes: DataFrame | None,
    radius_m: float,
    hours_on: int,
) -> DataFrame:
    """Boardings near the origin of each request in its hours, with the first call near the
    destination after them.

    Only trips that serve both ends are walked. Each boarding takes the arrival that lies
    next to it when a request's calls of a trip are walked from the last to the first, so boardings
    and arrivals are never joined. Calls without a trip and requests without an id find nothing.
    """
    places = stops.select("stop_id", "stop_name", "stop_lat", "stop_lon")
    shape = [] if serving_routes is None else ["shape_id"]
    called = stop_times.filter(F.col("trip_id").isNotNull()).select(
        "trip_id", "stop_sequence", "stop_id", "arrival_time", "departure_time", "route_id", "route_short_name", *shape
    ).join(places, "stop_id")
    call, trip = F.struct(*(c for c in called.columns if c != "trip_id")).alias("__call"), Window.partitionBy("trip_id")
    # A trip whose calls are all equal goes nowhere. To tell, a trip's calls are brought into one task, which all that
    # follows keeps to, and whole calls are compared, so that links and rides read one and the same shuffle.
    goes = F.min("__call").over(trip) != F.max("__call").over(trip)
    hour = F.coalesce(departure_hour(F.col("departure_time")), F.lit(NO_HOUR))
    located = called.select("trip_id", call).withColumn("__goes", goes).filter("__goes").select("trip_id", "__call.*")
    located = located.withColumn("__hour", hour)
    trips = _trips_met(located, requests, radius_m, hours_on)
    board, alight = (
        _is_near(F.col(f"{side}_lat"), F.col(f"{side}_lon"), F.col("stop_lat"), F.col("stop_lon"), radius_m) for side in SIDES
    )
    board &= F.col("__hour").between(F.col("hour"), F.col("hour") + hours_on)
    ends = F.array_compact(F.array(F.when(board, F.lit(False)), F.when(alight, F.lit(True))))
    is_dest = F.col("__dest")
    calls = located.join(trips, "trip_id").filter(board | alight).withColumn("__dest", F.explode(ends)).withColumn(
        "__time", F.when(is_dest, F.col("arrival_time")).otherwise(F.col("departure_time"))
    ).drop("arrival_time", "departure_time", "__hour", "hour", *(f"{side}_{degrees}" for side in SIDES for degrees in ("lat", "lon")))
    alighting = F.struct(
        F.col("__time").alias("alight_time"), F.col("stop_name").alias("alight_stop"),
        F.col("stop_lat").alias("alight_lat"), F.col("stop_lon").alias("alight_lon"),
    )
    # At one sequence boardings come first: only later calls are arrivals of theirs.
    backwards = Window.partitionBy("request_id", "trip_id").orderBy(F.desc("stop_sequence"), "__dest", F.desc("stop_id"))
    met = backwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rides = (
        calls.withColumn("__alight", F.last(F.when(F.col("__dest"), alighting), ignorenulls=True).over(met))
        .filter(~F.col("__dest") & F.col("__alight").isNotNull())
        .withColumnsRenamed({"__time": "board_time", "stop_name": "board_stop", "stop_lat": "board_lat", "stop_lon": "board_lon"})
    )
    if serving_routes is None:
        return rides.withColumn("route", F.coalesce("route_short_name", "route_id"))
    names = distinct_on(
        serving_routes.select("shape_id", "route_long_name"), ["shape_id"], ["route_long_name"]
    )
    named = rides.join(names, "shape_id", "left")
    return named.withColumn("route", F.coalesce("route_short_name", "route_long_name", "route_id"))


def direct_departures(
    stop_times: DataFrame,
    stops: DataFrame,
    requests: DataFrame,
    serving_routes: DataFrame | None = None,
    *,
    radius_m: float = RADIUS_M,
    hours_on: int = HOURS_ON,
) -> DataFrame:
    """Boardings near the origin of each request from which the trip goes on to
    a stop near the destination, with the first such call; one per request, route label and departure.

    ``requests`` has request_id, origin_lat, origin_lon, dest_lat, dest_lon and
    hour.  A boarding qualifies when the trip has a later call near the destination.
    """
    rides = _rides(stop_times, stops, requests, serving_routes, radius_m, hours_on)
    return distinct_on(
        rides, ["request_id", "route", "board_time"], ["trip_id", "stop_sequence", "stop_id"]
    ).select(
        "request_id", "route", "route_id", "trip_id", "stop_sequence", "board_time",
        "board_stop", "board_lat", "board_lon", *ALIGHT,
    )


def trip_plan(
    stop_times: DataFrame,
    stops: DataFrame,
    requests: DataFrame,
    serving_routes: DataFrame | None = None,
    *,
    radius_m: float = RADIUS_M,
    hours_on: int = HOURS_ON,
) -> DataFrame:
    """Earliest direct trip per route for every request, by the clock and not by its text."""
    rides = _rides(stop_times, stops, requests, serving_routes, radius_m, hours_on)
    planned = distinct_on(
        rides, ["request_id", "route"],
        [F.asc_nulls_last(gtfs_seconds(F.col("board_time"))), "board_time", "trip_id", "stop_sequence", "stop_id"],
    ).select(
        "request_id", "route", "board_time", "route_id", "trip_id", "board_stop", "board_lat", "board_lon",
        *ALIGHT,
    )
    seconds = gtfs_seconds(F.col("alight_time")) - gtfs_seconds(F.col("board_time"))
    return planned.withColumn("duration_min", F.round(F.greatest(seconds, F.lit(0)) / 60, 1))
