"""Column types of the transit tables, feeds and snapshots."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
DOUBLE, FLOAT, LOCAL_TIME = T.DoubleType(), T.FloatType(), T.TimestampNTZType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# GTFS ids are text; only the columns the operators use are listed.
STOPS = _struct(stop_id=TEXT, stop_name=TEXT, stop_lat=DOUBLE, stop_lon=DOUBLE)
ROUTES = _struct(route_id=TEXT, route_short_name=TEXT, route_long_name=TEXT)
TRIPS = _struct(trip_id=TEXT, route_id=TEXT)

# Flattened feeds, as the flattening of messages gives them.
TRIP_UPDATES = _struct(
    trip_id=TEXT,
    route_id=TEXT,
    direction_id=INT,
    stop_id=TEXT,
    stop_sequence=INT,
    arrival_time=LONG,
    departure_time=LONG,
)
VEHICLE_POSITIONS = _struct(
    trip_id=TEXT,
    route_id=TEXT,
    stop_id=TEXT,
    latitude=DOUBLE,
    longitude=DOUBLE,
    bearing=DOUBLE,
    speed=DOUBLE,
    timestamp=LONG,
    vehicle_id=TEXT,
)

# Decoded real-time messages, one row per message.
_EVENT = _struct(time=LONG)
TRIP_UPDATE_FEED = _struct(
    entity=T.ArrayType(
        _struct(
            id=TEXT,
            trip_update=_struct(
                trip=_struct(trip_id=TEXT, route_id=TEXT, direction_id=INT),
                stop_time_update=T.ArrayType(
                    _struct(stop_id=TEXT, stop_sequence=INT, arrival=_EVENT, departure=_EVENT)
                ),
            ),
        )
    )
)
VEHICLE_FEED = _struct(
    entity=T.ArrayType(
        _struct(
            id=TEXT,
            vehicle=_struct(
                trip=_struct(trip_id=TEXT, route_id=TEXT),
                stop_id=TEXT,
                position=_struct(latitude=FLOAT, longitude=FLOAT, bearing=FLOAT, speed=FLOAT),
                timestamp=LONG,
                vehicle=_struct(id=TEXT),
            ),
        )
    )
)

# Exported snapshots that later questions read back.
MINUTE_SNAPSHOT = _struct(minute_ts=LOCAL_TIME, avg_delay_min=DOUBLE)
MINUTE_TOTALS = _struct(minute_ts=LOCAL_TIME, sum_sec=LONG, sum_us=LONG, n_delay=LONG)
STOP_SNAPSHOT = _struct(
    stop_id=TEXT, stop_name=TEXT, stop_lat=DOUBLE, stop_lon=DOUBLE, avg_delay_min=DOUBLE
)
