"""Declared schemas of the conformed race tables (no inference on read)."""

from __future__ import annotations

from pyspark.sql import types as T

I, L, D, S, B = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


CONFORMED: dict[str, T.StructType] = {
    "laps": _schema(("season", I), ("round", I), ("driverId", S), ("constructorId", S),
                    ("lap", I), ("lap_ms", L), ("is_pit", B), ("qty", D), ("disc", D),
                    ("tax", D)),
    "lap_times": _schema(("season", I), ("round", I), ("driverId", S), ("lap", I),
                         ("position", I), ("time", S)),
    "pit_stops": _schema(("season", I), ("round", I), ("driverId", S), ("lap", I),
                         ("stop", I), ("duration", S)),
    "qualifying": _schema(("season", I), ("round", I), ("driverId", S), ("constructorId", S),
                          ("position", I), ("q1", L), ("q2", L), ("q3", L)),
    "race_results": _schema(("season", I), ("round", I), ("driverId", S), ("constructorId", S),
                            ("position", S), ("points", D), ("laps", I)),
    "driver_standings": _schema(("season", I), ("driverId", S), ("points", D), ("wins", I),
                                ("position", I)),
    "constructor_standings": _schema(("season", I), ("constructorId", S), ("points", D),
                                     ("wins", I), ("position", I)),
    "weather": _schema(("season", I), ("round", I), ("mean_temp", D),
                       ("precipitation_sum", D), ("windspeed_mean", D)),
    "races": _schema(("season", I), ("round", I), ("raceName", S), ("circuitId", S)),
}
