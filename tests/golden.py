"""A small invented plant with planted faults; all results are worked out by hand."""

from datetime import date, datetime

from tierworks.schemas import EQUIPMENT, ORDERS, SENSOR_READINGS

# Four readings a day at 8, 9, 10 and 11 o'clock.
SENSORS = {
    "north-1": ("mill-1", "hall", [10.0, 20.0, 30.0, 40.0], [40.0, 30.0, 20.0, 10.0]),
    "north-2": ("mill-2", "hall", [100.0, 100.0, 100.0, 100.0], [300.0, 100.0, 300.0, 100.0]),
    "south-1": ("kiln-1", "yard", [50.0, 52.0, 54.0, 56.0], [60.0, 62.0, 64.0, None]),
    "south-2": ("kiln-2", "yard", [-5.0, 5.0, -5.0, 5.0], [-5.0, 5.0, -5.0, -2000.0]),
}
# sensor, day: readings, mean, deviation, median, p95, stability, signal, trend, spike, severity
ALERTS = {
    # squares of 15, 5, 5, 15 make 500, over three: 166.7, root 12.910; p95 lies 0.85 of the way from 30 to 40
    ("north-1", 15): (4, 25.0, 12.910, 25.0, 38.5, "NORMAL", "VERY_NOISY", "NO_HISTORY", "NO_HISTORY", "OK"),
    ("north-1", 16): (4, 25.0, 12.910, 25.0, 38.5, "NORMAL", "VERY_NOISY", "STEADY", "NORMAL", "OK"),
    ("north-2", 15): (4, 100.0, 0.0, 100.0, 100.0, "STABLE", "CLEAN", "NO_HISTORY", "NO_HISTORY", "OK"),
    # four squares of 100 over three: 13333.3, root 115.470; the maximum rose by 200, less than twice that
    ("north-2", 16): (4, 200.0, 115.470, 200.0, 300.0, "UNSTABLE", "VERY_NOISY", "DEGRADING", "NORMAL", "CRITICAL"),
    ("south-1", 15): (4, 53.0, 2.582, 53.0, 55.7, "STABLE", "CLEAN", "NO_HISTORY", "NO_HISTORY", "OK"),
    ("south-1", 16): (3, 62.0, 2.0, 62.0, 63.8, "STABLE", "CLEAN", "IMPROVING", "SPIKE", "OK"),
    ("south-2", 15): (4, 0.0, 5.774, 0.0, 5.0, "NORMAL", "INVALID", "NO_HISTORY", "NO_HISTORY", "OK"),
    ("south-2", 16): (3, -5.0 / 3, 5.774, -5.0, 4.0, "NORMAL", "VERY_NOISY", "STEADY", "NORMAL", "OK"),
}
# days with a value beyond one deviation from the mean (exactly on it is inside)
OUTSIDE = {("north-1", 15), ("north-1", 16), ("south-1", 15), ("south-2", 16)}
# number, unit, day of January, quantity, value, status, priority
ORDER_ROWS = [
    (1, "U1", 10, 2, 12000.0, "RELEASED", "HIGH"), (2, "U2", 10, 1, 5000.0, "RELEASED", "LOW"),
    (3, "U1", 11, 4, 100.0, "COMPLETED", "LOW"), (4, "U2", 11, 1, 300.0, "CANCELLED", "LOW"),
    (5, None, 12, 1, 400.0, "RELEASED", "HIGH"), (6, "U1", None, 1, 600.0, "RELEASED", "HIGH"),
    (7, "U2", 12, 3, 2000.0, "RELEASED", None),
]
UNITS = [
    ("U1", "mill-1", "MILL", 2012, "ACTIVE"), ("U2", "mill-2", "MILL", 2021, "ACTIVE"),
    ("U3", "kiln-1", "KILN", 2005, "DECOMMISSIONED"),
]


def readings(spark):
    rows = []
    for sensor, (unit, area, first, second) in SENSORS.items():
        for day, values in ((15, first), (16, second)):
            for i, value in enumerate(values):
                at = datetime(2024, 1, day, 8 + i)
                state = "ERROR" if value is None else "ACTIVE"
                rows.append((sensor, f"gauge {sensor}", unit, value, at, state, area, at.replace(minute=5)))
    return spark.createDataFrame(rows, SENSOR_READINGS)


def orders(spark):
    rows = []
    for n, unit, day, quantity, value, status, priority in ORDER_ROWS:
        placed = date(2024, 1, day) if day else None
        rows.append((f"O{n}", "T1", unit, "M1", placed, quantity, value, status, priority, "clerk", datetime(2024, 1, day or 16, 6)))
    return spark.createDataFrame(rows, ORDERS)


def equipment(spark):
    rows = [(i, n, t, f"place {i}", date(y, 6, 1), "maker", s, datetime(2024, 1, 1)) for i, n, t, y, s in UNITS]
    return spark.createDataFrame(rows, EQUIPMENT)
