"""tramflow: transit-delay analytics as Spark DataFrame operators.

GPS pings are matched to the nearest stop of their line, joined to scheduled
departures inside a time band on the right service day, turned into delays,
and given a route direction from the previous distinct stop.  Reference data
(schedule dumps, stop feeds, nested routes) is parsed by Spark jobs, and the
relational loads run as key- and foreign-key-checked set operations.

Every operator is ``DataFrame -> DataFrame`` with column names as arguments;
actions happen only at the edges (sinks, bench, tests).
"""

__version__ = "0.1.0"
