"""Marker-delimited schedule dump -> tables, as Spark jobs.

The dump is Latin-1 text with nested marker blocks::

    Linia:   1  - LINIA TRAMWAJOWA        line header
      *TR n                                 n routes follow
         TP-A , START ==> END               route header
            *LW m ... #LW                   m stop lines of the route
            *RP k / #OP                     next line: stop number (unit + post)
            *OD n                           next n lines: "HH.MM route/day_type/x"
    #WK                                     end of the line section
    *KA n ... #KA                           calendar: "yyyy-MM-dd k CODE CODE ..."

The file is read with the end marker as record separator (splittable; one
section per record), bytes are decoded with the dump's charset, and each
record is exploded into numbered lines.  Grammar state (current line, stop,
departure block, street) is carried with ``last(..., ignorenulls)`` over the
record's lines in order -- a partitioned window, one section per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramflow.functions.timeofday import departure_seconds, seconds_to_hms
from tramflow.operators.nested import assemble

# Markers of the dump grammar and the line filters.
LINE_MARKER = "Linia:"
SECTION_END = "#WK"
CALENDAR_START = "*KA"
CALENDAR_END = "#KA"
ROUTES_MARKER = "*TR"
STOPS_START = "*LW"
STOPS_END = "#LW"
STOP_MARKERS = ("*RP", "#OP")
DEPARTURES_MARKER = "*OD"
TRAM_CLASS = "TRAMWAJOWA"
EXCLUDED_LINES = ("T", "36")
DEFAULT_ENCODING = "ISO-8859-1"

_ROWS = (Window.unboundedPreceding, Window.currentRow)


def _tokens(line: Column) -> Column:
    return F.split(F.regexp_replace(line, r"^\s+|\s+$", ""), r"\s+")


def _tok(tokens: Column, i: int) -> Column:
    """1-based token, NULL when missing or blank."""
    t = F.try_element_at(tokens, F.lit(i))
    return F.when(F.length(t) > 0, t)


def read_records(spark: SparkSession, path: str, separator: str, encoding: str = DEFAULT_ENCODING) -> DataFrame:
    """Records between ``separator`` markers, decoded, with a file-order key.

    ``_rec`` increases in file order inside a split and splits keep file order,
    so (file, block start, _rec) orders the records of a file.
    """
    raw = spark.read.option("lineSep", separator).text(path)
    return raw.select(
        F.decode(F.col("value").cast("binary"), encoding).alias("text"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_rec"),
    )


def record_lines(records: DataFrame) -> DataFrame:
    """One row per line of every record: (_file, _block, _rec, pos, line).

    The first line of a record continues the separator's line and the last
    line starts it; both belong to the marker line, which the grammar consumes,
    so they are dropped -- except at the file's first and last record.
    """
    keys = records.select("_file", "_block", "_rec")
    ends = keys.groupBy("_file").agg(
        F.min(F.struct("_block", "_rec")).getField("_rec").alias("_first_rec"),
        F.max(F.struct("_block", "_rec")).getField("_rec").alias("_last_rec"),
    )
    parts = F.split(F.col("text"), r"\r?\n")
    lines = records.select(
        "_file", "_block", "_rec", (F.size(parts) - 1).alias("_n"), F.posexplode(parts).alias("pos", "line")
    )
    lines = lines.join(F.broadcast(ends), "_file")
    keep = ((F.col("pos") > 0) | (F.col("_rec") == F.col("_first_rec"))) & (
        (F.col("pos") < F.col("_n")) | (F.col("_rec") == F.col("_last_rec"))
    )
    return lines.filter(keep).drop("_n", "_first_rec", "_last_rec")


def _section_lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    return record_lines(read_records(spark, path, SECTION_END, encoding))


# ------------------------------------------------------------------ X1

def line_sections(lines: DataFrame) -> DataFrame:
    """Lines of each timetable line section.

    A section starts at a line holding ``Linia:`` whose second token is a
    decimal of at most two digits, and runs to the section end marker.  When a
    line number occurs in several sections the last one (file order) wins.
    Adds ``line_nr`` (the section's number) and keeps ``_rec``/``pos``.
    """
    toks = _tokens(F.col("line"))
    start = F.col("line").contains(LINE_MARKER) & F.coalesce(_tok(toks, 2).rlike(r"^[0-9]{1,2}$"), F.lit(False))
    w = Window.partitionBy("_rec").orderBy("pos").rowsBetween(*_ROWS)
    marked = lines.withColumn("_start_pos", F.min(F.when(start, F.col("pos"))).over(w)).withColumn(
        "_start_nr", F.first(F.when(start, _tok(toks, 2)), ignorenulls=True).over(w)
    )
    in_section = marked.filter(F.col("_start_pos").isNotNull())
    heads = in_section.filter(F.col("pos") == F.col("_start_pos")).select(
        "_file", "_block", "_rec", F.col("_start_nr").alias("line_nr")
    )
    latest = heads.groupBy("line_nr").agg(
        F.max(F.struct("_file", "_block", "_rec")).getField("_rec").alias("_rec")
    )
    # numbers have two digits at most, so there are few latest sections; each knows its own number
    return in_section.join(F.broadcast(latest), "_rec", "left_semi").select("_rec", "pos", "line", F.col("_start_nr").alias("line_nr"))


# ------------------------------------------------------------------ X2/X3

def departures(sections: DataFrame) -> DataFrame:
    """Departure state machine over section lines.

    ``*RP``/``#OP``: the next line's first token is the stop (unit = first 4
    characters, post = the rest).  ``*OD n``: the next n lines are departures
    ``HH.MM route/day_type/...``, numbered 0..n-1.  The current line number is
    the last ``Linia:`` line's second token.
    """
    line = F.col("line")
    toks = _tokens(line)
    w = Window.partitionBy("_rec").orderBy("pos")
    wr = w.rowsBetween(*_ROWS)
    is_rp = line.contains(STOP_MARKERS[0]) | line.contains(STOP_MARKERS[1])
    is_od = line.contains(DEPARTURES_MARKER)
    d = (
        sections.withColumn("_is_od", is_od)
        .withColumn("_stop_line", F.coalesce(F.lag(is_rp).over(w), F.lit(False)))
        .withColumn("_cur_line", F.last(F.when(line.contains(LINE_MARKER), _tok(toks, 2)), ignorenulls=True).over(wr))
        .withColumn("_cur_stop", F.last(F.when(F.col("_stop_line"), _tok(toks, 1)), ignorenulls=True).over(wr))
        # one struct per marker line: a block with an unreadable count has none, not its predecessor's
        .withColumn("_od", F.last(F.when(is_od, F.struct("pos", _tok(toks, 2).try_cast("int").alias("n"))), ignorenulls=True).over(wr))
    )
    k = F.col("pos") - F.col("_od.pos")
    # only departure lines are split into all their tokens, after the windows
    deps = d.filter(~F.col("_is_od") & ~F.col("_stop_line") & (k >= 1) & (k <= F.col("_od.n"))).withColumn("_toks", toks)
    hour_text = _tok(F.col("_toks"), 1)
    tag = F.split(_tok(F.col("_toks"), 2), "/")
    dep_sec = departure_seconds(hour_text)
    return deps.select(
        F.col("_cur_line").alias("line"),
        F.try_element_at(tag, F.lit(1)).alias("route"),
        F.try_element_at(tag, F.lit(2)).alias("day_type"),
        F.substring(F.col("_cur_stop"), 1, 4).alias("unit"),
        F.substr(F.col("_cur_stop"), F.lit(5)).alias("post"),
        seconds_to_hms(dep_sec).alias("departure_time"),
        dep_sec.cast("int").alias("dep_sec"),
        (k - 1).cast("int").alias("order"),
    )


def parse_timetable(spark: SparkSession, path: str, encoding: str = DEFAULT_ENCODING) -> DataFrame:
    return departures(line_sections(_section_lines(spark, path, encoding)))


# ------------------------------------------------------------------ X4

def calendar_days(lines: DataFrame) -> DataFrame:
    """``*KA`` block lines -> (day, day_types): token 0 and tokens 2..."""
    w = Window.partitionBy("_rec").orderBy("pos").rowsBetween(*_ROWS)
    line = F.col("line")
    toks = _tokens(line)
    opens, closes = line.contains(CALENDAR_START), line.contains(CALENDAR_END)
    d = lines.withColumn("_open", F.last(F.when(opens, True).when(closes, False), ignorenulls=True).over(w))
    body = d.filter(F.col("_open") & ~opens & F.col("line").rlike(r"\S"))
    return body.select(
        F.try_to_date(_tok(toks, 1), "yyyy-MM-dd").alias("day"),
        F.slice(toks, 3, F.greatest(F.size(toks) - 2, F.lit(0))).alias("day_types"),
    )


def parse_calendar(spark: SparkSession, path: str, encoding: str = DEFAULT_ENCODING) -> DataFrame:
    """The calendar block of the record that holds it (the preamble before the first section), so no record exceeds a section."""
    return calendar_days(_section_lines(spark, path, encoding))


# ------------------------------------------------------------------ X5-X7

def _route_marks(lines: DataFrame) -> DataFrame:
    """Per line: the section's tram-line header, route count, and the current
    ``*LW`` block (its position, size and route number)."""
    line = F.col("line")
    toks = _tokens(line)
    w = Window.partitionBy("_rec").orderBy("pos")
    wr = w.rowsBetween(*_ROWS)
    is_head = line.contains("Linia") & line.contains(TRAM_CLASS)
    is_lw = line.contains(STOPS_START)
    d = (
        lines.withColumn("_toks", toks)
        .withColumn("_is_lw", is_lw)
        .withColumn("_head_nr", F.last(F.when(is_head, _tok(toks, 2)), ignorenulls=True).over(wr))
        .withColumn("_n_routes", F.last(F.when(line.contains(ROUTES_MARKER), _tok(toks, 2).try_cast("int")), ignorenulls=True).over(wr))
        .withColumn("_prev_first", F.lag(_tok(F.col("_toks"), 1)).over(w))
        .withColumn("_lw", F.last(F.when(is_lw, F.struct("pos", _tok(toks, 2).try_cast("int").alias("n"), "_prev_first")), ignorenulls=True).over(wr))
    )
    ok_line = F.col("_head_nr").isNotNull() & ~F.col("_head_nr").isin(*EXCLUDED_LINES)
    return d.filter(ok_line).select(
        "_rec", "pos", "line", "_toks", "_is_lw",
        F.col("_head_nr").alias("line_nr"),
        F.col("_n_routes").alias("number_of_routes"),
        F.col("_lw.pos").alias("route_pos"),
        F.col("_lw._prev_first").alias("route_nr"),
        F.col("_lw.n").alias("number_of_stops"),
    )


def route_headers(lines: DataFrame) -> DataFrame:
    """One row per ``*LW`` block of a tram line: the route, even with no stops."""
    marks = _route_marks(lines)
    return marks.filter(F.col("_is_lw")).select(
        "_rec", "line_nr", "number_of_routes", "route_pos", "route_nr", "number_of_stops"
    )


def route_stop_lines(lines: DataFrame) -> DataFrame:
    """Stop lines of every ``*LW`` block with their route and line.

    Only sections whose header is a tram line (``TRAMWAJOWA``, not ``T``/``36``)
    count.  The route number is the first token of the line before ``*LW``.
    """
    marks = _route_marks(lines)
    k = F.col("pos") - F.col("route_pos")
    return marks.filter((k >= 1) & (k <= F.col("number_of_stops"))).drop("_is_lw")


def _remove_first(text: Column, part: Column) -> Column:
    at = F.instr(text, part)
    head = F.substr(text, F.lit(1), at - 1)
    return F.when((F.length(part) > 0) & (at > 0), F.concat(head, F.substr(text, at + F.length(part)))).otherwise(text)


def tokenize_stops(stop_lines: DataFrame) -> DataFrame:
    """Stop-line tokeniser.

    Optional ``r`` token sets ``r_flag``; the stop number is the first all-digit
    token; tokens before it are the street, carried to later stops of the same
    route that start with the number; the name is the text before the first
    comma once ``--`` reads as a comma; the pipe-separated fields 1 and 2 are the
    minimum/maximum minutes, blank meaning 0.
    """
    toks = F.col("_toks")
    r_flag = F.array_contains(toks, "r")
    data = F.col("_data")
    d = stop_lines.withColumn("_r", r_flag).withColumn(
        "_data",
        F.when(
            F.col("_r"),
            F.concat(
                F.slice(toks, 1, F.array_position(toks, "r").cast("int") - 1),
                F.slice(toks, F.array_position(toks, "r").cast("int") + 1, F.size(toks)),
            ),
        ).otherwise(toks),
    )
    # tokens joined by single spaces: the first all-digit token and the whole
    # tokens before it (each followed by its space) come from two expressions
    # columns of their own, so that what refers to them several times does not compute them again
    d = d.withColumn("_joined", F.array_join(data, " "))
    joined = F.col("_joined")
    first_number = F.regexp_extract(joined, r"(?:^| )([0-9]+)(?= |$)", 1)
    before_number = F.regexp_extract(joined, r"^((?:[^ ]+ )*?)[0-9]+(?: |$)", 1)
    has_number = F.col("_number") != ""
    starts_digit = joined.rlike(r"^[0-9]+( |$)")
    own_street = F.when(~starts_digit, F.when(has_number, before_number).otherwise(F.concat(joined, F.lit(" "))))
    w = Window.partitionBy("_rec", "route_pos").orderBy("pos").rowsBetween(*_ROWS)
    d = (
        d.withColumn("_number", first_number)
        .withColumn("stop_nr", F.when(has_number, F.col("_number")))
        .withColumn("_own_street", own_street)
        .withColumn("_street_raw", F.coalesce(F.last("_own_street", ignorenulls=True).over(w), F.lit("")))
    )
    # a carried street is stripped of commas before it is searched for again
    search = F.when(F.col("_own_street").isNotNull(), F.col("_own_street")).otherwise(
        F.regexp_replace(F.col("_street_raw"), ",", "")
    )
    d = d.withColumn("_search", search).withColumn("_text", _remove_first(joined, F.col("_search")))
    text = F.col("_text")
    text = F.when(F.col("stop_nr").isNotNull(), F.replace(text, F.col("stop_nr"), F.lit(""))).otherwise(text)
    d = d.withColumn("_plain", F.replace(F.trim(text), F.lit("--"), F.lit(",")))
    text = F.col("_plain")
    d = d.withColumn("_fields", F.split(text, r"\|"))
    fields = F.col("_fields")

    def minutes(i: int) -> Column:
        v = F.ltrim(F.try_element_at(fields, F.lit(i + 1)))
        return F.when(v == "", F.lit(0)).otherwise(v.try_cast("int")).cast("int")

    return d.select(
        "_rec", "pos", "line_nr", "number_of_routes", "route_pos", "route_nr", "number_of_stops",
        "stop_nr",
        F.split(text, ",").getItem(0).alias("stop_name"),
        F.regexp_replace(F.col("_street_raw"), ",", "").alias("street"),
        F.col("_r").alias("r_flag"),
        minutes(1).alias("min_time"),
        minutes(2).alias("max_time"),
    )


def routes_documents(stops: DataFrame, headers: DataFrame) -> DataFrame:
    """Nest stops into routes into one document per line section (A5).

    Routes come from the ``*LW`` headers, so a route without stops keeps an
    empty stops array.
    """
    stop_arrays = assemble(
        stops, ["_rec", "route_pos"], ["stop_nr", "stop_name", "street", "r_flag", "min_time", "max_time"], ["pos"], "stops"
    )
    empty = F.array().cast(stop_arrays.schema["stops"].dataType)
    # joined by section on a map of its routes' arrays: both sides keep the partitioning by section
    by_route = stop_arrays.groupBy("_rec").agg(F.map_from_entries(F.collect_list(F.struct("route_pos", "stops"))).alias("_stops"))
    routes = headers.join(by_route, "_rec", "left").withColumn(
        "stops", F.coalesce(F.try_element_at("_stops", F.col("route_pos")), empty)
    )
    lines = assemble(
        routes, ["_rec", "line_nr", "number_of_routes"], ["route_nr", "number_of_stops", "stops"], ["route_pos"], "routes"
    )
    return lines.select("line_nr", F.col("number_of_routes").cast("int").alias("number_of_routes"), "routes")


def parse_routes(spark: SparkSession, path: str, encoding: str = DEFAULT_ENCODING) -> DataFrame:
    lines = _section_lines(spark, path, encoding)
    return routes_documents(tokenize_stops(route_stop_lines(lines)), route_headers(lines))
