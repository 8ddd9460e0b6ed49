"""Findings of round 4."""

import datetime as dt
import glob
import random

from conftest import SF001
from tramflow.llm import collinear
from tramflow.operators import nearest
from tramflow.operators.nearest import nearest_match
from tramflow.plans import catalog, jobs, loads
from tramflow.plans import driver_views as dv
from tramflow.session import shuffles_removed
from tramflow.sources.sinks import staged

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)


def _match(spark, pings, stops, **options):
    left = spark.createDataFrame(pings, "Lines string, Brigade string, Time timestamp_ntz, VehicleNumber string, Lon double, Lat double")
    right = spark.createDataFrame(stops, "line_nr string, stop_nr string, s_Lon double, s_Lat double")
    return nearest_match(
        left, right, on=[("Lines", "line_nr")], left_xy=("Lon", "Lat"), right_xy=("s_Lon", "s_Lat"), group_by=["Lines", "Brigade", "Time"],
        right_cols=["stop_nr"], right_order=["stop_nr"], left_order=["VehicleNumber", "Lat", "Lon"], **options)


def test_all_pairs_without_a_grid_are_compared_in_blocks(spark, monkeypatch):
    """Finding 2: the plain join measured every pair of a line; only those that may be nearest are measured now."""
    monkeypatch.setattr(nearest, "_LEFT_ROWS", 50)
    monkeypatch.setattr(nearest, "_RIGHT_ROWS", 30)
    rnd = random.Random(4)
    odd = [float("nan"), float("inf"), 1e6, -359.0, 180.0, 201.0]
    stops = [(str(i % 2), f"s{i:03d}", rnd.choice(odd) if i % 9 == 0 else 21 + rnd.randrange(40) / 100, 52 + rnd.randrange(30) / 100) for i in range(300)]
    stops += [("only", f"n{i}", float("nan"), 52.0) for i in range(3)] + [("alone", "z", 21.0, 52.0)]
    pings = [(("0", "1", "only", "none", None)[i % 5], str(i % 3), T0 + dt.timedelta(seconds=i // 8), f"v{i % 11}",
              rnd.choice([*odd, None]) if i % 13 == 0 else 21 + rnd.randrange(80) / 200, (-52 if i % 7 == 0 else 52) + rnd.randrange(60) / 200) for i in range(600)]
    pings += pings[:40]
    found = _match(spark, pings, stops, cell_deg=None, grid_min_candidates=0)
    plain = _match(spark, pings, stops, cell_deg=None, grid_min_candidates=10**9)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().executedPlan().toString()
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(found) == rows(plain) and found.count() > 300


def _shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle_" in files.apply(i).getName() for i in range(files.length()))


def _checkpoints(spark) -> set:
    return set(glob.glob(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/rdd-*"))


def test_a_reload_leaves_no_shuffles_and_checkpoints(spark, scratch):
    """Finding 4: each load's shuffle files and numbered rows stayed on disk beside the next ones."""
    stops, routes, timetable = dv.stops_feed(spark, SF001), dv.routes_nested(spark, SF001), catalog._timetable_doc(spark, SF001)
    files, checkpoints = _shuffle_files(spark), _checkpoints(spark)
    with shuffles_removed(spark):
        routes = staged(routes, f"{scratch}/in")
    first, again = (jobs.reload_tables(stops, routes, timetable, f"{scratch}/db", loads.DEFAULT_LOAD_TS) for _ in range(2))
    assert _checkpoints(spark) == checkpoints and _shuffle_files(spark) <= files
    assert first == again and sum(map(sum, again.values())) > 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") != "true"


def test_streamed_delays_leave_no_shuffles_and_timetable_checkpoint(spark):
    """Finding 3: every micro-batch's shuffle of the whole timetable stayed on disk, and the timetable as a checkpoint."""
    files, checkpoints = _shuffle_files(spark), _checkpoints(spark)
    found = catalog.REGISTRY["t5_stream_delays"].build(spark, SF001)
    assert len(_checkpoints(spark) - checkpoints) <= 3  # the three parts of the stops' index
    assert _shuffle_files(spark) - files <= 100  # of small inputs that are looked at before the stream starts; 600 and more before
    assert found.columns[0] == "Lines" and found.count() > 0


def test_fuzzy_passages_of_seeds_that_the_texts_repeat(spark):
    """Finding 5: of a seed's places in a text only the first and the last met those of another text."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    prose = lambda n: [word() for _ in range(n)]
    rows, planted = [], []
    for both in (False, True):
        for crowd in (0, 5):
            passage = prose(80)
            variant = [word() if k % 16 == 15 else w for k, w in enumerate(passage)]  # runs of 15 words
            runs = [passage[at : at + 15] for at in range(0, 80, 16)]

            def stray(runs=runs):
                """Every two runs near each other, but no passage."""
                return [w for l in range(5) for k in range(l) for w in runs[k] + prose(18) + runs[l] + prose(110)]

            one = prose(30) + stray() + prose(60) + passage + prose(60) + stray() + prose(30)
            other = (stray() if both else []) + prose(60) + variant + prose(60) + (stray() if both else [])
            planted.append((len(rows), len(rows) + 1))
            rows += [" ".join(one), " ".join(other)] + [" ".join(prose(40) + run + prose(40)) for run in runs for _ in range(crowd)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {(r.doc_id, r.partner_id) for r in collinear.passages(docs).collect()}
    assert got == {(a, b) for a, b in planted} | {(b, a) for a, b in planted}
