"""Queries over spots and tracks: filters, kinematics, ingression, joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tetraframe.operators import filters as fl
from tetraframe.operators import ingression as ing
from tetraframe.operators import joins as jn
from tetraframe.operators import kinematics as kin
from tetraframe.operators import reports as rep
from tetraframe.plans import fixtures as fx
from tetraframe.plans.book import Book, r, rounded

BOX = (50.0, 350.0, 20.0, 180.0)
IN_BOX = "position_x BETWEEN 50.0 AND 350.0 AND position_y BETWEEN 20.0 AND 180.0"
CENTER = (200.0, 100.0, 50.0)
LENGTH, SPEED = 60, 200.0
COLS = "track_id, frame, position_x, position_y, position_z, id"

STEP = """speeds AS (SELECT *, CASE WHEN track_id IS NOT NULL AND frame > pf THEN sqrt((position_x - px) * (position_x - px) + (position_y - py) * (position_y - py) + (position_z - pz) * (position_z - pz)) / (frame - pf) END AS step_speed FROM (
  SELECT *, lag(frame) OVER w AS pf, lag(position_x) OVER w AS px, lag(position_y) OVER w AS py, lag(position_z) OVER w AS pz FROM spots WINDOW w AS (PARTITION BY track_id ORDER BY frame, id)))"""
LIMITS = "limits AS (SELECT track_id, count(frame) AS length, max(step_speed) AS max_speed FROM speeds WHERE track_id IS NOT NULL GROUP BY track_id)"
RADIAL = """radial AS (SELECT *, CASE WHEN track_id IS NOT NULL AND frame > lag(frame) OVER w THEN (radial_dist_to_center - lag(radial_dist_to_center) OVER w) / (frame - lag(frame) OVER w) END AS radial_velocity
  FROM (SELECT *, sqrt((position_x - 200.0) * (position_x - 200.0) + (position_y - 100.0) * (position_y - 100.0) + (position_z - 50.0) * (position_z - 50.0)) AS radial_dist_to_center FROM spots) WINDOW w AS (PARTITION BY track_id ORDER BY frame, id))"""
SMOOTH = "smooth AS (SELECT *, CASE WHEN track_id IS NOT NULL THEN avg(radial_velocity) OVER (PARTITION BY track_id ORDER BY frame, id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) END AS v FROM radial)"
VSTATS = "vstats AS (SELECT track_id, median(v) AS med, avg(v) AS mean, avg(CASE WHEN v < 0 THEN 1.0 WHEN v >= 0 THEN 0.0 END) AS inward, min(v) AS lo, count(frame) AS n FROM smooth WHERE track_id IS NOT NULL GROUP BY track_id)"
RUNS = """islands AS (SELECT *, sum(CASE WHEN inw THEN 0 ELSE 1 END) OVER (PARTITION BY track_id ORDER BY frame, id) AS island FROM (SELECT *, coalesce(v < 0, false) AS inw FROM smooth WHERE track_id IS NOT NULL)),
runs AS (SELECT *, CASE WHEN inw THEN count(*) FILTER (WHERE inw) OVER (PARTITION BY track_id, island ORDER BY frame, id) ELSE 0 END AS run FROM islands),
epochs AS (SELECT *, sum(reset) OVER (PARTITION BY track_id ORDER BY frame, id) AS epoch FROM (SELECT *, CASE WHEN NOT inw AND coalesce(lag(run) OVER (PARTITION BY track_id ORDER BY frame, id), 0) < 3 THEN 1 ELSE 0 END AS reset FROM runs)),
tops AS (SELECT track_id, max(epoch) AS top, max(run) AS sustained, arg_max(radial_dist_to_center, frame) - arg_min(radial_dist_to_center, frame) AS disp FROM epochs GROUP BY track_id),
onsets AS (SELECT e.track_id, any_value(t.sustained)::BIGINT AS sustained, any_value(t.disp) AS disp, min(e.frame) FILTER (WHERE inw AND epoch = top) AS onset FROM epochs e JOIN tops t USING (track_id) GROUP BY e.track_id)"""
FLAGS = """flags AS (SELECT s.track_id, s.n, s.med, s.inward, o.sustained, o.disp, o.onset,
  coalesce(s.n >= 5 AND s.med <= -0.5 AND s.inward >= 0.3 AND (o.disp IS NULL OR o.disp < -0.5) AND o.sustained >= greatest(3, floor(s.n * 0.15)), false) AS ingressing,
  0.30 * least(greatest((-0.5 - s.med) / 0.5, 0.0), 2.0) / 2 + 0.20 * least(greatest(s.inward, 0.0), 1.0) + 0.25 * least(greatest(o.sustained::DOUBLE / greatest(s.n, 1), 0.0), 1.0) + 0.25 * least(greatest(coalesce(-o.disp, 0.0) / greatest(s.n, 1), 0.0), 1.0) AS score
  FROM vstats s JOIN onsets o USING (track_id))"""

BOOK = Book(voxels=fx.VOXELS, spots=fx.SPOTS, tracks=fx.TRACKS, speeds=STEP, limits=LIMITS, radial=RADIAL, smooth=SMOOTH, vstats=VSTATS, runs=RUNS, flags=FLAGS, cloud=fx.CLOUD)
KIN = ("spots", "radial", "smooth", "vstats", "runs", "flags")


def on(f):
    """A query that applies f to the spots."""
    return lambda spark, sf: f(fx.spots(spark, sf))


def motion(spark: SparkSession, sf: str) -> DataFrame:
    """Spots with all radial columns."""
    return kin.radial_motion(fx.spots(spark, sf), CENTER, 5)


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    """Spots with ingression flags."""
    return ing.flag_ingressing(motion(spark, sf), -0.5, 5, 0.3)


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Load, keep tracked, speeds, limits, kept tracks, summary."""
    spots = fx.spots(spark, sf)
    kept = fl.kept_dropped_ids(spots, 3, SPEED * 10).where("kept")
    return rounded(rep.track_summary(fl.track_set(spots, kept)))


a = BOOK.add
a("flt1_tracked_only", on(fl.tracked_only), f"SELECT {COLS} FROM spots WHERE track_id IS NOT NULL", "spots")
a("flt2_frame_range", on(lambda d: fl.frame_range(d, 100, 400)), f"SELECT {COLS} FROM spots WHERE frame BETWEEN 100 AND 400", "spots")
a("flt3_current_frame", on(lambda d: fl.current_frame(d, 200)), f"SELECT {COLS} FROM spots WHERE frame = 200", "spots")
a("flt4_roi_filter", on(lambda d: fl.roi_filter(d, *BOX)), f"SELECT {COLS} FROM spots WHERE {IN_BOX}", "spots")
a("flt4_flag_roi", on(lambda d: fl.flag_roi(d, *BOX)), f"SELECT {COLS}, {IN_BOX} AS in_roi FROM spots", "spots")
a("flt5_slab", on(lambda d: fl.slab(d, "z", 50.0, 20.0)), f"SELECT {COLS} FROM spots WHERE position_z BETWEEN 40 AND 60", "spots")
a(
    "flt6_slab_project",
    on(lambda d: fl.slab_project(fl.slab(d, "x", 200.0, 40.0), "x")),
    'SELECT id, frame, position_z AS "row", position_y AS col FROM spots WHERE position_x BETWEEN 180 AND 220',
    "spots",
)
a(
    "flt7_min_track_length",
    on(lambda d: fl.min_track_length(fl.tracked_only(d), LENGTH)),
    f"SELECT {COLS} FROM spots WHERE track_id IN (SELECT track_id FROM spots GROUP BY 1 HAVING count(frame) >= {LENGTH})",
    "spots",
)
a(
    "flt8_max_speed",
    on(lambda d: fl.max_speed(fl.tracked_only(d), SPEED)),
    f"SELECT {COLS} FROM spots WHERE track_id IN (SELECT track_id FROM limits WHERE max_speed <= {SPEED})",
    "spots",
    "speeds",
    "limits",
)
a(
    "flt8_max_speed_zero",
    on(lambda d: fl.max_speed(fl.tracked_only(d), SPEED, "zero")),
    f"SELECT {COLS} FROM spots WHERE track_id IN (SELECT track_id FROM limits WHERE coalesce(max_speed, 0) <= {SPEED})",
    "spots",
    "speeds",
    "limits",
)
a("flt9_track_set", lambda s, f: fl.track_set(fx.spots(s, f), fx.tracks(s, f)), f"SELECT {COLS} FROM spots WHERE track_id IN (SELECT track_id FROM tracks)", "spots", "tracks")
a(
    "flt10_tracks_touching_roi",
    on(lambda d: fl.tracks_touching_roi(d, 0.0, 100.0, 0.0, 20.0)),
    f"SELECT {COLS} FROM spots WHERE track_id IN (SELECT track_id FROM spots WHERE position_x BETWEEN 0 AND 100 AND position_y BETWEEN 0 AND 20)",
    "spots",
)
a(
    "flt11_tracks_ingressing",
    lambda s, f: fl.tracks_ingressing(flagged(s, f)).select("track_id", "frame", "id"),
    "SELECT track_id, frame, id FROM spots WHERE track_id IN (SELECT track_id FROM flags WHERE ingressing)",
    *KIN,
)
a(
    "flt12_tracks_in_slab",
    on(lambda d: fl.tracks_in_slab(d, "z", 50.0, 60.0, 100)),
    f"""
    SELECT {COLS}
    FROM (SELECT *, count(*) OVER (PARTITION BY track_id) AS n
    FROM spots
    WHERE position_z BETWEEN 20 AND 80 AND track_id IN (SELECT track_id
    FROM spots
    WHERE frame = 100 AND position_z BETWEEN 20 AND 80))
    WHERE n >= 2
    """,
    "spots",
)
PIPE = """base AS (SELECT * FROM spots WHERE track_id IN (SELECT track_id FROM spots WHERE position_x BETWEEN 50.0 AND 350.0 AND position_y BETWEEN 20.0 AND 180.0) AND frame BETWEEN 50 AND 600),
long AS (SELECT * FROM base WHERE track_id IN (SELECT track_id FROM base GROUP BY 1 HAVING count(*) >= 10)),
sp AS (SELECT *, CASE WHEN frame > lag(frame) OVER w THEN sqrt(pow(position_x - lag(position_x) OVER w, 2) + pow(position_y - lag(position_y) OVER w, 2) + pow(position_z - lag(position_z) OVER w, 2)) / (frame - lag(frame) OVER w) END AS s FROM long WINDOW w AS (PARTITION BY track_id ORDER BY frame, id))"""
BOOK.views["pipe"] = PIPE
a(
    "flt13_track_filter_pipeline",
    on(lambda d: fl.track_filter_pipeline(d, BOX, 50, 600, 10, 250.0)),
    f"SELECT {COLS} FROM sp WHERE track_id IN (SELECT track_id FROM sp GROUP BY 1 HAVING max(s) <= 250)",
    "spots",
    "pipe",
)
KEY = "((((id % 2147483647) * 48271 + 12345 + {s}) % 2147483647 * 1103515) % 2147483647 + (id // 65536) % 2147483647) * 69621 + 12345 + {s}"


def key(seed: int, id: str = "id") -> str:
    """The order of a seeded sample as SQL."""
    return f"({KEY.format(s=seed)}) % 2147483647, id".replace("id", id)


a(
    "flt13_track_filter_all_steps",
    lambda s, f: fl.track_filter_pipeline(flagged(s, f), (0.0, 400.0, 0.0, 200.0), 20, 700, 5, 600.0, selection=fx.tracks(s, f).select("track_id"), ingressing=True, most=3).select("track_id", "frame", "id"),
    f"""WITH chosen AS (SELECT * FROM spots WHERE track_id IN (SELECT track_id FROM tracks) AND track_id IN (SELECT track_id FROM spots WHERE position_x BETWEEN 0.0 AND 400.0 AND position_y BETWEEN 0.0 AND 200.0) AND track_id IN (SELECT track_id FROM flags WHERE ingressing) AND frame BETWEEN 20 AND 700),
  enough AS (SELECT * FROM chosen WHERE track_id IN (SELECT track_id FROM chosen GROUP BY 1 HAVING count(*) >= 5)),
  moved AS (SELECT *, CASE WHEN frame > lag(frame) OVER w THEN sqrt(pow(position_x - lag(position_x) OVER w, 2) + pow(position_y - lag(position_y) OVER w, 2) + pow(position_z - lag(position_z) OVER w, 2)) / (frame - lag(frame) OVER w) END AS s FROM enough WINDOW w AS (PARTITION BY track_id ORDER BY frame, id)),
  slow AS (SELECT track_id FROM moved GROUP BY 1 HAVING max(s) <= 600) SELECT track_id, frame, id FROM moved WHERE track_id IN (SELECT track_id FROM slow ORDER BY {key(42, 'track_id')} LIMIT 3)""",
    "spots",
    "tracks",
    "radial",
    "smooth",
    "vstats",
    "runs",
    "flags",
)
a(
    "flt14_display_points",
    lambda s, f: fl.display_points(flagged(s, f), BOX, None, True).select("track_id", "frame", "id"),
    f"SELECT track_id, frame, id FROM spots WHERE {IN_BOX} AND track_id IN (SELECT track_id FROM flags WHERE ingressing)",
    *KIN,
)
a(
    "flt14_display_share",
    lambda s, f: fl.display_points(fx.spots(s, f), BOX, fx.tracks(s, f).select("track_id"), False, 40.0, 50).select("track_id", "frame", "id"),
    f"""
    WITH shown AS (SELECT *
    FROM spots
    WHERE {IN_BOX} AND track_id IN (SELECT track_id
    FROM tracks)) SELECT track_id, frame, id
    FROM (SELECT *, row_number() OVER (ORDER BY {key(0)}) AS rn, count(*) OVER () AS n
    FROM shown)
    WHERE rn <= greatest(50, floor(n * 40.0 / 100))
    """,
    "spots",
    "tracks",
)
a(
    "flt15_kept_dropped_ids",
    on(lambda d: fl.kept_dropped_ids(d, LENGTH, SPEED)),
    f"SELECT track_id, length >= {LENGTH} AND coalesce(max_speed, 0) <= {SPEED} AS kept FROM limits",
    "spots",
    "speeds",
    "limits",
)
FLAGSQL = f"""SELECT s.track_id, s.frame, s.id, coalesce(s.track_id IS NOT NULL AND (l.length < {LENGTH} OR NOT coalesce(l.max_speed <= {SPEED}, false)), false) AS filtered_out,
  CASE WHEN s.track_id IS NULL THEN '' WHEN l.length < {LENGTH} AND NOT coalesce(l.max_speed <= {SPEED}, false) THEN 'min_length+max_speed' WHEN NOT coalesce(l.max_speed <= {SPEED}, false) THEN 'max_speed'
  WHEN l.length < {LENGTH} THEN '%s' ELSE '' END AS filter_reason FROM spots s LEFT JOIN limits l USING (track_id)"""
a("flt16_filter_flags", on(lambda d: fl.filter_flags(d, LENGTH, SPEED).select("track_id", "frame", "id", "filtered_out", "filter_reason")), FLAGSQL % "min_length", "spots", "speeds", "limits")
a("flt16_filter_flags_compat", on(lambda d: fl.filter_flags(d, LENGTH, SPEED, True).select("track_id", "frame", "id", "filtered_out", "filter_reason")), FLAGSQL % "", "spots", "speeds", "limits")
a("flt17_column_reorder", on(lambda d: fl.column_reorder(d, ["id", "frame"])), "SELECT id, frame, track_id, position_x, position_y, position_z FROM spots", "spots")
a("flt22_selected_tracks", lambda s, f: fl.selected_tracks(fx.spots(s, f), fx.tracks(s, f).where("track_id < 60")).select("track_id", "frame", "id", "drawable"),
  "SELECT track_id, frame, id, count(*) OVER (PARTITION BY track_id) >= 2 AS drawable FROM spots WHERE track_id % 3 = 0 AND track_id < 60", "spots")
a("srt1_sort_track_frame", on(lambda d: fl.sort_track_frame(fl.tracked_only(d))), f"SELECT {COLS} FROM spots WHERE track_id IS NOT NULL ORDER BY track_id, frame, id", "spots")
a("srt2_lexsort", on(lambda d: d.orderBy("frame", F.desc("position_x"), "id")), f"SELECT {COLS} FROM spots ORDER BY frame, position_x DESC, id", "spots")
a(
    "srt4_latest_points",
    on(fl.latest_points),
    f"""
    SELECT {COLS}
    FROM (SELECT *, row_number() OVER (PARTITION BY track_id
    ORDER BY frame DESC, id DESC) AS rn
    FROM spots
    WHERE track_id IS NOT NULL)
    WHERE rn = 1
    """,
    "spots",
)


def spread_slices(s, f):
    """Five slices, evenly spread over the view's depth."""
    depth = fx.voxels(s, f).agg(F.max("z")).first()[0] + 1
    return s.range(1).select(F.posexplode(fl.linspace_slices(depth, 5))).select(F.col("pos").alias("k"), F.col("col").alias("z"))


a("srt6_linspace_slices", spread_slices, "SELECT k::INTEGER AS k, floor(k * max(z) / 4.0)::INTEGER AS z FROM voxels, range(5) r(k) GROUP BY k", "voxels")
a(
    "smp1_subsample_tracks",
    on(lambda d: fl.subsample_tracks(d, 20)),
    f"""
    SELECT {COLS}
    FROM spots
    WHERE track_id IN (SELECT track_id
    FROM (SELECT DISTINCT track_id
    FROM spots
    WHERE track_id IS NOT NULL)
    ORDER BY {key(42, 'track_id')} LIMIT 20)
    """,
    "spots",
)
a(
    "smp2_subsample_points",
    on(lambda d: fl.subsample_points(d, 5.0, 100)),
    f"""
    SELECT {COLS}
    FROM (SELECT *, row_number() OVER (ORDER BY {key(0)}) AS rn, count(*) OVER () AS n
    FROM spots)
    WHERE rn <= greatest(100, floor(n * 5 / 100))
    """,
    "spots",
)
a("smp3_sample_spots", on(lambda d: fl.subsample_points(d, 0.0, 500, 42)), f"SELECT {COLS} FROM spots ORDER BY {key(42)} LIMIT 500", "spots")
a("smp6_fit_subsample", lambda s, f: fl.subsample_points(fx.cloud(s, f), 0.0, 300, 42), f"SELECT id, frame, position_x, position_y, position_z FROM cloud ORDER BY {key(42)} LIMIT 300", "cloud")
a(
    "smp4_sample_without_repeat",
    lambda s, f: fl.sample_without_repeat(fx.spots(s, f), fx.tracks(s, f).select("track_id").distinct(), 25),
    f"SELECT track_id FROM (SELECT DISTINCT track_id FROM spots WHERE track_id % 3 <> 0) ORDER BY {key(0, 'track_id')} LIMIT 25",
    "spots",
)
a(
    "set2_id_difference",
    lambda s, f: fl.id_difference(fx.spots(s, f).select("track_id").distinct(), fx.tracks(s, f).select("track_id").distinct()).where("track_id IS NOT NULL"),
    "SELECT DISTINCT track_id FROM spots WHERE track_id % 3 <> 0",
    "spots",
)
a("set3_toggle_selection", lambda s, f: fl.toggle_selection(*(fx.spots(s, f).where(f"track_id % {k} = 0").select("track_id").distinct() for k in (2, 3))),
  "SELECT DISTINCT track_id FROM spots WHERE (track_id % 2 = 0) <> (track_id % 3 = 0)", "spots")
a(
    "set4_id_intersection",
    lambda s, f: fl.id_intersection(*(fx.spots(s, f).where(f"track_id % {k} = 0").select("track_id") for k in (2, 3))),
    "SELECT DISTINCT track_id FROM spots WHERE track_id % 6 = 0",
    "spots",
)
a("set5_union_of_columns", lambda s, f: fl.union_of_columns([fx.spots(s, f).select("id", "frame"), fx.spots(s, f).select("id", "track_id")]),
  "SELECT id, frame, NULL::BIGINT AS track_id FROM spots UNION ALL SELECT id, NULL, track_id FROM spots", "spots")

# Kinematics.
a("win1_step_speed", on(lambda d: rounded(kin.step_speed(d).select("track_id", "frame", "id", "step_speed"))), f"SELECT track_id, frame, id, {r('step_speed')} FROM speeds", "spots", "speeds")
a("win2_radial_distance", on(lambda d: rounded(kin.radial_distance(d, CENTER).select("id", "radial_dist_to_center"))), f"SELECT id, {r('radial_dist_to_center')} FROM radial", "spots", "radial")
a("win3_radial_velocity", lambda s, f: rounded(motion(s, f).select("id", "radial_velocity")), f"SELECT id, {r('radial_velocity')} FROM radial", "spots", "radial")
a("win4_rv_smooth", lambda s, f: rounded(motion(s, f).select("id", "radial_velocity_smooth")), f"SELECT id, {r('v AS radial_velocity_smooth')} FROM smooth", "spots", "radial", "smooth")
a(
    "win5_track_rv_stats",
    lambda s, f: rounded(motion(s, f).select("id", "track_median_radial_vel", "track_mean_radial_vel", "track_inward_fraction", "track_max_inward_vel")),
    f"""
    SELECT id, {r('med AS track_median_radial_vel', 'mean AS track_mean_radial_vel', 'inward AS track_inward_fraction', 'lo AS track_max_inward_vel')}
    FROM spots
    LEFT
    JOIN vstats USING (track_id)
    """,
    "spots",
    "radial",
    "smooth",
    "vstats",
)
a(
    "win6_net_radial_disp",
    lambda s, f: rounded(ing.net_radial_displacement(motion(s, f)).select("id", "track_net_radial_disp")),
    f"SELECT id, {r('disp AS track_net_radial_disp')} FROM spots LEFT JOIN flags USING (track_id)",
    *KIN,
)
a(
    "win7_sustained_inward",
    lambda s, f: ing.inward_runs(motion(s, f)).select("id", "track_sustained_inward"),
    "SELECT id, sustained AS track_sustained_inward FROM spots LEFT JOIN flags USING (track_id)",
    *KIN,
)
a("win8_onset_frame", lambda s, f: ing.inward_runs(motion(s, f)).select("id", "ingression_onset_frame"), "SELECT id, onset AS ingression_onset_frame FROM spots LEFT JOIN flags USING (track_id)", *KIN)
a("win9_flag_ingressing", lambda s, f: flagged(s, f).select("id", "ingressing"), "SELECT id, coalesce(ingressing, false) AS ingressing FROM spots LEFT JOIN flags USING (track_id)", *KIN)
a(
    "win10_ingression_score",
    lambda s, f: rounded(flagged(s, f).select("id", "ingression_score")),
    f"SELECT id, {r('CASE WHEN ingressing THEN score ELSE 0.0 END AS ingression_score')} FROM spots LEFT JOIN flags USING (track_id)",
    *KIN,
)
a(
    "win11_roi_restrict",
    lambda s, f: ing.roi_restrict(fl.flag_roi(flagged(s, f), *BOX), 205.0).select("id", "ingressing"),
    f"""
    SELECT id, coalesce(ingressing AND k, false) AS ingressing
    FROM spots
    LEFT
    JOIN flags USING (track_id)
    LEFT
    JOIN (SELECT track_id, bool_or({IN_BOX}) AND max(position_y) <= 205 AS k
    FROM spots
    GROUP BY 1) USING (track_id)
    """,
    *KIN,
)
OTSU = """ends AS (SELECT count(med) AS n, min(med) AS lo, max(med) AS hi, median(med) AS mid FROM vstats),
hist AS (SELECT CASE WHEN e.hi > e.lo THEN least(floor((med - e.lo) / ((e.hi - e.lo) / 200)), 199) ELSE 0 END AS bin, count(*) AS c, any_value(e.lo) AS lo, any_value(e.hi) AS hi FROM vstats, ends e WHERE med IS NOT NULL GROUP BY 1),
cum AS (SELECT *, lo + (bin + 0.5) * (hi - lo) / 200 AS center, sum(c) OVER (ORDER BY bin) AS w0, sum(c * (lo + (bin + 0.5) * (hi - lo) / 200)) OVER (ORDER BY bin) AS s0, sum(c) OVER () AS n, sum(c * (lo + (bin + 0.5) * (hi - lo) / 200)) OVER () AS s FROM hist),
best AS (SELECT center FROM cum WHERE n > w0 ORDER BY round(w0 * (n - w0) * pow(s0 / w0 - (s - s0) / (n - w0), 2), 6) DESC, bin LIMIT 1)"""
BOOK.views["otsu"] = OTSU


def medians(spark: SparkSession, sf: str) -> DataFrame:
    """(v): median smoothed radial velocity of each track."""
    return motion(spark, sf).where("track_id IS NOT NULL").groupBy("track_id").agg(F.median("radial_velocity_smooth").alias("v"))


a(
    "win12_otsu_threshold",
    lambda s, f: rounded(ing.otsu_threshold(medians(s, f))),
    f"SELECT {r('CASE WHEN n < 20 THEN coalesce(mid, -0.5) ELSE least(coalesce((SELECT center FROM best), lo - 0.4975), -0.005) END AS threshold')} FROM ends",
    "spots",
    "radial",
    "smooth",
    "vstats",
    "otsu",
)
a(
    "fit5_otsu_few_tracks",
    lambda s, f: rounded(ing.otsu_threshold(medians(s, f).withColumn("v", F.abs("v")), fewest=10**9)),
    f"SELECT {r('median(abs(med)) AS threshold')} FROM vstats",
    "spots",
    "radial",
    "smooth",
    "vstats",
)
LAG = """lagged AS (SELECT *, row_number() OVER w AS i, CASE WHEN frame - lag(frame, 4) OVER w = 4 THEN sqrt(pow((position_x - lag(position_x, 4) OVER w) * 0.5, 2) + pow((position_y - lag(position_y, 4) OVER w) * 0.5, 2) + pow((position_z - lag(position_z, 4) OVER w) * 0.5, 2)) / (4 * 30.0 / 60) END AS lag_speed
  FROM spots WHERE track_id IS NOT NULL WINDOW w AS (PARTITION BY track_id ORDER BY frame, id))"""
BOOK.views["lagged"] = LAG
a("win13_lag_speed", on(lambda d: rounded(kin.lag_speed(fl.tracked_only(d), 4, 0.5).select("id", "lag_speed"))), f"SELECT id, {r('lag_speed')} FROM lagged", "spots", "lagged")
STRAIGHT = """moves AS (SELECT *, sqrt(pow(position_x - lag(position_x) OVER w, 2) + pow(position_y - lag(position_y) OVER w, 2) + pow(position_z - lag(position_z) OVER w, 2)) AS m FROM spots WHERE track_id IS NOT NULL WINDOW w AS (PARTITION BY track_id ORDER BY frame, id)),
straight AS (SELECT track_id, CASE WHEN sum(m) > 0 THEN sqrt(pow(arg_max(position_x, frame) - arg_min(position_x, frame), 2) + pow(arg_max(position_y, frame) - arg_min(position_y, frame), 2) + pow(arg_max(position_z, frame) - arg_min(position_z, frame), 2)) / sum(m) END AS straightness FROM moves GROUP BY 1)"""
BOOK.views["straight"] = STRAIGHT
a("win15_straightness", on(lambda d: rounded(kin.straightness(d))), f"SELECT track_id, {r('straightness')} FROM straight", "spots", "straight")
SMOOTHED = """arr AS (SELECT track_id, count(*) AS n_points, count(*) * 0.5::DOUBLE AS minutes, coalesce(list(lag_speed ORDER BY i) FILTER (WHERE i > 4), []) AS a FROM lagged GROUP BY 1),
outs AS (SELECT track_id, unnest(range(0, greatest(len(a), 5))) AS i, a, len(a) AS n, (least(len(a), 5) - 1) // 2 AS s FROM arr WHERE len(a) > 0),
vals AS (SELECT track_id, i, list_avg(list_filter(list_slice(a, greatest(i + s - 4, 0) + 1, least(i + s, n - 1) + 1), lambda x: x IS NOT NULL)) AS v FROM outs)"""
BOOK.views["smoothed"] = SMOOTHED
a(
    "win14_smooth_speed",
    on(lambda d: rounded(kin.lag_speed(fl.tracked_only(d), 4, 0.5).withColumn("i", F.row_number().over(kin.along_track())).groupBy("track_id").agg(F.array_sort(F.collect_list(F.when(F.col("i") > 4, F.struct("i", "lag_speed")))).alias("a"))
  .select("track_id", F.posexplode(kin.smooth_array(F.transform("a", lambda x: x["lag_speed"]), 5)).alias("i", "speed")))),
    f"SELECT track_id, i::INTEGER AS i, {r('v AS speed')} FROM vals",
    "spots",
    "lagged",
    "smoothed",
)
a(
    "win16_selection_metrics",
    on(lambda d: rounded(kin.selection_metrics(d, 4, 5, 0.5).select("track_id", "n_points", "minutes", "straightness", "mean_speed", "n_speeds"))),
    f"""
    SELECT track_id, n_points, {r('minutes', 'straightness', 'mean_speed')}, n_speeds::INTEGER AS n_speeds
    FROM arr
    JOIN straight USING (track_id)
    LEFT
    JOIN (SELECT track_id, avg(v) AS mean_speed, count(*) AS c
    FROM vals
    GROUP BY 1) USING (track_id), LATERAL (SELECT coalesce(c, 0) AS n_speeds)
    """,
    "spots",
    "lagged",
    "straight",
    "smoothed",
)
EXT = f"""SELECT {COLS} FROM spots UNION ALL SELECT track_id, (SELECT max(frame) FROM spots), position_x, position_y, position_z, id FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY frame DESC, id DESC) AS rn FROM spots WHERE track_id IS NOT NULL) WHERE rn = 1 AND frame < (SELECT max(frame) FROM spots)"""
a("win17_last_point_extension", on(kin.last_point_extension), EXT, "spots")
a(
    "set1_union_extension",
    on(lambda d: kin.last_point_extension(fl.tracked_only(d)).groupBy("frame").agg(F.count(F.lit(1)).alias("n"))),
    f"SELECT frame, count(*) AS n FROM ({EXT}) WHERE track_id IS NOT NULL GROUP BY 1",
    "spots",
)
a(
    "win18_first_point",
    on(kin.first_point),
    """
    SELECT track_id, frame, position_x, position_y, position_z
    FROM (SELECT *, row_number() OVER (PARTITION BY track_id
    ORDER BY frame, id) AS rn
    FROM spots
    WHERE track_id IS NOT NULL)
    WHERE rn = 1
    """,
    "spots",
)

# Joins.
BOOK.views["all_tracks"] = "all_tracks AS (SELECT * FROM spots WHERE track_id IS NOT NULL)"
a(
    "jn1_assign_by_id",
    lambda s, f: jn.assign_by_id(fx.spots(s, f), fx.all_tracks(s, f)),
    "SELECT s.frame, s.id, s.position_x, s.position_y, s.position_z, t.track_id FROM spots s LEFT JOIN all_tracks t ON s.frame = t.frame AND s.id = t.id",
    "spots",
    "all_tracks",
)
a(
    "jn1_assign_stats",
    lambda s, f: jn.assign_stats(jn.assign_by_id(fx.spots(s, f), fx.all_tracks(s, f))),
    """
    SELECT count(*) AS n_spots, count(t.track_id) AS n_assigned, count(DISTINCT t.track_id) AS n_tracks
    FROM spots s
    LEFT
    JOIN all_tracks t ON s.frame = t.frame AND s.id = t.id
    """,
    "spots",
    "all_tracks",
)
NEAR = """cent AS (SELECT track_id, frame, avg(position_x) + 1.5 AS x, avg(position_y) - 1.0 AS y, avg(position_z) + 0.5 AS z FROM all_tracks GROUP BY 1, 2),
pairs AS (SELECT c.track_id, c.frame, s.id, sqrt((s.position_x - c.x) * (s.position_x - c.x) + (s.position_y - c.y) * (s.position_y - c.y) + (s.position_z - c.z) * (s.position_z - c.z)) AS d FROM cent c JOIN spots s USING (frame)),
near AS (SELECT *, row_number() OVER (PARTITION BY track_id, frame ORDER BY d, id) AS rn FROM pairs WHERE d <= 60.0),
won AS (SELECT frame, id, min(track_id) AS track_id FROM near WHERE rn = 1 GROUP BY 1, 2)"""
BOOK.views["near"] = NEAR


def shifted(tracks: DataFrame) -> DataFrame:
    """Tracks a little off their spots."""
    return tracks.withColumns({"position_x": F.col("position_x") + 1.5, "position_y": F.col("position_y") - 1.0, "position_z": F.col("position_z") + 0.5})


a(
    "jn2_assign_nearest",
    lambda s, f: jn.assign_nearest(fx.spots(s, f).withColumn("track_id", F.lit(None).cast("long")), shifted(fx.all_tracks(s, f)), 60.0).select("frame", "id", "track_id"),
    "SELECT s.frame, s.id, w.track_id FROM spots s LEFT JOIN won w ON s.frame = w.frame AND s.id = w.id",
    "spots",
    "all_tracks",
    "near",
)
NN = """nn AS (SELECT a.id, min(sqrt((a.position_x - b.position_x) * (a.position_x - b.position_x) + (a.position_y - b.position_y) * (a.position_y - b.position_y) + (a.position_z - b.position_z) * (a.position_z - b.position_z))) AS d FROM cloud a JOIN cloud b ON a.id <> b.id GROUP BY 1)"""
BOOK.views["nn"] = NN
a(
    "jn3_nn_tolerance",
    lambda s, f: rounded(jn.nn_tolerance(fx.cloud(s, f))),
    f"""
    WITH picked AS (SELECT *
    FROM cloud
    ORDER BY {key(0)} LIMIT 5000), own AS (SELECT a.id, min(sqrt(pow(a.position_x - b.position_x, 2) + pow(a.position_y - b.position_y, 2) + pow(a.position_z - b.position_z, 2))) AS d
    FROM picked a
    JOIN picked b ON a.id <> b.id
    GROUP BY 1) SELECT {r('greatest(1.5 * median(d), 1e-6) AS tolerance')}
    FROM own
    """,
    "cloud",
)
a("jn3_nn_tolerance_all", lambda s, f: rounded(jn.nn_tolerance(fx.cloud(s, f), None)), f"SELECT {r('greatest(1.5 * median(d), 1e-6) AS tolerance')} FROM nn", "cloud", "nn")
a("jn3_nn_distance", lambda s, f: rounded(jn.nearest_distance(fx.cloud(s, f))), f"SELECT id, {r('d AS distance')} FROM nn", "cloud", "nn")
a(
    "jn4_map_track_stats",
    on(lambda d: rounded(jn.map_track_stats(d, fl.track_limits(d)).select("id", "length", "max_speed"))),
    f"SELECT id, length, {r('max_speed')} FROM spots LEFT JOIN limits USING (track_id)",
    "spots",
    "speeds",
    "limits",
)
a(
    "jn6_semi",
    lambda s, f: fx.spots(s, f).join(fx.tracks(s, f).select("track_id").distinct(), "track_id", "left_semi").groupBy("frame").agg(F.count(F.lit(1)).alias("n")),
    "SELECT frame, count(*) AS n FROM spots WHERE track_id IN (SELECT track_id FROM tracks) GROUP BY 1",
    "spots",
    "tracks",
)
a(
    "jn6_anti",
    lambda s, f: fx.spots(s, f).join(fx.tracks(s, f).select("track_id").distinct(), "track_id", "left_anti").groupBy("frame").agg(F.count(F.lit(1)).alias("n")),
    "SELECT frame, count(*) AS n FROM spots s WHERE NOT EXISTS (SELECT 1 FROM tracks t WHERE t.track_id = s.track_id) GROUP BY 1",
    "spots",
    "tracks",
)
a(
    "jn10_nearest_spot",
    on(lambda d: rounded(jn.nearest_spot(d, (120.0, 60.0, 40.0), 333).select("id", "frame", "distance"))),
    f"""
    SELECT id, frame, {r('distance')}
    FROM (SELECT *, sqrt(pow(position_x - 120.0, 2) + pow(position_y - 60.0, 2) + pow(position_z - 40.0, 2)) AS distance
    FROM spots
    WHERE frame = (SELECT frame
    FROM spots
    ORDER BY abs(frame - 333), frame LIMIT 1))
    ORDER BY distance, id LIMIT 1
    """,
    "spots",
)
a(
    "jn10_nearest_to_ray",
    on(lambda d: rounded(jn.nearest_to_ray(d, (0.0, 0.0, 0.0), (1.0, 2.0, 2.0), 333).select("id", "frame", "distance"))),
    f"""
    SELECT id, frame, {r('distance')}
    FROM (SELECT *, sqrt(pow(position_y * 2 - position_z * 2, 2) + pow(position_z * 1 - position_x * 2, 2) + pow(position_x * 2 - position_y * 1, 2)) / 3.0 AS distance
    FROM spots
    WHERE frame = (SELECT frame
    FROM spots
    ORDER BY abs(frame - 333), frame LIMIT 1))
    ORDER BY round(distance, 9), id LIMIT 1
    """,
    "spots",
)
a(
    "jn11_nearest_frame_centroid",
    lambda s, f: rounded(jn.nearest_frame_centroid(fl.track_set(fx.spots(s, f), fx.tracks(s, f)), 333)),
    f"""
    SELECT frame, {r('avg(position_x) AS x', 'avg(position_y) AS y', 'avg(position_z) AS z')}
    FROM spots
    WHERE track_id % 3 = 0 AND frame = (SELECT frame
    FROM spots
    WHERE track_id % 3 = 0
    ORDER BY abs(frame - 333), frame LIMIT 1)
    GROUP BY frame
    """,
    "spots",
)

# Aggregates over tracks.
a(
    "agg1_track_length",
    on(lambda d: fl.tracked_only(d).groupBy("track_id").agg(F.count("frame").alias("length"))),
    "SELECT track_id, count(frame) AS length FROM spots WHERE track_id IS NOT NULL GROUP BY 1",
    "spots",
)
a("agg2_track_max_speed", on(lambda d: rounded(fl.track_limits(d).select("track_id", "max_speed"))), f"SELECT track_id, {r('max_speed')} FROM limits", "spots", "speeds", "limits")
a(
    "agg3_dataset_track_stats",
    on(lambda d: rounded(rep.dataset_track_stats(d))),
    f"""SELECT count(*) AS n_tracks, min(length)::BIGINT AS len_min, trunc(quantile_cont(length, 0.5))::BIGINT AS len_p50, trunc(quantile_cont(length, 0.95))::BIGINT AS len_p95, max(length)::BIGINT AS len_max,
  {r('quantile_cont(coalesce(max_speed, 0.0), 0.5) AS speed_p50', 'quantile_cont(coalesce(max_speed, 0.0), 0.95) AS speed_p95', 'quantile_cont(coalesce(max_speed, 0.0), 0.99) AS speed_p99', 'max(coalesce(max_speed, 0.0)) AS speed_max')} FROM limits""",
    "spots",
    "speeds",
    "limits",
)
a(
    "agg4_filter_counts",
    on(lambda d: rounded(rep.filter_counts(fl.kept_dropped_ids(d, LENGTH, SPEED)))),
    f"""
    SELECT count(*) FILTER (WHERE k) AS kept, count(*) FILTER (WHERE NOT k) AS dropped, {r('100.0 * count(*) FILTER (WHERE k) / count(*) AS kept_pct')}
    FROM (SELECT length >= {LENGTH} AND coalesce(max_speed, 0) <= {SPEED} AS k
    FROM limits)
    """,
    "spots",
    "speeds",
    "limits",
)
SUMMARY = f"count(*) AS n_spots, min(frame) AS frame_start, max(frame) AS frame_end, {r('avg(position_x) AS mean_x', 'avg(position_y) AS mean_y', 'avg(position_z) AS mean_z')}"
a("agg5_track_summary", on(lambda d: rounded(rep.track_summary(d))), f"SELECT track_id, {SUMMARY} FROM spots WHERE track_id IS NOT NULL GROUP BY 1", "spots")
a(
    "agg5_track_summary_flagged",
    lambda s, f: rounded(rep.track_summary(fl.filter_flags(fl.flag_roi(flagged(s, f), *BOX), LENGTH, SPEED)).select("track_id", "n_spots", "track_median_radial_vel", "ingression_onset_frame", "ingressing", "in_roi", "filtered_out", "filter_reason")),
    f"""SELECT track_id, any_value(f.n) AS n_spots, {r('any_value(f.med) AS track_median_radial_vel')}, any_value(f.onset) AS ingression_onset_frame, any_value(f.ingressing) AS ingressing, bool_or({IN_BOX}) AS in_roi,
  any_value(l.length < {LENGTH} OR NOT coalesce(l.max_speed <= {SPEED}, false)) AS filtered_out, any_value(CASE WHEN l.length < {LENGTH} AND NOT coalesce(l.max_speed <= {SPEED}, false) THEN 'min_length+max_speed' WHEN NOT coalesce(l.max_speed <= {SPEED}, false) THEN 'max_speed' WHEN l.length < {LENGTH} THEN 'min_length' ELSE '' END) AS filter_reason
  FROM spots JOIN flags f USING (track_id) JOIN limits l USING (track_id) GROUP BY track_id""",
    *KIN,
    "speeds",
    "limits",
)
a(
    "agg6_xs_track_summary",
    on(lambda d: rounded(rep.section_summary(d))),
    f"SELECT track_id, {SUMMARY}, {r('max(step_speed) AS max_speed')} FROM speeds WHERE track_id IS NOT NULL GROUP BY 1",
    "spots",
    "speeds",
)
a(
    "agg7_export_meta",
    on(lambda d: rep.export_meta(fl.filter_flags(d, LENGTH, SPEED))),
    f"""SELECT count(*) AS n_spots, count(DISTINCT frame) AS n_frames, count(*) FILTER (WHERE NOT x) AS kept_spots, count(*) FILTER (WHERE x) AS filtered_spots, count(DISTINCT CASE WHEN NOT x THEN track_id END) AS kept_tracks, count(DISTINCT CASE WHEN x THEN track_id END) AS filtered_tracks
  FROM (SELECT s.*, coalesce(l.length < {LENGTH} OR NOT coalesce(l.max_speed <= {SPEED}, false), false) AND s.track_id IS NOT NULL AS x FROM spots s LEFT JOIN limits l USING (track_id))""",
    "spots",
    "speeds",
    "limits",
)
a(
    "agg8_ingression_counts",
    lambda s, f: rounded(rep.ingression_counts(flagged(s, f))),
    f"""
    SELECT count(*) FILTER (WHERE ingressing) AS flagged_spots, count(DISTINCT CASE WHEN ingressing THEN track_id END) AS flagged_tracks, {r('100.0 * count(DISTINCT CASE WHEN ingressing THEN track_id END) / count(DISTINCT track_id) AS flagged_pct')}
    FROM spots
    LEFT
    JOIN flags USING (track_id)
    """,
    *KIN,
)
a(
    "agg26_depth_travel",
    lambda s, f: rounded(rep.travel(motion(s, f), "radial_dist_to_center")),
    f"SELECT track_id, {r('max(radial_dist_to_center) - min(radial_dist_to_center) AS travel')} FROM radial WHERE track_id IS NOT NULL GROUP BY 1",
    "spots",
    "radial",
)
a(
    "agg29_rv_quantiles",
    lambda s, f: rounded(rep.quantiles(motion(s, f), "radial_velocity_smooth")),
    f"SELECT {r('quantile_cont(v, 0.5) AS median', 'quantile_cont(v, 0.1) AS p10', 'quantile_cont(v, 0.9) AS p90')} FROM smooth",
    "spots",
    "radial",
    "smooth",
)
a(
    "sc11_track_lut_frame",
    on(lambda d: rep.track_lut(d, "frame")),
    """
    SELECT track_id, trunc((v - lo) / greatest(hi - lo, 1e-10) * 250 + 5)::INTEGER AS lut
    FROM (SELECT track_id, avg(frame) AS v
    FROM spots
    WHERE track_id IS NOT NULL
    GROUP BY 1), (SELECT min(v) AS lo, max(v) AS hi
    FROM (SELECT avg(frame) AS v
    FROM spots
    WHERE track_id IS NOT NULL
    GROUP BY track_id))
    """,
    "spots",
)
a(
    "sc11_track_lut_speed",
    on(lambda d: rep.track_lut(d, "speed")),
    """
    WITH m AS (SELECT track_id, avg(step_speed) AS v
    FROM speeds
    WHERE track_id IS NOT NULL
    GROUP BY 1) SELECT track_id, CASE WHEN v IS NULL THEN 20 ELSE trunc((v - lo) / greatest(hi - lo, 1e-10) * 250 + 5) END::INTEGER AS lut
    FROM m, (SELECT min(coalesce(v, 0)) AS lo, max(coalesce(v, 0)) AS hi
    FROM m)
    """,
    "spots",
    "speeds",
)
a(
    "sc11_track_lut_radial",
    lambda s, f: rep.track_lut(motion(s, f), "radial_vel"),
    """
    WITH m AS (SELECT track_id, avg(v) AS v
    FROM smooth
    WHERE track_id IS NOT NULL
    GROUP BY 1) SELECT track_id, trunc((least(greatest(coalesce(v, 0.0) / greatest(q, 1e-6), -1.0), 1.0) + 1) / 2 * 250 + 5)::INTEGER AS lut
    FROM m, (SELECT greatest(abs(quantile_cont(v, 0.02)), abs(quantile_cont(v, 0.98))) AS q
    FROM m)
    """,
    "spots",
    "radial",
    "smooth",
)
a(
    "sc11_track_lut_flags",
    lambda s, f: rep.track_lut(fl.flag_roi(fx.spots(s, f), *BOX), "roi"),
    f"SELECT track_id, CASE WHEN bool_or({IN_BOX}) THEN 240 ELSE 20 END AS lut FROM spots WHERE track_id IS NOT NULL GROUP BY 1",
    "spots",
)
a(
    "agg30_axis_ranges",
    on(rep.axis_ranges),
    """
    SELECT min(position_x) AS x_min, max(position_x) AS x_max, min(position_y) AS y_min, max(position_y) AS y_max, min(position_z) AS z_min, max(position_z) AS z_max, min(frame) AS frame_min, max(frame) AS frame_max
    FROM spots
    """,
    "spots",
)
a(
    "jn5_summary_join",
    lambda s, f: rounded(rep.summary_join(fl.flag_roi(fx.spots(s, f), *BOX))),
    f"SELECT track_id, {SUMMARY}, arg_min({IN_BOX}, frame) AS first_in_roi FROM spots WHERE track_id IS NOT NULL GROUP BY 1",
    "spots",
)
