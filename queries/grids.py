"""Operators on gridded tables."""

from pyspark.sql import functions as F

from queries.registry import ORACLES, query
from queries.views import V_GRID, grid_view, table
from tallymark.operators import grid
from tallymark.plans.variants import run_variants


def _reflect(value: str, limit: str) -> str:
    return f"CASE WHEN {value} < 0 THEN -({value}) WHEN {value} >= {limit} THEN 2 * ({limit} - 1) - ({value}) ELSE {value} END"


def _kernel(cells: list[tuple[int, int, float]], names: str = "w") -> str:
    rows = ", ".join(f"({dx}, {dy}, {w!r})" for dx, dy, w in cells)
    return f"(VALUES {rows}) AS k(dx, dy, {names})"


def _convolved(kernel: str, source: str = "v_grid", weights: str = "sum(w * i.v) AS s") -> str:
    return f"""WITH q AS MATERIALIZED (
    SELECT o.*, k.*, {_reflect('o.x + dx', '(SELECT days FROM v_days)')} AS rx, {_reflect('o.y + dy', '24')} AS ry FROM {source} o, {kernel})
  SELECT q.grid, q.x, q.y, any_value(q.v) AS v, {weights}
  FROM q JOIN {source} i ON i.grid = q.grid AND i.x = rx AND i.y = ry GROUP BY 1, 2, 3"""


BINOMIAL = [1, 4, 6, 4, 1]
GAUSS = _kernel([(x - 2, y - 2, BINOMIAL[x] * BINOMIAL[y] / 256) for x in range(5) for y in range(5)])
AROUND = [(x, y) for x in (-1, 0, 1) for y in (-1, 0, 1)]
LEVEL = "CAST(greatest(0, least(255, floor({s} + 0.5))) AS DOUBLE)"
BLUR = f"blur AS (SELECT grid, x, y, v AS raw, {LEVEL.format(s='s')} AS v FROM ({_convolved(GAUSS)}))"


@query("convolve_gaussian", f"WITH {V_GRID}, {BLUR} SELECT grid, x, y, v FROM blur")
def convolve_gaussian(spark, sf_dir):
    return grid.gaussian_blur(grid_view(spark, sf_dir))


LAP = _kernel([(0, 0, -4), (1, 0, 1), (-1, 0, 1), (0, 1, 1), (0, -1, 1)])


@query("convolve_laplacian", f"WITH {V_GRID} SELECT grid, x, y, {LEVEL.format(s='abs(s)')} AS v FROM ({_convolved(LAP)})")
def convolve_laplacian(spark, sf_dir):
    return grid.laplacian(grid_view(spark, sf_dir))


SOBEL = "(VALUES " + ", ".join(f"({x}, {y}, {x * (2 - abs(y))}, {y * (2 - abs(x))})" for x, y in AROUND) + ") AS k(dx, dy, wx, wy)"


@query("sobel_magnitude", f"""
WITH {V_GRID} SELECT grid, x, y, {LEVEL.format(s='sqrt(sx * sx + sy * sy)')} AS v
FROM ({_convolved(SOBEL, weights='sum(wx * i.v) AS sx, sum(wy * i.v) AS sy')})""")
def sobel_magnitude(spark, sf_dir):
    return grid.sobel_magnitude(grid_view(spark, sf_dir))


SHARP = _kernel([(x, y, 9 if x == y == 0 else -1) for x, y in AROUND])


@query("sharpen", f"WITH {V_GRID} SELECT grid, x, y, {LEVEL.format(s='s')} AS v FROM ({_convolved(SHARP)})")
def sharpen(spark, sf_dir):
    return grid.sharpen(grid_view(spark, sf_dir))


@query("high_boost", f"""
WITH {V_GRID}, {BLUR}
SELECT grid, x, y, CAST(greatest(0, least(255, round_even(2.5::DOUBLE * raw - 1.5::DOUBLE * v, 0))) AS DOUBLE) AS v FROM blur""")
def high_boost(spark, sf_dir):
    return grid.high_boost(grid_view(spark, sf_dir))


GABOR = """(SELECT dx, dy, exp(-0.5 * (a * a / 25 + c * c / 100)) * cos(2 * pi() * a / 10) AS w
  FROM (SELECT dx, dy, (dx + dy) * cos(pi() / 4) AS a, (dy - dx) * cos(pi() / 4) AS c
        FROM (SELECT unnest(range(-15, 16)) AS dx), (SELECT unnest(range(-15, 16)) AS dy))) AS k"""


@query("convolve_gabor", f"WITH {V_GRID} SELECT grid, x, y, {LEVEL.format(s='s')} AS v FROM ({_convolved(GABOR)})")
def convolve_gabor(spark, sf_dir):
    return grid.gabor(grid_view(spark, sf_dir))


@query("median_filter", f"""
WITH {V_GRID}
SELECT o.grid, o.x, o.y, CAST(median(i.v) AS DOUBLE) AS v
FROM v_grid o, (SELECT unnest(range(-2, 3)) AS dx), (SELECT unnest(range(-2, 3)) AS dy)
JOIN v_grid i ON i.grid = o.grid AND i.x = greatest(0, least((SELECT days - 1 FROM v_days), o.x + dx)) AND i.y = greatest(0, least(23, o.y + dy))
GROUP BY 1, 2, 3""")
def median_filter(spark, sf_dir):
    return grid.median_filter(grid_view(spark, sf_dir))


OTSU = """c AS (SELECT grid, v, count(*) AS n FROM {source} GROUP BY 1, 2),
s AS (SELECT grid, v, sum(n) OVER w AS w0, sum(n * v) OVER w AS s0, sum(n) OVER g AS w, sum(n * v) OVER g AS s FROM c
      WINDOW w AS (PARTITION BY grid ORDER BY v), g AS (PARTITION BY grid)),
b AS (SELECT grid, v, CASE WHEN w0 = w THEN 0 ELSE CAST(s * w0 - w * s0 AS DOUBLE) * CAST(s * w0 - w * s0 AS DOUBLE)
                           / CAST(w0 * (w - w0) AS DOUBLE) END AS between_var FROM s),
o AS (SELECT grid, CAST(v AS INTEGER) AS threshold FROM (SELECT *, row_number() OVER (PARTITION BY grid ORDER BY between_var DESC, v) AS r FROM b) WHERE r = 1)"""


@query("otsu_threshold", f"WITH {V_GRID}, {OTSU.format(source='v_grid')} SELECT grid, threshold FROM o")
def otsu_threshold(spark, sf_dir):
    return grid.otsu_threshold(grid_view(spark, sf_dir))


# A small margin, because the grids are only some 30 x 24 cells.
@query("crop_bbox", f"""
WITH {V_GRID}, {BLUR}, {OTSU.format(source='blur')},
box AS (SELECT blur.grid, min(x) - 2 AS x0, max(x) + 2 AS x1, min(y) - 2 AS y0, max(y) + 2 AS y1
        FROM blur JOIN o ON o.grid = blur.grid WHERE v > threshold GROUP BY 1)
SELECT g.grid, x, y, v FROM v_grid g JOIN box ON box.grid = g.grid WHERE x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1""")
def crop_bbox(spark, sf_dir):
    return grid.crop_to_foreground(grid_view(spark, sf_dir), margin=2)


def _equalized(source: str) -> str:
    return f"""SELECT grid, x, y, CAST(floor((cdf - low) * 255.0::DOUBLE / (cells - low) + 0.5) AS DOUBLE) AS v
FROM (SELECT grid, x, y, count(*) OVER (PARTITION BY grid ORDER BY v) AS cdf, count(*) OVER (PARTITION BY grid) AS cells,
             count(*) FILTER (v = lo) OVER (PARTITION BY grid) AS low
      FROM (SELECT *, min(v) OVER (PARTITION BY grid) AS lo FROM {source}))"""


@query("hist_equalize", f"WITH {V_GRID} {_equalized('v_grid')}")
def hist_equalize(spark, sf_dir):
    return grid.equalize(grid_view(spark, sf_dir))


@query("gamma_curve", f"WITH {V_GRID} SELECT grid, x, y, CAST(floor(pow(v / 255.0::DOUBLE, 1.0::DOUBLE / 1.5) * 255) AS DOUBLE) AS v FROM v_grid")
def gamma_curve(spark, sf_dir):
    return grid.gamma_curve(grid_view(spark, sf_dir), 1.5)


CHANNELS = ["r", "g", "b"]


def channel_view(spark, sf_dir):
    """One grid per event type with three channels by user, cells as summed value in whole levels."""
    events = table(spark, sf_dir, "events")
    channel = F.element_at(F.array(*[F.lit(c) for c in CHANNELS]), (F.col("user_id") % 3 + 1).cast("int"))
    days = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    cents = F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents")
    cells = events.groupBy(F.col("event_type").alias("grid"), days.alias("x"), F.hour("ts").alias("y"), channel.alias("channel")).agg(cents)
    peak = cells.groupBy("grid").agg(F.max("cents").alias("peak"))
    return cells.join(peak, "grid").select("grid", "x", "y", "channel", F.expr("cents * 255 div peak").cast("int").alias("v"))


V_RGB = """v_rgb AS (
  SELECT grid, x, y, channel, CAST(cents * 255 // max(cents) OVER (PARTITION BY grid) AS INTEGER) AS v
  FROM (SELECT event_type AS grid, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS x, CAST(hour(ts) AS INTEGER) AS y,
               ['r', 'g', 'b'][user_id % 3 + 1] AS channel, sum(CAST(round(value * 100) AS BIGINT)) AS cents
        FROM events GROUP BY 1, 2, 3, 4))"""


@query("channel_balance", f"""
WITH {V_RGB}, m AS (SELECT grid, channel, avg(v) AS mean FROM v_rgb GROUP BY 1, 2),
g AS (SELECT *, avg(mean) OVER (PARTITION BY grid) AS grey FROM m)
SELECT r.grid, x, y, r.channel, CAST(floor(greatest(0, least(255, v * (grey / mean)))) AS DOUBLE) AS v
FROM v_rgb r JOIN g ON g.grid = r.grid AND g.channel = r.channel""")
def channel_balance(spark, sf_dir):
    return grid.channel_balance(channel_view(spark, sf_dir))


@query("luma", f"""
WITH {V_RGB}
SELECT grid, x, y, CAST(floor(sum(v * CASE channel WHEN 'r' THEN 0.299::DOUBLE WHEN 'g' THEN 0.587::DOUBLE ELSE 0.114::DOUBLE END) + 0.5) AS DOUBLE) AS v
FROM v_rgb GROUP BY 1, 2, 3""")
def luma(spark, sf_dir):
    return grid.luma(channel_view(spark, sf_dir))


@query("variant_runs", f"""
WITH {V_GRID}, {BLUR},
curved AS (SELECT grid, x, y, CAST(floor(pow(v / 255.0::DOUBLE, 1.0::DOUBLE / 1.2) * 255) AS DOUBLE) AS v FROM v_grid)
SELECT 'bright' AS variant, * FROM ({_equalized('curved')})
UNION ALL
SELECT 'smooth', grid, x, y, CAST(floor((v - min(v) OVER w) / (max(v) OVER w - min(v) OVER w + 1e-8) * 255) AS DOUBLE)
FROM blur WINDOW w AS (PARTITION BY grid)""")
def variant_runs(spark, sf_dir):
    variants = {
        "bright": {"gamma": 1.2, "equalize": True},
        "smooth": {"denoise": "gaussian", "normalize": "minmax"},
    }
    return run_variants(grid_view(spark, sf_dir), variants)


@query("variant_pipeline", f"""
WITH {V_GRID}, {BLUR},
z AS (SELECT grid, x, y, (v - avg(v) OVER w) / (stddev_pop(v) OVER w + 1e-8) AS z FROM v_grid WINDOW w AS (PARTITION BY grid)),
q AS (SELECT grid, quantile_cont(v, 0.02) AS lo, quantile_cont(v, 0.98) AS hi FROM v_grid GROUP BY 1),
curved AS (SELECT grid, x, y, CAST(floor(pow(v / 255.0::DOUBLE, 1.0::DOUBLE / 1.2) * 255) AS DOUBLE) AS v FROM v_grid)
SELECT 'bright' AS variant, * FROM ({_equalized('curved')})
UNION ALL
SELECT 'smooth', grid, x, y, CAST(floor((v - min(v) OVER w) / (max(v) OVER w - min(v) OVER w + 1e-8) * 255) AS DOUBLE)
FROM blur WINDOW w AS (PARTITION BY grid)
UNION ALL
SELECT 'zscore', grid, x, y, CAST(floor((z - min(z) OVER w) / (max(z) OVER w - min(z) OVER w + 1e-8) * 255) AS DOUBLE)
FROM z WINDOW w AS (PARTITION BY grid)
UNION ALL
SELECT 'robust', v_grid.grid, x, y, CAST(floor(greatest(0, least(1, (v - lo) / (hi - lo + 1e-8))) * 255) AS DOUBLE) FROM v_grid JOIN q ON q.grid = v_grid.grid""")
def variant_pipeline(spark, sf_dir):
    variants = {
        "bright": {"gamma": 1.2, "equalize": True},
        "smooth": {"denoise": "gaussian", "normalize": "minmax"},
        "zscore": {"normalize": "zscore"},
        "robust": {"normalize": "robust"},
    }
    return run_variants(grid_view(spark, sf_dir), variants)


# One variant for each step of a single-channel grid, and a chain of steps over the channels.
STEP_SQL = {
    "denoise": "median_filter", "laplacian": "convolve_laplacian", "sobel": "sobel_magnitude", "gabor": "convolve_gabor",
    "high_boost": "high_boost", "sharpen": "sharpen", "gamma": "gamma_curve", "equalize": "hist_equalize",
}
CHAIN = f"""{V_RGB},
m AS (SELECT grid, channel, avg(v) AS mean FROM v_rgb GROUP BY 1, 2), g AS (SELECT *, avg(mean) OVER (PARTITION BY grid) AS grey FROM m),
balanced AS (SELECT r.grid, x, y, r.channel, CASE WHEN mean = 0 THEN v ELSE floor(greatest(0, least(255, v * (grey / mean)))) END AS v
  FROM v_rgb r JOIN g ON g.grid = r.grid AND g.channel = r.channel),
curved AS (SELECT grid, x, y, channel, floor(pow(v / 255.0::DOUBLE, 1.0::DOUBLE / 1.2) * 255) AS v FROM balanced),
before AS (SELECT grid, x, y, floor(sum(v * CASE channel WHEN 'r' THEN 0.299::DOUBLE WHEN 'g' THEN 0.587::DOUBLE ELSE 0.114::DOUBLE END) + 0.5) AS v FROM curved GROUP BY 1, 2, 3),
after AS ({_equalized('before')}),
moved AS (SELECT c.grid, c.x, c.y, channel, greatest(0.0::DOUBLE, least(255.0::DOUBLE, c.v + a.v - b.v)) AS v FROM curved c
  JOIN before b ON b.grid = c.grid AND b.x = c.x AND b.y = c.y JOIN after a ON a.grid = c.grid AND a.x = c.x AND a.y = c.y)"""


@query("variant_steps", f"""
{" UNION ALL ".join(f"SELECT '{step}' AS variant, NULL AS channel, grid, x, y, v FROM ({ORACLES[name]})" for step, name in STEP_SQL.items())}
UNION ALL
SELECT 'channels', channel, grid, x, y, CAST(floor((v - min(v) OVER w) / (max(v) OVER w - min(v) OVER w + 1e-8) * 255) AS DOUBLE)
FROM (WITH {CHAIN} SELECT * FROM moved) WINDOW w AS (PARTITION BY grid)
UNION ALL
SELECT 'luma', NULL, grid, x, y, v FROM ({ORACLES['luma']})""")
def variant_steps(spark, sf_dir):
    """Every step of a configuration by itself, and balance, gamma, equalising and normalising over the channels of a grid."""
    single = {
        "denoise": {"denoise": "median"}, "laplacian": {"laplacian": True}, "sobel": {"sobel": True}, "gabor": {"gabor": 31},
        "high_boost": {"high_boost": 1.5}, "sharpen": {"sharpen": 1.0}, "gamma": {"gamma": 1.5}, "equalize": {"equalize": True},
    }
    coloured = {
        "channels": {"channel_balance": True, "gamma": 1.2, "equalize": True, "normalize": "minmax"}, "luma": {"luma": True},
    }
    plain = run_variants(grid_view(spark, sf_dir), single)
    return plain.unionByName(run_variants(channel_view(spark, sf_dir), coloured), allowMissingColumns=True)
