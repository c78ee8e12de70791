"""SQL counterparts of the queries, for an independent engine."""

from __future__ import annotations

CELLS = """cells AS (SELECT p_partkey AS cell, CAST(p_partkey % 200 AS INT) AS ix,
  CAST(floor(p_partkey / 200) AS INT) AS iy,
  CAST(p_partkey % 200 AS DOUBLE) / 2 - 49.75 AS lon,
  CAST(floor(p_partkey / 200) AS DOUBLE) / 2 - 24.75 AS lat,
  CAST(p_partkey % 27 AS INT) AS country_id, CAST(p_size AS DOUBLE) AS weight FROM part)"""

QUANTITY = """quantity AS (SELECT 'quantity' AS variable, l_partkey AS cell,
  CAST(l_linenumber - 1 AS INT) AS band, CAST(year(l_shipdate) AS INT) AS year,
  sum(l_quantity) AS value FROM lineitem GROUP BY l_partkey, l_linenumber, year(l_shipdate))"""

PRICE = """price AS (SELECT 'price' AS variable, l_partkey AS cell, 0 AS band,
  CAST(year(l_shipdate) AS INT) AS year, round(sum(l_extendedprice), 2) AS value
  FROM lineitem GROUP BY l_partkey, year(l_shipdate))"""

VALUES = f"{QUANTITY}, {PRICE}, grid_values AS (SELECT * FROM quantity UNION ALL SELECT * FROM price)"

YEARS = """years AS (SELECT unnest(range(min(year), max(year) + 1)) AS year FROM grid_values)"""

FLAGS = """flags AS (SELECT l_partkey AS cell, CAST((CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END) * 3
  + (CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END) AS INT) AS band,
  CAST(year(l_shipdate) AS INT) AS year, count(*) AS value FROM lineitem GROUP BY ALL)"""

BANDS = """bands AS (SELECT 'quantity' AS variable, CAST(l_linenumber - 1 AS INT) AS band,
  concat('line ', CAST(l_linenumber AS VARCHAR)) AS band_label
  FROM (SELECT DISTINCT l_linenumber FROM lineitem) AS t UNION ALL SELECT 'price', 0, 'all')"""

COUNTRIES = """countries AS (SELECT n_nationkey AS id, n_name AS name,
  concat('N', lpad(CAST(n_nationkey AS VARCHAR), 2, '0')) AS code, n_regionkey AS region_id FROM nation)"""

RASTER = """raster AS (SELECT DISTINCT CAST(floor(ix / 4) AS DOUBLE) * 2 - 49.75 AS rlon,
  CAST(floor(iy / 4) AS DOUBLE) * 2 - 24.75 AS rlat,
  CAST(floor(ix / 4) * 1000 + floor(iy / 4) AS INT) AS rvalue FROM cells)"""

LINKS = """links AS (SELECT cell, CASE WHEN ix < 199 THEN cell + 1 END AS to_cell FROM cells)"""

PERIOD = """period AS (SELECT variable, min(year) AS firstyear, max(year) AS lastyear
  FROM grid_values GROUP BY variable)"""

EVENT_BAND = """CAST(CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
  WHEN 'signup' THEN 3 ELSE 4 END AS INT)"""

PAIRS = """offsets AS (SELECT dx, dy FROM range(-1, 2) AS a(dx), range(-1, 2) AS b(dy) WHERE dx <> 0 OR dy <> 0),
  pairs AS (SELECT cell, neighbour FROM (SELECT c.cell, n.cell AS neighbour,
    row_number() OVER (PARTITION BY c.cell ORDER BY n.cell) AS place FROM cells c, offsets o, cells n
  WHERE n.ix = c.ix + o.dx AND n.iy = c.iy + o.dy) WHERE place <= 8)"""

REGION = f"""{CELLS}, {COUNTRIES}, region AS (SELECT c.cell, c.lon, c.lat,
  row_number() OVER (ORDER BY c.cell) - 1 AS new_cell FROM cells c
  WHERE c.country_id IN (SELECT id FROM countries WHERE code = 'N03'))"""

SUPPLIED = """supplied AS (SELECT s_suppkey, c FROM supplier
  JOIN (SELECT l_suppkey, count(*) AS c FROM lineitem GROUP BY 1) ON s_suppkey = l_suppkey)"""

NEAR = """lons AS (SELECT c.lon, arg_min(r.rlon, abs(c.lon - r.rlon) * 1000000 - r.rlon) AS rlon
    FROM (SELECT DISTINCT lon FROM cells) c, (SELECT DISTINCT rlon FROM {raster}) r GROUP BY c.lon),
  lats AS (SELECT c.lat, arg_min(r.rlat, abs(c.lat - r.rlat) * 1000000 - r.rlat) AS rlat
    FROM (SELECT DISTINCT lat FROM cells) c, (SELECT DISTINCT rlat FROM {raster}) r GROUP BY c.lat),
  near AS (SELECT c.cell, r.rvalue FROM cells c JOIN lons ON c.lon = lons.lon JOIN lats ON c.lat = lats.lat
    LEFT JOIN {raster} r ON r.rlon = lons.rlon AND r.rlat = lats.rlat)"""

SERIES = "PARTITION BY variable, cell, band ORDER BY year"

ORACLES = {
    "neighbour_pairs": f"WITH {CELLS}, {PAIRS} SELECT cell, neighbour FROM pairs",
    "neighbourhood_padded": f"""WITH {CELLS}, {PAIRS},
      found AS (SELECT cell, list(neighbour ORDER BY neighbour) AS n FROM pairs GROUP BY cell)
      SELECT c.cell, c.lon, c.lat, array_to_string(list_transform(range(1, 9),
        lambda i: CAST(coalesce(f.n[i], -9999) AS VARCHAR)), ' ') AS neighbours
      FROM cells c LEFT JOIN found f ON c.cell = f.cell""",
    "neighbour_mean": f"""WITH {CELLS}, {PAIRS}, {QUANTITY}
      SELECT p.cell, q.year, avg(q.value) AS mean_value, count(*) AS n
      FROM pairs p JOIN quantity q ON q.cell = p.neighbour GROUP BY p.cell, q.year""",
    "nearest_cell": f"""WITH {CELLS}, {RASTER},
      lons AS (SELECT c.lon, arg_min(r.rlon, abs(c.lon - r.rlon) * 1000000 - r.rlon) AS rlon
        FROM (SELECT DISTINCT lon FROM cells) c, (SELECT DISTINCT rlon FROM raster) r GROUP BY c.lon),
      lats AS (SELECT c.lat, arg_min(r.rlat, abs(c.lat - r.rlat) * 1000000 - r.rlat) AS rlat
        FROM (SELECT DISTINCT lat FROM cells) c, (SELECT DISTINCT rlat FROM raster) r GROUP BY c.lat)
      SELECT c.cell, r.rlon, r.rlat, r.rvalue FROM cells c JOIN lons ON c.lon = lons.lon
      JOIN lats ON c.lat = lats.lat JOIN raster r ON r.rlon = lons.rlon AND r.rlat = lats.rlat""",
    "nearest_with_holes": f"""WITH {CELLS}, {RASTER},
      holed AS (SELECT * FROM raster WHERE rvalue % 7 <> 3 UNION ALL SELECT 1000000.0, -1000000.0, -1),
      lons AS (SELECT c.lon, arg_min(r.rlon, abs(c.lon - r.rlon) * 1000000 - r.rlon) AS rlon
        FROM (SELECT DISTINCT lon FROM cells) c, (SELECT DISTINCT rlon FROM holed) r GROUP BY c.lon),
      lats AS (SELECT c.lat, arg_min(r.rlat, abs(c.lat - r.rlat) * 1000000 - r.rlat) AS rlat
        FROM (SELECT DISTINCT lat FROM cells) c, (SELECT DISTINCT rlat FROM holed) r GROUP BY c.lat)
      SELECT c.cell, lons.rlon, lats.rlat, r.rvalue FROM cells c JOIN lons ON c.lon = lons.lon
      JOIN lats ON c.lat = lats.lat LEFT JOIN holed r ON r.rlon = lons.rlon AND r.rlat = lats.rlat""",
    "neighbours_of_copies": f"""WITH {CELLS},
      placed AS (SELECT cell, CASE WHEN ix % 4 = 3 THEN ix - 1 ELSE ix END AS ix, iy FROM cells),
      pairs AS (SELECT c.cell, n.cell AS neighbour, row_number() OVER (PARTITION BY c.cell ORDER BY n.cell) AS place
        FROM placed c JOIN placed n ON abs(c.ix - n.ix) <= 1 AND abs(c.iy - n.iy) <= 1 AND c.cell <> n.cell)
      SELECT cell, neighbour FROM pairs WHERE place <= 8""",
    "read_input": f"""WITH {CELLS}, {RASTER}, {VALUES}, {NEAR.format(raster="raster")},
      coarse AS (SELECT variable, floor(ix / 4) * 1000 + floor(iy / 4) AS point, band, year, round(sum(value), 2) AS value
        FROM grid_values JOIN cells USING (cell) WHERE year = 1996 GROUP BY ALL),
      axis AS (SELECT DISTINCT variable, band, year FROM coarse)
      SELECT a.variable, n.cell, a.band, a.year, k.value,
        CASE WHEN a.variable = 'quantity' THEN concat('line ', a.band + 1) ELSE 'all' END AS band_label
      FROM near n CROSS JOIN axis a LEFT JOIN coarse k ON k.point = n.rvalue AND k.variable = a.variable AND k.band = a.band""",
    "read_input_holes": f"""WITH {CELLS}, {RASTER}, {VALUES},
      holed AS (SELECT * FROM raster WHERE rvalue % 7 <> 3), {NEAR.format(raster="holed")},
      coarse AS (SELECT variable, floor(ix / 4) * 1000 + floor(iy / 4) AS point, band, year, round(sum(value), 2) AS value
        FROM grid_values JOIN cells USING (cell) WHERE year = 1996 AND (floor(ix / 4) * 1000 + floor(iy / 4)) % 11 <> 5 GROUP BY ALL),
      axis AS (SELECT DISTINCT variable, band, year FROM coarse)
      SELECT a.variable, n.cell, a.band, a.year, k.value,
        CASE WHEN a.variable = 'quantity' THEN concat('line ', a.band + 1) ELSE 'all' END AS band_label
      FROM near n CROSS JOIN axis a LEFT JOIN coarse k ON k.point = n.rvalue AND k.variable = a.variable AND k.band = a.band""",
    "focal_mean": f"""WITH {CELLS}, {QUANTITY},
      s AS (SELECT c.cell, ix, iy, year, sum(value) AS s FROM quantity q JOIN cells c ON c.cell = q.cell GROUP BY ALL),
      offsets AS (SELECT dx, dy FROM range(-1, 2) AS a(dx), range(-1, 2) AS b(dy))
      SELECT a.cell, a.year, sum(b.s) / count(*) AS mean_value, count(*) AS n
      FROM s a, offsets o, s b WHERE b.year = a.year AND b.ix = a.ix + o.dx AND b.iy = a.iy + o.dy GROUP BY a.cell, a.year""",
    "regrid_inputs": """SELECT CAST(s_suppkey // 50 AS INT) AS config, s_name AS name, CAST(s_suppkey AS INT) AS id,
      'clm' AS fmt, 'values' AS kind FROM supplier WHERE s_suppkey % 2 = 0""",
    "catalog_available": """SELECT CAST(s_suppkey // 50 AS INT) AS config, s_name AS name FROM supplier""",
    "catalog_coupled": """SELECT CAST(s_suppkey // 50 AS INT) AS config, s_name AS name, CAST(s_suppkey AS INT) AS index,
      CASE WHEN s_suppkey % 2 <> 0 THEN 'raw' ELSE 'cdf' END AS fmt FROM supplier WHERE s_suppkey % 3 = 0""",
    "years_range": f"WITH {VALUES} SELECT * FROM grid_values WHERE year BETWEEN 1996 AND 1998",
    "years_clamped": f"""WITH {VALUES}, {PERIOD} SELECT v.* FROM grid_values v JOIN period p
      ON v.variable = p.variable WHERE v.year BETWEEN greatest(p.firstyear, 1990) AND least(p.lastyear, 1996)""",
    "years_without_period": f"""WITH {VALUES}, {PERIOD} SELECT v.* FROM grid_values v JOIN period p
      ON v.variable = p.variable WHERE CASE WHEN v.variable = 'price' THEN v.year BETWEEN 1990 AND 1996
        ELSE v.year BETWEEN greatest(p.firstyear, 1990) AND least(p.lastyear, 1996) END""",
    "years_aligned": f"""WITH {VALUES} SELECT variable, cell, band, CAST(1998 AS INT) AS year, value
      FROM grid_values WHERE (variable = 'quantity' AND year = 1996) OR (variable = 'price' AND year = 1998)""",
    "calendar": f"""WITH {VALUES} SELECT CAST(y AS INT) AS year,
      CASE WHEN y < 1998 THEN 'historic' ELSE 'coupled' END AS phase, count(v.cell) AS n
      FROM (SELECT unnest(range(min(year), max(year) + 1)) AS y FROM grid_values)
      LEFT JOIN grid_values v ON v.year = y GROUP BY y""",
    "cells_indexed": f"""WITH {CELLS} SELECT cell * 1000003000019 AS cell, lon, lat,
      CAST(row_number() OVER (ORDER BY cell) - 1 AS BIGINT) AS cell_index FROM cells""",
    "cells_selected": f"""WITH {QUANTITY} SELECT *, CAST(cell - 100 AS BIGINT) AS cell_index
      FROM quantity WHERE cell >= 100""",
    "bands_selected": f"WITH {QUANTITY} SELECT * FROM quantity WHERE band IN (0, 3)",
    "code_to_name": f"""WITH {CELLS}, {COUNTRIES} SELECT cell, country_id,
      coalesce(name, CAST(country_id AS VARCHAR)) AS country FROM cells LEFT JOIN countries ON country_id = id""",
    "code_to_iso": f"""WITH {CELLS}, {COUNTRIES} SELECT cell, country_id,
      coalesce(code, CAST(country_id AS VARCHAR)) AS country FROM cells LEFT JOIN countries ON country_id = id""",
    "name_metadata": """SELECT p_brand AS variable, CASE WHEN p_brand IN ('Brand#11', 'Brand#22') THEN concat(p_brand, ' name')
      WHEN p_brand = 'Brand#33' THEN concat(p_brand, ' iso alpha-3 code') ELSE min(p_type) END AS long_name
      FROM part GROUP BY p_brand""",
    "iso_to_name": f"""WITH {CELLS}, {COUNTRIES} SELECT cell, c.code, lower(name) AS country
      FROM (SELECT cell, concat('N', lpad(CAST(country_id AS VARCHAR), 2, '0')) AS code FROM cells) c
      LEFT JOIN countries k ON c.code = k.code""",
    "fuzzy_match": r"""WITH names AS (SELECT p_name AS name, min(p_partkey) AS pos FROM part GROUP BY p_name),
      queries AS (SELECT DISTINCT concat(upper(translate(p_name, 'aeiou', 'eioua')), '#', p_size) AS query FROM part),
      texts AS (SELECT query, trim(lower(regexp_replace(query, '\W', ' ', 'g'))) AS t FROM queries),
      pairs AS (SELECT t, n.name, n.pos, trim(lower(regexp_replace(n.name, '\W', ' ', 'g'))) AS s
        FROM (SELECT DISTINCT t FROM texts), names n),
      scored AS (SELECT t, name, pos, length(s) + length(t) AS total,
        list_reduce(string_split(s, ''), lambda row_, c: list_reduce(range(1, length(t) + 1),
          lambda acc, j: list_append(acc, CASE WHEN t[j] = c THEN row_[j] + 1
            ELSE greatest(row_[j + 1], acc[-1]) END), [0]),
          list_transform(range(0, length(t) + 1), lambda z: 0))[-1] AS lcs FROM pairs),
      rated AS (SELECT t, name, pos, CAST(round_even(200.0 * lcs / total, 0) AS INT) AS score FROM scored),
      best AS (SELECT t, arg_max(name, CAST(score AS BIGINT) * 1000000000 - pos) AS name,
        concat('C', arg_max(pos, CAST(score AS BIGINT) * 1000000000 - pos)) AS code, max(score) AS score FROM rated GROUP BY t)
      SELECT query, name, code, score FROM texts JOIN best ON texts.t = best.t""",
    "extract_region": f"WITH {REGION} SELECT cell, lon, lat, CAST(new_cell AS BIGINT) AS new_cell FROM region",
    "regrid_values": f"""WITH {REGION}, {VALUES} SELECT v.variable, CAST(r.new_cell AS BIGINT) AS cell, v.band,
      v.year, v.value FROM grid_values v JOIN region r ON v.cell = r.cell""",
    "regrid_links": f"""WITH {REGION}, {LINKS} SELECT CAST(r.new_cell AS BIGINT) AS cell,
      CAST(t.new_cell AS BIGINT) AS to_cell FROM links l JOIN region r ON l.cell = r.cell
      LEFT JOIN region t ON l.to_cell = t.cell""",
    "labels_by_crop": f"""WITH {FLAGS} SELECT cell, band, year, value, concat(
      CASE WHEN band < 3 THEN 'rainfed' ELSE 'irrigated' END, ' ',
      CASE band % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'N' ELSE 'R' END) AS band_label FROM flags""",
    "labels_by_meta": f"""WITH {VALUES} SELECT variable, cell, band, year, value,
      CASE WHEN variable = 'quantity' THEN concat('line ', band + 1) END AS band_label FROM grid_values""",
    "attach_metadata": f"""WITH {VALUES} SELECT variable, cell, band, year, value, variable AS standard_name,
      CASE WHEN variable = 'quantity' THEN 'quantity sold' ELSE 'price paid' END AS long_name,
      CASE WHEN variable = 'quantity' THEN '1' ELSE 'money' END AS units,
      'line items' AS source, 'driver tables' AS history, CAST(0.5 AS DOUBLE) AS cellsize FROM grid_values""",
    "attach_coords": f"""WITH {CELLS}, {VALUES} SELECT v.*, c.lon, c.lat
      FROM grid_values v LEFT JOIN cells c ON v.cell = c.cell""",
    "densify": f"""WITH {CELLS}, {BANDS}, {VALUES}, {YEARS} SELECT b.variable, c.cell, b.band,
      CAST(y.year AS INT) AS year, q.value FROM cells c CROSS JOIN bands b CROSS JOIN years y
      LEFT JOIN grid_values q ON q.variable = b.variable AND q.cell = c.cell AND q.band = b.band AND q.year = y.year""",
    "missing_roundtrip": f"""WITH {VALUES} SELECT variable, cell, band, year,
      CASE WHEN variable = 'quantity' AND value % 7 = 0 THEN NULL
        WHEN variable = 'price' AND cell % 5 = 0 THEN NULL ELSE value END AS value,
      variable = 'quantity' AND value % 7 = 0 AS is_sentinel,
      variable = 'price' AND cell % 5 = 0 AS is_nan FROM grid_values""",
    "apply_scalar": f"""WITH {VALUES} SELECT variable, cell, band, year,
      value * CASE WHEN variable = 'quantity' THEN 0.5 ELSE 2.0 END AS value FROM grid_values""",
    "cast_types": f"""WITH {VALUES} SELECT variable, cell, band, year,
      CASE WHEN variable = 'quantity' THEN trunc(value / 4) ELSE CAST(CAST(value / 4 AS FLOAT) AS DOUBLE) END AS value
      FROM grid_values""",
    "steps_as_bands": """WITH v AS (SELECT user_id AS cell, CAST(year(ts) AS INT) AS year,
      CAST(day(ts) AS INT) AS step, count(*) AS n FROM events GROUP BY ALL)
      SELECT 'daily' AS variable, cell, CAST(dense_rank() OVER (PARTITION BY year ORDER BY step) - 1 AS INT) AS band,
      year, CAST(n AS DOUBLE) AS value FROM v""",
    "to_wide": f"""WITH {VALUES} SELECT cell, band, year,
      max(CASE WHEN variable = 'quantity' THEN value END) AS quantity,
      max(CASE WHEN variable = 'price' THEN value END) AS price FROM grid_values GROUP BY cell, band, year""",
    "to_long": f"WITH {VALUES} SELECT cell, band, year, variable, value FROM grid_values",
    "select_variable": f"""WITH {QUANTITY} SELECT variable, cell, band, year, value,
      concat('line ', band + 1) AS band_label FROM quantity""",
    "assemble": f"""WITH {VALUES} SELECT coalesce(q.cell, p.cell) AS cell, coalesce(q.band, p.band) AS band,
      coalesce(q.year, p.year) AS year, q.value AS quantity, p.value AS price
      FROM quantity q FULL JOIN price p ON q.cell = p.cell AND q.band = p.band AND q.year = p.year""",
    "append_years": f"WITH {QUANTITY} SELECT variable, cell, band, year, value FROM quantity",
    "overlay": f"""WITH {QUANTITY} SELECT variable, cell, band, year,
      CASE WHEN year = 1998 AND cell % 3 = 0 THEN (CASE WHEN band = 6 THEN NULL ELSE value * 2 END)
      ELSE value END AS value FROM quantity""",
    "compare_runs": f"""WITH {VALUES},
      b AS (SELECT variable, cell, band, year, CASE WHEN variable = 'quantity' AND cell % 100 = 0 THEN value + 1
        ELSE value END AS value FROM grid_values WHERE NOT (variable = 'price' AND year = 1997))
      SELECT a.variable, bool_and(coalesce(abs(a.value - b.value) <= 1e-8 + 1e-5 * abs(b.value), false)) AS all_close,
        max(abs(a.value - b.value)) AS max_abs_diff,
        CAST(count(*) - count(b.value) AS BIGINT) AS one_sided, count(*) AS compared
      FROM grid_values a LEFT JOIN b USING (variable, cell, band, year) GROUP BY a.variable""",
    "merge_datasets": f"""WITH {VALUES} SELECT variable, cell, band, year,
      CAST(CASE WHEN variable = 'quantity' AND cell % 3 = 0 AND cell % 5 = 0 THEN value + 1 ELSE value END AS DOUBLE) AS value
      FROM grid_values""",
    "merge_conflicts": f"""WITH {QUANTITY} SELECT variable, cell, band, year, CAST(2 AS BIGINT) AS n,
      CAST(value AS DOUBLE) AS low, CAST(value + 1 AS DOUBLE) AS high, CAST(0 AS INT) AS part
      FROM quantity WHERE cell % 3 <> 0 AND cell % 5 = 0""",
    "undefined_vars": """SELECT DISTINCT p_name AS name FROM part WHERE p_name NOT IN
      (SELECT p_name FROM part WHERE p_size = 50)""",
    "validate_shape": f"""WITH {CELLS}, {VALUES},
      keys AS (SELECT variable, year, cell, count(*) AS bands, max(band) AS top FROM grid_values GROUP BY ALL),
      shape AS (SELECT variable, year, count(*) AS cells, min(bands) AS fewest, max(bands) AS most, max(top) AS top
        FROM keys GROUP BY variable, year),
      want AS (SELECT *, CASE WHEN variable = 'quantity' THEN 7 ELSE 1 END AS nband FROM shape)
      SELECT 'shape' AS rule, variable, year, CAST(NULL AS BIGINT) AS cell, CAST(NULL AS INT) AS band,
        concat('cells=', cells, ' bands=', most) AS detail FROM want
      WHERE cells <> (SELECT count(*) FROM cells) OR fewest <> nband OR most <> nband OR top <> nband - 1""",
    "validate_missing": f"""WITH {CELLS}, {BANDS}, {VALUES}, {YEARS} SELECT 'missing' AS rule, b.variable,
      CAST(y.year AS INT) AS year, c.cell, b.band, 'no row' AS detail
      FROM cells c, bands b, years y WHERE NOT EXISTS (SELECT 1 FROM grid_values q
        WHERE q.variable = b.variable AND q.cell = c.cell AND q.band = b.band AND q.year = y.year)""",
    "validate_index": """SELECT DISTINCT 'index' AS rule, CAST(l_linenumber AS VARCHAR) AS variable, CAST(NULL AS INT) AS year,
      CAST(NULL AS BIGINT) AS cell, CAST(NULL AS INT) AS band,
      CASE WHEN l_linenumber = 3 THEN 'index of several outputs' ELSE 'index is not supported' END AS detail
      FROM lineitem WHERE l_linenumber = 3 OR l_linenumber > 5""",
    "validate_coupled": """SELECT 'registry' AS rule, s_name AS variable, CAST(NULL AS INT) AS year,
      CAST(NULL AS BIGINT) AS cell, CAST(NULL AS INT) AS band, CASE WHEN s_suppkey % 5 = 0 THEN 'input is not registered'
        ELSE concat('registered with id ', s_suppkey + 1) END AS detail
      FROM supplier WHERE s_suppkey % 3 = 0 AND (s_suppkey % 5 = 0 OR s_suppkey % 7 = 0)""",
    "validate_periods": """SELECT 'period' AS rule, variable, CAST(NULL AS INT) AS year, CAST(NULL AS BIGINT) AS cell,
      CAST(NULL AS INT) AS band, detail FROM (VALUES ('quantity', '2'), ('price', '0')) AS t(variable, detail)
      WHERE (SELECT count(*) FROM lineitem) > 0""",
    "validate_streams": """SELECT 'count' AS rule, variable, CAST(NULL AS INT) AS year, CAST(NULL AS BIGINT) AS cell,
      CAST(NULL AS INT) AS band, CAST(n AS VARCHAR) AS detail FROM (SELECT 'ninput' AS variable, count(*) AS n FROM supplier
      UNION ALL SELECT 'noutput', count(*) FROM customer)""",
    "validate_year": f"""WITH {VALUES} SELECT 'year' AS rule, variable, year, CAST(NULL AS BIGINT) AS cell,
      CAST(NULL AS INT) AS band, CAST(count(*) AS VARCHAR) AS detail FROM grid_values WHERE year <> 1996
      GROUP BY variable, year""",
    "validate_metadata": """SELECT DISTINCT 'cellsize' AS rule, p_brand AS variable, CAST(NULL AS INT) AS year,
      CAST(NULL AS BIGINT) AS cell, CAST(NULL AS INT) AS band,
      CASE WHEN CAST(substr(p_brand, 7) AS INT) % 3 = 0 THEN '0.5 0.25' ELSE '0.5' END AS detail
      FROM part WHERE CAST(substr(p_brand, 7) AS INT) % 3 <> 1""",
    "validate_subannual": """SELECT 'subannual' AS rule, 'daily' AS variable, CAST(year(ts) AS INT) AS year,
      CAST(NULL AS BIGINT) AS cell, CAST(NULL AS INT) AS band, 'several bands' AS detail FROM events
      GROUP BY year(ts) HAVING min(day(ts)) <> max(day(ts)) AND bool_or(event_type <> 'click')""",
    "validate_type": f"""WITH {VALUES} SELECT 'type' AS rule, variable, year, cell, band,
      CAST(value / 2 AS VARCHAR) AS detail FROM grid_values
      WHERE variable = 'quantity' AND value / 2 <> floor(value / 2)""",
    "validate_unknown": f"""WITH {VALUES} SELECT 'unknown' AS rule, variable, CAST(NULL AS INT) AS year,
      CAST(NULL AS BIGINT) AS cell, CAST(NULL AS INT) AS band, CAST(count(*) AS VARCHAR) AS detail
      FROM grid_values WHERE variable = 'price' GROUP BY variable""",
    "validate_duplicates": """SELECT 'duplicate' AS rule, 'line' AS variable, CAST(year(l_shipdate) AS INT) AS year,
      l_partkey AS cell, CAST(l_linenumber - 1 AS INT) AS band, CAST(count(*) AS VARCHAR) AS detail
      FROM lineitem GROUP BY l_partkey, l_linenumber, year(l_shipdate) HAVING count(*) > 1""",
    "operations_left": f"""WITH {VALUES}, years AS (SELECT DISTINCT year FROM grid_values),
      ops AS (SELECT year, 0 AS position, 'send_input' AS operation FROM years WHERE year >= 1998
        UNION ALL SELECT year, 1, 'read_output' FROM years WHERE year >= 1996)
      SELECT year, position, operation FROM ops WHERE NOT (year < 1999 AND operation = 'send_input')
        AND NOT (year < 1998 AND operation = 'read_output')""",
    "ledger_violations": """WITH log AS (SELECT user_id AS run, CAST(event_id AS BIGINT) AS seq, CAST(day(ts) AS INT) AS year,
        CASE WHEN event_type = 'click' THEN 'send_input' ELSE 'read_output' END AS operation
        FROM events WHERE event_type IN ('click', 'purchase')),
      years AS (SELECT DISTINCT CAST(day(ts) AS INT) AS year FROM events),
      expected AS (SELECT year, 'send_input' AS operation FROM years WHERE year >= 10
        UNION ALL SELECT year, 'read_output' FROM years WHERE year >= 5),
      firsts AS (SELECT run, year, operation, min(seq) AS seq FROM log GROUP BY ALL),
      done AS (SELECT r.run, e.year, e.operation, coalesce(f.seq, 9000000000000000000) AS seq
        FROM (SELECT DISTINCT run FROM log) r CROSS JOIN expected e LEFT JOIN firsts f
        ON f.run = r.run AND f.year = e.year AND f.operation = e.operation),
      per_year AS (SELECT run, year, max(seq) AS seq, max(CASE WHEN operation = 'send_input' THEN seq END) AS sent
        FROM done GROUP BY run, year),
      earlier AS (SELECT run, year, sent, max(seq) OVER (PARTITION BY run ORDER BY year
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM per_year),
      judged AS (SELECT l.run, l.seq, l.year, l.operation, CASE
        WHEN NOT EXISTS (SELECT 1 FROM expected e WHERE e.year = l.year AND e.operation = l.operation) THEN 'not expected'
        WHEN l.seq > f.seq THEN 'repeated' WHEN p.before > l.seq THEN 'before an earlier year is done'
        WHEN l.operation = 'read_output' AND p.sent > l.seq THEN 'output before input' END AS violation
        FROM log l JOIN firsts f ON f.run = l.run AND f.year = l.year AND f.operation = l.operation
        LEFT JOIN earlier p ON p.run = l.run AND p.year = l.year)
      SELECT * FROM judged WHERE violation IS NOT NULL""",
    "gate_steps": f"""WITH e AS (SELECT {EVENT_BAND} AS band, CAST(day(ts) AS INT) AS year FROM events)
      SELECT year, count(*) AS keys, CAST(0 AS BIGINT) AS missing FROM e
      GROUP BY year HAVING year % 10 <> 0 AND NOT (year % 4 = 0 AND bool_or(band = 2))""",
    "stream_coords": f"""WITH {CELLS} SELECT user_id AS cell, {EVENT_BAND} AS band, CAST(event_id AS BIGINT) AS step, lon, lat
      FROM events LEFT JOIN cells ON cell = user_id""",
    "flat_arrivals": f"""WITH {CELLS}, {QUANTITY}, years AS (SELECT DISTINCT year FROM quantity)
      SELECT 'demand' AS variable, c.cell, CAST(0 AS INT) AS band, CAST(y.year + 1 AS INT) AS year,
      CAST(count(q.value) AS DOUBLE) AS value FROM cells c CROSS JOIN years y
      LEFT JOIN quantity q ON q.cell = c.cell AND q.year = y.year
      WHERE y.year < (SELECT max(year) FROM quantity) GROUP BY c.cell, y.year""",
    "history": f"""WITH {VALUES} SELECT variable, cell, band, year, value,
      make_date(year, 12, 31) AS time FROM grid_values WHERE year >= 1996 AND year < 1999""",
    "stream_steps": f"""SELECT user_id AS cell, {EVENT_BAND} AS band, CAST(day(ts) AS INT) AS year,
      round(sum(value), 2) AS value, count(*) AS n FROM events GROUP BY ALL""",
    "late_rows": f"""SELECT user_id AS cell, {EVENT_BAND} AS band,
      CASE WHEN event_id % 97 <> 0 THEN CAST(day(ts) AS INT) END AS year, CAST(event_id AS BIGINT) AS step, value,
      CASE WHEN event_id % 97 <> 0 THEN 'step closed, open step is 11' ELSE 'row without a step' END AS reason
      FROM events WHERE day(ts) < 11 OR event_id % 97 = 0""",
    "complete_steps": f"""WITH e AS (SELECT user_id AS cell, {EVENT_BAND} AS band,
        CAST(day(ts) AS INT) AS year, event_id FROM events),
      got AS (SELECT year, count(*) AS got FROM e WHERE NOT (year % 4 = 0 AND band = 2) AND year % 10 <> 0 GROUP BY year),
      want AS (SELECT year, count(*) AS n FROM e GROUP BY year)
      SELECT want.year, n - coalesce(got, 0) = 0 AS complete, CAST(n - coalesce(got, 0) AS BIGINT) AS missing
      FROM want LEFT JOIN got ON want.year = got.year""",
    "run_steps": f"""WITH e AS (SELECT user_id AS cell, {EVENT_BAND} AS band,
        CAST(ceil(day(ts) / 7) AS INT) AS year, event_id FROM events)
      SELECT 'demand' AS variable, cell, CAST(0 AS INT) AS band, CAST(year + 1 AS INT) AS year,
      CAST(count(*) AS DOUBLE) AS value FROM e WHERE year < (SELECT max(year) FROM e) GROUP BY cell, year""",
    "decode_time_axis": """SELECT o_orderkey, CAST(year(CASE o_orderstatus
        WHEN 'O' THEN CAST(o_orderdate AS DATE)
        WHEN 'F' THEN CAST(DATE '1990-01-15' + to_months(CAST(o_orderkey % 300 AS INT)) AS DATE)
        ELSE CAST(DATE '1990-01-15' + to_years(CAST(o_orderkey % 40 AS INT)) AS DATE) END) AS INT) AS year,
      CAST(year(DATE '1990-02-01' + to_months(CAST(o_orderkey % 300 AS INT))) AS INT) AS month_index_year FROM orders""",
    "describe_dataset": f"""WITH {VALUES} SELECT variable, count(DISTINCT cell) AS ncell,
      count(DISTINCT band) AS nband, CAST(count(*) AS BIGINT) AS nvalue, min(year) AS firstyear, max(year) AS lastyear
      FROM grid_values GROUP BY variable""",
    "area_weighted_mean": f"""WITH {CELLS}, {QUANTITY} SELECT q.variable, q.year, q.band,
      sum(q.value * c.weight) / sum(c.weight) AS value FROM quantity q JOIN cells c ON q.cell = c.cell
      GROUP BY q.variable, q.year, q.band""",
    "reduce_mean": f"WITH {QUANTITY} SELECT variable, cell, year, avg(value) AS value FROM quantity GROUP BY ALL",
    "group_mean_by_country": f"""WITH {CELLS}, {COUNTRIES}, {QUANTITY} SELECT k.name AS country, q.variable, q.band, q.year,
      avg(q.value) AS value FROM quantity q JOIN cells c ON q.cell = c.cell JOIN countries k ON c.country_id = k.id
      GROUP BY ALL""",
    "resample_years": """SELECT 'daily' AS variable, user_id AS cell, CAST(0 AS INT) AS band,
      CAST(year(ts) AS INT) AS year, CAST(count(*) AS DOUBLE) AS value FROM events GROUP BY user_id, year(ts)""",
    "rolling_mean": f"""WITH {QUANTITY} SELECT variable, cell, band, year,
      CASE WHEN count(value) OVER w = 3 THEN sum(value) OVER w / 3 END AS value FROM quantity
      WINDOW w AS ({SERIES} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "year_diff": f"""SELECT variable, cell, band, year, value FROM (WITH {QUANTITY}
      SELECT variable, cell, band, year, value - lag(value) OVER w AS value, row_number() OVER w AS n
      FROM quantity WINDOW w AS ({SERIES})) WHERE n > 1""",
    "shift": f"""WITH {QUANTITY} SELECT variable, cell, band, year,
      lag(value) OVER ({SERIES}) AS value FROM quantity""",
    "cumsum": f"""WITH {QUANTITY} SELECT variable, cell, band, year, sum(value) OVER ({SERIES}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM quantity""",
    "ffill": f"""WITH {QUANTITY} SELECT variable, cell, band, year, last_value(
      CASE WHEN value % 3 <> 0 THEN value END IGNORE NULLS) OVER ({SERIES}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM quantity""",
    "fillna": f"""WITH {QUANTITY} SELECT variable, cell, band, year,
      CASE WHEN value % 3 <> 0 THEN value ELSE -1.0 END AS value FROM quantity""",
    "arithmetic": f"""WITH {VALUES} SELECT q.cell, q.band, q.year, p.value - q.value AS value
      FROM quantity q JOIN price p ON q.cell = p.cell AND q.band = p.band AND q.year = p.year""",
    "quantile": f"""WITH {QUANTITY} SELECT variable, year, round(quantile_cont(value, 0.9), 6) AS value
      FROM quantity GROUP BY variable, year""",
    "resolve_variable": f"""SELECT CAST(l_linenumber AS INT) AS index,
      CASE WHEN l_linenumber <> 7 THEN concat('line ', l_linenumber) END AS variable,
      sum(l_quantity) AS value FROM lineitem GROUP BY l_linenumber""",
    "input_types": """SELECT CAST(pos AS INT) AS id, name, CAST(CASE name WHEN 'landuse' THEN 64 WHEN 'fertilizer_nr' THEN 32
      WHEN 'sdate' THEN 24 WHEN 'residue_on_field' THEN 16 ELSE 1 END AS INT) AS nband,
      CASE WHEN name IN ('with_tillage', 'sdate') THEN 'int' ELSE 'float' END AS type,
      name IN ('landuse', 'fertilizer_nr', 'sdate', 'residue_on_field') AS has_bands, n
      FROM (SELECT l_linenumber AS pos, CASE l_linenumber WHEN 1 THEN 'landuse' WHEN 2 THEN 'with_tillage'
        WHEN 3 THEN 'fertilizer_nr' WHEN 4 THEN 'sdate' WHEN 5 THEN 'residue_on_field' ELSE 'soil' END AS name,
        count(*) AS n FROM lineitem GROUP BY 1, 2)""",
    "inventory_files": f"""WITH {SUPPLIED} SELECT CAST(s_suppkey AS INT) AS id, CASE s_suppkey % 5 WHEN 0 THEN 'clm'
      WHEN 1 THEN 'cdf' WHEN 2 THEN 'meta' WHEN 3 THEN 'text' ELSE 'raw' END AS io_type,
      CAST(CASE s_suppkey % 5 WHEN 0 THEN 35 WHEN 1 THEN 8 WHEN 2 THEN 6 WHEN 3 THEN 3 ELSE 2 END
        + length(CAST(c AS VARCHAR)) AS BIGINT) AS length FROM supplied""",
    "header_catalog": f"""WITH {SUPPLIED} SELECT CAST(s_suppkey AS INT) AS firstcell, CAST(s_suppkey % 4 + 1 AS INT) AS version,
      CASE WHEN s_suppkey % 3 = 0 THEN 'big' ELSE 'little' END AS endian, CAST(c AS INT) AS ncell,
      CAST(1901 + s_suppkey % 50 + 9 AS INT) AS lastyear,
      CAST(CASE WHEN s_suppkey % 4 < 2 THEN 1 ELSE 3 END AS INT) AS datatype,
      CAST(CASE s_suppkey % 4 WHEN 0 THEN 0.5 ELSE 0.25 END AS DOUBLE) AS cellsize_lat,
      CAST(7 + 4 * CASE s_suppkey % 4 WHEN 0 THEN 7 WHEN 1 THEN 9 WHEN 2 THEN 11 ELSE 13 END AS INT) AS header_bytes
      FROM supplied""",
    "scan_flat_grid": f"""WITH {CELLS}, {BANDS}, {QUANTITY} SELECT b.variable, c.cell, b.band,
      CAST(y.year AS INT) AS year, coalesce(q.value, -9999.0) AS value
      FROM cells c CROSS JOIN bands b CROSS JOIN (SELECT DISTINCT year FROM quantity) y
      LEFT JOIN quantity q ON q.cell = c.cell AND q.band = b.band AND q.year = y.year
      WHERE b.variable = 'quantity'""",
    "flat_grid_part": f"""WITH {CELLS}, {BANDS}, {QUANTITY} SELECT b.variable, c.cell, b.band,
      CAST(y.year AS INT) AS year, coalesce(q.value, -9999.0) AS value
      FROM cells c CROSS JOIN bands b CROSS JOIN (SELECT DISTINCT year FROM quantity) y
      LEFT JOIN quantity q ON q.cell = c.cell AND q.band = b.band AND q.year = y.year
      WHERE b.variable = 'quantity' AND y.year BETWEEN 1995 AND 1996 AND b.band IN (1, 4) AND c.cell > 150""",
    "convert_raw": f"""WITH {VALUES} SELECT variable, cell, band, year,
      CASE WHEN variable = 'price' THEN CAST(CAST(value AS FLOAT) AS DOUBLE) WHEN year >= 1998 THEN value + 1 ELSE value END AS value,
      CASE WHEN variable = 'price' THEN 'money' ELSE '1' END AS unit, 'raw' AS format FROM grid_values""",
    "nested_metadata": """WITH t AS (SELECT p_brand AS variable, count(*) AS n FROM part GROUP BY p_brand),
      s AS (SELECT p_brand AS variable, string_agg(concat('{"size":', p_size, '}'), ',' ORDER BY p_size) AS parts
        FROM (SELECT DISTINCT p_brand, p_size FROM part) GROUP BY p_brand)
      SELECT variable, concat('{"variable":"', variable, '","settings":{"count":', n, ',"parts":[', parts,
        ']},"named":{"a":{"v":', n, '}}}') AS json FROM t JOIN s USING (variable)""",
    "metadata_catalog": """SELECT p_brand AS variable, CAST(count(DISTINCT p_type) AS INT) AS nbands,
      CASE WHEN CAST(substr(p_brand, 7) AS INT) % 2 = 0
        THEN array_to_string(list_transform(range(0, count(DISTINCT p_type)), lambda i: CAST(i AS VARCHAR)), ' ')
        ELSE string_agg(DISTINCT p_type, ' ' ORDER BY p_type) END AS band_names,
      CAST(count(*) AS INT) AS ncell FROM part GROUP BY p_brand""",
    "merge_metadata": """SELECT p_brand AS variable, CAST(count(*) AS INT) AS ncell,
      CASE WHEN CAST(substr(p_brand, 7) AS INT) % 3 = 0 THEN 'from source' ELSE 'from target' END AS unit,
      string_agg(DISTINCT p_type, ' ' ORDER BY p_type) AS band_names,
      'area.bin.json' AS area_file FROM part GROUP BY p_brand""",
    "catalog_outputs": """SELECT CAST(s_suppkey // 50 AS INT) AS config, s_name AS name, CAST(s_suppkey AS INT) AS index,
      'cdf' AS fmt, s_suppkey % 3 = 0 AS socket FROM supplier WHERE s_suppkey % 2 = 0""",
    "catalog_inputs": """SELECT CAST(s_suppkey // 50 AS INT) AS config, s_name AS name, CAST(s_suppkey AS INT) AS id,
      CASE WHEN s_suppkey % 2 = 0 THEN 'clm' ELSE 'raw' END AS fmt FROM supplier WHERE s_suppkey % 3 = 0""",
    "convert_format": f"""WITH {VALUES} SELECT variable, cell, band, year, value FROM grid_values
      WHERE variable = 'quantity'""",
    "load_grid": """SELECT 'quantity' AS variable, CAST(l_linenumber - 1 AS INT) AS band,
      CAST(year(l_shipdate) AS INT) AS year, l_partkey AS cell, sum(l_quantity) AS value FROM lineitem GROUP BY ALL""",
}
ORACLES["nearest_regular"] = ORACLES["nearest_cell"]
