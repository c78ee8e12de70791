import random

from gridsteps.operators import spatial
from gridsteps.operators.numbering import dense_index


def make_cells(spark, rows):
    return spark.createDataFrame(rows, "cell long, lon double, lat double")


def brute(rows, cellsize):
    r = 1.5 * cellsize
    out = {}
    for c, x, y in rows:
        near = sorted(d for d, u, v in rows
                      if d != c and (x - u) * (x - u) + (y - v) * (y - v) <= r * r)
        out[c] = (near + [-9999] * 8)[:8]
    return out


def found(cells, **kw):
    return {r[0]: r.neighbours for r in spatial.neighbourhood(cells, **kw).collect()}


def test_two_adjacent_cells(spark):
    cells = make_cells(spark, [(27410, 5.25, 52.25), (27411, 5.25, 52.75)])
    assert found(cells) == {27410: [27411] + [-9999] * 7, 27411: [27410] + [-9999] * 7}


def test_indices_instead_of_ids(spark):
    cells = dense_index(make_cells(spark, [(27410, 5.25, 52.25), (27411, 5.25, 52.75)]), "cell")
    assert found(cells, by="cell_index") == {0: [1] + [-9999] * 7, 1: [0] + [-9999] * 7}


def test_no_wrap_and_no_neighbour(spark):
    cells = make_cells(spark, [(1, -179.75, 0.25), (2, 179.75, 0.25), (3, 0.25, 0.25)])
    assert all(v == [-9999] * 8 for v in found(cells).values())


def test_random_points_with_copies(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randint(0, 12) / 2, rnd.randint(0, 12) / 2) for i in range(150)]
    rows += [(i, 2.0, 2.0) for i in range(150, 190)]  # a crowded coordinate
    assert found(make_cells(spark, rows)) == brute(rows, 0.5)


def test_crowded_tile(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.random() * 3, rnd.random() * 3) for i in rnd.sample(range(1000), 120)]
    rows += [(i, 1 + rnd.random() / 8, 1 + rnd.random() / 8) for i in rnd.sample(range(1000, 2000), 80)]
    assert found(make_cells(spark, rows)) == brute(rows, 0.5)
    assert found(make_cells(spark, rows), cellsize=0.2) == brute(rows, 0.2)


def test_symmetry_below_eight(spark):
    rows = [(i, (i % 5) / 2, (i // 5) / 2) for i in range(20)]
    pairs = {(r.cell, r.neighbour) for r in spatial.neighbours(make_cells(spark, rows)).collect()}
    assert pairs == {(b, a) for a, b in pairs}


def nearest(value, axis):
    return min(axis, key=lambda a: (abs(a - value), -a))


def test_nearest_on_irregular_axis(spark):
    rnd = random.Random(5)
    axis = sorted({rnd.randint(-400, 400) / 4 for _ in range(60)})
    targets = [rnd.randint(-500, 500) / 8 for _ in range(200)] + [-1000.0, 1000.0]
    got = spatial.nearest_on_axis(
        spark.createDataFrame([(t,) for t in targets], "lon double"),
        spark.createDataFrame([(a,) for a in axis], "lon double"), "lon", buckets=16).collect()
    assert {r.target: r.nearest for r in got} == {t: nearest(t, axis) for t in targets}


def test_nearest_on_single_value(spark):
    one = spark.createDataFrame([(3.0,)], "lon double")
    got = spatial.nearest_on_axis(spark.createDataFrame([(1.0,), (9.0,)], "lon double"), one, "lon")
    assert {tuple(r) for r in got.collect()} == {(1.0, 3.0), (9.0, 3.0)}


def test_select_nearest_keeps_bands_and_ties_go_up(spark):
    raster = spark.createDataFrame(
        [(x, y, b, x * 100 + y * 10 + b) for x in (0.0, 2.0) for y in (0.0, 2.0) for b in (0, 1)],
        "lon double, lat double, band int, value double")
    cells = make_cells(spark, [(1, 1.0, 0.5), (2, 99.0, -99.0)])
    for spacing in (None, 2.0):
        got = spatial.select_nearest(raster, cells, spacing).select("cell", "rlon", "rlat", "band", "value")
        assert {tuple(r) for r in got.collect()} == {
            (1, 2.0, 0.0, 0, 200.0), (1, 2.0, 0.0, 1, 201.0),
            (2, 2.0, 0.0, 0, 200.0), (2, 2.0, 0.0, 1, 201.0)}


def test_dense_index_over_blocks(spark):
    ids = [-5, 0, 3, 4, 9, 100, 101, 10**12]
    df = spark.createDataFrame([(i,) for i in ids], "cell long")
    got = {r.cell: r.cell_index for r in dense_index(df, "cell", bits=2).collect()}
    assert got == {c: i for i, c in enumerate(ids)}


def test_region_and_regrid(spark):
    cells = spark.createDataFrame(
        [(10, 0.0, 0.0, 1), (11, 0.5, 0.0, 2), (12, 1.0, 0.0, 1)],
        "cell long, lon double, lat double, country_id int")
    countries = spark.createDataFrame([(1, "AAA"), (2, "BBB")], "id int, code string")
    region = spatial.extract_region(cells, countries, "AAA")
    assert {(r.cell, r.new_cell) for r in region.collect()} == {(10, 0), (12, 1)}
    mapping = spatial.cell_mapping(cells, region)
    links = spark.createDataFrame([(10, 11), (12, 10), (11, 12), (10, None)], "cell long, to_cell long")
    got = spatial.regrid_links(links, mapping).collect()
    assert sorted((r.cell, r.to_cell) for r in got if r.to_cell is not None) == [(1, 0)]
    assert sum(r.to_cell is None for r in got) == 2


def test_regrid_inputs(spark):
    catalog = spark.createDataFrame(
        [("coord", "clm", "g"), ("lakes", "clm", "l"), ("soil", "clm", "s"), ("drainage", "clm", "d"),
         ("co2", "txt", "c"), ("wateruse", "clm", "DUMMYLOCATION")], "name string, fmt string, filename string")
    got = {(r.name, r.kind) for r in spatial.regrid_inputs(catalog).select("name", "kind").collect()}
    assert got == {("soil", "values"), ("drainage", "links")}


def stored_cells(spark, path, columns=()):
    """3000 cells in rows of 50; the file looks far smaller than what a neighbourhood derives from it."""
    spark.range(3000).selectExpr("id AS cell", "id % 50 / 2.0D AS lon", "floor(id / 50) / 2.0D AS lat", *columns).write.parquet(path)
    return spark.read.parquet(path)


def around(cell):
    return [d for y in (-50, 0, 50) for d in range(cell + y - 1, cell + y + 2)
            if 0 <= d < 3000 and d != cell and d // 50 == (cell + y) // 50]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_mean_of_neighbours_broadcasts_no_cells(spark, tmp_path):
    near = spatial.neighbours(stored_cells(spark, str(tmp_path / "cells")))
    means = near.groupBy("cell").agg({"neighbour": "avg"})
    want = {c: sum(around(c)) / len(around(c)) for c in range(3000)}
    assert {c: m for c, m in means.collect()} == want
    assert "Broadcast" not in final_plan(means)


def test_pairs_broadcast_no_cells(spark, tmp_path):
    near = spatial.neighbours(stored_cells(spark, str(tmp_path / "cells")))
    assert sorted(near.collect()) == [(c, d) for c in range(3000) for d in around(c)]
    assert "Broadcast" not in final_plan(near)


def test_padded_lists_broadcast_no_cells(spark, tmp_path):
    padded = spatial.neighbourhood(stored_cells(spark, str(tmp_path / "cells")))
    assert {r.cell: r.neighbours for r in padded.collect()} == {
        c: (around(c) + [-9999] * 8)[:8] for c in range(3000)}
    assert "Broadcast" not in final_plan(padded)


def test_copies_broadcast_no_cells(spark, tmp_path):
    """Pairs of cells at one place; the size comes with the data."""
    cells = stored_cells(spark, str(tmp_path / "cells"), ["0.5D AS cellsize"])
    shared = cells.selectExpr("cell", "floor(cell % 50 / 2) * 1.0D AS lon", "lat", "cellsize")
    near = spatial.neighbours(shared, cellsize=2.0)
    want = [(c, d) for c in range(3000)
            for d in (c ^ 1, *(y + e for y in (c - 50, c + 50) if 0 <= y < 3000 for e in (0, (y ^ 1) - y)))]
    assert sorted(near.collect()) == sorted(want)
    assert "Broadcast" not in final_plan(near)
