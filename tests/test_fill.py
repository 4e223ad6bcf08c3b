import numpy as np
import pytest

from lamella.operators import surface


def loop(image, value):
    v = image.copy()
    v[[0, 0, -1, -1], [0, -1, 0, -1]] = 0
    todo = [(0, 0), (0, v.shape[1] - 1), (v.shape[0] - 1, 0), (v.shape[0] - 1, v.shape[1] - 1)]
    out, seen = v.copy(), set(todo)
    while todo:
        y, x = todo.pop()
        out[y, x] = value
        for b, a in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
            if 0 <= b < v.shape[0] and 0 <= a < v.shape[1] and (b, a) not in seen and v[b, a] <= value:
                seen.add((b, a))
                todo.append((b, a))
    return out


def maze(n):
    """One long dark path that winds through all tiles, from a corner to a dead end."""
    image = np.full((n, n), 200)
    image[::4] = 3
    for k, y in enumerate(range(2, n - 2, 4)):
        x = n - 1 if k % 2 == 0 else 0
        image[y - 1 : y + 2, x] = 3
    return image


@pytest.mark.parametrize("tile", [4, 7, 256])
def test_tiles_equal_a_loop(spark, tile):
    rnd = np.random.default_rng(5)
    images = {1: rnd.integers(0, 100, (17, 22)), 2: maze(21), 3: np.full((9, 9), 50), 4: np.full((1, 5), 90), 5: rnd.integers(20, 60, (12, 12))}
    rows = [(k, int(y), int(x), int(v)) for k, i in images.items() for (y, x), v in np.ndenumerate(i)]
    frame = spark.createDataFrame(rows, "slice_id int, y int, x int, v int").repartition(3)
    got = sorted(map(tuple, surface.fill_outside(frame, ["slice_id"], 45, tile).collect()))
    want = sorted((k, int(y), int(x), int(v)) for k, i in images.items() for (y, x), v in np.ndenumerate(loop(i, 45)))
    assert got == want
    assert surface.fill_outside(frame.limit(0), ["slice_id"], 45, tile).count() == 0


def test_labels_are_connected_regions():
    rnd = np.random.default_rng(2)
    dark = rnd.random((30, 25)) < 0.6
    labels = surface._labels(dark)
    assert ((labels > 0) == dark).all()
    for a, b in ((labels[1:], labels[:-1]), (labels[:, 1:], labels[:, :-1])):
        both = (a > 0) & (b > 0)
        assert (a[both] == b[both]).all()
    assert labels.max() <= dark.size and all(labels.ravel()[n - 1] == n for n in np.unique(labels) if n)


def test_many_small_images_are_labelled_together(spark):
    calls = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")  # images that go on in the next batch
    try:
        rnd = np.random.default_rng(6)
        images = {f"s{k}": rnd.integers(0, 100, (int(rnd.integers(1, 9)), int(rnd.integers(1, 9)))) for k in range(40)}
        rows = [(k, int(y), int(x), int(v)) for k, i in images.items() for (y, x), v in np.ndenumerate(i)]
        filled = surface.fill_outside(spark.createDataFrame(rows, "slice_id string, y int, x int, v long").repartition(3), ["slice_id"], 45, 4)
        got = sorted(map(tuple, filled.collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", calls)
    assert got == sorted((k, int(y), int(x), int(v)) for k, i in images.items() for (y, x), v in np.ndenumerate(loop(i, 45)))
    assert not hasattr(surface, "pd")  # no call of pandas for each tile
