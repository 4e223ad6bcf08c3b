import json

from lamella.operators import register
from lamella.sources import manifest, store


def test_index_texts_with_and_without_maps(spark):
    whole = {"SliceTransform": {"a.txt": {"ChannelName": "488nm_10X", "SliceID": "3.0"}, "/abs/b.txt": {"ChannelName": "none", "SliceID": 4}}, "BrainTransform": {"x": {"any": 1}, "y": {}}}
    files = spark.createDataFrame([(json.dumps(whole),), ("{}",), ("no json",), (None,)], "json string")
    entries = manifest.index_entries(files, "/data/")
    channels = spark.createDataFrame([("2", "488nm_10X", 2), ("1", "488nm_10X", 1)], "channel_id string, channel_name string, channel_ord int")
    slices, brain = manifest.read_reconstruction_index(entries, channels)
    assert [tuple(r) for r in slices.collect()] == [("1", 3, "/data/Reconstruction/SliceTransform/a.txt")]
    assert brain.first().path == "/data/Reconstruction/BrainTransform/y"


def test_typed_values(spark):
    text = '//(K 1)\nno bracket\n(K "a" 2 -.5 1d word nan)\n(Empty)\n(Open "x'
    files = spark.createDataFrame([("p", text)], "path string, json string")
    got = sorted((r.key, r.pos, r.text, None if r.number is None else str(r.number)) for r in manifest.read_typed_params(files).where("key = 'K'").collect())
    assert got == [("K", 0, "a", None), ("K", 1, None, "2.0"), ("K", 2, None, "-0.5"), ("K", 3, None, None), ("K", 4, None, None), ("K", 5, None, "nan")]
    rest = [(r.key, r.pos, r.text) for r in manifest.read_typed_params(files).where("key <> 'K'").orderBy("key").collect()]
    assert rest == [("Empty", None, None), ("Open", 0, "x")]


def test_slice_texts_round_trip(spark):
    boxes = spark.createDataFrame([(1, 0.0, 1.0, 2.0, 3.0, 4.0, 5.0), (2, *[0.0] * 6)], "slice_id int, lo_x double, lo_y double, lo_z double, hi_x double, hi_y double, hi_z double")
    columns = boxes.where("slice_id = 1").selectExpr("slice_id", "7 column_id", "lo_x", "lo_y", "lo_z", "hi_x", "hi_y", "hi_z")
    maps = spark.createDataFrame([(1, 7, [float(i) for i in range(12)])], "slice_id int, column_id int, params array<double>")
    sources = spark.createDataFrame([(1, "raw", None, [1.0], [2.0])], "slice_id int, stack_source string, image_source string, image_origin array<double>, image_spacing array<double>")
    texts = manifest.write_slice_files(boxes, maps, columns, sources, "0.4.0").selectExpr("slice_id", "'/d/s.json' path", "json")
    back, transforms = manifest.read_slice_geometry(texts)
    assert sorted(r.version for r in back.collect()) == ["0.4.0", "0.4.0"] and transforms.count() == 1
    assert [tuple(r) for r in manifest.read_column_spheres(texts).collect()] == [(1, 7, 0.0, 1.0, 2.0, 3.0, 4.0, 5.0)]
    assert sorted(map(tuple, manifest.read_slice_sources(texts).collect())) == [(1, "raw", None, None, None), (2, None, None, None, None)]


def test_absent_frames_are_zeros(spark):
    frames = spark.createDataFrame([(1, 5, bytearray(b"\x01\x00" * 6))], "column_id int, frame int, data binary")
    got = sorted(map(tuple, store.read_frame_pixels(frames, ["column_id"], 4, 6, 2, 3, 12).collect()))
    assert got == [(1, 4, 2, 3, 4.0, bytes(12)), (1, 5, 2, 3, 4.0, b"\x01\x00" * 6)]
    assert [(r.frame, r.spacing) for r in store.read_frame_pixels(frames, ["column_id"], 5, None, 2, 3).collect()] == [(5, 1.0)]


def test_pairs_follow_the_reference_channel(spark):
    rows = [(s, c, side, f"{side}{s}{c}") for s, c in ((1, "1"), (1, "2"), (2, "1"), (4, "1"), (4, "2"), (5, "2")) for side in "ul"]
    surfaces = spark.createDataFrame(rows, "slice_id int, channel_id string, side string, path string")
    channels = spark.createDataFrame([("1", 2), ("2", 1)], "channel_id string, channel_ord int")
    got = {(r.slice_id, r.channel_id): (r.lower, r.upper, r["last"]) for r in register.surface_pair_lists(surfaces, channels, "1").collect()}
    assert got == {
        (1, None): (None, ["u12", "u11"], False),
        (2, None): (["l12", "l11"], [None, "u21"], False),
        (4, None): (None, ["u42", "u41"], False),
        (2, "1"): (["l21"], None, True),
        (2, "2"): ([None], None, True),
        (4, "1"): (["l41"], None, True),
        (4, "2"): (["l42"], None, True),
    }
