"""Files in and out, resumed runs, hooks for callers' models."""

import json
import struct

import numpy as np
import pytest

from pointloom.sources import files, sinks
from pointloom.streaming import resume


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return path


def test_point_csv(spark, tmp_path):
    put(tmp_path / "a/f1.csv", "X,Y,Z,Intensity,BlockID\n1,2,2,9,0\n\n3,4,0,8,1\n")
    put(tmp_path / "a/f2.csv", "x\ty\tz\tintensity\n1\t0\t0\t7\n")
    put(tmp_path / "a/f3.csv", "x y z intensity distance\n1 0 0 nan 5\n")
    got = {(r.frame_id, r.row_idx): r for r in files.point_csv(spark, str(tmp_path / "a")).collect()}
    assert got["f1", 0].distance == 3.0 and got["f1", 1].block_id == 1.0 and got["f1", 1].reflectivity == 8.0
    assert got["f2", 0].intensity == 7.0 and got["f2", 0].slot is None and got["f3", 0].distance == 5.0 and np.isnan(got["f3", 0].intensity)
    assert len(got) == 4
    put(tmp_path / "b/f.csv", "x,y,z,intensity\n1,2,3\n")
    with pytest.raises(Exception, match="short row"):
        files.point_csv(spark, str(tmp_path / "b")).collect()
    put(tmp_path / "c/f.csv", "x,y,z,intensity\n1,2,3,abc\n")
    with pytest.raises(Exception):
        files.point_csv(spark, str(tmp_path / "c")).collect()


def test_binary_frames(spark, tmp_path):
    put(tmp_path / "r/f.bin", np.arange(8, dtype="<f4").tobytes())
    got = files.float_records(spark, str(tmp_path / "r"), ["x", "y", "z", "i"]).orderBy("row_idx").collect()
    assert [(r.frame_id, r.x, r.i) for r in got] == [("f", 0.0, 3.0), ("f", 4.0, 7.0)]
    put(tmp_path / "bad/f.bin", b"12345")
    with pytest.raises(Exception, match="whole records"):
        files.float_records(spark, str(tmp_path / "bad"), ["x"]).collect()
    record = lambda d: struct.pack("<8f", d, 1, 2, 3, 4, 5, 6, 7) + b"\0" * 20
    put(tmp_path / "p/f.bin", struct.pack("<QQ", 1, 2) + b"".join(record(k) for k in range(390)) + b"cut")
    got = files.packet_frames(spark, str(tmp_path / "p")).orderBy("row_idx").collect()
    assert len(got) == 390 and (got[384].slot, got[384].pixel, got[384].block_id) == (1, 0, 0) and (got[4].pixel, got[4].block_id) == (1, 1) and got[7].distance == 7.0
    sinks.decoded_csv(files.packet_frames(spark, str(tmp_path / "p")), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 390


def test_arrays_and_archives(spark, tmp_path):
    import io

    b = io.BytesIO()
    np.save(b, np.array([[2, 42], [5, 0]], np.uint16))
    put(tmp_path / "m/f.npy", b.getvalue())
    put(tmp_path / "m/g.label", np.array([7, 8], "<u4").tobytes())
    got = {(r.frame_id, r.v, r.u): r.label for r in files.npy_pixels(spark, str(tmp_path / "m")).collect()}
    assert got["f", 0, 1] == 42 and got["g", 0, 1] == 8 and len(got) == 6
    b = io.BytesIO()
    np.savez(b, masks=np.array([[[0, 1, 1], [1, 0, 1]]], bool), scores=np.array([0.5]), labels=np.array(["car"]))
    put(tmp_path / "d/f.npz", b.getvalue())
    runs = {(r.v, r.u0, r.u1) for r in files.detection_archives(spark, str(tmp_path / "d")).collect()}
    assert runs == {(0, 1, 3), (1, 0, 1), (1, 2, 3)}
    found = spark.createDataFrame([("f", "npy", "a"), ("f", "label", "b"), ("g", "label", "c")], "frame_id string, kind string, path string")
    assert {r.frame_id: r.path for r in files.label_files(found, ["label", "npy"]).collect()} == {"f": "b", "g": "c"}


def test_wide_packets(spark):
    wide = spark.createDataFrame([("f", 0, 1.0, -5.0, 9.0, 8.0, 1.0, 2.0), ("f", 1, 2.0, 3.0, 7.0, 6.0, 3.0, 4.0)], "frame_id string, row_idx int, dis0 double, dis1 double, int0 double, int1 double, ref0 double, ref1 double")
    got = files.packet_csv_points(wide, 2).orderBy("beam", "azimuth_idx").collect()
    assert [(r.beam, r.azimuth_idx, r.strength) for r in got] == [(0, 0, 9.0), (0, 1, 7.0), (1, 0, 8.0), (1, 1, 6.0)]
    assert got[2].x == 0 and round(sum(v * v for v in (got[1].x, got[1].y, got[1].z)), 9) == 4


def test_annotations(spark, tmp_path):
    put(tmp_path / "j/a.json", json.dumps([{"objectType": "car", "indices": [1, 2]}]))
    put(tmp_path / "j/b.json", json.dumps({"data": {"objects": [{"objectType": "bus"}, {"objectType": "cone"}]}}))
    put(tmp_path / "j/c.json", '{"objectType": "x"}\n{"objectType": "y"}\n')
    put(tmp_path / "j/d.json", "")
    got = files.annotations(spark, str(tmp_path / "j")).selectExpr("frame_id", "object_index", "try_variant_get(object, '$.objectType', 'string') t").collect()
    assert {(r.frame_id, r.object_index, r.t) for r in got} == {("a", 0, "car"), ("b", 0, "bus"), ("b", 1, "cone"), ("c", 0, "x"), ("c", 1, "y")}


def test_small_texts(spark, tmp_path):
    put(tmp_path / "map.txt", "a >> b\n\n c>>d \n")
    assert {tuple(r) for r in files.delimited_map(spark, str(tmp_path / "map.txt"), ["l", "r"]).collect()} == {("a", "b"), ("c", "d")}
    put(tmp_path / "bad.txt", "a >> \n")
    with pytest.raises(Exception, match="bad line"):
        files.delimited_map(spark, str(tmp_path / "bad.txt"), ["l", "r"]).collect()
    put(tmp_path / "t.csv", "i,t\n0,1.5\n1,2.0000005\n")
    assert [r.ts_us for r in files.timestamps_csv(spark, str(tmp_path / "t.csv"), "i", "t", "s").collect()] == [1_500_000, 2_000_000]
    put(tmp_path / "ins.csv", "secs,nsecs,attitude_X\n10,300000000,0.5\n")
    assert files.pose_log(spark, str(tmp_path / "ins.csv")).first().ts_us == 10_300_000
    put(tmp_path / "m.jsonl", '{"sample_id": "a", "n": 1}\n\n{"sample_id": "b", "n": 2}\n')
    assert files.jsonl(spark, str(tmp_path / "m.jsonl"), "sample_id string, n int").count() == 2
    put(tmp_path / "logs/x/1.json", '{"frame": "1", "t": 2.0}')
    put(tmp_path / "logs/2.json", "broken")
    good, bad = files.frame_logs(spark, str(tmp_path / "logs"), "frame string, t double")
    assert [r.frame for r in good.collect()] == ["1"] and bad.count() == 1
    with pytest.raises(Exception, match="malformed"):
        files.frame_logs(spark, str(tmp_path / "logs"), "frame string, t double", strict=True)[0].collect()
    for n in ("p/a.jpg", "p/b.png", "q/a.png", "p/c.txt"):
        put(tmp_path / "img" / n, "x")
    found = files.images(spark, str(tmp_path / "img"))
    assert found.count() == 3 and files.doubled_stems(found).first().stem == "a"
    with pytest.raises(ValueError):
        files.dimension(spark, [("car", 1), ("bus", 1)], "name string, id int", ("id",))
    put(tmp_path / "s.json", json.dumps({"frames": [{"frame_id": "1", "synced": True}, {"frame_id": "2", "synced": False}]}))
    assert [r.frame_id for r in files.synced_frames(spark, str(tmp_path / "s.json")).collect()] == ["1"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("f", 0, 1.0, 2.0, 3.0, 4.0, 5), ("f", 1, 5.0, 6.0, 7.0, 8.0, 255)], "frame_id string, row_idx int, x double, y double, z double, intensity double, label int")
    sinks.frames_table(df, str(tmp_path / "t"))
    with pytest.raises(Exception):
        sinks.frames_table(df, str(tmp_path / "t"))
    sinks.frames_table(df, str(tmp_path / "t"), overwrite=True)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    packed = sinks.point_cloud_bytes(df).first()
    assert np.frombuffer(packed.cloud, "<f4").tolist() == [1, 2, 3, 4, 5, 6, 7, 8] and np.frombuffer(packed.labels, "<u4").tolist() == [5, 255]
    sinks.report_csv(df, str(tmp_path / "r"))
    sinks.manifest_jsonl(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).columns == sorted(df.columns)
    poses = spark.createDataFrame([(1, [0.1] * 12)], "k int, p array<double>")
    sinks.pose_lines(poses, str(tmp_path / "p"), "p", "k")
    assert spark.read.text(str(tmp_path / "p")).first().value == " ".join(["0.1"] * 12)


def test_point_clouds_are_packed_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(sinks, "PACKED", 7)
    n = 50
    df = spark.range(2 * n).selectExpr("concat('f', id % 2) AS frame_id", "99 - id AS row_idx", "id / 4D AS x", "-id AS y", "0D AS z", "id * 2D AS intensity", "id % 256 AS label").repartition(5)
    got = {r.frame_id: r for r in sinks.point_cloud_bytes(df).collect()}
    for k in range(2):
        ids = [i for i in range(2 * n - 1, -1, -1) if i % 2 == k]
        assert np.frombuffer(got[f"f{k}"].cloud, "<f4").tolist() == [v for i in ids for v in (i / 4, -i, 0, 2 * i)]
        assert np.frombuffer(got[f"f{k}"].labels, "<u4").tolist() == [i % 256 for i in ids]


def test_resumed_stream(spark, tmp_path):
    schema = "source_id string, v int"
    write = lambda rows, n: spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
    write([("a", 1), ("b", 2)], "x")
    run = lambda s={"k": 1}: resume.process(spark, str(tmp_path / "in/*"), schema, lambda d: d.selectExpr("source_id", "v * 10 AS v"), str(tmp_path / "out"), str(tmp_path / "state"), "source_id", s)  # noqa: B006, E731
    run()
    run()
    write([("b", 3)], "y")
    run()
    assert {(r.source_id, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {("a", 10), ("b", 30)}
    with pytest.raises(ValueError):
        run({"k": 2})
    left = resume.pending(spark.createDataFrame([("a",), ("c",)], "source_id string"), spark.read.parquet(str(tmp_path / "out")), "source_id")
    assert [r.source_id for r in left.collect()] == ["c"]


def run_of(spark, at, work=None, files=1):
    """Rows (source, v) after a run over ``at``/in."""
    work = work or (lambda d: d.selectExpr("source_id", "v * 10 AS v"))
    resume.process(spark, str(at / "in/*"), "source_id string, v int", work, str(at / "out"), str(at / "state"), "source_id", {"k": 1}, files)
    return sorted((r.source_id, r.v) for r in spark.read.parquet(str(at / "out")).collect())


def put_rows(spark, at, name, rows):
    spark.createDataFrame(rows, "source_id string, v int").coalesce(1).write.parquet(str(at / "in" / name))


def test_a_source_in_several_batches_keeps_all_rows(spark, tmp_path):
    for k in range(4):
        put_rows(spark, tmp_path, f"f{k}", [("a: b/c", k * 25 + j) for j in range(25)] + [(f"own {k}", k)])
    want = sorted([("a: b/c", 10 * v) for v in range(100)] + [(f"own {k}", 10 * k) for k in range(4)])
    assert run_of(spark, tmp_path, files=2) == want
    assert run_of(spark, tmp_path) == want  # nothing new: nothing changes
    for k in range(3):  # the source comes again in three batches of one run, and then with no rows to keep
        put_rows(spark, tmp_path, f"g{k}", [("a: b/c", 1000 + k)])
    again = sorted([("a: b/c", 10 * (1000 + k)) for k in range(3)] + [(f"own {k}", 10 * k) for k in range(4)])
    assert run_of(spark, tmp_path) == again
    put_rows(spark, tmp_path, "h", [("a: b/c", -1), ("new", 7)])
    assert run_of(spark, tmp_path, lambda d: d.where("v > 0")) == sorted([("new", 7)] + [(f"own {k}", 10 * k) for k in range(4)])


@pytest.mark.parametrize("late", [False, True])
def test_a_run_stopped_between_batches_goes_on(spark, tmp_path, late):
    put_rows(spark, tmp_path, "old", [("a", 1), ("b", 2)])
    assert run_of(spark, tmp_path) == [("a", 10), ("b", 20)]
    for k in range(3):
        put_rows(spark, tmp_path, f"f{k}", [("a", 100 + k)])
    seen = []

    def stops(d):
        seen.append(1)
        if len(seen) == 2:
            if late:  # the batch writes, then fails: the next try must not double it
                d.selectExpr("source_id", "v * 10 AS v", "2 AS batch_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_id", "batch_id").parquet(str(tmp_path / "out"))
            raise RuntimeError("stopped")
        return d.selectExpr("source_id", "v * 10 AS v")

    with pytest.raises(Exception, match="stopped"):
        run_of(spark, tmp_path, stops)
    assert run_of(spark, tmp_path) == [("a", 1000), ("a", 1010), ("a", 1020), ("b", 20)]


def test_model_hooks(spark):
    df = spark.createDataFrame([([1.0, 3.0],), ([2.0, 2.0],)], "v array<float>")
    model = sinks.classifier(lambda: lambda x: x / x.sum(axis=1, keepdims=True), features=2)
    assert [r.p for r in df.select(model("v").alias("p")).collect()] == [[0.25, 0.75], [0.5, 0.5]]
    found = sinks.detector(spark.createDataFrame([("a",)], "path string"), lambda d: d.assign(label="car", score=0.5), "path string, label string, score double")
    assert found.first().label == "car"


def test_layouts_and_calibration(spark, tmp_path):
    points = spark.createDataFrame([("f", 0, True), ("f", 1, False), ("f", 2, True), ("g", 0, True), ("g", 1, False)], "frame_id string, row_idx bigint, is_primary boolean")
    labels = spark.createDataFrame([("f", 0, 7), ("f", 1, 8), ("g", 0, 5), ("g", 1, 6)], "frame_id string, row_idx bigint, label int")
    assert {tuple(r) for r in files.flat_labels(labels, points).collect()} == {("f", 0, 7), ("f", 2, 8), ("g", 0, 5)}
    found = spark.createDataFrame([("a_labels", "p1"), ("b", "p2"), ("b_manual", "p3")], "stem string, path string")
    frames = spark.createDataFrame([("a",), ("b",), ("c",)], "frame_id string")
    assert {tuple(r) for r in files.annotation_for_frames(frames, found).collect()} == {("a", "p1"), ("b", "p2"), ("c", None)}
    put(tmp_path / "k.json", json.dumps({"camera_matrix": [[1, 0, 2], [0, 1, 3], [0, 0, 1]], "T": [[1, 0, 0, 5], [0, 1, 0, 6], [0, 0, 1, 7]], "direction": "camera_to_lidar"}))
    k, t = files.calibration(spark, str(tmp_path / "k.json"))
    assert k[2] == 2 and [round(x, 9) for x in t[3::4]] == [-5, -6, -7, 1]


def test_yaml_sections(spark, tmp_path):
    put(tmp_path / "c.yaml", "stray: 1\n# note\nclasses:\n  Car: 2  # wide\n  'bus' : 3\n  groups_of:\n    - a b\n    - \"c\"\n  sky: [1, 2]\n    - lost\n\nother:\r\n  Car: x:y\n")
    got = sorted(((r.section, r.key, r.value, r.item) for r in files.yaml_sections(spark, str(tmp_path)).collect()), key=str)
    assert {(s, k): v for s, k, v, i in got if i is None} == {("classes", "Car"): "2", ("classes", "'bus'"): "3", ("classes", "sky"): "[1, 2]", ("other", "Car"): "x:y"}
    assert [(v, i) for s, k, v, i in got if i is not None] == [("a b", 0), ("c", 1)]


def test_flat_labels_never_broadcast_a_row_a_point(spark):
    from pointloom.plans.file_queries import src10

    df = src10(spark, "/root/testdata/sf0.001")
    assert df.count() == len(df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [frame_id" in plan and not [x for x in plan.splitlines() if "BroadcastHashJoin" in x and "place" in x]


def test_archives_leave_some_masks_at_a_time(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    masks = rng.random((11, 6, 9)) < 0.4
    np.savez_compressed(tmp_path / "7.npz", masks=masks, scores=np.arange(11) / 11, labels=np.array([f"c{k}" for k in range(11)]))
    monkeypatch.setattr(files, "MASKS", 4)
    got = files.detection_archives(spark, str(tmp_path)).collect()
    held = np.zeros_like(masks)
    for r in got:
        assert r.label == f"c{r.det_id}" and r.score == r.det_id / 11 and not held[r.det_id, r.v, r.u0 : r.u1].any()
        held[r.det_id, r.v, r.u0 : r.u1] = True
    assert (held == masks).all()


def test_packets_leave_some_records_at_a_time(spark, tmp_path, monkeypatch):
    records = np.zeros(1000, files.RECORD)
    records["distance"] = np.arange(1000)
    (tmp_path / "3.pkt").write_bytes(bytes(16) + records.tobytes() + b"cut")
    (tmp_path / "4.pkt").write_bytes(bytes(16))
    monkeypatch.setattr(files, "RECORDS", 300)
    got = sorted(files.packet_frames(spark, str(tmp_path)).collect(), key=lambda r: r.row_idx)
    assert [(r.row_idx, r.slot, r.pixel, r.block_id, r.distance) for r in got] == [(k, k // 384, k // 3 % 128, k % 3, float(k)) for k in range(1000)]


def test_frame_logs_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    from pointloom.plans import file_queries

    monkeypatch.setattr(file_queries, "work_path", lambda spark, name: str(tmp_path / name))
    want = spark.read.parquet("/root/testdata/sf0.01/supplier.parquet").where("s_suppkey % 5 <> 0").count()
    assert file_queries.src20(spark, "/root/testdata/sf0.01").count() == want
    assert len({p.name.split("-")[1] for p in (tmp_path / "logs").glob("part-*")}) > 4
