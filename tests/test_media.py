"""Frames, workers, files there and back, the flow and the command line."""

import io
import json
import tarfile

import numpy as np
import pytest

from reelmill import cli
from reelmill.functions import workers
from reelmill.operators import frames, gates, manifest, shards, statistics
from reelmill.plans.flow import Flow, Stage
from reelmill.sources import readers, writers


def film(n, h=6, w=8, seed=0):
    out = io.BytesIO()
    np.save(out, np.random.default_rng(seed).integers(0, 256, (n, h, w, 3), dtype=np.uint8))
    return out.getvalue()


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame([("a/x.mp4", film(20)), ("a/y.mp4", film(1)), ("b/z.mp4", b"no film"), ("b/n.mp4", None)], "path string, content binary")


def test_decoding(files):
    got, name = frames.decoded(film(20), max_frames=7)
    assert len(got) == 7 and name == "npy" and got[0].shape == (6, 8, 3)
    with pytest.raises(ValueError):
        frames.decoded(b"no film")
    rows = frames.frames_of(files, max_frames=18, batch=16).collect()
    assert sorted((r["path"], r["frame_idx"], r["batch"]) for r in rows) == sorted([("a/x.mp4", i, i // 16) for i in range(18)] + [("a/y.mp4", 0, 0)])


def test_pixels():
    a, b = (np.random.default_rng(k).integers(0, 256, (5, 7), dtype=np.uint8) for k in (1, 2))
    assert frames.ssim(a, a) == 1 and 0 <= frames.ssim(a, b) < 1
    assert frames.grey(np.array([[10, 20, 30]], dtype=np.uint8)).tolist() == [18]
    x = np.random.default_rng(3).integers(0, 256, (2, 9, 6, 3), dtype=np.uint8)
    got = frames.resized(x, 4, 11)
    assert got.shape == (2, 3, 4, 11) and got.min() >= -1 and got.max() <= 1
    assert np.allclose(frames.resized(x, 9, 6), x.transpose(0, 3, 1, 2) / 127.5 - 1)
    assert np.allclose(frames.resized(np.full((1, 5, 5, 3), 51, np.uint8), 3, 8), 51 / 127.5 - 1)

    def weight(size, to, i, j):  # one weight by its definition
        step = size / to
        tri = lambda k: max(0.0, 1 - abs(k + 0.5 - (i + 0.5) * step) / max(step, 1))
        return tri(j) / sum(map(tri, range(size)))

    want = sum(weight(9, 4, 1, i) * weight(6, 11, 5, j) * x[1, i, j, 2] for i in range(9) for j in range(6)) / 127.5 - 1
    assert abs(got[1, 2, 1, 5] - want) < 1e-9
    latent = np.arange(2 * 4 * 3 * 3, dtype=float).reshape(2, 4, 3, 3)
    shape, data = frames.packed_latent(latent)
    assert shape == [4, 2, 3, 3] and np.array_equal(frames.unpacked_latent(shape, data), latent.transpose(1, 0, 2, 3))


def test_workers(files):
    light = lambda x: x.reshape(len(x), -1)[:, :4] / 255.0
    run = lambda load, schema, **kw: {r["path"]: r for r in workers.run_worker(files, load, schema, **kw).collect()}
    got = run(lambda: workers.EmbedWorker(light), workers.EmbedWorker.schema)
    assert got["a/x.mp4"]["status"] == "ok" and len(got["a/x.mp4"]["frame_embeddings"]) == 8 and len(got["a/y.mp4"]["frame_embeddings"]) == 1
    assert abs(np.linalg.norm(got["a/x.mp4"]["mean_embedding"]) - 1) < 1e-5
    assert got["b/z.mp4"]["status"].startswith("failed: ") and got["b/n.mp4"]["status"].startswith("failed: ") and got["b/z.mp4"]["mean_embedding"] is None
    got = run(lambda: workers.ScoreWorker(lambda x: x.mean((1, 2, 3))), workers.ScoreWorker.schema, zeros={"mean_score": 0.0, "frame_scores": []})
    assert got["a/x.mp4"]["mean_score"] == pytest.approx(np.mean(got["a/x.mp4"]["frame_scores"]), abs=1e-3) and got["b/z.mp4"]["mean_score"] == 0
    change = lambda a, b: float(np.abs(a.astype(int) - b).mean())
    got = run(lambda: workers.MotionWorker(change), workers.MotionWorker.schema, zeros={"motion_score": 0.0})
    assert got["a/y.mp4"]["status"] == "failed: too few frames" and got["a/y.mp4"]["motion_score"] == 0
    every = [frames.grey(f) for f in frames.decoded(film(20))[0]]
    at = frames.sample_places(20, 17)
    flows = [change(every[i], every[j]) for i, j in zip(at, at[1:], strict=False)]
    assert len(flows) == 16 and got["a/x.mp4"]["flow_magnitude"] == round(float(np.mean(flows)), 4) and got["a/x.mp4"]["flow_variance"] == round(float(np.var(flows)), 4)
    no_flow = run(lambda: workers.MotionWorker(), workers.MotionWorker.schema)
    assert no_flow["a/x.mp4"]["status"].startswith(("failed: No module", "ok"))
    got = run(lambda: workers.CaptionWorker(lambda x: f" {len(x)} frames "), workers.CaptionWorker.schema)
    assert got["a/x.mp4"]["caption"] == "8 frames"
    got = run(lambda: workers.LatentWorker(lambda x: x[:, :1], height=4, width=4), workers.LatentWorker.schema)
    assert got["a/y.mp4"]["shape"] == [1, 16, 4, 4] and len(got["a/y.mp4"]["data"]) == 16 * 16 * 2
    query = workers.encode_query(lambda t: np.array([[3.0, 4.0]]), "a query")
    assert np.allclose(query, [0.6, 0.8])
    row = workers.profile(workers.run_worker(files, lambda: workers.EmbedWorker(light), workers.EmbedWorker.schema)).first()
    assert row["clips"] == 4 and row["ok"] == 2 and row["longest_s"] <= row["seconds"] + 1e-3


def test_text_worker(spark):
    rows = spark.createDataFrame([("p", "words"), ("q", None)], "path string, caption string")
    got = {r["path"]: r for r in workers.run_worker(rows, lambda: workers.TextWorker(lambda t: np.array([[float(len(t[0])), 0.0]])), workers.TextWorker.schema).collect()}
    assert np.allclose(got["p"]["text_embedding"], [1, 0]) and got["q"]["status"].startswith("failed")


def test_results_cache(spark, tmp_path):
    path, schema = f"file://{tmp_path}/results", "path string, status string, caption string, time_s double"
    rows = spark.createDataFrame([("a", "ok", "x", 0.1), ("b", "failed: y", None, 0.1)], schema)
    assert writers.cached_results(spark, path, schema).count() == 0
    writers.append_results(rows, path)
    writers.append_results(rows, path)
    known = writers.cached_results(spark, path, schema)
    assert [r["path"] for r in known.collect()] == ["a"]
    assert [r["path"] for r in gates.not_cached(rows.select("path"), known).collect()] == ["b"]


def test_archives(spark, tmp_path):
    with tarfile.open(tmp_path / "part.tar.gz", "w:gz") as tar:
        for name, data in (("in/yt_1_000_010.mp4", b"1"), ("in/yt_2_000_010.mp4", b"22"), ("in/note.txt", b"x")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    (tmp_path / "bad.tar.gz").write_bytes(b"damaged")
    tars = spark.read.format("binaryFile").load(f"file://{tmp_path}/*.tar.gz")
    lookup = spark.createDataFrame([("yt_1", "dancing")], "yt_id string, label string")
    found = shards.labelled_clips(tars, lookup)
    assert {(r["name"], r["label"], bytes(r["data"])) for r in found.collect()} == {("yt_1_000_010.mp4", "dancing", b"1"), ("yt_2_000_010.mp4", "unknown", b"22")}
    writers.write_by_label(found, f"file://{tmp_path}/out")
    assert spark.read.parquet(f"file://{tmp_path}/out").where("label = 'unknown'").count() == 1
    (tmp_path / "urls.txt").write_text(" http://h/p/part_1.tar.gz \n\n  \nhttp://h/p/part_2.tar.gz\n")
    assert [r["url"] for r in readers.url_list(spark, f"file://{tmp_path}/urls.txt").limit(1).collect()] == ["http://h/p/part_1.tar.gz"]


def test_shards_are_written_once(spark, tmp_path):
    rows = shards.assigned(spark.createDataFrame([(f"p{i}", b"x" * i) for i in range(7)], "path string, content binary"), 3)
    folder = f"file://{tmp_path}/tars"
    first = sorted(map(tuple, shards.write_tars(rows, folder, {"mp4": "content"}).collect()))
    assert sorted(map(tuple, shards.write_tars(rows, folder, {"mp4": "content"}).collect())) == first
    assert sorted(p.name for p in (tmp_path / "tars").iterdir() if not p.name.endswith(".crc")) == [f"shard_{i:05d}.tar" for i in range(3)]
    row = shards.shard_stats(spark.read.format("binaryFile").load(folder)).first()
    assert [f["samples"] for f in row["files"]] == [3, 3, 1] and row["total_bytes"] == 3 * 10240


def test_latent_files(spark, tmp_path):
    shape, data = frames.packed_latent(np.ones((2, 4, 1, 1)))
    writers.write_latents(spark.createDataFrame([("s", shape, data)], "stem string, shape array<int>, data binary"), f"file://{tmp_path}/l").collect()
    assert np.load(tmp_path / "l" / "s.npy").shape == (4, 2, 1, 1)


def test_principal_points(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(50, 5)) * np.array([9, 4, 1, 1, 1]) + 3
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(99, None)], "id long, v array<double>")
    got = np.array([(r["x"], r["y"]) for r in statistics.principal_points(rows, "id", "v", 40).orderBy("id").collect()])
    c = v[:40] - v[:40].mean(0)
    u, s, _ = np.linalg.svd(c, full_matrices=False)
    assert got.shape == (40, 2) and np.allclose(np.abs(got), np.abs(u[:, :2] * s[:2]))
    share = [r["share"] for r in statistics.principal_shares(rows.where("v is not null"), "v").orderBy("component").collect()]
    every = np.linalg.svd(v - v.mean(0), compute_uv=False) ** 2
    assert np.allclose(share, (every / every.sum())[:2])


def test_statistics(spark):
    none = spark.createDataFrame([], "path string, label string")
    assert statistics.class_totals(none).first().asDict() == {"n_classes": 0, "total_clips": 0} and statistics.top_labels(none).count() == 0
    rows = spark.createDataFrame([("b/y", "b"), ("a-b/x", "a-b"), ("a/z", "a"), ("b/x", None)], "path string, label string")
    assert [r["path"] for r in statistics.first_paths(rows, 3).collect()] == ["a-b/x", "a/z", "b/x"]
    assert statistics.class_totals(rows).first().asDict() == {"n_classes": 3, "total_clips": 4}
    assert statistics.top_labels(rows, 1).count() == 1


def test_flow(spark, tmp_path):
    ran, fails = [], {"score": 1}

    def step(name, *needs):
        def run(tables):
            ran.append(name)
            assert set(needs) <= set(tables)
            if fails.get(name, 0):
                fails[name] -= 1
                raise RuntimeError(name)
            return spark.range(3)

        return run

    steps = {Stage.INGEST: step("ingest"), Stage.SCORE: step("score", "ingest"), Stage.MOTION: step("motion", "score"), Stage.MANIFEST: step("manifest", "score")}
    flow = Flow(spark, f"file://{tmp_path}", steps)
    assert set(flow.run(no_v2=True)) == {"ingest", "score", "manifest"} and ran == ["ingest", "score", "score", "manifest"]
    assert {(r["stage"], r["status"], r["tries"]) for r in flow.metric_rows().collect()} == {("ingest", "ok", 1), ("score", "ok", 2), ("manifest", "ok", 1)}
    ran.clear()
    assert len(flow.run(from_stage=Stage.MOTION)) == 4 and ran == ["motion", "manifest"]
    fails["manifest"] = 9
    with pytest.raises(RuntimeError):
        flow.run(from_stage=Stage.MANIFEST)
    assert flow.metrics[-1][:3] == ("manifest", "failed", 1)


def test_manifest_files(spark, tmp_path, capsys):
    flat = spark.createDataFrame([("v1", 10, 8, 2, 7, 5, 4.7)], "version string, total_videos long, dedup_kept long, dedup_removed long, score_scored long, score_passing long, score_mean double")
    tars = spark.createDataFrame([], "path string, length long")
    for version, t in (("v1", 4.5), ("v2", 5.0)):
        row = manifest.document(flat.replace("v1", version, ["version"]), shards.shard_stats(tars), "2024-01-02T03:04:05.6+00:00", "raw", {}, {"min_score": t})
        writers.write_object(row, f"file://{tmp_path}/m/{version}.json")
    found = json.loads((tmp_path / "m" / "v1.json").read_text())
    assert found["scoring"] == {"scored": 7, "passing": 5, "mean": 4.7, "min_score_threshold": 4.5} and found["motion"] is None
    assert found["shards"] == {"count": 0, "total_samples": 0, "total_bytes": 0, "total_mb": 0.0, "files": []}
    lines = cli.main(["list", f"file://{tmp_path}/m"], spark)
    assert lines[1].split() == ["v1", "2024-01-02T03:04:05", "10", "8", "0", "0.0"] and len(lines) == 3
    lines = cli.main(["diff", f"file://{tmp_path}/m/v1.json", f"file://{tmp_path}/m/v2.json"], spark)
    assert any(x.split()[:3] == ["min_score", "4.5", "5.0"] and "+0.5" in x for x in lines) and any(x.split()[:3] == ["motion_passing", "?", "?"] for x in lines)


def test_filter_and_stats_objects(spark):
    rows = spark.createDataFrame([("b", 0.5, True), ("a", 0.5, True), ("c", 0.1, False)], "path string, similarity double, kept boolean")
    row = writers.filter_result(rows, "q", 0.2, False).first()
    assert [k["path"] for k in row["kept"]] == ["a", "b"] and row["removed"] == ["c"] and row["total"] == 3
    empty = writers.filter_result(rows.limit(0), "q", 0.2, False).first()
    assert empty["total"] == 0 and empty["kept"] == [] and empty["removed"] == []
    clips = spark.createDataFrame([], "path string, label string")
    got = writers.stats_object(statistics.label_distribution(clips), statistics.class_totals(clips), statistics.rare_labels(clips)).first()
    assert got["label_distribution"] == {} and got["underrepresented_classes"] == []
