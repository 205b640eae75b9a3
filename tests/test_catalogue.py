"""Golden values from the published formulas, edge rows of gates and dedup, and files there and back."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelmill.functions import expressions as X
from reelmill.functions.models import HashedText, apply_model
from reelmill.operators import dedup, filtering, gates, manifest, shards, statistics
from reelmill.sources import readers


def value(spark, column, **fields):
    rows = spark.createDataFrame([tuple(fields.values())], list(fields)) if fields else spark.range(1)
    return rows.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("m,v,s,want", [(5, 0, 1, 10), (0, 0, 1, 8.8196), (7.07, 0, 0.588, 7.6936), (20, 30, 0.3, 1.6329), (5, 0, 0, 5), (3, 10, 0.9, 8.0051), (0, 1000, 0, 1.8196)])
def test_motion_score(spark, m, v, s, want):
    assert round(value(spark, X.motion_score("m", "v", "s"), m=float(m), v=float(v), s=float(s)), 4) == want


@pytest.mark.parametrize("a,n,c,want", [(0.319, 27, 0.622, 0.7396), (0.10, 0, 0, 0), (0.40, 30, 1, 1), (0.25, 4, 0.5, 0.48), (0.25, 5, 0.5, 0.5), (0.25, 31, 0.5, 0.5967), (0.25, 90, 0.5, 0.4), (0.05, 20, 0.8, 0.4), (0.9, 60, 0.2, 0.66)])
def test_quality_score(spark, a, n, c, want):
    assert round(value(spark, X.quality_score("a", "n", "c"), a=float(a), n=n, c=float(c)), 4) == want


@pytest.mark.parametrize("text,want", [("", 0), ("a the is", 0), ("A man, is doing ... something!", 4 / 6), ("  lead and trail  ", 2 / 3)])
def test_specificity(spark, text, want):
    assert math.isclose(value(spark, X.specificity("t"), t=text), want)


@pytest.mark.parametrize("m1,m2,v1,v2,cov,want", [(100, 100, 50, 50, 50, 1), (100, 50, 50, 50, 0, 0.295378), (100, 100, 400, 400, -400, 0), (0, 255, 0, 0, 0, 0.0001)])
def test_global_ssim(spark, m1, m2, v1, v2, cov, want):
    got = value(spark, X.global_ssim(*map(F.col, "abcde")), a=float(m1), b=float(m2), c=float(v1), d=float(v2), e=float(cov))
    assert abs(got - want) < 1e-6


@pytest.mark.parametrize("n,k,repeat,want", [(1, 8, False, [0]), (5, 8, False, [0, 1, 2, 3, 4]), (10, 8, False, [0, 1, 2, 3, 5, 6, 7, 9]), (64, 8, False, [0, 9, 18, 27, 36, 45, 54, 63]), (64, 9, False, [0, 7, 15, 23, 31, 39, 47, 55, 63]), (5, 16, True, [0, 0, 0, 0, 1, 1, 1, 1, 2, 2, 2, 2, 3, 3, 3, 4]), (0, 8, False, []), (9, 1, False, [0])])
def test_frame_sample(spark, n, k, repeat, want):
    assert value(spark, X.sample_indices("n", k, repeat), n=n) == want


def test_names_and_text(spark):
    assert value(spark, X.clip_id("n"), n="abc_x_000010_000020") == "abc_x"
    assert value(spark, X.clip_id("n"), n="noparts.mp4") == "noparts.mp4"
    assert value(spark, X.stem("p"), p="a/b/c.d.mp4") == "c.d"
    assert value(spark, X.parent_label("p"), p="a/b/c.mp4") == "b" and value(spark, X.parent_label("p"), p="c.mp4") is None
    assert value(spark, X.delta_text("a", "b"), a=5833.7, b=4104.9) == "(Δ -1728.8)"
    assert value(spark, X.delta_text("a", "b"), a=10000.0, b=10000.0) == "(Δ +0.0)"
    assert value(spark, X.shard_key("s", "p"), s=2, p=0) == "00002_0000"
    assert [value(spark, X.bin_of("x", F.lit(0.0), F.lit(1.0)), x=x) for x in (0.0, 0.5, 1.0)] == [1, 21, 40]
    assert value(spark, X.status_class("s"), s="failed: x") == "failed"


def test_folded_layers(spark):
    rng = np.random.default_rng(0)
    layers = [(rng.normal(size=(4, 3)), rng.normal(size=4)), (rng.normal(size=(1, 4)), rng.normal(size=1))]
    w, b = X.fold_layers(layers)
    x = rng.normal(size=3)
    want = (layers[1][0] @ (layers[0][0] @ x + layers[0][1]) + layers[1][1])[0]
    assert math.isclose(value(spark, X.affine_head("v", w, b), v=x.tolist()), want)


def test_gates_in_order(spark):
    nan = float("nan")
    clips = spark.createDataFrame([(f"p{i}", "s") for i in range(8)], "path string, source string")
    scores = spark.createDataFrame([("p0", "ok", 4.5), ("p1", "failed: x", 0.0), ("p2", "ok", nan), ("p4", "ok", 9.0), ("p5", "ok", 9.0), ("p6", "ok", 9.0), ("p7", "ok", 9.0)], "path string, status string, mean_score double")
    motion = spark.createDataFrame([(p, "ok", 5.0) for p in ("p0", "p5", "p6", "p7")], "path string, status string, motion_score double")
    quality = spark.createDataFrame([(p, "ok", q, 0.3, 9) for p, q in (("p0", 0.65), ("p5", 0.1), ("p6", 0.9), ("p7", 0.9))], "path string, status string, quality_score double, clip_alignment double, caption_length int")
    captions = spark.createDataFrame([("p0", "ok", "a"), ("p6", "ok", ""), ("p7", "ok", "b")], "path string, status string, caption string")
    got = {r["path"]: r["gate"] for r in gates.gated(clips, scores, captions, motion, quality).collect()}
    assert got == {"p0": "pass", "p1": "score", "p2": "score", "p3": "score", "p4": "motion", "p5": "quality", "p6": "caption", "p7": "pass"}
    off = {r["path"]: r["gate"] for r in gates.gated(clips, scores, captions).collect()}
    assert off["p4"] == "caption" and off["p5"] == "caption"
    row = gates.composition(gates.gated(clips, scores, captions, motion, quality)).first()
    assert sum(row[c] for c in row.asDict() if c != "source") == 8
    nothing = gates.passing(scores, "mean_score", 99.0)
    assert gates.passing_all(clips, nothing).count() == 0 and gates.passing_all(clips, None).count() == 8
    assert gates.kept_only(clips, nothing).count() == 8 and gates.kept_only(clips, nothing, empty_keeps_all=False).count() == 0


def test_exact_dedup(spark):
    clips = spark.createDataFrame([("b/x", b"1"), ("a/x", b"1"), ("c/x", b"1"), ("d/x", b""), ("e/x", None)], "path string, content binary")
    got = {r["path"]: r["kept"] for r in dedup.exact_dedup(clips).collect()}
    assert got == {"a/x": True, "b/x": False, "c/x": False, "d/x": True, "e/x": True}
    stale = spark.createDataFrame([("a/x", "other"), ("gone", "other")], "path string, md5 string")
    got = {r["path"]: r["kept"] for r in dedup.exact_dedup(clips, stale).collect()}
    assert got["a/x"] and got["b/x"] and "gone" not in got


def plain_components(n, pairs):
    up = list(range(n))
    for a, b in pairs * n:
        up[a] = up[b] = min(up[a], up[b])
    return up


@pytest.mark.parametrize("block", [7, 1024])
def test_near_dedup(spark, block):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(60, 8))
    v[10:20] = v[9] + 0.05 * rng.normal(size=(10, 8))
    v[59] = 0
    rows = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    u = v / (np.linalg.norm(v, axis=1, keepdims=True) + 1e-8)
    sims = u @ u.T
    want = {(a, b) for a in range(60) for b in range(a + 1, 60) if sims[a, b] >= 0.9}
    found = dedup.neighbours(rows, 0.9, block=block).where("id < other")
    assert {(r["id"], r["other"]) for r in found.collect()} == want
    got = {r["id"]: r["component"] for r in dedup.components(rows, dedup.near_pairs(rows, 0.9)).collect()}
    assert [got[i] for i in range(60)] == plain_components(60, sorted(want))


def test_neighbour_limit(spark):
    rows = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(60)], "id long, v array<double>")
    found = dedup.neighbours(rows, 0.95)
    assert found.count() == 60 * 50 and found.agg(F.max("other")).first()[0] == 49
    assert dedup.near_dedup(rows, 0.95).where("kept").count() == 1


def test_filter(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0]), (4, [0.0, 0.0])], "id long, v array<double>")
    kept = filtering.semantic_filter(rows, [1.0, 0.0], 0.2)
    assert [r["id"] for r in filtering.best(kept, 5).collect()] == [1, 3]
    other = filtering.semantic_filter(rows, [1.0, 0.0], 0.2, invert=True)
    assert {r["id"] for r in other.where("kept").collect()} == {2, 4}
    assert filtering.filter_summary(kept.limit(0)).first()["total"] == 0


def test_statistics(spark):
    empty = spark.createDataFrame([], "path string, status string, mean_score double")
    assert statistics.score_summary(empty).count() == 0
    assert manifest.signal(empty, "mean_score", 4.5, "x").first().asDict() == {"x_scored": 0, "x_passing": 0, "x_mean": 0.0}
    clips = spark.createDataFrame([("a",)] * 10 + [("b",)] * 9, "label string")
    assert [r["label"] for r in statistics.rare_labels(clips).collect()] == ["b"]


@pytest.mark.parametrize("n", [0, 4, 5])
def test_shards(spark, n, tmp_path):
    rows = spark.createDataFrame([(f"p{i:03d}", f"x{i}".encode(), None if i else "t") for i in range(n)], "path string, content binary, note string")
    made = shards.assigned(rows, 2)
    keys = sorted(r["key"] for r in made.collect())
    assert keys == [f"{i // 2:05d}_{i % 2:04d}" for i in range(n)]
    folder = f"file://{tmp_path}/tars"
    assert sum(r["samples"] for r in shards.write_tars(made, folder, {"mp4": "content", "txt": "note"}).collect()) == n
    if n:
        (tmp_path / "tars" / "shard_99999.tar").write_bytes(b"damaged")
        files = spark.read.format("binaryFile").load(folder)
        names = {(r["name"], bytes(r["data"])) for r in shards.tar_members(files, ".mp4").collect()}
        assert names == {(f"{k}.mp4", f"x{i}".encode()) for i, k in enumerate(keys)}
        assert shards.shard_stats(files).first()["total_samples"] == n


def test_sources(spark, tmp_path):
    (tmp_path / "l.csv").write_text("dancing ballet,id1,0,10\nshort\nold,id2,0,1\nnew,id2,0,1\n")
    found = {r["yt_id"]: r["label"] for r in readers.label_lookup(spark, f"file://{tmp_path}/l.csv").collect()}
    assert found == {"id1": "dancing_ballet", "id2": "new"}
    np.savez(tmp_path / "a.npz", mean_embedding=np.ones(3, "f4"), frame_embeddings=np.ones((2, 3), "f4"), video_path=np.array(["v/a.mp4"]))
    assert readers.npz_vectors(spark, f"file://{tmp_path}").first()["path"] == "v/a.mp4"
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        readers.npz_vectors(spark, f"file://{tmp_path}/none")
    rows = spark.createDataFrame([("p", "ok", "c", 1.0)], readers.CAPTIONS)
    readers.write_records(rows, f"file://{tmp_path}/c.json")
    assert readers.records(spark, f"file://{tmp_path}/c.json", readers.CAPTIONS).collect() == rows.collect()
    (tmp_path / "d.json").write_text('{"kept": ["a"], "removed": ["b"], "exact_removed": [], "threshold": 0.95, "total": 2}')
    assert readers.dedup_decisions(spark, f"file://{tmp_path}/d.json").count() == 2


def test_models_and_cache(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", None)], "path string, text string")
    got = {r["path"]: r["status"] for r in apply_model(rows.repartition(2, "path"), HashedText, "path string, status string, embedding array<double>").collect()}
    assert got["b"].startswith("failed") and (got["a"] == "ok" or got["a"].startswith("failed"))
    results = spark.createDataFrame([("a", "ok"), ("b", "failed: x")], "path string, status string")
    assert [r["path"] for r in gates.not_cached(rows, results).collect()] == ["b"]


def test_stream(spark, tmp_path):
    from reelmill.streaming.ingest import ingest_new

    (tmp_path / "in" / "a").mkdir(parents=True)
    (tmp_path / "in" / "a" / "x.mp4").write_bytes(b"1")
    for want in (1, 2):
        ingest_new(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out", f"file://{tmp_path}/ck").awaitTermination()
        assert spark.read.parquet(f"file://{tmp_path}/out").count() == want
        (tmp_path / "in" / "a" / "y.mp4").write_bytes(b"2")
        (tmp_path / "in" / "a" / "z.mp4").write_bytes(b"1")


def test_components_that_do_not_settle_are_an_error(spark):
    nodes, pairs = spark.range(1, 10), spark.createDataFrame([(i, i + 1) for i in range(1, 9)], "a long, b long")
    with pytest.raises(RuntimeError):
        dedup.components(nodes, pairs, max_rounds=1)
    assert {r["component"] for r in dedup.components(nodes, pairs).collect()} == {1}
