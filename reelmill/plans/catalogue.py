"""The registered queries over the clip catalogue, and the same in SQL.

There are no media files among the inputs, so these tables stand in: documents are clips (path from source and id, the
text as content), their first sentence is the caption, embeddings of the same id are clip vectors, labels say whether
scoring worked, and a user's events are the frame pairs of a clip.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmill.functions import expressions as X
from reelmill import cli
from reelmill.operators import dedup, filtering, frames, gates, manifest, shards, statistics, tables
from reelmill.operators.tables import shared_dir
from reelmill.plans import flow
from reelmill.sources import readers, writers

NEAR, MOTION_GATE, SHARD_SIZE, SIM = 0.42, 5.7, 50, 0.1
QUERY = [((7 * i) % 5 - 2) / 10 for i in range(64)]
HEAD = [1.0] * 64


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _path(source: str = "source", doc_id: str = "doc_id"):
    return F.concat(F.lit("raw_videos/"), source, F.lit("/"), F.col(doc_id).cast("string"), F.lit(".mp4"))


def clips(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", _path().alias("path"), F.col("source").alias("label"), "source", F.col("text").alias("content"))


def vectors(spark, sf):
    return _t(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))


def captions(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", _path().alias("path"), F.lit("ok").alias("status"), F.split_part("text", F.lit("."), F.lit(1)).alias("caption"))


def scores(spark, sf):
    """ok where a label and a vector are there; a failed row has 0."""
    docs, labels = _t(spark, sf, "documents"), _t(spark, sf, "labels").select("doc_id", "quality")
    rows = docs.select("doc_id", _path().alias("path")).join(labels, "doc_id", "left").join(vectors(spark, sf), F.col("doc_id") == F.col("id"), "left")
    ok = F.col("quality").isNotNull() & F.col("v").isNotNull()
    return rows.select("path", F.when(ok, "ok").otherwise("failed: no score").alias("status"), F.when(ok, F.round(X.affine_head("v", HEAD, 5.0), 4)).otherwise(0.0).alias("mean_score"))


def frame_pairs(spark, sf):
    pairs = statistics.motion_pairs(_t(spark, sf, "events").select("user_id", "ts", "event_id", "value"), "user_id", ["ts", "event_id"], "value")
    return pairs.select("user_id", "event_id", (F.col("value") / 10).alias("flow"), F.exp(-F.abs(F.col("value") - F.col("before")) / 50.0).alias("ssim"))


def motion(spark, sf):
    found = statistics.motion_scores(frame_pairs(spark, sf), "user_id")
    return found.join(_t(spark, sf, "documents").select(F.col("doc_id").alias("user_id"), _path().alias("path")), "user_id")


def caption_quality(spark, sf):
    rows = captions(spark, sf).join(vectors(spark, sf), F.col("doc_id") == F.col("id"), "left")
    has = F.col("v").isNotNull()
    aligned = F.when(has, X.dot("v", F.array(*[F.lit(q) for q in QUERY]))).otherwise(0.0)
    n, content = X.token_count("caption"), X.specificity("caption")
    return rows.select(
        "path", F.when(has, "ok").otherwise("failed: no embedding").alias("status"), F.round(aligned, 4).alias("clip_alignment"),
        F.when(has, n).otherwise(0).alias("caption_length"), F.when(has, F.round(content, 4)).otherwise(0.0).alias("specificity_score"),
        F.when(has, F.round(X.quality_score(aligned, n, content), 4)).otherwise(0.0).alias("quality_score"),
    )


_STOP = ", ".join(f"'{w}'" for w in X.STOPWORDS)
_Q = "[" + ", ".join(map(str, QUERY)) + "]::DOUBLE[]"
_TOKENS = r"list_filter(string_split_regex(caption, '\s+'), lambda t: t <> '')"
_N = "greatest(n, 1)"
CTE = rf"""
WITH RECURSIVE clips AS (SELECT doc_id, 'raw_videos/' || source || '/' || doc_id || '.mp4' AS path, source AS label, source, text AS content FROM documents),
vectors AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
units AS (SELECT id, list_transform(v, lambda x: x / (sqrt(list_dot_product(v, v)) + 1e-8)) AS u FROM vectors),
captions AS (SELECT doc_id, path, 'ok' AS status, split_part(content, '.', 1) AS caption FROM clips),
scores AS (SELECT path, CASE WHEN quality IS NOT NULL AND v IS NOT NULL THEN 'ok' ELSE 'failed: no score' END AS status,
  CASE WHEN quality IS NOT NULL AND v IS NOT NULL THEN round(list_sum(v) + 5.0, 4) ELSE 0.0 END AS mean_score
  FROM clips LEFT JOIN labels USING (doc_id) LEFT JOIN vectors ON doc_id = id),
lagged AS (SELECT user_id, event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events),
frame_pairs AS (SELECT user_id, event_id, value / 10 AS flow, exp(-abs(value - before) / 50.0) AS ssim FROM lagged WHERE before IS NOT NULL),
moments AS (SELECT user_id, avg(flow) AS m, var_pop(flow) AS v, avg(ssim) AS s FROM frame_pairs GROUP BY user_id),
motion AS (SELECT user_id, 'ok' AS status, round(m, 4) AS flow_magnitude, round(v, 4) AS flow_variance, round(s, 4) AS ssim_mean,
  round(greatest(0.0, least(10.0, 5.0 * s + 3.0 * exp(-pow(m - 5.0, 2) / 50.0) + 2.0 * exp(-v / 10.0))), 4) AS motion_score, path
  FROM moments JOIN clips ON doc_id = user_id),
counted AS (SELECT path, caption, v, len({_TOKENS}) AS n, list_dot_product(v, {_Q}) AS a,
  coalesce(len(list_filter({_TOKENS}, lambda t: trim(lower(t), '.,!?;:"''') NOT IN ({_STOP}))) / nullif(len({_TOKENS}), 0)::DOUBLE, 0.0) AS spec
  FROM captions LEFT JOIN vectors ON doc_id = id),
length_scored AS (SELECT *, CASE WHEN n < 5 THEN n / 5.0::DOUBLE * 0.5::DOUBLE WHEN n <= 30 THEN 0.5::DOUBLE + (n - 5) / 50.0::DOUBLE ELSE greatest(0.0::DOUBLE, 1.0::DOUBLE - (n - 30) / 60.0::DOUBLE) END AS ls FROM counted),
caption_quality AS (SELECT path, CASE WHEN v IS NULL THEN 'failed: no embedding' ELSE 'ok' END AS status,
  CASE WHEN v IS NULL THEN 0.0 ELSE round(a, 4) END AS clip_alignment, CASE WHEN v IS NULL THEN 0 ELSE n END::INT AS caption_length,
  CASE WHEN v IS NULL THEN 0.0 ELSE round(spec, 4) END AS specificity_score,
  CASE WHEN v IS NULL THEN 0.0 ELSE round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.5::DOUBLE * greatest(0.0::DOUBLE, least(1.0::DOUBLE, (a - 0.1::DOUBLE) / 0.3::DOUBLE)) + 0.3::DOUBLE * spec + 0.2::DOUBLE * ls)), 4) END AS quality_score
  FROM length_scored),
exact AS (SELECT path, md5(content) AS md5, path = min(path) OVER (PARTITION BY md5(content)) AS kept FROM clips),
gated AS (SELECT c.*, CASE WHEN NOT coalesce(mean_score, 0.0) >= 4.5 THEN 'score' WHEN NOT coalesce(motion_score >= {MOTION_GATE}, false) THEN 'motion'
  WHEN NOT coalesce(quality_score >= 0.65, false) THEN 'quality' WHEN coalesce(caption, '') = '' THEN 'caption' ELSE 'pass' END AS gate,
  mean_score, motion_score, quality_score, clip_alignment, caption_length
  FROM clips c LEFT JOIN scores USING (path) LEFT JOIN motion USING (path) LEFT JOIN caption_quality q USING (path) LEFT JOIN captions USING (path)),
filtered AS (SELECT id, round(s, 4) AS similarity, s >= {SIM} AS kept FROM (SELECT id, list_dot_product(u, list_transform({_Q}, lambda x: x / (sqrt(list_dot_product({_Q}, {_Q})) + 1e-8))) AS s FROM units)),
sims AS (SELECT a.id, b.id AS other, list_dot_product(a.u, b.u) AS sim FROM units a, units b),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sim DESC, other) AS r FROM sims),
pairs AS (SELECT least(id, other) AS a, greatest(id, other) AS b, max(sim) AS sim FROM ranked WHERE r <= 50 AND id <> other AND sim >= {NEAR} GROUP BY ALL),
edges AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(x, y) AS (SELECT a, b FROM edges UNION SELECT r.x, e.b FROM reach r JOIN edges e ON r.y = e.a),
near AS (SELECT id, coalesce(least(id, m), id) AS component FROM vectors LEFT JOIN (SELECT x, min(y) AS m FROM reach GROUP BY x) ON id = x),
sampled AS (SELECT doc_id, n_chars % 70 AS n FROM documents),
own AS (SELECT id, u FROM units JOIN clips ON doc_id = id JOIN exact USING (path) WHERE kept),
own_ranked AS (SELECT a.id, b.id AS other, list_dot_product(a.u, b.u) AS sim, row_number() OVER (PARTITION BY a.id ORDER BY list_dot_product(a.u, b.u) DESC, b.id) AS r FROM own a, own b),
own_edges AS (SELECT id AS a, other AS b FROM own_ranked WHERE r <= 50 AND id <> other AND sim >= {NEAR} UNION SELECT other, id FROM own_ranked WHERE r <= 50 AND id <> other AND sim >= {NEAR}),
own_reach(x, y) AS (SELECT a, b FROM own_edges UNION SELECT r.x, e.b FROM own_reach r JOIN own_edges e ON r.y = e.a)
"""
_GATES = {"min_motion": MOTION_GATE}


def _gated(s, f):
    return gates.gated(clips(s, f), scores(s, f), captions(s, f), motion(s, f), caption_quality(s, f), **_GATES)


def _signals(s, f):
    ok = F.col("status") == "ok"
    return caption_quality(s, f).where(ok)


def _stats(*names: tuple[str, str]) -> str:
    return ", ".join(f"round({fn}({c}), 3) AS {out}" for out, fn, c in names)


def _score_sql(table: str, col: str, t: float, prefix: str) -> str:
    return f"(SELECT count(*) AS {prefix}_scored, count(*) FILTER ({col} >= {t}) AS {prefix}_passing, round(coalesce(avg({col}), 0.0), 3) AS {prefix}_mean FROM {table} WHERE status = 'ok')"


def _manifest(s, f, version="v1", min_score=4.5):
    return manifest.manifest(version, clips(s, f), dedup.exact_dedup(clips(s, f)), scores(s, f), motion(s, f), caption_quality(s, f), min_score=min_score, min_motion=MOTION_GATE)


def _manifest_sql(version="v1", min_score=4.5):
    return f"""SELECT '{version}' AS version, * FROM (SELECT count(*) AS total_videos FROM clips),
(SELECT count(*) FILTER (kept) AS dedup_kept, count(*) FILTER (NOT kept) AS dedup_removed FROM exact),
{_score_sql("scores", "mean_score", min_score, "score")}, {_score_sql("motion", "motion_score", MOTION_GATE, "motion")}, {_score_sql("caption_quality", "quality_score", 0.65, "quality")},
(SELECT round(coalesce(avg(clip_alignment), 0.0), 3) AS mean_clip_alignment FROM caption_quality WHERE status = 'ok')"""


def _samples(s, f):
    return shards.assigned(_gated(s, f).where("mean_score >= 4.5").select("path", "label", "source", "content", "mean_score", "motion_score", "quality_score"), SHARD_SIZE)


_SAMPLES = f"SELECT *, i // {SHARD_SIZE} AS shard_idx, i % {SHARD_SIZE} AS position FROM (SELECT *, row_number() OVER (ORDER BY path) - 1 AS i FROM gated WHERE mean_score >= 4.5)"


def _tar_roundtrip(s, f):
    folder = shared_dir(s)
    rows = shards.metadata(_samples(s, f), ["path", "source", "label", "mean_score", "motion_score"])
    shards.write_tars(rows, folder, {"mp4": "content", "json": "json"}).collect()
    files = s.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(folder)
    return shards.tar_members(files, ".mp4").select("name", "size", F.md5("data").alias("md5"))


def _shard_files(s, f):
    folder = shared_dir(s)
    shards.write_tars(_samples(s, f), folder, {"mp4": "content"}).collect()
    return s.read.format("binaryFile").option("pathGlobFilter", "shard_*.tar").load(folder)


#: A tar holds a header and whole blocks of 512 bytes a member, two empty blocks, and fills records of 10,240 bytes.
_TARS = f"SELECT shard_idx, printf('shard_%05d.tar', shard_idx) AS name, (ceil((sum(512 + ceil(strlen(content) / 512.0) * 512) + 1024) / 10240.0) * 10240)::BIGINT AS size_bytes, count(*) AS samples FROM ({_SAMPLES}) GROUP BY 1, 2"


def _manifest_files(s, f):
    folder, stats = shared_dir(s), shards.shard_stats(_shard_files(s, f))
    for k, (version, t) in enumerate((("v1", 4.5), ("v2", 5.0))):
        row = manifest.document(_manifest(s, f, version, t), stats, f"2024-01-0{k + 1}T03:04:05.678901+00:00", "raw_videos", {"min_score": str(t)}, {"min_score": t, "min_motion": MOTION_GATE, "min_quality": 0.65, "dedup": NEAR})
        writers.write_object(row, f"{folder}/{version}.json")
    return cli.manifests(s, folder)


def _near_of_exact(s, f):
    """Near duplicates among the clips that exact dedup keeps and that have a vector, by path."""
    kept = dedup.exact_dedup(clips(s, f)).where("kept").join(clips(s, f).select("path", "doc_id"), "path")
    rows = tables.written(vectors(s, f).join(kept, F.col("id") == F.col("doc_id")).select("id", "v", "path"))
    return dedup.near_dedup(rows.select("id", "v"), NEAR).join(rows.select("id", "path"), "id").select("path", "kept")


def _dedup_file(s, f):
    path = f"{shared_dir(s)}/dedup_results.json"
    near = tables.written(_near_of_exact(s, f))
    writers.write_object(writers.dedup_result(dedup.exact_dedup(clips(s, f)), near, NEAR), path)
    return readers.dedup_decisions(s, path)


def _filter_file(s, f):
    path = f"{shared_dir(s)}/filter_results.json"
    rows = _filtered(s, f).select(F.col("id").cast("string").alias("path"), "similarity", "kept")
    writers.write_object(writers.filter_result(rows, "a query", SIM, False), path)
    found = readers.records(s, path, "query string, threshold double, inverted boolean, total long, kept array<struct<path:string,similarity:double>>, removed array<string>")
    return found.select("query", "total", F.posexplode("kept").alias("place", "k")).select("query", "total", F.col("place").cast("long").alias("place"), "k.path", "k.similarity")


def _stats_file(s, f):
    path, c = f"{shared_dir(s)}/dataset_stats.json", clips(s, f)
    row = writers.stats_object(statistics.label_distribution(c), statistics.class_totals(c), statistics.rare_labels(c, 300), scores=statistics.score_summary(scores(s, f)), captions=statistics.caption_coverage(c, captions(s, f)))
    writers.write_object(row, path)
    found = readers.records(s, path, "label_distribution map<string,long>, n_classes long, total_clips long, underrepresented_classes array<string>, scores struct<n:long,mean:double>, captions struct<captioned:long>")
    return found.select(F.explode("label_distribution").alias("label", "clips"), "n_classes", "total_clips", F.col("scores.n").alias("scored"), "captions.captioned").withColumn("rare", F.col("clips") < 300)


def _npz_roundtrip(s, f):
    folder = shared_dir(s)
    v = vectors(s, f).where("id < 40").select(F.concat(F.lit("clip"), F.col("id").cast("string")).alias("stem"), F.concat(F.lit("videos/"), F.col("id").cast("string")).alias("path"), F.col("v").alias("mean_embedding"), F.array("v").alias("frame_embeddings"))
    writers.write_npz(v, folder).count()
    return readers.npz_vectors(s, folder).select("path", F.round(X.dot("mean_embedding", F.col("frame_embeddings")[0]), 4).alias("square"))


def _pixels(s, f):
    """Two frames of a document: the digests of its text and of the text reversed, a letter a byte."""
    docs = _t(s, f, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return docs.select("doc_id", F.encode(F.md5(F.col("text").cast("binary")), "UTF-8").alias("a"), F.encode(F.md5(F.reverse("text").cast("binary")), "UTF-8").alias("b"))


_PIXELS = "SELECT doc_id, list_transform(string_split(md5(coalesce(text, '')), ''), lambda x: ascii(x)) AS a, list_transform(string_split(md5(reverse(coalesce(text, ''))), ''), lambda x: ascii(x)) AS b FROM documents"
_MOMENTS = f"SELECT doc_id, list_avg(a) AS mx, list_avg(b) AS my, list_var_pop(a) AS vx, list_var_pop(b) AS vy, list_avg(list_transform(range(1, 33), lambda i: a[i] * b[i])) - list_avg(a) * list_avg(b) AS c FROM ({_PIXELS})"


def _frames(s, f):
    """Frames of an array of as many 2 x 2 frames as a document's characters over 50 say, decoded by the array backend."""

    @F.udf("binary")
    def film(doc_id, n):
        import io

        import numpy as np

        out = io.BytesIO()
        np.save(out, np.full((n, 2, 2, 3), doc_id % 251, dtype=np.uint8))
        return out.getvalue()

    docs = _t(s, f, "documents").where("doc_id < 200")
    files = docs.select(_path().alias("path"), film("doc_id", (F.col("n_chars") / 50).cast("int")).alias("content"))
    return frames.frames_of(files, backends=("pyav", "npy"), max_frames=64, batch=16)


def _latents(s, f):
    @F.udf("shape array<int>, data binary")
    def latent(doc_id):
        import numpy as np

        return frames.packed_latent(np.arange(3 * 4 * 2 * 2, dtype=float).reshape(3, 4, 2, 2) + doc_id % 7)

    docs = _t(s, f, "documents").where("doc_id % 3 = 0")
    return docs.select(F.col("doc_id").cast("string").alias("stem"), latent("doc_id").alias("l")).select("stem", "l.shape", "l.data")


def _flow(s, f):
    """A run of all stages, then one from the shards on: the rows of each table and how often the stage ran."""
    gated = lambda t: gates.gated(t["ingest"], t["score"], t["caption"], t.get("motion"), t.get("caption_quality"), **_GATES)
    steps = {
        flow.Stage.INGEST: lambda t: clips(s, f), flow.Stage.EMBED: lambda t: vectors(s, f), flow.Stage.DEDUP: lambda t: dedup.exact_dedup(t["ingest"]), flow.Stage.SCORE: lambda t: scores(s, f),
        flow.Stage.MOTION: lambda t: motion(s, f), flow.Stage.CAPTION: lambda t: captions(s, f), flow.Stage.CAPTION_QUALITY: lambda t: caption_quality(s, f),
        flow.Stage.SHARD: lambda t: gated(t).where("gate = 'pass'").select("path"), flow.Stage.MANIFEST: lambda t: manifest.manifest("v1", t["ingest"], t["dedup"], t["score"], t.get("motion"), t.get("caption_quality"), min_motion=MOTION_GATE),
    }
    run = flow.Flow(s, shared_dir(s), steps)
    run.run()
    found = run.run(from_stage=flow.Stage.SHARD)
    rows = [found[k].agg(F.lit(k).alias("stage"), F.count("*").alias("rows")) for k in found]
    every = rows[0]
    for r in rows[1:]:
        every = every.union(r)
    runs = run.metric_rows().where("status = 'ok'").groupBy("stage").agg(F.count("*").alias("runs"))
    return every.join(runs, "stage")


def _funnel(s, f):
    """How many clips are left after each of nine steps; the later signals count among those of the steps before."""
    rows = _gated(s, f).join(vectors(s, f).select("id", F.lit(True).alias("embedded")), F.col("doc_id") == F.col("id"), "left")
    rows = rows.join(dedup.exact_dedup(clips(s, f)).select("path", "kept"), "path")
    score, moved, good = (F.coalesce(F.col(c) >= t, F.lit(False)) for c, t in (("mean_score", 4.5), ("motion_score", MOTION_GATE), ("quality_score", 0.65)))
    steps = {"ingested": F.lit(True), "embedded": F.col("embedded"), "deduplicated": F.col("kept"), "aesthetic": score, "motion": moved, "captioned": score & moved, "quality": good, "latents": score & moved & good, "written": F.col("gate") == "pass"}
    return rows.agg(*[F.count_if(c).alias(k) for k, c in steps.items()])


def _names(s, f):
    docs = _t(s, f, "documents")
    odd = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("clip"), F.col("doc_id").cast("string"))).otherwise(F.concat(F.lit("yt_"), (F.col("doc_id") % 25).cast("string"), F.lit("_000010_000020")))
    return docs.select("doc_id", odd.alias("name"))


_NAMES = "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'clip' || doc_id ELSE 'yt_' || (doc_id % 25) || '_000010_000020' END AS name FROM documents"
_IDS = f"SELECT doc_id, name, coalesce(nullif(regexp_extract(name, '^(.*)_([^_]*)_([^_]*)$', 1), ''), name) AS yt_id FROM ({_NAMES})"


def _lookup(s, f):
    return _t(s, f, "nation").where("n_nationkey % 2 = 0").select(F.concat(F.lit("yt_"), F.col("n_nationkey").cast("string")).alias("yt_id"), X.normal_label("n_name").alias("label"))


def _labelled(s, f):
    from reelmill.sources.readers import with_label

    return with_label(_names(s, f), _lookup(s, f)).select("doc_id", "yt_id", "label")


_LABELLED = f"SELECT doc_id, yt_id, coalesce(replace(trim(n_name), ' ', '_'), 'unknown') AS label FROM ({_IDS}) LEFT JOIN nation ON yt_id = 'yt_' || n_nationkey AND n_nationkey % 2 = 0"


def _near(s, f):
    return dedup.near_dedup(vectors(s, f), NEAR)


def _filtered(s, f, invert=False):
    return filtering.semantic_filter(vectors(s, f), QUERY, SIM, invert)


def _indices(k: int, repeat: bool) -> str:
    m = str(k) if repeat else f"least({k}, n)"
    return f"SELECT doc_id, CASE WHEN n > 0 THEN list_transform(range({m}), lambda i: CASE WHEN {m} > 1 THEN floor(i * (n - 1) / ({m} - 1)::DOUBLE) ELSE 0 END::BIGINT)::VARCHAR ELSE '[]' END AS frames FROM sampled"


def _sampled(s, f, k, repeat):
    frames = X.sample_indices(F.col("n_chars") % 70, k, repeat)
    return _t(s, f, "documents").select("doc_id", F.concat(F.lit("["), F.array_join(frames.cast("array<string>"), ", "), F.lit("]")).alias("frames"))


_CQ = [("alignment_mean", "avg", "clip_alignment"), ("alignment_median", "median", "clip_alignment"), ("length_mean", "avg", "caption_length"), ("length_median", "median", "caption_length"), ("specificity_mean", "avg", "specificity_score"), ("quality_mean", "avg", "quality_score")]
_MO = [("mean", "avg", "motion_score"), ("median", "median", "motion_score"), ("flow_mean", "avg", "flow_magnitude"), ("ssim_mean", "avg", "ssim_mean")]


def _rounded(names):
    return [F.round(getattr(F, fn)(c), 3).alias(out) for out, fn, c in names]


#: name: (query, SQL after the common tables or None)
CATALOGUE: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "label_distribution": (lambda s, f: statistics.label_distribution(clips(s, f)), "SELECT label, count(*) AS clips FROM clips GROUP BY label"),
    "rare_labels": (lambda s, f: statistics.rare_labels(_t(s, f, "customer").select(F.col("c_nationkey").alias("label")), 60), "SELECT c_nationkey AS label, count(*) AS clips FROM customer GROUP BY 1 HAVING count(*) < 60"),
    "score_summary": (lambda s, f: statistics.score_summary(scores(s, f)), f"SELECT count(*) AS n, {_stats(*[(o, fn, 'mean_score') for o, fn in (('mean', 'avg'), ('median', 'median'), ('std', 'stddev_pop'), ('min', 'min'), ('max', 'max'))])}, round(100.0 * count(*) FILTER (mean_score >= 4.5) / count(*), 1) AS pct_4_5, round(100.0 * count(*) FILTER (mean_score >= 5.0) / count(*), 1) AS pct_5_0 FROM scores WHERE status = 'ok' HAVING count(*) > 0"),
    "score_histogram": (lambda s, f: statistics.histogram(_t(s, f, "lineitem"), "l_extendedprice"), "SELECT least(40, floor((l_extendedprice - lo) / (hi - lo) * 40) + 1)::INT AS bin, count(*) AS n FROM lineitem, (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem) GROUP BY 1"),
    "caption_tokens": (lambda s, f: captions(s, f).select("doc_id", X.token_count("caption").alias("n")), f"SELECT doc_id, len({_TOKENS})::INT AS n FROM captions"),
    "caption_specificity": (lambda s, f: captions(s, f).select("path", F.round(X.specificity("caption"), 4).alias("specificity")), "SELECT path, round(spec, 4) AS specificity FROM counted"),
    "caption_quality": (caption_quality, "SELECT * FROM caption_quality"),
    "caption_quality_summary": (lambda s, f: _signals(s, f).agg(*_rounded(_CQ), F.count_if(F.col("quality_score") >= 0.65).alias("passing_quality"), F.count_if(F.col("clip_alignment") >= 0.2).alias("passing_alignment")), f"SELECT {_stats(*_CQ)}, count(*) FILTER (quality_score >= 0.65) AS passing_quality, count(*) FILTER (clip_alignment >= 0.2) AS passing_alignment FROM caption_quality WHERE status = 'ok'"),
    "caption_coverage": (lambda s, f: statistics.caption_coverage(clips(s, f), captions(s, f)), "SELECT count(*) AS total_videos, count(*) FILTER (caption <> '') AS captioned, count(*) FILTER (caption = '') AS empty, 0::BIGINT AS failed, round(100.0 * count(*) FILTER (caption <> '') / count(*), 1) AS coverage_pct FROM captions"),
    "caption_preview": (lambda s, f: captions(s, f).select("path", X.preview("caption").alias("preview")), "SELECT path, substr(caption, 1, 80) AS preview FROM captions"),
    "aesthetic_head": (lambda s, f: vectors(s, f).select("id", F.round(X.affine_head("v", HEAD, 5.0), 4).alias("score")), "SELECT id, round(list_sum(v) + 5.0, 4) AS score FROM vectors"),
    "aesthetic_gate": (lambda s, f: gates.passing(scores(s, f), "mean_score", 4.5, need_ok=False), "SELECT DISTINCT path FROM scores WHERE coalesce(mean_score, 0.0) >= 4.5"),
    "motion_gate": (lambda s, f: gates.passing(motion(s, f), "motion_score", MOTION_GATE), f"SELECT DISTINCT path FROM motion WHERE status = 'ok' AND motion_score >= {MOTION_GATE}"),
    "motion_pairs": (lambda s, f: frame_pairs(s, f).select("user_id", "event_id", F.round("flow", 4).alias("flow"), F.round("ssim", 4).alias("ssim")), "SELECT user_id, event_id, round(flow, 4) AS flow, round(ssim, 4) AS ssim FROM frame_pairs"),
    "motion_score": (motion, "SELECT * FROM motion"),
    "motion_summary": (lambda s, f: motion(s, f).where("status = 'ok'").agg(*_rounded(_MO), F.count_if(F.col("motion_score") >= MOTION_GATE).alias("passing")), f"SELECT {_stats(*_MO)}, count(*) FILTER (motion_score >= {MOTION_GATE}) AS passing FROM motion"),
    "gate_composition": (lambda s, f: gates.composition(_gated(s, f)), "SELECT source, count(*) FILTER (gate = 'pass') AS total_written, " + ", ".join(f"count(*) FILTER (gate = '{g}') AS skipped_{g}" for g in ("score", "motion", "quality", "caption")) + " FROM gated GROUP BY source"),
    "passing_intersection": (lambda s, f: gates.passing_all(clips(s, f).select("path"), gates.passing(scores(s, f), "mean_score", 4.5), gates.passing(motion(s, f), "motion_score", MOTION_GATE), gates.passing(caption_quality(s, f), "quality_score", 0.3)), f"SELECT path FROM scores WHERE status = 'ok' AND mean_score >= 4.5 INTERSECT SELECT path FROM motion WHERE motion_score >= {MOTION_GATE} INTERSECT SELECT path FROM caption_quality WHERE status = 'ok' AND quality_score >= 0.3"),
    "kept_semi": (lambda s, f: gates.kept_only(clips(s, f).select("path", "label"), dedup.exact_dedup(clips(s, f)).where("kept")), "SELECT path, label FROM clips WHERE path IN (SELECT path FROM exact WHERE kept)"),
    "not_cached_anti": (lambda s, f: gates.not_cached(clips(s, f).select("path"), scores(s, f)), "SELECT path FROM clips WHERE path NOT IN (SELECT path FROM scores WHERE status = 'ok')"),
    "cache_union": (lambda s, f: gates.with_cached(gates.not_cached(clips(s, f).select("path", F.lit("new").alias("status"), F.lit(0.0).alias("mean_score")), scores(s, f)), scores(s, f)), "SELECT path, 'new' AS status, 0.0::DOUBLE AS mean_score FROM clips WHERE path NOT IN (SELECT path FROM scores WHERE status = 'ok') UNION ALL SELECT * FROM scores WHERE status = 'ok'"),
    "exact_dedup": (lambda s, f: dedup.exact_dedup(clips(s, f)), "SELECT * FROM exact"),
    "dedup_summary": (lambda s, f: dedup.exact_dedup(clips(s, f)).agg(F.count("*").alias("total"), F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("removed"), F.round(X.percent(F.count_if(~F.col("kept")), F.count("*")), 1).alias("duplicate_pct")), "SELECT count(*) AS total, count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS removed, round(100.0 * count(*) FILTER (NOT kept) / count(*), 1) AS duplicate_pct FROM exact"),
    "knn_topk": (lambda s, f: dedup.neighbours(vectors(s, f), k=5).select("id", "other", F.round("sim", 4).alias("sim")), "SELECT id, other, round(sim, 4) AS sim FROM ranked WHERE r <= 5"),
    "near_pairs": (lambda s, f: dedup.near_pairs(vectors(s, f), NEAR).select("a", "b", F.round("sim", 4).alias("sim")), "SELECT a, b, round(sim, 4) AS sim FROM pairs"),
    "near_components": (lambda s, f: _near(s, f).select("id", "component"), "SELECT id, component FROM near"),
    "near_dedup": (_near, "SELECT id, component, id = component AS kept FROM near"),
    "semantic_filter": (lambda s, f: _filtered(s, f).select("id", "similarity", "kept"), "SELECT * FROM filtered"),
    "semantic_filter_inverted": (lambda s, f: _filtered(s, f, True).select("id", "similarity", "kept"), "SELECT id, similarity, NOT kept AS kept FROM filtered"),
    "semantic_top5": (lambda s, f: filtering.best(_filtered(s, f).select("id", "similarity", "kept"), 5), "SELECT * FROM filtered WHERE kept ORDER BY similarity DESC, id LIMIT 5"),
    "filter_summary": (lambda s, f: filtering.filter_summary(_filtered(s, f)), "SELECT count(*) AS total, count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS removed, round(100.0 * count(*) FILTER (kept) / count(*), 1) AS kept_pct, round(avg(similarity), 3) AS sim_mean, round(median(similarity), 3) AS sim_median, round(max(similarity), 3) AS sim_max, round(min(similarity), 3) AS sim_min FROM filtered"),
    "clip_name_parse": (lambda s, f: _names(s, f).select("doc_id", "name", X.clip_id("name").alias("yt_id")), _IDS),
    "label_lookup": (_labelled, _LABELLED),
    "relabel_count": (lambda s, f: _labelled(s, f).agg(F.count_if(F.col("label") != "unknown").alias("moved"), F.count("*").alias("total")), f"SELECT count(*) FILTER (label <> 'unknown') AS moved, count(*) AS total FROM ({_LABELLED})"),
    "url_parts": (lambda s, f: _t(s, f, "pages").select("page_id", X.part_name("url").alias("part")), r"SELECT page_id, replace(regexp_extract(url, '([^/]+?)(\.[^./]*)?$', 1), '.tar', '') AS part FROM pages"),
    "frame_sample_index": (lambda s, f: _sampled(s, f, 8, False), _indices(8, False)),
    "frame_sample_repeat": (lambda s, f: _sampled(s, f, 16, True), _indices(16, True)),
    "shard_assignment": (lambda s, f: _samples(s, f).select("path", "ordinal", "shard_idx", "position", "key", "shard"), f"SELECT path, i AS ordinal, shard_idx, position, printf('%05d_%04d', shard_idx, position) AS key, printf('shard_%05d.tar', shard_idx) AS shard FROM ({_SAMPLES})"),
    "shard_metadata": (lambda s, f: shards.metadata(_samples(s, f), ["path", "source", "label"]).select("path", "json"), f"SELECT path, '{{\"path\":\"' || path || '\",\"source\":\"' || source || '\",\"label\":\"' || label || '\"}}' AS json FROM ({_SAMPLES})"),
    "shard_stats": (lambda s, f: shards.shard_stats(_shard_files(s, f)).drop("files"), f"SELECT count(*) AS count, sum(samples)::BIGINT AS total_samples, sum(size_bytes)::BIGINT AS total_bytes, round(sum(size_bytes) / 1e6, 1) AS total_mb FROM ({_TARS})"),
    "shard_files": (lambda s, f: shards.shard_files(_shard_files(s, f)), f"SELECT name, size_bytes, samples FROM ({_TARS})"),
    "class_totals": (lambda s, f: statistics.class_totals(clips(s, f)), "SELECT count(DISTINCT label) AS n_classes, count(*) AS total_clips FROM clips"),
    "top_labels": (lambda s, f: statistics.top_labels(_t(s, f, "customer").select(F.col("c_nationkey").alias("label")), 10), "SELECT c_nationkey AS label, count(*) AS clips FROM customer GROUP BY 1 ORDER BY clips DESC, label LIMIT 10"),
    "first_rare_labels": (lambda s, f: statistics.rare_labels(_t(s, f, "customer").select(F.col("c_nationkey").alias("label")), 60).orderBy("label").limit(5), "SELECT c_nationkey AS label, count(*) AS clips FROM customer GROUP BY 1 HAVING count(*) < 60 ORDER BY label LIMIT 5"),
    "first_clips": (lambda s, f: statistics.first_paths(clips(s, f).select("path"), 100), "SELECT path FROM clips ORDER BY regexp_replace(path, '[^/]*$', ''), regexp_extract(path, '[^/]*$') LIMIT 100"),
    "throughput": (lambda s, f: statistics.throughput(_t(s, f, "events"), F.unix_micros(F.col("ts").cast("timestamp")) / 1e6, F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 + 1), "SELECT count(*) AS clips, round(max(epoch_us(ts)) / 1e6 + 1 - min(epoch_us(ts)) / 1e6, 3) AS seconds, round(count(*) / (max(epoch_us(ts)) / 1e6 + 1 - min(epoch_us(ts)) / 1e6), 3) AS clips_per_s FROM events"),
    "frame_score_mean": (lambda s, f: vectors(s, f).select("id", F.round(X.mean_of("v"), 4).alias("mean")).withColumn("mean", F.col("mean") + 0.0), "SELECT id, round(list_avg(v), 4) + 0.0 AS mean FROM vectors"),
    "metric_rows": (lambda s, f: statistics.metrics("run1", "score", statistics.score_summary(scores(s, f))), f"UNPIVOT (SELECT 'run1' AS run, 'score' AS stage, * FROM (SELECT count(*)::DOUBLE AS n, {_stats(*[(o, fn, 'mean_score') for o, fn in (('mean', 'avg'), ('median', 'median'), ('std', 'stddev_pop'), ('min', 'min'), ('max', 'max'))])}, round(100.0 * count(*) FILTER (mean_score >= 4.5) / count(*), 1)::DOUBLE AS pct_4_5, round(100.0 * count(*) FILTER (mean_score >= 5.0) / count(*), 1)::DOUBLE AS pct_5_0 FROM scores WHERE status = 'ok')) ON COLUMNS(* EXCLUDE (run, stage)) INTO NAME metric VALUE value"),
    "frame_grey": (lambda s, f: _pixels(s, f).select("doc_id", F.round(frames.grey_mean("a"), 4).alias("grey")), f"SELECT doc_id, round(list_avg(list_transform(range(0, 10), lambda i: (299 * a[3 * i + 1] + 587 * a[3 * i + 2] + 114 * a[3 * i + 3] + 500) // 1000)), 4) AS grey FROM ({_PIXELS})"),
    "frame_ssim": (lambda s, f: _pixels(s, f).select("doc_id", F.round(frames.frame_ssim("a", "b"), 4).alias("ssim")).withColumn("ssim", F.col("ssim") + 0.0), f"SELECT doc_id, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, (2 * mx * my + 6.5025::DOUBLE) * (2 * c + 58.5225::DOUBLE) / ((mx * mx + my * my + 6.5025::DOUBLE) * (vx + vy + 58.5225::DOUBLE)))), 4) + 0.0 AS ssim FROM ({_MOMENTS})"),
    "frames_decoded": (lambda s, f: _frames(s, f).groupBy("path", "backend").agg(F.count("*").alias("n_frames"), F.max("batch").alias("last_batch"), F.count_distinct("rgb").alias("colours")), "SELECT path, 'npy' AS backend, least(64, n_chars // 50)::BIGINT AS n_frames, ((least(64, n_chars // 50) - 1) // 16)::INT AS last_batch, 1::BIGINT AS colours FROM clips JOIN documents USING (doc_id) WHERE doc_id < 200 AND n_chars >= 50"),
    "latent_members": (lambda s, f: shards.with_latents(clips(s, f).select("path"), _latents(s, f)).select("path", F.coalesce(F.octet_length("latent"), F.lit(0)).alias("size")), "SELECT path, CASE WHEN doc_id % 3 = 0 THEN 96 ELSE 0 END::INT AS size FROM clips"),
    "latent_shapes": (lambda s, f: _latents(s, f).select("stem", F.array_join(F.col("shape").cast("array<string>"), "x").alias("shape"), F.hex(F.substring("data", 1, 2)).alias("head")), "SELECT doc_id::VARCHAR AS stem, '4x3x2x2' AS shape, ['0000', '003C', '0040', '0042', '0044', '0045', '0046'][doc_id % 7 + 1] AS head FROM documents WHERE doc_id % 3 = 0"),
    "manifest_list": (lambda s, f: manifest.listed(_manifest_files(s, f)), f"SELECT version, created, (SELECT count(*) FROM clips) AS videos, (SELECT count(*) FILTER (kept) FROM exact) AS kept, t.shards, t.size_mb FROM (VALUES ('v1', '2024-01-01T03:04:05'), ('v2', '2024-01-02T03:04:05')) AS m(version, created), (SELECT count(*) AS shards, round(sum(size_bytes) / 1e6, 1) AS size_mb FROM ({_TARS})) AS t"),
    "dedup_result": (_dedup_file, "SELECT path, 'exact_removed' AS decision FROM exact WHERE NOT kept UNION ALL SELECT path, CASE WHEN id = m THEN 'kept' ELSE 'near_removed' END FROM (SELECT path, id, coalesce(least(id, min(y)), id) AS m FROM (SELECT path, doc_id AS id FROM exact JOIN clips USING (path) JOIN vectors ON id = doc_id WHERE kept) LEFT JOIN own_reach ON x = id GROUP BY path, id)"),
    "filter_result": (_filter_file, "SELECT 'a query' AS query, (SELECT count(*) FROM filtered) AS total, row_number() OVER (ORDER BY similarity DESC, id::VARCHAR) - 1 AS place, id::VARCHAR AS path, similarity FROM filtered WHERE kept"),
    "stats_result": (_stats_file, "SELECT label, count(*) AS clips, (SELECT count(DISTINCT label) FROM clips) AS n_classes, (SELECT count(*) FROM clips) AS total_clips, (SELECT count(*) FROM scores WHERE status = 'ok') AS scored, (SELECT count(*) FROM captions WHERE caption <> '') AS captioned, count(*) < 300 AS rare FROM clips GROUP BY label"),
    "npz_roundtrip": (_npz_roundtrip, "SELECT 'videos/' || id AS path, round(list_dot_product(v, v), 4) AS square FROM vectors WHERE id < 40"),
    "flow_stages": (_flow, "SELECT * FROM (SELECT 'ingest' AS stage, count(*) AS rows, 1::BIGINT AS runs FROM clips UNION ALL SELECT 'embed', count(*), 1 FROM vectors UNION ALL SELECT 'dedup', count(*), 1 FROM exact UNION ALL SELECT 'score', count(*), 1 FROM scores UNION ALL SELECT 'motion', count(*), 1 FROM motion UNION ALL SELECT 'caption', count(*), 1 FROM captions UNION ALL SELECT 'caption_quality', count(*), 1 FROM caption_quality UNION ALL SELECT 'shard', count(*), 2 FROM gated WHERE gate = 'pass' UNION ALL SELECT 'manifest', 1, 2)"),
    "funnel_steps": (_funnel, f"SELECT count(*) AS ingested, count(*) FILTER (id IS NOT NULL) AS embedded, count(*) FILTER (e.kept) AS deduplicated, count(*) FILTER (mean_score >= 4.5) AS aesthetic, count(*) FILTER (motion_score >= {MOTION_GATE}) AS motion, count(*) FILTER (mean_score >= 4.5 AND motion_score >= {MOTION_GATE}) AS captioned, count(*) FILTER (quality_score >= 0.65) AS quality, count(*) FILTER (mean_score >= 4.5 AND motion_score >= {MOTION_GATE} AND quality_score >= 0.65) AS latents, count(*) FILTER (gate = 'pass') AS written FROM gated LEFT JOIN vectors ON id = doc_id JOIN exact e USING (path)"),
    "round_robin": (lambda s, f: shards.numbered(clips(s, f).select("path"), "path").select("path", (F.col("ordinal") % 8).alias("worker")), "SELECT path, (row_number() OVER (ORDER BY path) - 1) % 8 AS worker FROM clips"),
    "embedding_pca_points": (lambda s, f: statistics.principal_points(_t(s, f, "embeddings"), "vec_id", "embedding"), None),
    "latent_disk_usage": (lambda s, f: clips(s, f).agg(X.megabytes(F.sum(F.octet_length("content"))).alias("mb")), "SELECT round(sum(strlen(content)) / 1e6, 1) AS mb FROM clips"),
    "manifest_create": (_manifest, _manifest_sql()),
    "manifest_diff": (lambda s, f: manifest.diff(_manifest(s, f), _manifest(s, f, "v2", 5.0)), f"SELECT metric, a, b, printf('(Δ %+.1f)', b - a) AS delta FROM (UNPIVOT (SELECT * EXCLUDE (version) REPLACE ({', '.join(f'{c}::DOUBLE AS {c}' for c in ('total_videos', 'dedup_kept', 'dedup_removed', 'score_scored', 'score_passing', 'motion_scored', 'motion_passing', 'quality_scored', 'quality_passing'))}) FROM ({_manifest_sql()})) ON * INTO NAME metric VALUE a) JOIN (UNPIVOT (SELECT * EXCLUDE (version) REPLACE ({', '.join(f'{c}::DOUBLE AS {c}' for c in ('total_videos', 'dedup_kept', 'dedup_removed', 'score_scored', 'score_passing', 'motion_scored', 'motion_passing', 'quality_scored', 'quality_passing'))}) FROM ({_manifest_sql('v2', 5.0)})) ON * INTO NAME metric VALUE b) USING (metric)"),
    "status_counts": (lambda s, f: statistics.status_counts(scores(s, f)), "SELECT CASE WHEN status IN ('ok', 'cached') THEN status ELSE 'failed' END AS status, count(*) AS n FROM scores GROUP BY 1"),
    "funnel": (lambda s, f: _gated(s, f).agg(F.count("*").alias("ingested"), F.count_if(F.col("mean_score") >= 4.5).alias("aesthetic"), F.count_if(F.col("motion_score") >= MOTION_GATE).alias("motion"), F.count_if(F.col("quality_score") >= 0.65).alias("quality"), F.count_if(F.col("gate") == "pass").alias("written")), f"SELECT count(*) AS ingested, count(*) FILTER (mean_score >= 4.5) AS aesthetic, count(*) FILTER (motion_score >= {MOTION_GATE}) AS motion, count(*) FILTER (quality_score >= 0.65) AS quality, count(*) FILTER (gate = 'pass') AS written FROM gated"),
    "last_wins_lookup": (lambda s, f: gates.last_wins(_t(s, f, "orders").select("o_custkey", "o_orderkey", "o_orderstatus"), "o_custkey", "o_orderkey"), "SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY o_custkey"),
    "label_index": (lambda s, f: statistics.dense_label_index(clips(s, f)), "SELECT label, (dense_rank() OVER (ORDER BY label) - 1)::INT AS index FROM (SELECT DISTINCT label FROM clips)"),
    "mean_pool": (lambda s, f: statistics.mean_pool(_t(s, f, "embeddings"), "label", "embedding").select("label", "place", F.round("mean", 4).alias("mean")), "SELECT label, place, round(m / (sqrt(sum(m * m) OVER (PARTITION BY label)) + 1e-8), 4) AS mean FROM (SELECT label, place - 1 AS place, avg(x::DOUBLE) AS m FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS place FROM embeddings) GROUP BY ALL)"),
    "embedding_pca_variance": (lambda s, f: statistics.principal_shares(_t(s, f, "embeddings"), "embedding"), None),
    "tar_roundtrip": (_tar_roundtrip, f"SELECT printf('%05d_%04d.mp4', shard_idx, position) AS name, strlen(content) AS size, md5(content) AS md5 FROM ({_SAMPLES})"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q for k, (q, _) in CATALOGUE.items()}


def oracle_sql() -> dict[str, str]:
    return {k: CTE + sql for k, (_, sql) in CATALOGUE.items() if sql}
