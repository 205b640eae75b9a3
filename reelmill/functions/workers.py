"""The steps that need a model, a worker each: a clip's bytes in, its row of results out. Models are given, not shipped."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from reelmill.operators import frames as P

Images = Callable[[np.ndarray], np.ndarray]  # [frames, h, w, 3] of bytes -> a vector or a score for each


@dataclass
class EmbedWorker:
    """The mean of the frames' vectors over its length plus 1e-8, and the vectors themselves."""

    model: Images
    frames: int = 8
    max_frames: int = P.FEW_FRAMES
    backends: tuple[str, ...] = tuple(P.BACKENDS)
    schema = "path string, status string, mean_embedding array<float>, frame_embeddings array<array<float>>, time_s double"

    def sampled(self, content: bytes) -> np.ndarray:
        found, _ = P.decoded(content, self.backends, self.max_frames)
        if not found:
            raise ValueError("no frames")
        return np.stack([found[i] for i in P.sample_places(len(found), self.frames)])

    def __call__(self, row: dict) -> dict:
        vectors = np.asarray(self.model(self.sampled(row["content"])), dtype=np.float64)
        mean = vectors.mean(0)
        return {"mean_embedding": (mean / (np.linalg.norm(mean) + 1e-8)).tolist(), "frame_embeddings": vectors.tolist()}


@dataclass
class ScoreWorker(EmbedWorker):
    """A score for each sampled frame, and their mean, four digits."""

    schema = "path string, status string, mean_score double, frame_scores array<double>, time_s double"

    def __call__(self, row: dict) -> dict:
        scores = np.asarray(self.model(self.sampled(row["content"])), dtype=np.float64).reshape(-1)
        return {"mean_score": round(float(scores.mean()), 4), "frame_scores": [round(float(s), 4) for s in scores]}


def farneback(a: np.ndarray, b: np.ndarray) -> float:
    """Mean length of dense optical flow between two grey frames; needs OpenCV."""
    import cv2

    flow = cv2.calcOpticalFlowFarneback(a, b, None, 0.5, 3, 15, 3, 5, 1.2, 0)
    return float(np.linalg.norm(flow, axis=2).mean())


@dataclass
class MotionWorker:
    """Flow and similarity of neighbouring frames among 17 evenly spaced ones; fewer than two are a failure."""

    flow: Callable[[np.ndarray, np.ndarray], float] = farneback
    pairs: int = 16
    backends: tuple[str, ...] = tuple(P.BACKENDS)
    schema = "path string, status string, flow_magnitude double, flow_variance double, ssim_mean double, motion_score double, time_s double"

    def __call__(self, row: dict) -> dict:
        found, _ = P.decoded(row["content"], self.backends)
        if len(found) < 2:
            raise ValueError("too few frames")
        grey = [P.grey(found[i]) for i in P.sample_places(len(found), self.pairs + 1)]
        flows = np.array([self.flow(a, b) for a, b in zip(grey, grey[1:], strict=False)])
        alike = float(np.mean([P.ssim(a, b) for a, b in zip(grey, grey[1:], strict=False)]))
        m, v = float(flows.mean()), float(flows.var())
        score = float(np.clip(5 * alike + 3 * np.exp(-((m - 5) ** 2) / 50) + 2 * np.exp(-v / 10), 0, 10))
        return {"flow_magnitude": round(m, 4), "flow_variance": round(v, 4), "ssim_mean": round(alike, 4), "motion_score": round(score, 4)}


@dataclass
class CaptionWorker(EmbedWorker):
    """One caption for the sampled frames, without blanks at its ends."""

    schema = "path string, status string, caption string, time_s double"

    def __call__(self, row: dict) -> dict:
        return {"caption": str(self.model(self.sampled(row["content"]))).strip()}


@dataclass
class TextWorker:
    """The unit vector of a caption."""

    model: Callable[[list[str]], np.ndarray]
    schema = "path string, status string, text_embedding array<float>, time_s double"

    def __call__(self, row: dict) -> dict:
        return {"text_embedding": encode_query(self.model, row["caption"])}


@dataclass
class LatentWorker:
    """The latent of 16 frames, repeated where a clip has fewer, as half-precision bytes with its shape."""

    model: Images
    frames: int = 16
    height: int = 256
    width: int = 256
    backends: tuple[str, ...] = tuple(P.BACKENDS)
    schema = "path string, status string, shape array<int>, data binary, time_s double"

    def __call__(self, row: dict) -> dict:
        found, _ = P.decoded(row["content"], self.backends)
        if not found:
            raise ValueError("no frames")
        chosen = np.stack([found[i] for i in P.sample_places(len(found), self.frames, repeat=True)])
        shape, data = P.packed_latent(np.asarray(self.model(P.resized(chosen, self.height, self.width))))
        return {"shape": shape, "data": data}


def run_worker(clips: DataFrame, load: Callable[[], object], schema: str, zeros: dict | None = None) -> DataFrame:
    """A row a clip by the worker that ``load`` makes once a task; ``time_s`` is what the clip took.

    A clip that raises gives ``failed: <why>`` and the values of ``zeros``, null elsewhere. Clips with results should be
    left out before (``gates.not_cached``) and joined to the rest after (``gates.with_cached``).
    """
    names = [c.strip().split()[0] for c in schema.replace("array<array<float>>", "x").split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker = load()
        for rows in batches:
            out = []
            for row in rows.to_dict("records"):
                began = time.perf_counter()
                try:
                    found = worker(row) | {"status": "ok"}
                except Exception as e:  # a bad clip is a row, not the end of the job
                    found = (zeros or {}) | {"status": f"failed: {e}"}
                out.append(found | {"path": row["path"], "time_s": round(time.perf_counter() - began, 4)})
            made = pd.DataFrame({n: pd.Series([r.get(n) for r in out], dtype=object) for n in names})
            yield made

    return clips.mapInPandas(run, schema)


def encode_query(model: Callable[[list[str]], np.ndarray], text: str) -> list[float]:
    """One text's vector over its length plus 1e-8, on the driver: a literal for ``filtering.semantic_filter``."""
    v = np.asarray(model([text]), dtype=np.float64).reshape(-1)
    return (v / (np.linalg.norm(v) + 1e-8)).tolist()


def profile(results: DataFrame) -> DataFrame:
    """One row over a worker's results: clips, ok, seconds in all, the mean and the longest, clips a second of work."""
    from pyspark.sql import functions as F

    rate = F.when(F.sum("time_s") > 0, F.round(F.count("*") / F.sum("time_s"), 3))
    return results.agg(F.count("*").alias("clips"), F.count_if(F.col("status") == "ok").alias("ok"), F.round(F.sum("time_s"), 3).alias("seconds"), F.round(F.avg("time_s"), 4).alias("mean_s"), F.max("time_s").alias("longest_s"), rate.alias("clips_per_s"))
