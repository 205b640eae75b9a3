"""Frames of clips: decoding behind named backends, and what is computed from pixels."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frames that embedding and scoring look at, frames that any decoding stops at, frames of a batch.
FEW_FRAMES, MAX_FRAMES, BATCH = 64, 512, 16
#: Weights of red, green and blue in a grey value, in thousandths.
GREY = (299, 587, 114)

Decoder = Callable[[bytes], Iterator[np.ndarray]]


def from_npy(content: bytes) -> Iterator[np.ndarray]:
    """Frames of an array file [frames, height, width, 3] of bytes."""
    yield from np.load(io.BytesIO(content), allow_pickle=False)


def by_pyav(content: bytes) -> Iterator[np.ndarray]:
    import av

    with av.open(io.BytesIO(content)) as container:
        for frame in container.decode(video=0):
            yield frame.to_ndarray(format="rgb24")


def by_opencv(content: bytes) -> Iterator[np.ndarray]:
    import tempfile

    import cv2

    with tempfile.NamedTemporaryFile(suffix=".mp4") as f:  # read by this process alone
        f.write(content)
        f.flush()
        video = cv2.VideoCapture(f.name)
        try:
            while (got := video.read())[0]:
                yield cv2.cvtColor(got[1], cv2.COLOR_BGR2RGB)
        finally:
            video.release()


#: Backends by name, in the order in which they are tried.
BACKENDS: dict[str, Decoder] = {"pyav": by_pyav, "opencv": by_opencv, "npy": from_npy}


def decoded(content: bytes, backends: Sequence[str] = tuple(BACKENDS), max_frames: int = MAX_FRAMES) -> tuple[list[np.ndarray], str]:
    """The first frames, and the backend that gave them: one that is not installed or fails gives way to the next."""
    why: list[str] = []
    for name in backends:
        try:
            frames: list[np.ndarray] = []
            for frame in BACKENDS[name](content):
                if len(frames) == max_frames:
                    break
                frames.append(np.asarray(frame, dtype=np.uint8))
            return frames, name
        except Exception as e:  # ImportError, or content that this backend cannot read
            why.append(f"{name}: {e}")
    raise ValueError("; ".join(why))


def frames_of(files: DataFrame, backends: Sequence[str] = tuple(BACKENDS), max_frames: int = MAX_FRAMES, batch: int = BATCH) -> DataFrame:
    """(path, content) -> a row a frame: path, frame_idx, batch, height, width, rgb, backend. Undecodable clips give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for path, content in zip(rows["path"], rows["content"], strict=True):
                try:
                    frames, name = decoded(bytes(content), backends, max_frames)
                except (ValueError, TypeError):
                    continue
                for at in range(0, len(frames), batch):
                    out = [(path, at + i, at // batch, f.shape[0], f.shape[1], f.tobytes(), name) for i, f in enumerate(frames[at : at + batch])]
                    yield pd.DataFrame(out, columns=["path", "frame_idx", "batch", "height", "width", "rgb", "backend"])

    return files.select("path", "content").mapInPandas(run, "path string, frame_idx int, batch int, height int, width int, rgb binary, backend string")


def sample_places(n: int, k: int, repeat: bool = False) -> list[int]:
    """k evenly spaced numbers below n, truncated; fewer where n is smaller, unless they may repeat."""
    k = k if repeat else min(k, n)
    return [] if n < 1 else [i * (n - 1) // (k - 1) if k > 1 else 0 for i in range(k)]


def grey(rgb: np.ndarray) -> np.ndarray:
    """Grey values 0 to 255 of [..., 3], rounded half up."""
    return ((rgb.astype(np.int64) @ np.array(GREY) + 500) // 1000).astype(np.uint8)


def ssim(a: np.ndarray, b: np.ndarray) -> float:
    """Structural similarity of two grey images over one window, between 0 and 1."""
    x, y = a.astype(np.float64).ravel(), b.astype(np.float64).ravel()
    c1, c2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2
    mx, my = x.mean(), y.mean()
    top = (2 * mx * my + c1) * (2 * ((x - mx) * (y - my)).mean() + c2)
    return float(np.clip(top / ((mx * mx + my * my + c1) * (x.var() + y.var() + c2)), 0, 1))


def _triangle(size: int, to: int) -> np.ndarray:
    """The matrix that takes ``size`` samples to ``to``: triangles as wide as a step, so that shrinking averages."""
    step = size / to
    width = max(step, 1.0)
    centre = (np.arange(to) + 0.5) * step
    w = np.maximum(0, 1 - np.abs(np.arange(size)[None, :] + 0.5 - centre[:, None]) / width)
    return w / w.sum(1, keepdims=True)


def resized(frames: np.ndarray, height: int, width: int) -> np.ndarray:
    """[frames, h, w, 3] of bytes -> [frames, 3, height, width] between -1 and 1, bilinear with smoothing."""
    x = np.einsum("ih,thwc,jw->tcij", _triangle(frames.shape[1], height), frames.astype(np.float64), _triangle(frames.shape[2], width))
    return x / 127.5 - 1


def packed_latent(latent: np.ndarray) -> tuple[list[int], bytes]:
    """[frames, channels, h, w] -> shape [channels, frames, h, w] and its little-endian half-precision bytes."""
    half = np.ascontiguousarray(latent.transpose(1, 0, 2, 3)).astype("<f2")
    return list(half.shape), half.tobytes()


def unpacked_latent(shape: Sequence[int], data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<f2").reshape(shape)


def grey_mean(rgb: Column | str) -> Column:
    """Mean grey value of the pixels in a frame's bytes; what does not fill a pixel is left out; null without one."""

    def mean(rgb: pd.Series) -> pd.Series:
        return pd.Series([float(grey(np.frombuffer(x, np.uint8)[: len(x) // 3 * 3].reshape(-1, 3)).mean()) if x is not None and len(x) > 2 else None for x in rgb], dtype=float)

    return F.pandas_udf(mean, "double")(rgb)


def frame_ssim(a: Column | str, b: Column | str) -> Column:
    """Similarity of two grey frames of one size, given as bytes; null if sizes differ or a frame is missing."""

    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        ok = lambda x, y: x is not None and y is not None and len(x) == len(y) > 0
        return pd.Series([ssim(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)) if ok(x, y) else None for x, y in zip(a, b, strict=True)], dtype=float)

    return F.pandas_udf(alike, "double")(a, b)
