"""Scalar functions of the clip catalogue as Column expressions; no Python runs for any of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that carry no content, and the signs stripped from a token before it is looked up.
STOPWORDS = (
    "a an the is are was were be been being have has had do does did will would could should may might shall can "
    "in on at to for of with by from up about into through during and or but not no so this that these those it its "
    "he she they we you i my his her their our your who which what where when there here some each very just as if"
).split()
TOKEN_SIGNS = ".,!?;:\"'"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clamp(x: Column, low: float, high: float) -> Column:
    """Between low and high; NaN counts as low, so that it fails every gate."""
    return F.when(F.isnan(x), F.lit(low)).otherwise(F.greatest(F.lit(low), F.least(F.lit(high), x)))


def stem(path: Column | str) -> Column:
    """File name without its last suffix."""
    return F.regexp_extract(_c(path), r"([^/]+?)(\.[^./]*)?$", 1)


def parent_label(path: Column | str) -> Column:
    """Name of the folder that holds the file; null for a bare file name."""
    return F.try_element_at(F.split(_c(path), "/"), F.lit(-2))


def clip_id(name: Column | str) -> Column:
    """``<id>_<start>_<end>`` gives the id, which may hold underscores; any other name stays whole."""
    found = F.regexp_extract(_c(name), r"^(.*)_([^_]*)_([^_]*)$", 1)
    return F.when(found == "", _c(name)).otherwise(found)


def part_name(url: Column | str) -> Column:
    return F.replace(stem(url), F.lit(".tar"), F.lit(""))


def normal_label(label: Column | str) -> Column:
    return F.replace(F.trim(_c(label)), F.lit(" "), F.lit("_"))


def status_class(status: Column | str) -> Column:
    """ok, cached, or failed for anything else, null included."""
    return F.when(_c(status).isin("ok", "cached"), _c(status)).otherwise("failed")


def tokens(text: Column | str) -> Column:
    return F.filter(F.split(F.lower(_c(text)), r"\s+"), lambda t: t != "")


def token_count(text: Column | str) -> Column:
    return F.coalesce(F.size(F.filter(F.split(_c(text), r"\s+"), lambda t: t != "")), F.lit(0))


def specificity(text: Column | str) -> Column:
    """Share of tokens that are no stopwords; 0 without tokens."""
    words = tokens(text)
    content = F.filter(words, lambda t: ~F.btrim(t, F.lit(TOKEN_SIGNS)).isin(*STOPWORDS))
    return F.when(F.size(words) > 0, F.size(content) / F.size(words)).otherwise(F.lit(0.0))


def length_score(n: Column | str) -> Column:
    """Rises to a half at 5 tokens and to 1 at 30, then falls to 0 at 90."""
    n = _c(n)
    return F.when(n < 5, n / 5.0 * 0.5).when(n <= 30, 0.5 + (n - 5) / 50.0).otherwise(F.greatest(F.lit(0.0), 1.0 - (n - 30) / 60.0))


def quality_score(alignment: Column | str, n: Column | str, content: Column | str) -> Column:
    """Half alignment between 0.1 and 0.4, three tenths specificity, a fifth length."""
    aligned = clamp((_c(alignment) - 0.10) / 0.30, 0.0, 1.0)
    return clamp(0.50 * aligned + 0.30 * _c(content) + 0.20 * length_score(n), 0.0, 1.0)


def motion_score(flow: Column | str, variance: Column | str, ssim: Column | str) -> Column:
    """Coherence, a reward for moderate flow and one for steadiness, between 0 and 10."""
    reward = 3.0 * F.exp(-F.pow(_c(flow) - 5.0, F.lit(2.0)) / 50.0)
    return clamp(5.0 * _c(ssim) + reward + 2.0 * F.exp(-_c(variance) / 10.0), 0.0, 10.0)


def global_ssim(m1: Column, m2: Column, v1: Column, v2: Column, cov: Column) -> Column:
    """Structural similarity of two grey images from their means, population variances and covariance, one window."""
    c1, c2 = (0.01 * 255) ** 2, (0.03 * 255) ** 2
    s = ((2 * m1 * m2 + c1) * (2 * cov + c2)) / ((m1 * m1 + m2 * m2 + c1) * (v1 + v2 + c2))
    return clamp(s, 0.0, 1.0)


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column | str) -> Column:
    """The vector over its length plus 1e-8: a zero vector stays zero."""
    length = F.sqrt(dot(v, v)) + 1e-8
    return F.transform(_c(v), lambda x: x.cast("double") / length)


def mean_of(values: Column | str) -> Column:
    return F.aggregate(_c(values), F.lit(0.0), lambda s, x: s + x) / F.size(_c(values))


def affine_head(v: Column | str, weights: list[float], constant: float) -> Column:
    """Linear layers without activations between them are one affine map: fold them once, apply this."""
    return dot(v, F.array(*[F.lit(float(w)) for w in weights])) + constant


def fold_layers(layers: list[tuple]) -> tuple[list[float], float]:
    """(matrix, constants) of successive linear layers, the last with one output -> weights and constant of one map."""
    import numpy as np

    w, b = np.asarray(layers[0][0], dtype=float), np.asarray(layers[0][1], dtype=float)
    for m, c in layers[1:]:
        m = np.asarray(m, dtype=float)
        w, b = m @ w, m @ b + np.asarray(c, dtype=float)
    return w.reshape(-1).tolist(), float(b.reshape(-1)[0])


def sample_indices(n: Column | str, k: int, repeat: bool = False) -> Column:
    """k evenly spaced frame numbers below n; a shorter clip gives each frame once, or with repeat some again."""
    n = _c(n).cast("long")
    wanted = F.lit(k).cast("long") if repeat else F.least(F.lit(k).cast("long"), n)
    place = lambda i: F.when(wanted > 1, F.floor(i * (n - 1) / (wanted - 1))).otherwise(F.lit(0)).cast("long")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), wanted - 1), place)).otherwise(F.array().cast("array<bigint>"))


def shard_key(shard: Column | str, place: Column | str) -> Column:
    return F.format_string("%05d_%04d", _c(shard), _c(place))


def shard_file(shard: Column | str) -> Column:
    return F.format_string("shard_%05d.tar", _c(shard))


def megabytes(size: Column | str) -> Column:
    return F.round(_c(size) / 1e6, 1)


def percent(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part / F.greatest(whole, F.lit(1))


def delta_text(a: Column | str, b: Column | str) -> Column:
    """The change between two numbers, empty unless both are there."""
    return F.when(_c(a).isNotNull() & _c(b).isNotNull(), F.format_string("(Δ %+.1f)", _c(b) - _c(a))).otherwise("")


def preview(text: Column | str, n: int = 80) -> Column:
    return F.substring(_c(text), 1, n)


def bin_of(x: Column | str, low: Column, high: Column, bins: int = 40) -> Column:
    """Equal-width bins from 1; the last one includes its upper edge; a single value is in bin 1."""
    x = _c(x)
    return F.when(high > low, F.least(F.lit(bins), F.floor((x - low) / (high - low) * bins) + 1)).otherwise(F.lit(1)).cast("int")
