"""Clip signal functions.

Framing, energies and spectral shapes are column expressions on arrays; only the
Fourier transform and the products with fixed filter matrices go through Arrow
batches.  Filter matrices depend on parameters alone, never on the data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VECTOR = T.ArrayType(T.DoubleType())


@dataclass(frozen=True)
class Framing:
    """Frame length and hop in samples; centred frames see half a frame of padding at both ends."""

    size: int = 2048
    hop: int = 512
    center: bool = True

    @property
    def bins(self) -> int:
        return self.size // 2 + 1


def cut(samples: Column, sr: Column, seconds: float) -> Column:
    return F.slice(samples, F.lit(1), F.floor(sr * F.lit(seconds)).cast("int"))


def frames(samples: Column, framing: Framing, edge: bool = False) -> Column:
    """Array of frames; padded with zeros, or with the end values when ``edge``."""
    x = samples.cast("array<double>")
    if framing.center:
        half = F.lit(framing.size // 2)
        left = F.coalesce(F.get(x, F.lit(0)), F.lit(0.0)) if edge else F.lit(0.0)
        right = F.coalesce(F.try_element_at(x, F.lit(-1)), F.lit(0.0)) if edge else F.lit(0.0)
        x = F.concat(F.array_repeat(left, half), x, F.array_repeat(right, half))
    last = F.floor((F.size(x) - framing.size) / framing.hop).cast("int")
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(x, i * framing.hop + 1, framing.size))


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)


def rms(x: Column) -> Column:
    return F.sqrt(F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v * v) / F.size(x))


def zero_crossing_rate(x: Column, floor: float = 1e-10) -> Column:
    """Sign changes between neighbours per sample; values within ``floor`` count as zero."""

    def below(v):
        return v < -floor

    n = F.size(x) - 1
    flips = F.zip_with(F.slice(x, F.lit(1), n), F.slice(x, F.lit(2), n), lambda a, b: F.when(below(a) != below(b), 1.0).otherwise(0.0))
    return total(flips) / F.size(x)


def magnitudes(frame: Column) -> Column:
    """Magnitude spectrum of a frame under a periodic Hann window."""

    @F.pandas_udf(_VECTOR)
    def run(batch: pd.Series) -> pd.Series:
        if not len(batch):
            return pd.Series([], dtype=object)
        x = np.stack(batch.to_numpy())
        window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(x.shape[1]) / x.shape[1])
        return pd.Series(list(np.abs(np.fft.rfft(x * window, axis=1))))

    return run(frame)


def project(vector: Column, matrix_of: Callable[[int], np.ndarray], rate: Column) -> Column:
    """Product of each vector with the matrix that belongs to its sample rate."""

    @F.pandas_udf(_VECTOR)
    def run(batch: pd.Series, rates: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(batch), dtype=object)
        for sr, at in rates.groupby(rates).groups.items():
            out.loc[at] = pd.Series(list(np.stack(batch.loc[at].to_numpy()) @ matrix_of(int(sr)).T), index=at, dtype=object)
        return out

    return run(vector, rate)


def frequencies(framing: Framing, sr: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(framing.bins - 1)), lambda k: k * sr / framing.size)


def _mean_at(weights: Column, values: Column) -> Column:
    """Weighted mean; 0 where all weights are 0."""
    return F.coalesce(F.try_divide(total(F.zip_with(weights, values, lambda w, v: w * v)), total(weights)), F.lit(0.0))


def centroid(mag: Column, freq: Column) -> Column:
    return _mean_at(mag, freq)


def bandwidth(mag: Column, freq: Column, center: Column) -> Column:
    return F.sqrt(_mean_at(mag, F.transform(freq, lambda f: (f - center) * (f - center))))


def rolloff(mag: Column, framing: Framing, sr: Column, share: float = 0.85) -> Column:
    """Lowest frequency with at least ``share`` of the summed magnitude at or below it."""
    goal = total(mag) * share
    below = F.aggregate(
        mag,
        F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n")),
        lambda s, m: F.struct((s["sum"] + m).alias("sum"), (s["n"] + F.when(s["sum"] + m < goal, 1).otherwise(0)).alias("n")),
        lambda s: s["n"],
    )
    return below * sr / framing.size


def power_db(power: Column, floor: float = 1e-10) -> Column:
    return F.transform(power, lambda p: 10 * F.log10(F.greatest(p, F.lit(floor))))


# ---- filter matrices --------------------------------------------------------


def _mel(hz):
    """Mel scale: linear below 1 kHz, logarithmic above."""
    hz = np.asarray(hz, dtype=float)
    step, knee = 200.0 / 3, 1000.0
    return np.where(hz < knee, hz / step, knee / step + np.log(np.maximum(hz, knee) / knee) * 27 / np.log(6.4))


def _hz(mel):
    mel = np.asarray(mel, dtype=float)
    step, knee = 200.0 / 3, 15.0
    return np.where(mel < knee, mel * step, 1000.0 * np.exp((mel - knee) * np.log(6.4) / 27))


def mel_matrix(sr: int, size: int, bands: int = 128) -> np.ndarray:
    """Triangular filters of equal area, evenly spaced on the mel scale."""
    bins = np.arange(size // 2 + 1) * sr / size
    edges = _hz(np.linspace(_mel(0.0), _mel(sr / 2), bands + 2))
    low, mid, high = edges[:-2, None], edges[1:-1, None], edges[2:, None]
    triangle = np.minimum((bins - low) / (mid - low), (high - bins) / (high - mid))
    return np.maximum(triangle, 0) * 2 / (high - low)


def chroma_matrix(sr: int, size: int, classes: int = 12) -> np.ndarray:
    """Weight of each bin in each pitch class, C first.

    A bell over the circular distance in pitch classes, as wide as the bin,
    scaled to unit length per bin and damped away from the middle octaves.
    """
    freq = np.arange(1, size // 2 + 2) * sr / size
    pitch = classes * np.log2(freq / 27.5)
    pitch, above = np.r_[pitch[0] - 1.5 * classes, pitch[:-1]], pitch
    width = np.maximum(above - pitch, 1.0)
    turn = (pitch[None, :] - np.arange(classes)[:, None] + classes / 2) % classes - classes / 2
    bell = np.exp(-0.5 * (2 * turn / width) ** 2)
    bell /= np.linalg.norm(bell, axis=0)
    bell *= np.exp(-0.5 * ((pitch / classes - 5.0) / 2.0) ** 2)
    return np.roll(bell, -(classes // 4), axis=0)


def cosine_matrix(bands: int, count: int = 20) -> np.ndarray:
    """Orthonormal cosine transform, first ``count`` rows."""
    k, n = np.arange(count)[:, None], np.arange(bands)[None, :]
    out = np.sqrt(2 / bands) * np.cos(np.pi * k * (2 * n + 1) / (2 * bands))
    out[0] /= np.sqrt(2)
    return out


def harmonic_share(mag: np.ndarray, width: int) -> np.ndarray:
    """Soft mask of the harmonic part of magnitudes (frames x bins); the rest is percussive."""
    along_time = running_median(mag, width) ** 2
    along_freq = running_median(mag.T, width).T ** 2
    both = along_time + along_freq
    return np.divide(along_time, both, out=np.full_like(both, 0.5), where=both > 0)


def running_median(x: np.ndarray, width: int) -> np.ndarray:
    """Median along the first axis over ``width`` rows, fewer at the ends."""
    half, n = width // 2, len(x)
    out = np.empty_like(x)
    for i in range(0, n - 2 * half, 64):  # blocks bound the windowed copy
        rows = x[i : i + 64 + 2 * half]
        view = np.lib.stride_tricks.sliding_window_view(rows, 2 * half + 1, axis=0)
        out[i + half : i + half + len(view)] = np.median(view, axis=-1)
    for i in {*range(min(half, n)), *range(max(n - half, 0), n)}:
        out[i] = np.median(x[max(i - half, 0) : i + half + 1], axis=0)
    return out
