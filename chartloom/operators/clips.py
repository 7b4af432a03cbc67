"""Clip features: frame tables and their per-clip summaries.

A clip is one row of samples.  It is spread over rows of frames; everything per
frame is column work without an exchange, and the summaries are aggregates that
combine map-side.  Where frames need their neighbours (onsets, the clip's peak,
moving medians) the frame rows are hash-partitioned by clip once; the window and
the grouped step that follow share that exchange.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartloom.functions import signal
from chartloom.functions.signal import Framing
from chartloom.schemas import FEATURE_HEADER, N_MFCC

MAX_TEMPO, START_TEMPO = 320.0, 120.0


def mean_var(c: Column, name: str) -> list[Column]:
    """Mean and population variance."""
    return [F.avg(c).alias(f"{name}_mean"), F.var_pop(c).alias(f"{name}_var")]


def by_clip(frames: DataFrame) -> DataFrame:
    """Hash-partition by clip.  The number is given, so that AQE does not merge
    small-looking partitions ahead of the heavy work on them."""
    spark = frames.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return frames.repartition(n, "clip_id")


def array_mean_var(clips: DataFrame, key: str, samples: str) -> DataFrame:
    """Mean and population variance of each array, within its row."""
    x = F.col(samples).cast("array<double>")
    rows = clips.select(key, x.alias("__x")).filter(F.size("__x") > 0)
    rows = rows.withColumn(f"{samples}_mean", signal.total(F.col("__x")) / F.size("__x"))
    apart = F.transform("__x", lambda v: (v - F.col(f"{samples}_mean")) * (v - F.col(f"{samples}_mean")))
    return rows.select(key, f"{samples}_mean", (signal.total(apart) / F.size("__x")).alias(f"{samples}_var"))


def frame_table(clips: DataFrame, framing: Framing) -> DataFrame:
    """(clip_id, sr, length, frame, x, ends): zero-padded and end-padded frames."""
    both = F.arrays_zip(
        signal.frames(F.col("samples"), framing).alias("x"), signal.frames(F.col("samples"), framing, edge=True).alias("ends")
    )
    rows = clips.select("clip_id", "sr", F.size("samples").cast("bigint").alias("length"), F.posexplode(both).alias("frame", "__f"))
    return rows.select("clip_id", "sr", "length", "frame", F.col("__f.x").alias("x"), F.col("__f.ends").alias("ends"))


def spectra(clips: DataFrame, framing: Framing) -> DataFrame:
    """Frame table with energies and the magnitude spectrum."""
    return frame_table(clips, framing).select(
        "clip_id",
        "sr",
        "length",
        "frame",
        signal.rms(F.col("x")).alias("rms"),
        signal.zero_crossing_rate(F.col("ends")).alias("zero_crossing_rate"),
        signal.magnitudes(F.col("x")).alias("mag"),
    )


def spectral_shape(spec: DataFrame, framing: Framing, share: float = 0.85) -> DataFrame:
    """Adds centroid, bandwidth and roll-off of each frame."""
    freq = signal.frequencies(framing, F.col("sr"))
    return (
        spec.withColumn("spectral_centroid", signal.centroid(F.col("mag"), freq))
        .withColumn("spectral_bandwidth", signal.bandwidth(F.col("mag"), freq, F.col("spectral_centroid")))
        .withColumn("rolloff", signal.rolloff(F.col("mag"), framing, F.col("sr"), share))
    )


def add_chroma(spec: DataFrame, framing: Framing) -> DataFrame:
    """Pitch-class energies of each frame, the largest scaled to 1."""
    raw = spec.withColumn("__power", F.transform("mag", lambda m: m * m)).withColumn(
        "__raw", signal.project(F.col("__power"), lambda sr: signal.chroma_matrix(sr, framing.size), F.col("sr"))
    )
    top = F.array_max("__raw")
    scaled = F.transform("__raw", lambda v: F.when(top > 0, v / top).otherwise(0.0))
    return raw.withColumn("chroma", scaled).drop("__power", "__raw")


def add_mel(spec: DataFrame, framing: Framing, bands: int) -> DataFrame:
    """Mel band powers of each frame in dB."""
    power = F.transform("mag", lambda m: m * m)
    levels = signal.project(power, lambda sr: signal.mel_matrix(sr, framing.size, bands), F.col("sr"))
    return spec.withColumn("mel_db", signal.power_db(levels))


def add_neighbours(mel: DataFrame, bands: int, top_db: float = 80.0) -> DataFrame:
    """Band levels cut at ``top_db`` under the clip's peak, and onset strength:
    the mean rise over the bands from one frame to the next."""
    clip = W.partitionBy("clip_id")
    along = clip.orderBy("frame")
    # The ordered window first: its sort also serves the one over the whole clip.
    placed = mel.withColumn("__prev", F.lag("mel_db").over(along)).withColumn(
        "__floor", F.max(F.array_max("mel_db")).over(clip) - top_db
    )

    def cut(c):
        return F.transform(c, lambda v: F.greatest(v, F.col("__floor")))

    rise = F.zip_with(cut("mel_db"), cut("__prev"), lambda a, b: F.greatest(a - b, F.lit(0.0)))
    return (
        placed.withColumn("onset", F.coalesce(signal.total(rise) / bands, F.lit(0.0)))
        .withColumn("mel_db", cut("mel_db"))
        .drop("__floor", "__prev")
    )


def add_mfcc(cut_mel: DataFrame, bands: int) -> DataFrame:
    turned = signal.project(F.col("mel_db"), lambda sr: signal.cosine_matrix(bands, N_MFCC), F.col("sr"))
    return cut_mel.withColumn("mfcc", turned).drop("mel_db")


def add_parts(spec: DataFrame, width: int = 31) -> DataFrame:
    """Energy of the harmonic and the percussive part of each frame.

    Moving medians along time and along frequency give two soft masks.  A group
    holds the frames of one clip, whose length the ``duration`` cut bounds.
    """
    extra = spec.drop("mag")
    schema = ", ".join(f"{n} {t}" for n, t in extra.dtypes) + ", harmony double, perceptr double"

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame")
        mag = np.stack(pdf["mag"].to_numpy())
        share = signal.harmonic_share(mag, width)
        return pdf.drop(columns="mag").assign(
            harmony=((share * mag) ** 2).sum(axis=1), perceptr=(((1 - share) * mag) ** 2).sum(axis=1)
        )

    return spec.groupBy("clip_id").applyInPandas(split, schema)


def clip_blocks(clips: DataFrame, framing: Framing, frames: int, before: int, after: int) -> DataFrame:
    """(clip_id, length, total, own, low, high, at, x): a clip in blocks of ``frames`` frames with margins.

    A block owns the frames from ``own`` on; x are the samples, from ``at`` on, that its
    frames from ``low`` to ``high`` (exclusive) see: its own, ``before`` earlier and
    ``after`` later ones.  ``total`` counts the clip's frames.
    """
    pad = framing.size // 2 if framing.center else 0
    n = F.size("samples")
    total = F.greatest(F.floor((n + 2 * pad - framing.size) / framing.hop).cast("int") + 1, F.lit(0))

    def block(own: Column) -> Column:
        low, high = F.greatest(own - before, F.lit(0)), F.least(own + frames + after, F.col("total"))
        at = F.greatest(low * framing.hop - pad, F.lit(0))
        end = F.least((high - 1) * framing.hop + framing.size - pad, F.col("length"))
        x = F.slice(F.col("samples").cast("array<double>"), at + 1, F.greatest(end - at, F.lit(0)))
        return F.struct(own.alias("own"), low.alias("low"), high.alias("high"), at.alias("at"), x.alias("x"))

    rows = clips.select("clip_id", "samples", n.alias("length"), total.alias("total")).filter("total > 0")
    starts = F.sequence(F.lit(0), F.col("total") - 1, F.lit(frames))
    return rows.select("clip_id", "length", "total", F.explode(F.transform(starts, block)).alias("b")).select(
        "clip_id", "length", "total", "b.*"
    )


def _overlapped(frames: np.ndarray, hop: int) -> np.ndarray:
    """Frames added up at their places."""
    out = np.zeros((len(frames) - 1) * hop + frames.shape[1])
    for i, frame in enumerate(frames):
        out[i * hop : i * hop + len(frame)] += frame
    return out


def harmonic_percussive(clips: DataFrame, framing: Framing, width: int = 31, frames: int = 256) -> DataFrame:
    """(clip_id, at, harmonic, percussive): the two signals of each clip, in blocks of samples from ``at`` on.

    Complex spectra are masked by moving medians along time and along frequency and
    turned back: inverse transform, window, overlapped sum over the sum of squared
    windows.  Blocks are worked on apart, with margins that hold every frame their
    samples need, so a clip of any length is exact and takes bounded memory; no frame
    is exchanged.
    """
    size, hop = framing.size, framing.hop
    pad, half = (size // 2 if framing.center else 0), width // 2
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    cut = clip_blocks(clips, framing, frames, half + -(-size // hop) - 1, half)

    def parts(length, total, own, low, high, at, x):
        padded = np.zeros((high - low - 1) * hop + size)
        skip = at - (low * hop - pad)
        padded[skip : skip + len(x)] = x
        spectra = np.fft.rfft(np.lib.stride_tricks.sliding_window_view(padded, size)[::hop] * window, axis=1)
        share = signal.harmonic_share(np.abs(spectra), width)
        weight = _overlapped(np.broadcast_to(window**2, (high - low, size)), hop)
        first = max(own * hop, pad)
        last = length + pad if own + frames >= total else min((own + frames) * hop, length + pad)
        here = slice(first - low * hop, last - low * hop)
        for mask in (share, 1 - share):
            turned = _overlapped(np.fft.irfft(spectra * mask, n=size, axis=1) * window, hop)[here]
            w = weight[here]
            yield np.divide(turned, w, out=turned, where=w > np.finfo(np.float32).tiny)

    def run(batches):
        for batch in batches:
            rows = []
            for _, length, total, own, low, high, at, x in zip(*batch.columns):
                numbers = [v.as_py() for v in (length, total, own, low, high, at)]
                rows.append((max(numbers[2] * hop - pad, 0), *parts(*numbers, x.values.to_numpy(zero_copy_only=False))))
            doubles = pa.list_(pa.float64())
            columns = [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], doubles) for i in (1, 2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["clip_id", "at", "harmonic", "percussive"])

    kind = clips.schema["clip_id"].dataType.simpleString()
    return cut.mapInArrow(run, f"clip_id {kind}, at int, harmonic array<double>, percussive array<double>")


def signal_moments(parts: DataFrame) -> DataFrame:
    """Mean and variance of both signals per clip: sums per block, then merged."""
    sums = [F.sum(F.size("harmonic")).alias("n")]
    for name in ("harmonic", "percussive"):
        sums += [
            F.sum(signal.total(F.col(name))).alias(f"{name}1"),
            F.sum(F.aggregate(name, F.lit(0.0), lambda acc, v: acc + v * v)).alias(f"{name}2"),
        ]
    rows = parts.groupBy("clip_id").agg(*sums)
    out = ["clip_id"]
    for name, into in (("harmonic", "harmony"), ("percussive", "perceptr")):
        mean, square = (F.coalesce(F.try_divide(F.col(f"{name}{i}"), F.col("n")), F.lit(0.0)) for i in (1, 2))
        out += [mean.alias(f"{into}_mean"), F.greatest(square - mean * mean, F.lit(0.0)).alias(f"{into}_var")]
    return rows.select(*out)


def tempo_of(onsets: Column, sr: Column, hop: int, spread: float = 1.0, longest: float = 8.0) -> Column:
    """Tempo of an onset array: autocorrelation weighted towards the start tempo.

    ``longest`` is the longest period looked at, in seconds.
    """
    n = F.size(onsets)

    def product(lag):
        ahead = F.slice(onsets, lag + 1, n - lag)
        return signal.total(F.zip_with(F.slice(onsets, F.lit(1), n - lag), ahead, lambda a, b: a * b))

    def scored(lag):
        bpm = 60.0 * sr / (hop * lag)
        match = F.coalesce(F.try_divide(product(lag), product(F.lit(0))), F.lit(0.0))
        octaves = (F.log2(bpm) - F.log2(F.lit(START_TEMPO))) / spread
        return F.when(bpm < MAX_TEMPO, F.struct((F.log1p(match * 1e6) - 0.5 * octaves * octaves).alias("s"), (-lag).alias("l"), bpm.alias("bpm")))

    lags = F.when(n >= 2, F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(n - 1, F.floor(sr * longest / hop).cast("int"))))).otherwise(F.array().cast("array<int>"))
    best = F.array_max(F.transform(lags, scored))
    return F.coalesce(best["bpm"], F.lit(0.0))


def summarise(frames: DataFrame, hop: int) -> DataFrame:
    """One row per clip with the values that the frame columns give."""
    scalars = ["rms", "spectral_centroid", "spectral_bandwidth", "rolloff", "zero_crossing_rate"]
    aggs = [F.max("length").alias("length"), F.max("sr").alias("__sr")]
    for name in scalars:
        aggs += mean_var(F.col(name), name)
    aggs += chroma_mean_var()
    for i in range(N_MFCC):
        aggs += mean_var(F.get("mfcc", F.lit(i)), f"mfcc{i + 1}")
    aggs.append(F.array_sort(F.collect_list(F.struct("frame", "onset"))).alias("__onsets"))
    rows = frames.groupBy("clip_id").agg(*aggs)
    onsets = F.transform("__onsets", lambda o: o["onset"])
    return rows.withColumn("__env", onsets).withColumn("tempo", tempo_of(F.col("__env"), F.col("__sr"), hop)).drop("__env", "__onsets", "__sr")


def chroma_moments(frames: DataFrame) -> DataFrame:
    """The chroma array of a frame reduced to its mean and its mean square."""
    n = F.size("chroma")
    square = F.aggregate("chroma", F.lit(0.0), lambda acc, v: acc + v * v)
    return frames.withColumns({"chroma_m1": signal.total(F.col("chroma")) / n, "chroma_m2": square / n}).drop("chroma")


def chroma_mean_var() -> list[Column]:
    """Over all frames and classes at once; every frame has the same number of classes."""
    mean = F.avg("chroma_m1")
    return [mean.alias("chroma_stft_mean"), (F.avg("chroma_m2") - mean * mean).alias("chroma_stft_var")]


def feature_rows(
    clips: DataFrame,
    framing: Framing = Framing(),
    bands: int = 128,
    width: int = 31,
    duration: float | None = 30.0,
    label: str = "",
) -> DataFrame:
    """Wide feature row per clip (clip_id, sr, samples), in the fixed header order.

    Exchanges: the frames' levels by clip, then partial summaries and the moments of
    the harmonic and percussive signals, each a row per clip; spectra are not exchanged.
    """
    rows = clips
    if duration is not None:
        rows = rows.withColumn("samples", signal.cut(F.col("samples"), F.col("sr"), duration))
    spec = spectral_shape(spectra(rows, framing), framing)
    levels = add_mel(chroma_moments(add_chroma(spec, framing)), framing, bands)
    full = add_mfcc(add_neighbours(by_clip(levels.drop("mag")), bands), bands)
    out = summarise(full, framing.hop).join(signal_moments(harmonic_percussive(rows, framing, width)), "clip_id")
    out = out.withColumn("filename", F.col("clip_id").cast("string")).withColumn("label", F.lit(label))
    return out.select(*FEATURE_HEADER)
