import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartloom.functions import signal
from chartloom.functions.signal import Framing
from chartloom.operators import clips
from chartloom.schemas import AUDIO_FIELDS, FEATURE_HEADER, ordered_values

SR = 8000
SMALL = Framing(size=256, hop=64)


def frame(spark, **samples):
    rows = [(k, SR, [float(v) for v in x]) for k, x in samples.items()]
    return spark.createDataFrame(rows, "clip_id string, sr int, samples array<float>")


def tone(hz, n=4000):
    return np.sin(2 * np.pi * hz * np.arange(n) / SR)


@pytest.fixture(scope="module")
def rows(spark):
    impulse = np.zeros(4000)
    impulse[2000] = 1.0
    beat = np.zeros(SR * 8)
    beat[:: SR // 2] = 1.0
    data = frame(spark, silence=np.zeros(4000), impulse=impulse, sine=tone(1000), short=[0.5] * 10, empty=[], beat=beat)
    # The median is wider than the three bins a tone fills under the window.
    out = clips.feature_rows(data, SMALL, bands=40, width=15, duration=None).collect()
    return {r.filename: r for r in out}


def test_header(rows):
    assert set(rows) == {"silence", "impulse", "sine", "short", "empty", "beat"}
    assert list(rows["sine"].asDict()) == FEATURE_HEADER
    assert len(AUDIO_FIELDS) == 58 and rows["short"].length == 10 and rows["sine"].label == ""


def test_silence(rows):
    r = rows["silence"]
    for name in ("rms", "spectral_centroid", "spectral_bandwidth", "rolloff", "zero_crossing_rate", "chroma_stft", "harmony", "perceptr"):
        assert r[f"{name}_mean"] == 0 and r[f"{name}_var"] == 0
    assert r.mfcc1_mean == pytest.approx(-100 * math.sqrt(40)) and r.mfcc2_mean == pytest.approx(0, abs=1e-9)


def test_sine(rows):
    r = rows["sine"]
    assert r.spectral_centroid_mean == pytest.approx(1000, rel=0.1)
    assert r.zero_crossing_rate_mean == pytest.approx(2 * 1000 / SR, rel=0.05)
    assert r.rms_mean == pytest.approx(math.sqrt(0.5), rel=0.05)
    assert r.harmony_var > 5 * r.perceptr_var


def test_impulse(rows):
    r = rows["impulse"]
    assert r.perceptr_var > 5 * r.harmony_var
    assert r.rms_mean > 0


def test_beat(rows):
    assert rows["beat"].tempo == pytest.approx(120, rel=0.05)


def test_pitch_class(spark):
    spec = clips.add_chroma(clips.spectra(frame(spark, a=tone(440, 8000)), Framing(size=2048, hop=512)), Framing(2048, 512))
    middle = spec.filter("frame = 8").first()
    assert int(np.argmax(middle.chroma)) == 9 and max(middle.chroma) == pytest.approx(1.0)


def test_frames_match_numpy(spark):
    x = np.random.default_rng(1).normal(size=1000)
    got = clips.frame_table(frame(spark, a=x), SMALL).orderBy("frame").collect()
    padded = np.pad(x.astype("float32"), 128)
    want = np.lib.stride_tricks.sliding_window_view(padded, 256)[::64]
    assert np.allclose([r.x for r in got], want)
    edge = np.lib.stride_tricks.sliding_window_view(np.pad(x.astype("float32"), 128, mode="edge"), 256)[::64]
    assert np.allclose([r.ends for r in got], edge)
    plain = frame(spark, a=x).select(signal.frames(F.col("samples"), Framing(256, 64, center=False)).alias("f")).first().f
    assert len(plain) == 1 + (1000 - 256) // 64
    mags = clips.spectra(frame(spark, a=x), SMALL).orderBy("frame").collect()
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(256) / 256)
    assert np.allclose([r.mag for r in mags], np.abs(np.fft.rfft(want * window)), atol=1e-5)


def test_cut(value):
    assert value(lambda x, s: signal.cut(x, s, 0.5), [1.0, 2.0, 3.0], 4, types=["array<float>", "int"]) == [1.0, 2.0]


def test_running_median():
    x = np.random.default_rng(2).normal(size=(150, 3))
    for width in (1, 5, 31, 301):
        h = width // 2
        want = np.array([np.median(x[max(i - h, 0) : i + h + 1], axis=0) for i in range(len(x))])
        assert np.allclose(signal.running_median(x, width), want)


def test_matrices():
    mel = signal.mel_matrix(22050, 2048)
    assert mel.shape == (128, 1025) and (mel >= 0).all() and (mel.sum(axis=1) > 0).all()
    dct = signal.cosine_matrix(40, 40)
    assert np.allclose(dct @ dct.T, np.eye(40))


def test_ordered_values(spark):
    df = spark.createDataFrame([((1.0, 2.0),)], "s struct<a:double,b:double>")
    assert df.select(ordered_values(F.col("s"), ["b", "a"]).alias("v")).first().v == [2.0, 1.0]


def signals(spark, data, frames):
    rows = clips.harmonic_percussive(data, SMALL, 9, frames).collect()
    out = {}
    for r in sorted(rows, key=lambda r: r["at"]):
        h, p = out.setdefault(r.clip_id, ([], []))
        assert r["at"] == len(h)  # blocks join without gaps or double samples
        h += r.harmonic
        p += r.percussive
    return out


def test_harmonic_and_percussive_signals(spark):
    """Cut into blocks of any size the signals are those of the whole clip, and together they are the input."""
    rng = np.random.default_rng(2)
    inputs = {"noise": rng.normal(size=7001), "mixed": tone(500, 5000) + (np.arange(5000) % 997 == 0), "short": [0.5] * 10, "empty": []}
    data = frame(spark, **inputs)
    whole = signals(spark, data, 10**6)
    for frames in (1, 7, 32):
        cut = signals(spark, data, frames)
        assert set(cut) == set(inputs)
        for name in inputs:
            for a, b in zip(cut[name], whole[name]):
                np.testing.assert_allclose(a, b, atol=1e-9)
    for name, x in inputs.items():
        np.testing.assert_allclose(np.add(*whole[name]), np.array(x, np.float32), atol=1e-6)


def test_clip_blocks_hold_their_frames_only(spark):
    blocks = clips.clip_blocks(frame(spark, a=np.arange(100_000)), SMALL, 64, 7, 4).collect()
    assert max(len(r.x) for r in blocks) <= (64 + 7 + 4) * SMALL.hop + SMALL.size
    assert sorted(r.own for r in blocks) == list(range(0, blocks[0].total, 64))


def test_signals_exchange_no_spectra(spark):
    parts = clips.signal_moments(clips.harmonic_percussive(frame(spark, a=tone(300)), SMALL))
    text = parts._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "FlatMapGroups" not in text
