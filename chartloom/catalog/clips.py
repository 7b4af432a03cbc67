"""Clip features on the embedding vectors: 64 samples at 64 per second."""

from __future__ import annotations

from pyspark.sql import functions as F

from chartloom.catalog import query
from chartloom.catalog.standins import table
from chartloom.functions import signal
from chartloom.functions.signal import Framing
from chartloom.operators import clips as ops
from chartloom.schemas import CLIP_PAIRS, N_MFCC

SR, BANDS, WIDTH = 64, 20, 3
FRAMING = Framing(size=32, hop=16)
BINS = FRAMING.bins


def _clips(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("clip_id"), F.lit(SR).alias("sr"), F.col("embedding").alias("samples")
    )


def _digits(name: str) -> int:
    """Crossing rates are multiples of 1/32, exact in ten digits and often on a tie in five."""
    return 10 if name.startswith("zero_crossing") else 5


def _rounded(*names):
    return [(F.round(n, _digits(n)) + 0.0).alias(n) for n in names]


def _r(expr: str, name: str) -> str:
    return f"round({expr}, {_digits(name)}) + 0.0 AS {name}"


def _pair(expr: str, name: str) -> str:
    return f"{_r(f'avg({expr})', name + '_mean')}, {_r(f'var_pop({expr})', name + '_var')}"


def _values(matrix, row: str, column: str) -> str:
    cells = ", ".join(
        f"({i}, {j}, {v!r}::DOUBLE)" for i, r in enumerate(matrix.tolist()) for j, v in enumerate(r) if v
    )
    return f"(VALUES {cells}) AS t({row}, {column}, w)"


_X = f"""x AS (SELECT vec_id, i - 1 AS i, embedding[i]::DOUBLE AS v FROM (SELECT vec_id, embedding,
    unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)),
slots AS (SELECT vec_id, f AS frame, k, f * {FRAMING.hop} + k - {FRAMING.size // 2} AS i FROM (SELECT vec_id FROM embeddings),
  range(0, {64 // FRAMING.hop + 1}) AS a(f), range(0, {FRAMING.size}) AS b(k)),
fr AS (SELECT s.vec_id, frame, k, coalesce(v, 0) AS v FROM slots s LEFT JOIN x ON s.vec_id = x.vec_id AND s.i = x.i),
ed AS (SELECT s.vec_id, frame, k, v FROM slots s JOIN x ON s.vec_id = x.vec_id AND least(greatest(s.i, 0), 63) = x.i)"""
_SPEC = f"""{_X}, sp AS (SELECT vec_id, frame, bin, sqrt(power(sum(v * w * cos(2 * pi() * bin * k / {FRAMING.size})), 2)
    + power(sum(v * w * sin(2 * pi() * bin * k / {FRAMING.size})), 2)) AS m
  FROM (SELECT *, 0.5 - 0.5 * cos(2 * pi() * k / {FRAMING.size}) AS w FROM fr), range(0, {BINS}) AS b(bin) GROUP BY 1, 2, 3)"""
_HZ = f"bin * {SR / FRAMING.size}"
_SHAPE = f"""{_SPEC}, cen AS (SELECT vec_id, frame, sum({_HZ} * m) / sum(m) AS c FROM sp GROUP BY 1, 2),
bw AS (SELECT vec_id, frame, any_value(c) AS c, sqrt(sum(m * power({_HZ} - c, 2)) / sum(m)) AS b FROM sp JOIN cen USING (vec_id, frame) GROUP BY 1, 2),
ro AS (SELECT vec_id, frame, min({_HZ}) FILTER (run >= 0.85 * tot) AS r FROM (SELECT *, sum(m) OVER (PARTITION BY vec_id, frame ORDER BY bin) AS run,
  sum(m) OVER (PARTITION BY vec_id, frame) AS tot FROM sp) GROUP BY 1, 2)"""
_CHROMA = f"""ch AS (SELECT vec_id, frame, cls, v / max(v) OVER (PARTITION BY vec_id, frame) AS v FROM (
  SELECT vec_id, frame, cls, sum(m * m * w) AS v FROM sp JOIN {_values(signal.chroma_matrix(SR, FRAMING.size), "cls", "bin")} USING (bin) GROUP BY 1, 2, 3))"""
_MEL = f"""mel AS (SELECT vec_id, frame, band, 10 * log10(greatest(coalesce(p, 0), 1e-10)) AS db FROM (SELECT DISTINCT vec_id, frame FROM sp)
  CROSS JOIN range(0, {BANDS}) AS b(band) LEFT JOIN (SELECT vec_id, frame, band, sum(m * m * w) AS p FROM sp
    JOIN {_values(signal.mel_matrix(SR, FRAMING.size, BANDS), "band", "bin")} USING (bin) GROUP BY 1, 2, 3) USING (vec_id, frame, band)),
cutmel AS (SELECT vec_id, frame, band, greatest(db, max(db) OVER (PARTITION BY vec_id) - 80) AS db FROM mel)"""
_MFCC = f"""mf AS (SELECT vec_id, frame, coef, sum(db * w) AS v FROM cutmel
  JOIN {_values(signal.cosine_matrix(BANDS, N_MFCC), "coef", "band")} USING (band) GROUP BY 1, 2, 3)"""
_TEMPO = f"""ons AS (SELECT vec_id, frame, coalesce(sum(greatest(db - prev, 0)) / {BANDS}, 0) AS o FROM (SELECT *,
    lag(db) OVER (PARTITION BY vec_id, band ORDER BY frame) AS prev FROM cutmel) GROUP BY 1, 2),
ac AS (SELECT a.vec_id, b.frame - a.frame AS lag, sum(a.o * b.o) AS p FROM ons a JOIN ons b ON a.vec_id = b.vec_id AND b.frame >= a.frame GROUP BY 1, 2),
tp AS (SELECT vec_id, coalesce(arg_max(bpm, s), 0) AS tempo FROM (SELECT a.vec_id, bpm,
    ln(1 + 1e6 * coalesce(p / nullif(z.p0, 0), 0)) - 0.5 * power(log2(bpm) - log2(120), 2) AS s
    FROM (SELECT *, 60.0 * {SR} / ({FRAMING.hop} * lag) AS bpm FROM ac WHERE lag > 0) a
    JOIN (SELECT vec_id, p AS p0 FROM ac WHERE lag = 0) z ON a.vec_id = z.vec_id WHERE bpm < 320) GROUP BY 1)"""
_HPSS = f"""med AS (SELECT vec_id, frame, bin, m, power(median(m) OVER (PARTITION BY vec_id, bin ORDER BY frame ROWS BETWEEN {WIDTH // 2} PRECEDING AND {WIDTH // 2} FOLLOWING), 2) AS h,
    power(median(m) OVER (PARTITION BY vec_id, frame ORDER BY bin ROWS BETWEEN {WIDTH // 2} PRECEDING AND {WIDTH // 2} FOLLOWING), 2) AS p FROM sp),
hp AS (SELECT vec_id, frame, sum(power(m * h / (h + p), 2)) AS harmony, sum(power(m * p / (h + p), 2)) AS perceptr FROM med GROUP BY 1, 2)"""
# Masked spectra turned back: inverse transform as a join and sum, then overlapped sums.
_SIGNALS = f"""cx AS (SELECT vec_id, frame, bin, sum(v * w * cos(2 * pi() * bin * k / {FRAMING.size})) AS re,
    sum(v * w * sin(2 * pi() * bin * k / {FRAMING.size})) AS im
  FROM (SELECT *, 0.5 - 0.5 * cos(2 * pi() * k / {FRAMING.size}) AS w FROM fr), range(0, {BINS}) AS b(bin) GROUP BY 1, 2, 3),
back AS (SELECT vec_id, frame, k, 0.5 - 0.5 * cos(2 * pi() * k / {FRAMING.size}) AS w, sum(h / (h + p) * turn) AS hy, sum(p / (h + p) * turn) AS py
  FROM (SELECT vec_id, frame, k, h, p, CASE WHEN bin IN (0, {BINS - 1}) THEN 1 ELSE 2 END
      * (re * cos(2 * pi() * bin * k / {FRAMING.size}) + im * sin(2 * pi() * bin * k / {FRAMING.size})) / {FRAMING.size} AS turn
    FROM med JOIN cx USING (vec_id, frame, bin), range(0, {FRAMING.size}) AS a(k)) GROUP BY 1, 2, 3),
sig AS (SELECT vec_id, frame * {FRAMING.hop} + k - {FRAMING.size // 2} AS i, sum(hy * w) / sum(w * w) AS h, sum(py * w) / sum(w * w) AS p
  FROM back GROUP BY 1, 2 HAVING i BETWEEN 0 AND 63),
hp2 AS (SELECT vec_id, h AS harmony, p AS perceptr FROM sig)"""
_RMS = "rm AS (SELECT vec_id, frame, sqrt(avg(v * v)) AS r FROM fr GROUP BY 1, 2)"
_ZCR = f"""zc AS (SELECT vec_id, frame, count_if(flip) / {FRAMING.size}.0 AS z FROM (SELECT vec_id, frame,
  (v < -1e-10) <> lag(v < -1e-10) OVER (PARTITION BY vec_id, frame ORDER BY k) AS flip FROM ed) GROUP BY 1, 2)"""


@query("clip_length", "SELECT vec_id AS clip_id, len(embedding) AS length, 32::BIGINT AS cut_length FROM embeddings")
def clip_length(spark, sf_dir):
    return _clips(spark, sf_dir).select(
        "clip_id",
        F.size("samples").cast("bigint").alias("length"),
        F.size(signal.cut(F.col("samples"), F.col("sr"), 0.5)).cast("bigint").alias("cut_length"),
    )


@query("array_mean_var", f"WITH {_X} SELECT vec_id AS clip_id, {_pair('v', 'samples')} FROM x GROUP BY 1")
def array_mean_var(spark, sf_dir):
    out = ops.array_mean_var(_clips(spark, sf_dir), "clip_id", "samples")
    return out.select("clip_id", *_rounded("samples_mean", "samples_var"))


@query(
    "frames",
    f"""WITH {_X} SELECT fr.vec_id AS clip_id, frame::INTEGER AS frame, count(*) AS size, {_r('sum(fr.v)', 'total')},
  {_r('max(fr.v) FILTER (k = 0)', 'first_sample')} FROM fr GROUP BY 1, 2""",
)
def frames(spark, sf_dir):
    rows = ops.frame_table(_clips(spark, sf_dir), FRAMING).select(
        "clip_id", "frame", F.size("x").cast("bigint").alias("size"), signal.total(F.col("x")).alias("total"),
        F.get("x", F.lit(0)).alias("first_sample"),
    )
    return rows.select("clip_id", "frame", "size", *_rounded("total", "first_sample"))


def _summary(frame_rows, name):
    rows = frame_rows.groupBy("clip_id").agg(*ops.mean_var(F.col(name), name))
    return rows.select("clip_id", *_rounded(f"{name}_mean", f"{name}_var"))


@query("frame_rms", f"WITH {_X}, {_RMS} SELECT vec_id AS clip_id, {_pair('r', 'rms')} FROM rm GROUP BY 1")
def frame_rms(spark, sf_dir):
    rows = ops.frame_table(_clips(spark, sf_dir), FRAMING).select("clip_id", signal.rms(F.col("x")).alias("rms"))
    return _summary(rows, "rms")


@query("frame_zcr", f"WITH {_X}, {_ZCR} SELECT vec_id AS clip_id, {_pair('z', 'zero_crossing_rate')} FROM zc GROUP BY 1")
def frame_zcr(spark, sf_dir):
    rate = signal.zero_crossing_rate(F.col("ends")).alias("zero_crossing_rate")
    return _summary(ops.frame_table(_clips(spark, sf_dir), FRAMING).select("clip_id", rate), "zero_crossing_rate")


@query(
    "spectrum",
    f"WITH {_SPEC} SELECT vec_id AS clip_id, frame::INTEGER AS frame, bin::INTEGER AS bin, {_r('m', 'magnitude')} FROM sp",
)
def spectrum(spark, sf_dir):
    spec = ops.spectra(_clips(spark, sf_dir), FRAMING)
    return spec.select("clip_id", "frame", F.posexplode("mag").alias("bin", "magnitude")).select(
        "clip_id", "frame", "bin", *_rounded("magnitude")
    )


def _shapes(spark, sf_dir):
    return ops.spectral_shape(ops.spectra(_clips(spark, sf_dir), FRAMING), FRAMING)


@query("spectral_centroid", f"WITH {_SHAPE} SELECT vec_id AS clip_id, {_pair('c', 'spectral_centroid')} FROM cen GROUP BY 1")
def spectral_centroid(spark, sf_dir):
    return _summary(_shapes(spark, sf_dir), "spectral_centroid")


@query("spectral_bandwidth", f"WITH {_SHAPE} SELECT vec_id AS clip_id, {_pair('b', 'spectral_bandwidth')} FROM bw GROUP BY 1")
def spectral_bandwidth(spark, sf_dir):
    return _summary(_shapes(spark, sf_dir), "spectral_bandwidth")


@query("spectral_rolloff", f"WITH {_SHAPE} SELECT vec_id AS clip_id, {_pair('r', 'rolloff')} FROM ro GROUP BY 1")
def spectral_rolloff(spark, sf_dir):
    return _summary(_shapes(spark, sf_dir), "rolloff")


@query("chroma", f"WITH {_SPEC}, {_CHROMA} SELECT vec_id AS clip_id, {_pair('v', 'chroma_stft')} FROM ch GROUP BY 1")
def chroma(spark, sf_dir):
    rows = ops.chroma_moments(ops.add_chroma(ops.spectra(_clips(spark, sf_dir), FRAMING), FRAMING))
    out = rows.groupBy("clip_id").agg(*ops.chroma_mean_var())
    return out.select("clip_id", *_rounded("chroma_stft_mean", "chroma_stft_var"))


def _coefficients():
    return [f"mfcc{i}_{s}" for i in range(1, N_MFCC + 1) for s in ("mean", "var")]


_MF_WIDE = ", ".join(
    f"{_r(f'avg(v) FILTER (coef = {i})', f'mfcc{i + 1}_mean')}, {_r(f'var_pop(v) FILTER (coef = {i})', f'mfcc{i + 1}_var')}"
    for i in range(N_MFCC)
)


def _neighbours(spark, sf_dir):
    spec = ops.add_mel(ops.spectra(_clips(spark, sf_dir), FRAMING), FRAMING, BANDS).drop("mag")
    return ops.add_neighbours(ops.by_clip(spec), BANDS)


@query("mfcc", f"WITH {_SPEC}, {_MEL}, {_MFCC} SELECT vec_id AS clip_id, {_MF_WIDE} FROM mf GROUP BY 1")
def mfcc(spark, sf_dir):
    aggs = [a for i in range(N_MFCC) for a in ops.mean_var(F.get("mfcc", F.lit(i)), f"mfcc{i + 1}")]
    return ops.add_mfcc(_neighbours(spark, sf_dir), BANDS).groupBy("clip_id").agg(*aggs).select("clip_id", *_rounded(*_coefficients()))


@query("tempo", f"WITH {_SPEC}, {_MEL}, {_TEMPO} SELECT vec_id AS clip_id, {_r('tempo', 'tempo')} FROM tp")
def tempo(spark, sf_dir):
    listed = F.array_sort(F.collect_list(F.struct("frame", "onset")))
    rows = _neighbours(spark, sf_dir).groupBy("clip_id", "sr").agg(listed.alias("o"))
    rows = rows.withColumn("env", F.transform("o", lambda x: x["onset"]))
    return rows.withColumn("tempo", ops.tempo_of(F.col("env"), F.col("sr"), FRAMING.hop)).select("clip_id", *_rounded("tempo"))


@query(
    "hpss_energy",
    f"WITH {_SPEC}, {_HPSS} SELECT vec_id AS clip_id, {_pair('harmony', 'harmony')}, {_pair('perceptr', 'perceptr')} FROM hp GROUP BY 1",
)
def hpss_energy(spark, sf_dir):
    parts = ops.add_parts(ops.by_clip(ops.spectra(_clips(spark, sf_dir), FRAMING)), WIDTH)
    out = parts.groupBy("clip_id").agg(*ops.mean_var(F.col("harmony"), "harmony"), *ops.mean_var(F.col("perceptr"), "perceptr"))
    return out.select("clip_id", *_rounded("harmony_mean", "harmony_var", "perceptr_mean", "perceptr_var"))


@query(
    "hpss_signals",
    f"WITH {_SPEC}, {_HPSS}, {_SIGNALS} SELECT vec_id AS clip_id, i::INTEGER AS i, {_r('h', 'harmonic')}, {_r('p', 'percussive')} FROM sig",
)
def hpss_signals(spark, sf_dir):
    """The two signals, sample by sample; a block holds two of the five frames."""
    parts = ops.harmonic_percussive(_clips(spark, sf_dir), FRAMING, WIDTH, frames=2)
    rows = parts.select("clip_id", "at", F.posexplode(F.arrays_zip("harmonic", "percussive")).alias("k", "s"))
    return rows.select("clip_id", (F.col("at") + F.col("k")).alias("i"), F.col("s.harmonic"), F.col("s.percussive")).select(
        "clip_id", "i", *_rounded("harmonic", "percussive")
    )


@query(
    "hpss_moments",
    f"WITH {_SPEC}, {_HPSS}, {_SIGNALS} SELECT vec_id AS clip_id, {_pair('harmony', 'harmony')}, {_pair('perceptr', 'perceptr')} FROM hp2 GROUP BY 1",
)
def hpss_moments(spark, sf_dir):
    out = ops.signal_moments(ops.harmonic_percussive(_clips(spark, sf_dir), FRAMING, WIDTH, frames=3))
    return out.select("clip_id", *_rounded("harmony_mean", "harmony_var", "perceptr_mean", "perceptr_var"))


_PARTS = {
    "chroma_stft": ("ch", "v"), "rms": ("rm", "r"), "spectral_centroid": ("cen", "c"), "spectral_bandwidth": ("bw", "b"),
    "rolloff": ("ro", "r"), "zero_crossing_rate": ("zc", "z"), "harmony": ("hp2", "harmony"), "perceptr": ("hp2", "perceptr"),
}
_JOINED = " ".join(
    f"JOIN (SELECT vec_id, {_pair(_PARTS[n][1], n)} FROM {_PARTS[n][0]} GROUP BY 1) USING (vec_id)" for n in CLIP_PAIRS
)
_PAIR_NAMES = ", ".join(f"{n}_mean, {n}_var" for n in CLIP_PAIRS)


@query(
    "feature_row",
    f"""WITH {_SHAPE}, {_CHROMA}, {_MEL}, {_MFCC}, {_TEMPO}, {_HPSS}, {_SIGNALS}, {_RMS}, {_ZCR}
SELECT CAST(vec_id AS VARCHAR) AS filename, 64::BIGINT AS length, {_PAIR_NAMES}, {_r('tempo', 'tempo')},
  {", ".join(_coefficients())}, '' AS label
FROM tp {_JOINED} JOIN (SELECT vec_id, {_MF_WIDE} FROM mf GROUP BY 1) USING (vec_id)""",
)
def feature_row(spark, sf_dir):
    out = ops.feature_rows(_clips(spark, sf_dir), FRAMING, BANDS, WIDTH)
    return out.select("filename", "length", *_rounded(*[f"{n}_{s}" for n in CLIP_PAIRS for s in ("mean", "var")]),
                      *_rounded("tempo"), *_rounded(*_coefficients()), "label")
