"""Chroma audio fingerprints of a media column, and their alignment.

A recording (signed 16-bit samples) becomes frames of twelve pitch classes. Sixteen filters, sums
over rectangles read off an integral image, are cut at two bits each and packed in one integer
for each frame. Two recordings are aligned by the histogram of the offsets at which their integers
agree; at the best offset, the share of differing bits decides.

Recordings with equal fingerprints form a class, and one stands for all. Two classes link if at the offset
where most of their integers agree these are SHARED of the shorter one's integers at least, OVERLAP of the
shorter one lies beside the other, and at most ERRORS of the bits of that overlap differ. So an excerpt
aligns with its recording, and few equal integers make a candidate that the bits decide on. The shorter
class of a link has one of the agreeing integers among its rarest, all but SHARED - 1; only those are joined
with the integers of longer classes. Links are found between classes; each recording gets its class,
its number of links (recordings, its copies included) and its best partner class.

Defined cases: null, empty or too short audio has no fingerprint, is a class of its own and has
no links; silence has a fingerprint like any sound; equal histograms go to the offset of least
size (of those the smaller), equal partners to the smaller id; repeated rows with one id are copies; an
empty table gives no rows; columns not asked for are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize

RATE, FRAME, HOP = 4_000, 1_024, 512
#: Frames that a filter spans at most.
SPAN = 16
#: Shares of the shorter recording's integers that agree and that overlap at the offset of a link, and of bits
#: that may differ there.
SHARED, OVERLAP, ERRORS = 0.15, 0.5, 0.25
_PRINT = "id long, codes array<long>"


def _pitch_classes(frame: int, rate: int) -> np.ndarray:
    """Which of twelve classes each frequency bin belongs to (12 for none)."""
    hertz = np.fft.rfftfreq(frame, 1 / rate)
    out = np.full(len(hertz), 12)
    some = (hertz >= 55) & (hertz <= min(3520, rate / 2))
    out[some] = np.round(12 * np.log2(hertz[some] / 440)).astype(int) % 12
    return out


def chroma(samples: np.ndarray, frame: int = FRAME, hop: int = HOP, rate: int = RATE) -> np.ndarray:
    """Frames x 12 pitch-class energies of unit length."""
    if len(samples) < frame:
        return np.zeros((0, 12))
    frames = np.lib.stride_tricks.sliding_window_view(samples.astype(float), frame)[::hop]
    power = np.abs(np.fft.rfft(frames * np.hanning(frame), axis=1)) ** 2
    classes = _pitch_classes(frame, rate)
    energy = np.stack([power[:, classes == k].sum(1) for k in range(12)], 1)
    length = np.sqrt((energy**2).sum(1, keepdims=True))
    return np.divide(energy, length, out=np.zeros_like(energy), where=length > 1e-9)


def filters() -> list[tuple[int, int, int, int]]:
    """(kind, first pitch class, classes, frames) by rule: kinds of contrast in turn, at four widths."""
    return [(k % 4, 3 * (k // 4), 3 + k % 3, (4, 8, 12, SPAN)[(k + k // 4) % 4]) for k in range(16)]


def fingerprint(image: np.ndarray) -> np.ndarray:
    """Packed 32-bit integers, one for each place where the widest filter fits."""
    n = len(image) - SPAN + 1
    if n < 1:
        return np.zeros(0, np.int64)
    wide = np.hstack([image, image])  # pitch classes wrap around
    integral = np.zeros((wide.shape[0] + 1, wide.shape[1] + 1))
    integral[1:, 1:] = wide.cumsum(0).cumsum(1)
    t = np.arange(n)

    def area(t0, t1, c0: int, c1: int) -> np.ndarray:
        return integral[t1, c1] - integral[t0, c1] - integral[t1, c0] + integral[t0, c0]

    out = np.zeros(n, np.int64)
    for kind, c, high, width in filters():
        half, mid = width // 2, c + (high + 1) // 2
        if kind == 0:
            a, b = area(t, t + width, c, c + high), area(t, t + width, c + 6, c + 6 + high)
        elif kind == 1:
            a, b = area(t, t + half, c, c + high), area(t + half, t + width, c, c + high)
        elif kind == 2:
            a, b = area(t, t + width, c, mid), area(t, t + width, mid, c + high)
        else:
            a = area(t, t + half, c, mid) + area(t + half, t + width, mid, c + high)
            b = area(t, t + half, mid, c + high) + area(t + half, t + width, c, mid)
        value = np.log((a + 1.0) / (b + 1.0))
        level = np.digitize(value, (-0.25, 0.0, 0.25))
        out = (out << 2) | (level ^ (level >> 1))  # neighbours differ in one bit
    return out


def fingerprints(media: DataFrame, id_col: str, audio_col: str) -> DataFrame:
    """id and codes (null without) of each recording (binary, little-endian signed 16-bit samples)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for x in batch.column(1):
                data = x.as_py() or b""
                found = fingerprint(chroma(np.frombuffer(data[: len(data) // 2 * 2], "<i2")))
                codes.append(found.tolist() if len(found) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.list_(pa.int64()))], ["id", "codes"])

    return media.select(F.col(id_col).cast("long").alias("id"), F.col(audio_col).alias("audio")).mapInArrow(run, _PRINT)


def align(prints: DataFrame, shared: float = SHARED, overlap: float = OVERLAP, errors: float = ERRORS) -> DataFrame:
    """id, n_codes, class_id, n_links, best_class, offset (place there less place here) and bit_error of
    each fingerprint."""
    prints = materialize(prints.select("id", "codes", F.xxhash64("codes").alias("sign")))
    some = prints.filter(F.col("codes").isNotNull())
    classes = materialize(some.groupBy("sign", "codes").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("members")))
    n = F.size("codes")
    places = classes.select("class_id", n.alias("n"), F.explode(F.array_distinct("codes")).alias("code"))
    counts = places.groupBy("code").agg(F.count(F.lit(1)).alias("often"))
    # codes of one class only cannot be shared, but they count among the rarest
    counted = materialize(places.join(counts, "code"))
    order = Window.partitionBy("class_id").orderBy("often", "code")
    rare = counted.withColumn("rank", F.row_number().over(order)).filter((F.col("rank") <= F.col("n") - F.ceil(F.col("n") * shared) + 1) & (F.col("often") > 1))
    longer = counted.filter("often > 1").select("code", F.col("class_id").alias("other"), F.col("n").alias("m"))
    pairs = rare.select("code", "class_id", "n").join(longer, "code").filter((F.col("m") > F.col("n")) | (F.col("m") == F.col("n")) & (F.col("other") > F.col("class_id"))).select("class_id", "other").distinct()
    left = classes.select("class_id", F.col("codes").alias("a"))
    right = classes.select(F.col("class_id").alias("other"), F.col("codes").alias("b"))
    both = pairs.join(left, "class_id").join(right, "other")
    # the offset histogram of a pair: how many codes agree at each offset
    agree = F.flatten(F.transform("a", lambda x, i: F.transform(F.filter(F.transform("b", lambda y, j: F.struct(y.alias("y"), j.alias("j"))), lambda z: z["y"] == x), lambda z: z["j"] - i)))
    hits = both.select("class_id", "other", F.explode(agree).alias("offset")).groupBy("class_id", "other", "offset").agg(F.count(F.lit(1)).alias("hits"))
    top = hits.groupBy("class_id", "other").agg(F.max(F.struct("hits", (-F.abs("offset")).alias("near"), (-F.col("offset")).alias("low"))).alias("top")).select("class_id", "other", "top.hits", (-F.col("top.low")).alias("offset"))
    scored = top.join(left, "class_id").filter(F.col("hits") >= F.ceil(F.size("a") * shared)).join(right, "other")
    first = F.greatest(F.lit(0), -F.col("offset"))
    length = F.least(F.size("a") - first, F.size("b") - (first + F.col("offset")))
    bits = F.aggregate(F.zip_with(F.slice("a", first + 1, length), F.slice("b", first + F.col("offset") + 1, length), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    long_enough = length >= F.ceil(F.size("a") * overlap)
    links = materialize(scored.filter(long_enough).withColumn("bit_error", bits / (32.0 * length)).filter(F.col("bit_error") <= errors).select("class_id", "other", "offset", "bit_error"))
    ways = links.unionByName(links.select(F.col("other").alias("class_id"), F.col("class_id").alias("other"), (-F.col("offset")).alias("offset"), "bit_error"))
    sized = ways.join(classes.select(F.col("class_id").alias("other"), "members"), "other")
    best = sized.groupBy("class_id").agg(F.sum("members").alias("beside"), F.min(F.struct("bit_error", F.col("other").alias("best_class"), "offset")).alias("best"))
    by_class = classes.join(best, "class_id", "left").select("sign", "codes", "class_id", (F.col("members") - 1 + F.coalesce("beside", F.lit(0))).alias("n_links"), "best.best_class", "best.offset", "best.bit_error")
    found = some.join(by_class, ["sign", "codes"]).select("id", F.size("codes").cast("long").alias("n_codes"), "class_id", "n_links", "best_class", F.col("offset").cast("long").alias("offset"), "bit_error")
    none = prints.filter(F.col("codes").isNull()).select("id", F.lit(0).cast("long").alias("n_codes"), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("best_class"), F.lit(None).cast("long").alias("offset"), F.lit(None).cast("double").alias("bit_error"))
    return found.unionByName(none)


def tones(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", samples: int = 256, every: int = 10) -> DataFrame:
    """The vectors as recordings: each component is a tone whose pitch follows its value. The test
    tables hold no audio; this gives them a media column. Each recording whose id is divisible by `every` has a
    copy with the id -id - 1, made by rule: it begins 2 to 5 frames later (2 + (id / every) modulo 4), and noise of
    a hundredth to a tenth of full scale is added ((1 + (id / every) modulo 10) hundredths)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = np.arange(samples)
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                ids, audio = [], []
                for i, v in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    x = np.nan_to_num(np.array([e or 0.0 for e in v or ()], float), posinf=0, neginf=0)
                    pitch = 440 * 2 ** (np.clip(np.round(x * 24), -24, 12) / 12)
                    wave = np.sin(2 * np.pi * np.cumsum(np.repeat(pitch, len(t))) / RATE)
                    ids.append(i)
                    audio.append((wave * 20_000).astype("<i2").tobytes())
                    if i is not None and i >= 0 and i % every == 0:
                        j = i // every
                        copy = wave[(2 + j % 4) * HOP :]
                        noise = np.random.default_rng(i).normal(0, (1 + j % 10) / 100, len(copy))
                        ids.append(-i - 1)
                        audio.append((np.clip(copy + noise, -1.5, 1.5) * 20_000).astype("<i2").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(audio, pa.binary())], ["id", "audio"])

    return vectors.select(F.col(id_col).cast("long"), vector_col).mapInArrow(run, "id long, audio binary")
