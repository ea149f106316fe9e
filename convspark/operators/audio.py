"""Quality figures of sampled audio."""

from __future__ import annotations

import io
import wave

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def frame_sums(signals: DataFrame, frame: int) -> DataFrame:
    """(meeting_id, frame_no, sum_sq, n) of sample arrays (meeting_id, samples)."""
    k = F.explode(F.sequence(F.lit(0), F.floor((F.size("samples") - 1) / frame).cast("int")))
    part = signals.where(F.size("samples") > 0).select("meeting_id", k.alias("frame_no"), "samples").withColumn("s", F.slice("samples", F.col("frame_no") * frame + 1, frame))
    return part.select("meeting_id", "frame_no", F.aggregate("s", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")).alias("sum_sq"), F.size("s").alias("n"))


#: Columns of ``wav_frames``.
FRAMES = "meeting_id string, frame_no int, sum_sq double, n int, rate int, channels int, width int"


def frame_size(rate: int, frame_ms: int) -> int:
    """Samples of a channel in a frame."""
    return max(1, rate * frame_ms // 1000)


def decode(raw: bytes, channels: int, width: int) -> np.ndarray:
    """Samples of all channels in turn; what a cut file has of a last sample is left out."""
    raw = raw[: len(raw) - len(raw) % (channels * width)]
    if width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        return ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) - ((b[:, 2] >> 7) << 24)).astype(float)
    return np.frombuffer(raw, {1: np.uint8, 2: np.int16, 4: np.int32}[width]).astype(float) - (128 if width == 1 else 0)


def wav_frames(files: DataFrame, frame_ms: int = 30) -> DataFrame:
    """(meeting_id, frame_no, sum_sq, n, rate, channels, width) of PCM files (meeting_id, content); unreadable files give none.

    For files that are held as values, of 2 GB at most; ``sources.wav.wav_frames`` reads files of any length by ranges."""

    def read(batches):
        for pdf in batches:
            out = []
            for meeting, data in zip(pdf["meeting_id"], pdf["content"], strict=True):
                try:
                    with wave.open(io.BytesIO(bytes(data))) as w:
                        rate, channels, width = w.getframerate(), w.getnchannels(), w.getsampwidth()
                        raw = w.readframes(w.getnframes())
                except (wave.Error, EOFError):
                    continue
                size = frame_size(rate, frame_ms) * channels
                sq = decode(raw, channels, width) ** 2
                for k in range(0, len(sq), size):
                    out.append((meeting, k // size, float(sq[k : k + size].sum()), len(sq[k : k + size]), rate, channels, width))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in FRAMES.split(", ")])

    return files.select("meeting_id", "content").mapInPandas(read, FRAMES)


def quality(frames: DataFrame, share: float = 0.08, floor: int = 5, whole: bool = True) -> DataFrame:
    """rms and the share of frames whose rms is at most max(floor, share * rms), of (meeting_id, frame_no, sum_sq, n).

    With ``whole`` rms values and the threshold are cut to whole numbers, as for integer samples. Frames of ``wav_frames``
    give duration_sec (three decimals), channels, sample_rate and sample_width_bytes as well.
    """
    form = [c for c in ("rate", "channels", "width") if c in frames.columns]
    cut = (lambda c: F.floor(c).cast("double")) if whole else (lambda c: c)
    total = frames.groupBy("meeting_id").agg(cut(F.sqrt(F.sum("sum_sq") / F.sum("n"))).alias("rms"), F.sum("n").alias("samples"), *[F.first(c).alias(c) for c in form])
    f = frames.select("meeting_id", cut(F.sqrt(F.col("sum_sq") / F.col("n"))).alias("frame_rms")).join(total, "meeting_id")
    quiet = F.col("frame_rms") <= F.greatest(F.lit(float(floor)), cut(F.col("rms") * share))
    out = f.groupBy("meeting_id", "rms", "samples", *form).agg(F.avg(quiet.cast("double")).alias("silence_ratio"))
    if not form:
        return out
    duration = F.bround(F.col("samples") / F.col("channels") / F.col("rate"), 3)
    return out.select("meeting_id", "rms", "samples", F.bround("silence_ratio", 4).alias("silence_ratio"), duration.alias("duration_sec"), "channels", F.col("rate").alias("sample_rate"), F.col("width").alias("sample_width_bytes"))


def sample_slice(samples: Column, start: Column, end: Column, rate: Column | float) -> Column:
    """Samples from start to end in seconds: from 0 on, one at least."""
    rate = rate if isinstance(rate, Column) else F.lit(rate)
    first = F.floor(F.greatest(F.lit(0.0), start) * rate)
    last = F.floor(F.greatest(F.greatest(F.lit(0.0), start), end) * rate)
    return F.slice(samples, (F.least(first, F.size(samples)) + 1).cast("int"), F.greatest(F.lit(1), last - first).cast("int"))


def wav_files(signals: DataFrame, rate: int) -> DataFrame:
    """(meeting_id, content): 16-bit mono files of whole-number samples (meeting_id, samples)."""

    def write(batches):
        for pdf in batches:
            out = []
            for samples in pdf["samples"]:
                data = io.BytesIO()
                with wave.open(data, "wb") as w:
                    w.setnchannels(1)
                    w.setsampwidth(2)
                    w.setframerate(rate)
                    w.writeframes(np.asarray(samples).astype("<i2").tobytes())
                out.append(data.getvalue())
            yield pd.DataFrame({"meeting_id": pdf["meeting_id"], "content": out})

    return signals.select("meeting_id", "samples").mapInPandas(write, "meeting_id string, content binary")
