"""WAV files of any length: a data source that reads ranges of frames, and a writer."""

from __future__ import annotations

import io
import re
import uuid
import wave

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.audio import FRAMES, decode, frame_size

#: Bytes that opening a file counts for when small files are put together.
OPEN_COST = 1 << 20
#: Bytes of samples that a task holds at a time.
PIECE = 4 << 20
#: Bytes, with what opening costs, that short parts fill in a task.
TASK = 256 << 20


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    local = re.fullmatch(r"file:(?://)?(/.*)", path)
    if local or "://" not in path:
        return fs.LocalFileSystem(), local[1] if local else path
    return fs.FileSystem.from_uri(path)


class Ranges(InputPartition):
    """Parts of files (path, part, parts): frames from part / parts of the file's frames on, up to the next part's."""

    def __init__(self, parts: list[tuple[str, int, int]]):
        super().__init__(None)
        self.parts = parts


def ranges(sizes: list[tuple[str, int]], part_bytes: int, tasks: int | None = None) -> list[Ranges]:
    """Long files are cut into parts of at most ``part_bytes``; small ones share a partition.

    With ``tasks`` short parts share one as well: each of about so many gets its share, up to ``TASK`` bytes, so that
    partitions are as few as the work allows, however short the parts are. Each part costs an opened file.
    """
    cut = [(path, k, n, -(-size // n) + OPEN_COST) for path, size in sizes for n in (max(1, -(-size // part_bytes)),) for k in range(n)]
    limit = max(part_bytes, min(TASK, -(-sum(c for *_, c in cut) // tasks))) if tasks else part_bytes
    out, held, room = [], [], limit
    for path, k, n, cost in cut:
        if held and cost > room:
            out.append(Ranges(held))
            held, room = [], limit
        held.append((path, k, n))
        room -= cost
    return [*out, Ranges(held)] if held else out


class WavReader(DataSourceReader):
    def __init__(self, path: str, frame_ms: int, part_bytes: int, tasks: int | None = None):
        self.path, self.frame_ms, self.part_bytes, self.tasks = path, frame_ms, part_bytes, tasks

    def partitions(self):
        files, at = store(self.path)
        info = files.get_file_info(at)
        found = [info] if info.type == fs.FileType.File else files.get_file_info(fs.FileSelector(at, recursive=True))
        sizes = sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(".wav"))
        return ranges(sizes, self.part_bytes, self.tasks) or [Ranges([])]

    def read(self, partition):
        files, _ = store(self.path)
        for path, part, parts in partition.parts:
            meeting = re.search(r"([^/]+?)(?:\.Mix-Headset)?\.wav$", path)[1]
            with files.open_input_file(path) as f:
                try:
                    w = wave.open(f)
                except (wave.Error, EOFError):
                    continue
                rate, channels, width = w.getframerate(), w.getnchannels(), w.getsampwidth()
                size = frame_size(rate, self.frame_ms)
                frames = -(-w.getnframes() // size)
                first, end = frames * part // parts, frames * (part + 1) // parts
                step = max(1, PIECE // (size * channels * width))
                for k in range(first, end, step):
                    w.setpos(k * size)
                    s = decode(w.readframes(min(step, end - k) * size), channels, width)
                    if not len(s):
                        break
                    starts = np.arange(0, len(s), size * channels)
                    n = len(starts)
                    sums = np.add.reduceat(s * s, starts)
                    columns = [pa.array([meeting] * n), pa.array(np.arange(k, k + n, dtype=np.int32)), pa.array(sums), pa.array(np.diff(np.r_[starts, len(s)]).astype(np.int32)), *(pa.array(np.full(n, x, np.int32)) for x in (rate, channels, width))]
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in FRAMES.split(", ")])


class WavFrames(DataSource):
    """``spark.read.format("wav_frames").option("frame_ms", 30).load(path)``: the rows of ``audio.wav_frames`` for all ``.wav``
    files below a folder, or one file. A file of any length is read by ranges of frames in many tasks, each of which holds
    a few MB; ``part_bytes`` (64 MB) is what is read as one part, and ``tasks`` over how many tasks short parts are dealt.
    Files that aren't PCM give no rows."""

    @classmethod
    def name(cls):
        return "wav_frames"

    def schema(self):
        return FRAMES

    def reader(self, schema):
        return WavReader(self.options["path"], int(self.options.get("frame_ms", "30")), int(self.options.get("part_bytes", str(64 << 20))), int(self.options.get("tasks", "0")) or None)


def wav_frames(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(WavFrames)
    return spark.read.format("wav_frames").options(**{"tasks": 4 * spark.sparkContext.defaultParallelism, **options}).load(path)


def write_wav(signals: DataFrame, path: str, rate: int) -> int:
    """Writes (meeting_id, samples) as ``<meeting_id>.Mix-Headset.wav``, 16-bit mono; the number of files. Each is moved to its
    place when it is whole, so that a task that runs twice leaves one file."""

    def write(batches):
        for pdf in batches:
            files, folder = store(path)
            files.create_dir(folder, recursive=True)
            for meeting, samples in zip(pdf["meeting_id"], pdf["samples"], strict=True):
                data = io.BytesIO()
                with wave.open(data, "wb") as w:
                    w.setnchannels(1)
                    w.setsampwidth(2)
                    w.setframerate(rate)
                    w.writeframes(np.asarray(samples).astype("<i2").tobytes())
                whole = f"{folder}/{meeting}.Mix-Headset.wav"
                part = f"{whole}.{uuid.uuid4().hex}"
                with files.open_output_stream(part) as f:
                    f.write(data.getvalue())
                files.move(part, whole)
            yield pdf[["meeting_id"]]

    return signals.select("meeting_id", "samples").mapInPandas(write, "meeting_id string").count()
