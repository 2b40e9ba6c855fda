"""Media columns: audio features.

A document's bytes are kept as the 8-bit samples of a mono WAV file.  Features
are computed from the samples read back out of that file: a polyphase filter
resamples them, overlapped frames pass a log-mel filterbank, and a hysteresis on
frame energy cuts out segments.  The log-mel frames of each segment are pooled
to a fixed number of rows, so that segments are tensors of one shape, kept with
their time spans.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from docquarry.llm.common import in_arrow, table, text_of

#: The payload is a multiple of this many bytes.
UNIT = 576
RATE = 16_000
#: Resampling by UP / DOWN, to 8 kHz; TAPS a phase.
UP, DOWN, TAPS = 1, 2, 16
FRAME, HOP, MELS = 256, 128, 20
#: Segments become tensors of this many rows of MELS values.
ROWS = 4
#: Energy, in units of the document's median, at which a segment opens and closes.
OPEN, CLOSE = 1.15, 0.9
#: Samples worked on at a time.
BLOCK = 1 << 17
#: Characters of texts whose tensors share a stream; a longer text has its own.
TOGETHER = 4_000_000


# ---- the container ----------------------------------------------------------


def payload_of(text: str) -> bytes:
    data = text.encode()
    units = max(1, -(-len(data) // UNIT))
    return data + b"\xff" * (units * UNIT - len(data))


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """An 8-bit mono WAV file of these samples."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload))
    return head + payload + b"\0" * (len(payload) % 2)


def from_wav(media: bytes) -> tuple[bytes, int]:
    """The samples and the rate of an 8-bit mono WAV file, chunk by chunk."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, rate = 12, 0
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (kind, channels, bits) != (1, 1, 8):
                raise ValueError("only 8-bit mono samples are read")
        elif name == b"data":
            return media[at + 8 : at + 8 + size], rate
        at += 8 + size + size % 2
    raise ValueError("no samples")


# ---- features ---------------------------------------------------------------


@cache
def polyphase(up: int = UP, down: int = DOWN, taps: int = TAPS) -> np.ndarray:
    """A windowed-sinc low-pass filter, split into ``up`` phases of ``taps``."""
    n = up * taps
    t = np.arange(n) - (n - 1) / 2
    cutoff = 1 / max(up, down)
    h = np.sinc(t * cutoff) * cutoff * np.hamming(n) * up
    phases = h.reshape(taps, up).T
    return (phases / phases.sum(axis=1, keepdims=True)).astype(np.float32)


def _windows(values: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """Rows of ``width`` neighbours, every ``step``; a view of contiguous ``values``."""
    rows = (len(values) - width) // step + 1
    return np.ndarray((rows, width), values.dtype, values, 0, (step * values.itemsize, values.itemsize))


def resample(samples: np.ndarray, up: int = UP, down: int = DOWN) -> np.ndarray:
    """Rational resampling: each output sample uses one phase of the filter."""
    phases = polyphase(up, down)
    taps = phases.shape[1]
    n = -(-len(samples) * up // down)
    padded = np.concatenate([np.zeros(taps - 1, np.float32), samples.astype(np.float32)])
    views = _windows(padded, taps)
    out = np.empty(n, np.float32)
    for first in range(min(up, n)):
        taken = np.ascontiguousarray(phases[(first * down) % up, ::-1])
        for block in range(first, n, up * BLOCK):
            at = np.arange(block, min(n, block + up * BLOCK), up) * down
            out[block : min(n, block + up * BLOCK) : up] = views[at // up] @ taken
    return out


def mel_bank(rate: int = RATE * UP // DOWN, frame: int = FRAME, mels: int = MELS) -> np.ndarray:
    """Triangular filters, evenly spaced on the mel scale: (bins, mels)."""
    top = 2595 * np.log10(1 + rate / 2 / 700)
    hz = 700 * (10 ** (np.linspace(0, top, mels + 2) / 2595) - 1)
    bins = np.fft.rfftfreq(frame, 1 / rate)[:, None]
    rise = (bins - hz[:-2]) / (hz[1:-1] - hz[:-2])
    fall = (hz[2:] - bins) / (hz[2:] - hz[1:-1])
    return np.maximum(0, np.minimum(rise, fall)).astype(np.float32)


_BANK, _WINDOW = mel_bank(), np.hanning(FRAME).astype(np.float32)


def log_mel(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-mel rows and mean energies of all overlapped frames.  Long inputs are
    worked off in blocks that share a frame's overlap, short ones are padded."""
    if len(samples) < FRAME:
        samples = np.concatenate([samples, np.zeros(FRAME - len(samples), np.float32)])
    frames = _windows(samples, FRAME, HOP)
    mels = np.empty((len(frames), MELS), np.float32)
    energy = np.empty(len(frames), np.float32)
    many = BLOCK // FRAME
    for at in range(0, len(frames), many):
        part = frames[at : at + many]
        spectrum = np.fft.rfft(part * _WINDOW, axis=1)
        power = (spectrum.real**2 + spectrum.imag**2).astype(np.float32)
        mels[at : at + many] = np.log(power @ _BANK + 1e-6)
        energy[at : at + many] = np.einsum("ij,ij->i", part, part) / FRAME
    return mels, energy


def segments(energy: np.ndarray, opens: float = OPEN, closes: float = CLOSE) -> list[tuple[int, int]]:
    """Frame spans (end exclusive) that begin where energy reaches ``opens``
    times its median and end where it falls below ``closes`` times; without any,
    the whole."""
    middle = np.partition(energy, [(len(energy) - 1) // 2, len(energy) // 2])
    level = float((middle[(len(energy) - 1) // 2] + middle[len(energy) // 2]) / 2)
    state = np.where(energy >= opens * level, 1, np.where(energy < closes * level, 0, -1))
    decided = np.flatnonzero(state >= 0)
    if not len(decided):
        return [(0, len(energy))]
    values = state[decided]
    change = np.flatnonzero(np.diff(values, prepend=0))
    edges = decided[change]
    if len(edges) % 2:
        edges = np.append(edges, len(energy))
    return [(int(a), int(b)) for a, b in edges.reshape(-1, 2)] or [(0, len(energy))]


def tensors(mels: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """(spans, ROWS, MELS): the frames of each span averaged into ROWS parts."""
    sums = np.concatenate([np.zeros((1, MELS)), np.cumsum(mels, axis=0, dtype=np.float64)])
    edges = np.array([[a + (b - a) * k // ROWS for k in range(ROWS)] for a, b in spans])
    ends = np.array([[max(a + (b - a) * (k + 1) // ROWS, a + (b - a) * k // ROWS + 1) for k in range(ROWS)] for a, b in spans])
    ends = np.minimum(ends, len(mels))
    edges = np.minimum(edges, ends - 1)
    return ((sums[ends] - sums[edges]) / (ends - edges)[..., None]).astype(np.float32)


def features(payload: bytes) -> tuple[np.ndarray, list[tuple[int, int]], int]:
    """Tensors, their spans in milliseconds, and the number of frames."""
    samples = (np.frombuffer(payload, np.uint8).astype(np.float32) - 128) / 128
    mels, energy = log_mel(resample(samples))
    spans = segments(energy)
    ms = 1000 * HOP * DOWN // (UP * 1)
    times = [(a * ms // RATE, (b * ms + (FRAME - HOP) * 1000 * DOWN // UP) // RATE) for a, b in spans]
    return tensors(mels, spans), times, len(energy)


def tensor_type() -> pa.DataType:
    return pa.fixed_shape_tensor(pa.float32(), (ROWS, MELS), dim_names=["part", "mel"])


def tensors_to_ipc(values: np.ndarray, times: list[tuple[int, int]]) -> bytes:
    """An Arrow stream with columns ``tensor`` (fixed shape), ``start_ms``, ``end_ms``."""
    tensor = pa.FixedShapeTensorArray.from_numpy_ndarray(np.ascontiguousarray(values))
    starts, ends = pa.array([a for a, _ in times], pa.int64()), pa.array([b for _, b in times], pa.int64())
    found = pa.RecordBatch.from_arrays([tensor, starts, ends], ["tensor", "start_ms", "end_ms"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, found.schema) as out:
        out.write_batch(found)
    return sink.getvalue().to_pybytes()


def tensors_from_ipc(stream: bytes) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The tensors and time spans of such a stream."""
    found = pa.ipc.open_stream(stream).read_next_batch()
    times = zip(found["start_ms"].to_pylist(), found["end_ms"].to_pylist(), strict=True)
    return found["tensor"].to_numpy_ndarray(), list(times)


def audio_rows(texts: list[str], with_media: bool = True) -> list[tuple]:
    """What ``audio_columns`` has of each text, from ``n_bytes`` on.  A text has a
    stream of its own if streams are asked for, else all texts share one; files
    and streams are made and read back, and the rest is of what was read."""
    made, rows = [], []
    for text in texts:
        media = to_wav(payload_of(text))
        payload, _ = from_wav(media)
        made.append(features(payload))
        told = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest())
        rows.append((len(text.encode()), media if with_media else None, told))
    out = []
    for first in range(0, len(texts), 1 if with_media else max(1, len(texts))):
        group = made[first : first + 1] if with_media else made
        stream = tensors_to_ipc(np.concatenate([values for values, _, _ in group]), [t for _, times, _ in group for t in times])
        every, spans = tensors_from_ipc(stream)
        rounded, at = np.round(every * 8).astype("<i2"), 0
        for k, (_, times, frames) in enumerate(group, first):
            end = at + len(times)
            length = sum(b - a for a, b in spans[at:end])
            n_bytes, media, told = rows[k]
            feature = f"frames={frames};segments={end - at};span_ms={length};mel={zlib.crc32(rounded[at:end].tobytes()):08x}"
            out.append((n_bytes, *((media, stream) if with_media else ()), *told, feature))
            at = end
    return out


def audio_row(text: str) -> tuple:
    return audio_rows([text])[0]


def audio_columns(docs: DataFrame, with_media: bool = True) -> DataFrame:
    """Per input row: ``doc_id``, ``n_bytes`` (of the text), ``media`` (the WAV
    file), ``segments`` (an Arrow stream of fixed-shape tensors with time spans)
    and what was read back: ``payload_bytes``, ``payload_sha256``,
    ``tail_crc32``, ``media_bytes``, ``media_sha256`` and ``feature``.

    Without ``with_media`` the two large columns are not returned; files and tensors
    are made and read back all the same, tensors in a stream for many texts.  Null
    texts count as empty and give one unit of padding.  Each text is worked on by
    itself, so equal texts give equal values; memory follows the longest text, of
    which spectra are held a block at a time.
    """
    large = "media binary, segments binary, " if with_media else ""
    schema = (
        f"doc_id long, n_bytes long, {large}payload_bytes long, payload_sha256 string, tail_crc32 long, "
        "media_bytes long, media_sha256 string, feature string"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[part.split()[1]] for part in schema.split(", ")]

        def batch(ids: list, texts: list[str]) -> pa.RecordBatch:
            columns = [ids, *zip(*audio_rows(texts, with_media), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for found in batches:
            ids, texts, held = [], [], 0
            for i, text in zip(found.column(0), found.column(1), strict=True):
                ids.append(i.as_py()), texts.append(text.as_py())
                held += len(texts[-1])
                if held > TOGETHER:
                    yield batch(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield batch(ids, texts)

    return docs.select(docs["doc_id"].cast("long"), text_of().alias("text")).transform(in_arrow(run, schema))


def op10_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``audio_columns`` of ``documents`` without the large columns, a row per row; null texts as
    empty."""
    return audio_columns(table(spark, sf_dir, "documents"), with_media=False)
