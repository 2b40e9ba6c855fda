import hashlib
import io
import random
import wave
import zlib

import numpy as np
import pyarrow as pa
import pytest

from docquarry.llm import media
from tests.llm import cases


def test_container_is_a_wav_file():
    for text in ["", "abc", "é" * 1000]:
        payload = media.payload_of(text)
        with wave.open(io.BytesIO(media.to_wav(payload))) as f:
            assert (f.getnchannels(), f.getsampwidth(), f.getframerate()) == (1, 1, media.RATE)
            assert f.readframes(f.getnframes()) == payload
        assert media.from_wav(media.to_wav(payload)) == (payload, media.RATE)
        assert len(payload) % media.UNIT == 0 and len(payload) > 0


@pytest.mark.parametrize("up, down", [(1, 2), (3, 4), (2, 3)])
def test_polyphase_equals_the_plain_filter(up, down):
    """Insert zeros, filter, and drop samples."""
    x = np.random.default_rng(1).normal(size=500).astype(np.float32)
    phases = media.polyphase(up, down)
    h = phases.T.ravel()
    stuffed = np.zeros(len(x) * up)
    stuffed[::up] = x
    plain = np.convolve(stuffed, h)[: len(stuffed)][::down]
    got = media.resample(x, up, down)
    assert np.allclose(got[: len(plain)], plain[: len(got)], atol=1e-4)


def test_frames_and_segments():
    assert media.segments(np.array([1, 1, 2, 1, 1, 0.5, 1, 2, 2], np.float32)) == [(2, 5), (7, 9)]
    assert media.segments(np.ones(4, np.float32)) == [(0, 4)]
    rng = np.random.default_rng(2)
    x = rng.normal(size=media.BLOCK * 2 + 77).astype(np.float32)
    mels, energy = media.log_mel(x)
    for k in [0, 3, len(mels) - 1]:
        frame = x[k * media.HOP : k * media.HOP + media.FRAME]
        power = np.abs(np.fft.rfft(frame * np.hanning(media.FRAME))) ** 2
        assert np.allclose(mels[k], np.log(power @ media.mel_bank() + 1e-6), atol=1e-3) and energy[k] == pytest.approx((frame**2).mean(), rel=1e-4)
    assert media.tensors(mels, [(0, 1), (5, 9), (0, len(mels))]).shape == (3, media.ROWS, media.MELS)


def test_columns(spark):
    docs = cases.frame(spark)
    rows = media.audio_columns(docs.select("doc_id", "text", "found")).collect()
    texts = {}
    for r in cases.rows():
        texts.setdefault(r[0], set()).add(hashlib.sha256(media.payload_of(r[1] or "")).hexdigest())
    assert len(rows) == docs.count()
    seen = {}
    for r in rows:
        payload, _ = media.from_wav(bytes(r["media"]))
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["payload_sha256"] in texts[r["doc_id"]]
        assert r["payload_bytes"] == len(payload) and r["tail_crc32"] == zlib.crc32(payload[-32:])
        assert r["media_bytes"] == len(r["media"]) and r["media_sha256"] == hashlib.sha256(r["media"]).hexdigest()
        assert payload[: r["n_bytes"]] + b"\xff" * (len(payload) - r["n_bytes"]) == payload
        assert seen.setdefault(payload, r["feature"]) == r["feature"]
        batch = pa.ipc.open_stream(bytes(r["segments"])).read_all()
        assert batch.schema.field("tensor").type.shape == [media.ROWS, media.MELS]
        assert all(a < b for a, b in zip(batch["start_ms"].to_pylist(), batch["end_ms"].to_pylist(), strict=True))
    assert media.audio_columns(cases.empty(spark)).count() == 0


def test_feature_is_of_the_stored_tensors(monkeypatch):
    stored, plain = [], media.audio_row("some text " * 900)

    def other(values, times, store=media.tensors_to_ipc):
        stored.append(store(values + 1, times[:1] * len(times)))
        return stored[-1]

    values, times, _ = media.features(media.payload_of("some text " * 900))
    got, spans = media.tensors_from_ipc(media.tensors_to_ipc(values, times))
    assert np.array_equal(got, values) and got.dtype == np.float32 and spans == times
    monkeypatch.setattr(media, "tensors_to_ipc", other)
    changed = media.audio_row("some text " * 900)
    assert changed[2] == stored[0] and changed[-1] != plain[-1] and changed[3:-1] == plain[3:-1]


def plain_feature(text: str) -> tuple[np.ndarray, list[tuple[int, int]], int]:
    """Tensors, spans and frames by loops over samples, frames and filters."""
    data = text.encode()
    data += b"\xff" * (max(1, -(-len(data) // 576)) * 576 - len(data))
    x = [(b - 128) / 128 for b in data]
    taps = [np.sinc((k - 7.5) / 2) / 2 * (0.54 - 0.46 * np.cos(2 * np.pi * k / 15)) for k in range(16)]
    taps = [t / sum(taps) for t in taps]
    y = [sum(taps[k] * x[n - k] for k in range(16) if n >= k) for n in range(0, len(x), 2)]
    y += [0.0] * (256 - len(y))
    window = [0.5 - 0.5 * np.cos(2 * np.pi * k / 255) for k in range(256)]
    edges = [700 * (10 ** (m / 2595) - 1) for m in np.linspace(0, 2595 * np.log10(1 + 4000 / 700), 22)]
    rows, energy = [], []
    for a in range(0, len(y) - 255, 128):
        frame = np.array(y[a : a + 256])
        power = np.abs(np.fft.rfft(frame * window)) ** 2
        energy.append(float((frame**2).mean()))
        row = []
        for m in range(20):
            low, mid, high = edges[m : m + 3]
            total = 0.0
            for k, p in enumerate(power):
                hz = k * 8000 / 256
                total += p * max(0.0, min((hz - low) / (mid - low), (high - hz) / (high - mid)))
            row.append(np.log(total + 1e-6))
        rows.append(row)
    level, spans, begun = float(np.median(np.array(energy, np.float32))), [], None
    for k, e in enumerate(energy):
        if begun is None and e >= 1.15 * level:
            begun = k
        elif begun is not None and e < 0.9 * level:
            spans.append((begun, k))
            begun = None
    if begun is not None:
        spans.append((begun, len(energy)))
    spans = spans or [(0, len(energy))]
    parts = []
    for a, b in spans:
        for k in range(4):
            first = a + (b - a) * k // 4
            last = min(max(a + (b - a) * (k + 1) // 4, first + 1), len(rows))
            parts.append(np.mean(rows[min(first, last - 1) : last], axis=0))
    return np.array(parts).reshape(len(spans), 4, 20), [(a * 16, b * 16 + 16) for a, b in spans], len(energy)


def test_features_equal_loops():
    texts = ["", "abc", "short text " * 30, "Quiet words, then LOUD ONES!!! " * 60, "éü中" * 700]
    texts += [r[1] for r in cases.rows()[8:10]]
    words = cases.prose(random.Random(3), 2000)
    texts.append("".join(words[a : a + 1500].upper() if a % 3000 else words[a : a + 1500] for a in range(0, 9000, 1500)))
    several = 0
    for text in texts:
        values, spans, frames = plain_feature(text)
        row = media.audio_row(text)
        got, times = media.tensors_from_ipc(row[2])
        assert np.allclose(got, values, atol=2e-2) and times == spans
        quiet = zlib.crc32(np.round(got * 8).astype("<i2").tobytes())
        assert row[-1] == f"frames={frames};segments={len(spans)};span_ms={sum(b - a for a, b in spans)};mel={quiet:08x}"
        several += len(spans) > 1
    assert several
