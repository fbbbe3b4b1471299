"""Small wav and annotation files for tests."""

import wave

import numpy as np


def write_wav(path, channels, rate, width=2):
    """``channels`` is a list of equally long arrays in -1..1."""
    data = np.stack(channels, axis=1)
    if width == 1:
        raw = np.clip(np.rint(data * 128 + 128), 0, 255).astype(np.uint8).tobytes()
    elif width == 3:
        ints = np.clip(np.rint(data * (1 << 23)), -(1 << 23), (1 << 23) - 1).astype("<i4")
        raw = ints.reshape(-1, 1).view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
    else:
        top = 1 << (8 * width - 1)
        raw = np.clip(np.rint(data * top), -top, top - 1).astype(f"<i{width}").tobytes()
    with wave.open(str(path), "wb") as out:
        out.setnchannels(len(channels))
        out.setsampwidth(width)
        out.setframerate(rate)
        out.writeframes(raw)


def speech_like(pattern, rate, seed=0):
    """Noise bursts and silences: ``pattern`` is (seconds, loudness) pairs."""
    rng = np.random.default_rng(seed)
    return np.concatenate(
        [rng.normal(0, 1, int(s * rate)).clip(-3, 3) / 3 * level for s, level in pattern]
    )
