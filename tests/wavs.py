"""Small WAV files and a plain-Python reading of the cleaning rules."""

import io
import math
import struct
import wave

import numpy as np


def make_wav(samples, rate=16_000, width=2, channels=1):
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        if width == 1:
            data = bytes(int(s) + 128 for s in samples)
        elif width == 2:
            data = struct.pack(f"<{len(samples)}h", *samples)
        elif width == 3:
            data = b"".join(int(s).to_bytes(3, "little", signed=True) for s in samples)
        else:
            data = struct.pack(f"<{len(samples)}i", *samples)
        w.writeframes(data)
    return buffer.getvalue()


def tone(n, rate, level=20_000, hertz=440):
    return [int(level * math.sin(2 * math.pi * hertz * i / rate)) for i in range(n)]


def samples_of(content):
    with wave.open(io.BytesIO(content)) as w:
        return w.getparams(), np.frombuffer(w.readframes(w.getnframes()), "<i2").tolist()


def resample_slowly(x, rate, target):
    """Walk the output positions one by one in exact integer arithmetic."""
    out, k = [], 0
    while True:
        right = -(-k * rate // target)
        if right >= len(x):
            return out
        behind = right * target - k * rate
        value = (x[max(0, right - 1)] * behind + x[right] * (target - behind)) * 65536 / target
        out.append(int(value) >> 16)
        k += 1
