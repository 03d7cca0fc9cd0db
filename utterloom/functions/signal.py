"""Signal functions over arrays of samples: column expressions where SQL can say them, NumPy in Arrow batches else."""

from __future__ import annotations

import io
import wave
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

# Profiles of the compressor and the de-esser (decibels, seconds, hertz).
COMPRESSION = {
    "male": {"threshold": -18, "ratio": 3.0, "attack": 0.020, "release": 0.150, "knee_width": 6},
    "female": {"threshold": -16, "ratio": 2.5, "attack": 0.015, "release": 0.120, "knee_width": 4},
    "neutral": {"threshold": -17, "ratio": 2.75, "attack": 0.018, "release": 0.135, "knee_width": 5},
}
DEESSING = {
    "low": {"threshold": 0.15, "ratio": 2.5, "makeup_gain": 0.5, "reduction_factor": 0.3, "freq_range": (4500, 9000)},
    "high": {"threshold": 0.25, "ratio": 3.5, "makeup_gain": 0.4, "reduction_factor": 0.5, "freq_range": (5000, 10000)},
}
QUIET = 1e-5
SILENT = 1e-4


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def rms(a: Column) -> Column:
    return F.sqrt(total(F.transform(a, lambda x: x * x)) / F.size(a))


def peak(a: Column) -> Column:
    return F.array_max(F.transform(a, F.abs))


def decibels(level: Column) -> Column:
    return 20 * F.log10(F.greatest(level, F.lit(QUIET)))


def fades(a: Column, rate: int, in_ms: int = 30, out_ms: int = 40) -> Column:
    """Linear ramps at both ends, their end points included; a ramp as long as the audio covers half of it."""
    n = F.size(a)

    def length(ms: int) -> Column:
        want = F.lit(int(ms / 1000 * rate))
        return F.when(want >= n, F.floor(n / 2).cast("int")).otherwise(want)

    def ramp(at: Column, size: Column) -> Column:
        return F.when((at < size) & (size > 1), at / (size - 1)).when(at < size, F.lit(0.0)).otherwise(F.lit(1.0))

    # a ramp of one sample starts at 0 on its way in and at 1 on its way out
    down = lambda at, size: F.when(size == 1, F.lit(1.0)).otherwise(ramp(at, size))
    return F.transform(a, lambda x, i: x * ramp(i, length(in_ms)) * down(n - 1 - i, length(out_ms)))


def normalised(a: Column, target: float = -16.0, limit: float = 0.99) -> Column:
    """Gain to a loudness from the root mean square, less where the peak would pass the limit; silence stays silent."""
    level = rms(a)
    gain = F.pow(F.lit(10.0), (F.lit(target) - (20 * F.log10(level) - 0.691)) / 20)
    top = peak(a) * gain
    whole = F.when(level > 0, F.when(top > limit, gain * limit / top).otherwise(gain)).otherwise(F.lit(0.0))
    return F.get(F.transform(F.array(whole), lambda g: F.transform(a, lambda x: x * g)), F.lit(0))


def zero_crossing_variance(a: Column) -> Column:
    """Population variance of the sign changes for each sample in equal groups (the first ones longer by one).

    There are four groups, or as many quarters of the length, rounded down, as fit. Null under four samples.
    """
    n = F.size(a)
    groups = F.greatest(F.lit(4), F.floor(n / F.floor(n / 4)).cast("int"))

    def rate(g: Column, groups: Column) -> Column:
        size, more = F.floor(n / groups).cast("int"), n % groups
        start = g * size + F.least(g, more)
        part = F.slice(a, start + 1, size + F.when(g < more, 1).otherwise(0))
        return _let(part, lambda p: total(F.transform(p, lambda x, i: F.when((i > 0) & ((x < 0) != (F.get(p, i - 1) < 0)), 1.0).otherwise(0.0))) / F.size(p))

    rates = _let(groups, lambda c: F.transform(F.sequence(F.lit(0), c - 1), lambda g: rate(g, c)))
    variance = _let(rates, lambda r: total(F.transform(r, lambda x: F.pow(x - total(r) / F.size(r), F.lit(2)))) / F.size(r))
    return F.when(n >= 4, variance)


def lowest_energy(a: Column, windows: int) -> Column:
    """(window, sample): the first quietest of equal sub-windows, silent ones before all others, and its least sample."""
    n = F.size(a)

    def place(i: Column) -> Column:
        start, end = F.floor(i * n / windows).cast("int"), F.floor((i + 1) * n / windows).cast("int")
        part = F.slice(a, start + 1, end - start)
        silent = F.size(F.filter(part, lambda x: F.abs(x) < SILENT)) / F.size(part) > 0.95
        least = F.array_position(F.transform(part, F.abs), F.array_min(F.transform(part, F.abs))) - 1
        return F.struct((~silent).alias("loud"), F.round(decibels(rms(part)), 9).alias("db"), i.alias("window"), least.cast("int").alias("sample"))

    return F.array_min(F.transform(F.sequence(F.lit(0), F.lit(windows - 1)), place))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- NumPy


def trim_trailing_silence(a: np.ndarray, rate: int, floor_db: float = -50.0, chunk_ms: int = 10) -> np.ndarray:
    """Chunks below the floor are cut from the end; one chunk at least stays."""
    size = max(1, rate * chunk_ms // 1000)
    end = len(a)
    while end > size and 20 * np.log10(max(np.sqrt(np.mean(a[max(0, end - size) : end] ** 2)), 1e-10)) < floor_db:
        end -= size
    return a[:end]


def compressed(a: np.ndarray, rate: int, profile: str = "neutral") -> np.ndarray:
    """Soft-knee gain curve with attack and release smoothing. The curve raises what is over the threshold."""
    p = COMPRESSION[profile]
    level = 20 * np.log10(np.maximum(np.abs(a), 1e-12))
    slope, half = 1 - 1 / p["ratio"], p["knee_width"] / 2
    over = level - p["threshold"]
    gain = np.where(over <= -half, 0.0, np.where(over >= half, slope * over, slope * (over + half) ** 2 / (2 * p["knee_width"])))
    fall, rise = np.exp(-1 / (p["attack"] * rate)), np.exp(-1 / (p["release"] * rate))
    smooth = np.zeros(len(a))
    for i in range(1, len(a)):
        c = fall if gain[i] <= smooth[i - 1] else rise
        smooth[i] = c * smooth[i - 1] + (1 - c) * gain[i]
    return a * 10 ** (smooth / 20)


def _zero_phase(a: np.ndarray, rate: int, response: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Filter by a squared magnitude in the frequency domain, as a filter run forward and backward has it."""
    f = np.fft.rfftfreq(2 * len(a), 1 / rate)
    return np.fft.irfft(np.fft.rfft(np.concatenate([a, a[::-1]])) * response(f), 2 * len(a))[: len(a)]


def deessed(a: np.ndarray, rate: int, profile: str = "low") -> np.ndarray:
    """Sibilants (Butterworth band of order 4, zero phase) compressed over an adaptive threshold and taken off."""
    p = DEESSING[profile]
    low, high = (min(x, 0.499 * rate) for x in p["freq_range"])
    if high <= low:
        return a
    band = lambda f: 1 / (1 + ((f**2 - low * high) / (np.maximum(f, 1e-9) * (high - low))) ** 8)
    s = _zero_phase(a, rate, band)
    limit = p["threshold"] * np.sqrt(np.mean(s**2))
    s = np.where(np.abs(s) > limit, np.sign(s) * (limit + (np.abs(s) - limit) / p["ratio"]), s) * p["makeup_gain"]
    return a - _zero_phase(s, rate, lambda f: 1 / (1 + (f / 150) ** 4)) * p["reduction_factor"]


def ends_abruptly(a: np.ndarray, rate: int) -> bool:
    """Whether the last tenth of a second (a third of the audio at most) breaks off with energy."""
    a = np.asarray(a, np.float32)
    if len(a) and np.max(np.abs(a)) > 1:
        a = a / np.max(np.abs(a))
    tail = a[len(a) - min(rate // 10, len(a) // 3) :]
    size = int(0.005 * rate)
    if size < 1 or len(tail) // size < 1 or len(tail) < 4:
        return False
    energy = np.array([np.sqrt(np.mean(x**2)) for x in np.array_split(tail, len(tail) // size)])
    end, top = np.mean(energy[-3:]), np.max(energy)
    if top == 0:
        return False
    rates = [np.sum(np.abs(np.diff(np.signbit(x).astype(int)))) / len(x) for x in np.array_split(tail, 4)]
    last = np.abs(tail)[-max(1, int(0.01 * rate)) :]
    signs = (
        end / top > 0.5,
        len(energy) >= 4 and (energy[-1] - energy[-4]) / 3 > 0,
        np.var(rates) > 0.05,
        abs(rates[-1] - np.mean(rates[:-1])) > 0.3,
        np.mean(last) < 0.1 * np.mean(np.abs(tail)),
    )
    return bool(any(signs) and end > 0.1)


def resampled(a: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Linear interpolation to another rate."""
    if rate == target or not len(a):
        return a
    n = max(1, round(len(a) * target / rate))
    return np.interp(np.arange(n) * rate / target, np.arange(len(a)), a)


def effects(a: np.ndarray, rate: int, target: int | None = None, loudness: float | None = None, compress: str | None = None, deess: str | None = None, trim: bool = False, fade: tuple[int, int] = (0, 0)) -> np.ndarray | None:
    """The chain in its fixed order; None if the result isn't finite."""
    a = np.array(a, np.float64)  # a copy: ramps are applied in place
    if len(a) and np.max(np.abs(a)) > 1:
        a = a / np.max(np.abs(a))
    if target:
        a, rate = resampled(a, rate, target), target
    with np.errstate(all="ignore"):
        if loudness is not None:
            level = 20 * np.log10(np.sqrt(np.mean(a**2))) - 0.691
            a = a * 10 ** ((loudness - level) / 20)
            a = a * min(1.0, 0.99 / np.max(np.abs(a)))
        if compress:
            a = compressed(a, rate, compress)
        if deess:
            a = deessed(a, rate, deess)
        if trim:
            a = trim_trailing_silence(a, rate)
        for ms, ramp_in in zip(fade, (True, False), strict=True):
            n = int(ms / 1000 * rate)
            n = len(a) // 2 if n >= len(a) else n
            if n and ramp_in:
                a[:n] *= np.linspace(0, 1, n)
            elif n:
                a[-n:] *= np.linspace(1, 0, n)
        top = np.max(np.abs(a)) if len(a) else 0
        a = a * (0.99 / top) if top > 0.99 else a
    return a if np.all(np.isfinite(a)) else None


def pitch(a: np.ndarray, rate: int, frame: int = 1024, hop: int = 256) -> float:
    """Mean over frames of the frequency with most energy, frames without any left out."""
    found = []
    for at in range(0, max(1, len(a) - frame + 1), hop):
        spectrum = np.abs(np.fft.rfft(a[at : at + frame] * np.hanning(len(a[at : at + frame]))))
        k = int(np.argmax(spectrum))
        if k:
            found.append(k * rate / len(a[at : at + frame]))
    return float(np.mean(found)) if found else 0.0


def variation(values: np.ndarray) -> float:
    mean = np.mean(values) if len(values) else 0.0
    return float(np.std(values) / mean) if mean else 0.0


def decode_wav(content: bytes) -> tuple[int, np.ndarray] | None:
    """(rate, mono samples within -1 and 1) of a PCM file; None if it can't be read."""
    try:
        with wave.open(io.BytesIO(content)) as w:
            width, channels, rate = w.getsampwidth(), w.getnchannels(), w.getframerate()
            raw = w.readframes(w.getnframes())
    except (wave.Error, EOFError):
        return None
    if width == 3:
        x = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((x[:, 0] | x[:, 1] << 8 | x[:, 2] << 16) ^ 0x800000) - 0x800000
    else:
        x = np.frombuffer(raw, {1: np.uint8, 2: "<i2", 4: "<i4"}[width]).astype(np.float64) - (128 if width == 1 else 0)
    return rate, (x.reshape(-1, channels).mean(axis=1) / 2.0 ** (8 * width - 1)).astype(np.float64)


def encode_wav(samples: np.ndarray, rate: int) -> bytes:
    """Mono 16-bit PCM."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 1) * 32767).round().astype("<i2").tobytes())
    return out.getvalue()


def mapped(f: Callable[[np.ndarray], np.ndarray | float | bool | None], column: Column, returns: str) -> Column:
    """f over the arrays of a column, in Arrow batches; a null or failing array gives null."""

    def one(x):
        try:
            return None if x is None else f(np.asarray(x, np.float64))
        except (ValueError, ZeroDivisionError, FloatingPointError):
            return None

    def batch(values: pd.Series) -> pd.Series:
        return pd.Series([one(x) for x in values], dtype=object)

    return F.pandas_udf(batch, returns)(column)
