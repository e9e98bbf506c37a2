"""Numpy kernels for signal transforms that have no SQL form; each works on one chunk with its halo."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np


def sinc_reach(rate: int, target: int, zeros: int) -> int:
    """Input samples on either side that an output sample needs."""
    return int(np.ceil(zeros * max(1.0, rate / target))) + 1


@lru_cache(maxsize=8)
def polyphase_bank(rate: int, target: int, zeros: int) -> tuple[int, int, np.ndarray]:
    """(phases, step, taps[phase, tap]): outputs n, n + phases, ... use one row of taps, at inputs `step` apart."""
    g = math.gcd(rate, target)
    phases, step = target // g, rate // g
    reach, cut = sinc_reach(rate, target, zeros), min(1.0, target / rate)
    d = np.arange(-reach, reach + 1)[None] - (np.arange(phases) * step % phases / phases)[:, None]
    width = zeros / cut
    taps = cut * np.sinc(cut * d) * np.where(np.abs(d) < width, 0.5 + 0.5 * np.cos(np.pi * d / width), 0)
    return phases, step, taps / taps.sum(axis=1, keepdims=True)


def resample(x: np.ndarray, start: int, left: int, right: int, rate: int, target: int, zeros: int) -> np.ndarray:
    """Outputs whose place lies in the chunk's own samples. x begins at input sample `start` and has halos of left and right.

    A phase at a time: its outputs are the products of its taps with inputs that lie `step` apart. Beyond the recording's ends the signal counts as zero.
    """
    own0, own1 = start + left, start + len(x) - right
    first, stop = -(-own0 * target // rate), -(-own1 * target // rate)
    out = np.zeros(max(0, stop - first), np.float32)
    if not len(out):
        return out
    phases, step, bank = polyphase_bank(rate, target, zeros)
    reach = bank.shape[1] // 2
    ahead = max(0, start - (first * rate // target - reach))
    behind = max(0, (stop - 1) * rate // target + reach + 1 - start - len(x))
    held = np.pad(x.astype(np.float64), (ahead, behind))
    reached = np.lib.stride_tricks.sliding_window_view(held, bank.shape[1])
    for n in range(first, min(first + phases, stop)):
        at = n * rate // target - reach - start + ahead
        own = out[n - first::phases]
        own[:] = reached[at::step][:len(own)] @ bank[n % phases]
    return out


def hann(n: int) -> np.ndarray:
    """Periodic Hann window."""
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)


@lru_cache(maxsize=8)
def padded_window(n: int, n_fft: int) -> np.ndarray:
    """A Hann window of n in the middle of n_fft zeros."""
    out = np.zeros(n_fft)
    at = (n_fft - n) // 2
    out[at:at + n] = hann(n)
    return out


def spectra(frames: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Complex spectra (frames, bins) of windowed frames."""
    return np.fft.rfft(frames * window, axis=-1)


@lru_cache(maxsize=8)
def mel_filters(rate: int, n_fft: int, n_mels: int = 128, fmin: float = 20.0, fmax: float | None = None) -> np.ndarray:
    """Triangular filters (n_mels, bins), even on the Slaney mel scale, of unit area."""
    fmax = rate // 2 if fmax is None else fmax
    step, knee = 200.0 / 3, 1000.0
    log_step = np.log(6.4) / 27
    to_mel = lambda f: np.where(f < knee, f / step, knee / step + np.log(np.maximum(f, 1e-9) / knee) / log_step)
    to_hz = lambda m: np.where(m < knee / step, m * step, knee * np.exp(log_step * (m - knee / step)))
    edges = to_hz(np.linspace(to_mel(np.float64(fmin)), to_mel(np.float64(fmax)), n_mels + 2))
    bins = np.arange(n_fft // 2 + 1) * rate / n_fft
    up = (bins[None] - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    down = (edges[2:, None] - bins[None]) / (edges[2:] - edges[1:-1])[:, None]
    return np.maximum(0, np.minimum(up, down)) * (2 / (edges[2:] - edges[:-2]))[:, None]


@lru_cache(maxsize=8)
def dct_matrix(n: int, keep: int) -> np.ndarray:
    """The first `keep` rows of the orthonormal DCT-II of length n."""
    k, i = np.arange(keep)[:, None], np.arange(n)[None]
    out = np.cos(np.pi * k * (2 * i + 1) / (2 * n)) * np.sqrt(2 / n)
    out[0] /= np.sqrt(2)
    return out


#: Bytes of neighbours that a running median lays out at a time.
MEDIAN_BYTES = 16 << 20


def running_median(x: np.ndarray, width: int, axis: int) -> np.ndarray:
    """Median of `width` (odd) neighbours along an axis of a matrix, mirrored at the ends; lines are taken in slabs, so memory does not grow with the width."""
    lines = np.ascontiguousarray(x if axis == 1 else x.T)
    padded = np.pad(lines, ((0, 0), (width // 2, width // 2)), mode="symmetric")
    out = np.empty_like(lines)
    # a slab is a stretch of lines, and of a long line a stretch of its places
    places = max(1, min(lines.shape[1], MEDIAN_BYTES // (width * x.itemsize)))
    step = max(1, MEDIAN_BYTES // (width * x.itemsize * places))
    for a in range(0, lines.shape[0], step):
        for b in range(0, lines.shape[1], places):
            near = np.lib.stride_tricks.sliding_window_view(padded[a:a + step, b:b + places + width - 1], width, axis=1)
            out[a:a + step, b:b + places] = np.partition(near, width // 2, axis=-1)[..., width // 2]
    return out if axis == 1 else out.T


def inverse(spec: np.ndarray, window: np.ndarray, hop: int, length: int) -> np.ndarray:
    """Overlap-add of spectra (frames, bins) whose frames start at k * hop - n_fft / 2; samples 0 .. length."""
    n_fft = len(window)
    frames = np.fft.irfft(spec, n_fft, axis=-1) * window
    total = np.zeros(hop * (len(spec) - 1) + n_fft)
    weight = np.zeros_like(total)
    for k, f in enumerate(frames):
        total[k * hop:k * hop + n_fft] += f
        weight[k * hop:k * hop + n_fft] += window**2
    out = np.where(weight > 1e-8, total / np.maximum(weight, 1e-8), 0)[n_fft // 2:n_fft // 2 + length]
    return np.pad(out, (0, length - len(out)))


def centred_frames(x: np.ndarray, n: int, hop: int, mode: str = "constant") -> np.ndarray:
    """Frames (1 + len(x) // hop, n) centred on the samples 0, hop, ...; n even."""
    padded = np.pad(x.astype(np.float64), (n // 2, n // 2), mode=mode) if len(x) else np.zeros(n)
    return np.lib.stride_tricks.sliding_window_view(padded, n)[::hop]


def harmonic(x: np.ndarray, n_fft: int = 2048, hop: int = 512, width: int = 31, margin: float = 3.0) -> np.ndarray:
    """The harmonic part: medians along time against medians along frequency, a soft mask of power two with a margin."""
    if not len(x):
        return x.astype(np.float32)
    w = hann(n_fft)
    spec = spectra(centred_frames(x, n_fft, hop), w)
    mag = np.abs(spec)
    along, across = running_median(mag, width, 0), running_median(mag, width, 1) * margin
    top = np.maximum(along, across)
    with np.errstate(divide="ignore", invalid="ignore"):
        mask = np.where(top > np.finfo(np.float32).tiny, (along / top) ** 2 / ((along / top) ** 2 + (across / top) ** 2), 0)
    return inverse(spec * mask, w, hop, len(x)).astype(np.float32)


def gate_reach(n_fft: int = 1024, hop: int = 256, smooth_frames: int = 32) -> int:
    """Samples on either side of a chunk that its gated samples depend on."""
    return smooth_frames * hop + n_fft + hop


def gate(x: np.ndarray, prop_decrease: float, floor_db: np.ndarray | None, start: int = 0, n_fft: int = 1024, hop: int = 256, smooth_frames: int = 32, above: float = 2.0, sharp: float = 10.0) -> np.ndarray:
    """Spectral gate: bins near the noise floor are lowered by a share of prop_decrease.

    The floor is floor_db (stationary) or, without it, each bin's own level smoothed over neighbouring frames; the mask
    is a logistic function of how far a bin is above it. x begins at sample `start` of the recording; frames lie on the
    recording's grid of hops, so the result does not depend on where x begins, `gate_reach` samples aside.
    """
    if not len(x) or prop_decrease == 0:
        return x.astype(np.float32)
    skip = min(-start % hop, len(x))
    w, y = hann(n_fft), x[skip:]
    if not len(y):
        return x.astype(np.float32)
    spec = spectra(centred_frames(y, n_fft, hop), w)
    mag = np.abs(spec)
    if floor_db is not None:
        open_share = 1 / (1 + np.exp(-np.clip(20 * np.log10(np.maximum(mag, 1e-10)) - floor_db, -50, 50)))
    else:
        run = np.concatenate([np.zeros((1, mag.shape[1])), np.cumsum(mag, axis=0)])
        at = np.arange(len(mag))
        low, high = np.maximum(at - smooth_frames, 0), np.minimum(at + smooth_frames + 1, len(mag))
        level = (run[high] - run[low]) / (high - low)[:, None]
        rise = (mag - level) / np.maximum(level, 1e-10)
        open_share = 1 / (1 + np.exp(-np.clip((rise - above) * sharp, -50, 50)))
    return np.concatenate([x[:skip], inverse(spec * (1 - prop_decrease * (1 - open_share)), w, hop, len(y))]).astype(np.float32)
