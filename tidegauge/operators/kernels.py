"""Numeric kernels of one window, sequence or set of points, in numpy: peaks, spectra, entropy, discriminants, K-Means, Viterbi."""

from __future__ import annotations

import numpy as np


def find_peaks(x: np.ndarray, distance: int) -> np.ndarray:
    """Indices of local maxima (the middle of a plateau), the highest first taking its neighbourhood of `distance`."""
    if len(x) < 3:
        return np.zeros(0, np.int64)
    change = np.flatnonzero(np.diff(x)) + 1
    starts, ends = np.concatenate(([0], change)), np.concatenate((change, [len(x)])) - 1
    level = x[starts]
    top = np.flatnonzero((level[1:-1] > level[:-2]) & (level[1:-1] > level[2:])) + 1
    peaks = (starts[top] + ends[top]) // 2
    keep = np.ones(len(peaks), bool)
    for k in np.argsort(x[peaks], kind="stable")[::-1]:
        if keep[k]:
            near = np.abs(peaks - peaks[k]) < distance
            near[k] = False
            keep &= ~near
    return peaks[keep]


def pulse_features(x: np.ndarray, rate: float) -> dict[str, float]:
    """Peaks at least .3 s apart, mean height, rise time from the lowest point in the .5 s before, and interval variability."""
    p = find_peaks(x, max(1, int(0.3 * rate)))
    out = {"n_peaks": float(len(p)), "peak_amplitude": np.nan, "rise_time_s": np.nan, "sdnn_ms": np.nan, "rmssd_ms": np.nan, "pnn50": np.nan}
    if len(p):
        out["peak_amplitude"] = float(x[p].mean())
        back = int(0.5 * rate)
        lows = [k - (max(0, k - back) + int(np.argmin(x[max(0, k - back) : k + 1]))) for k in p]
        out["rise_time_s"] = float(np.mean(lows) / rate)
    if len(p) > 1:
        nn = np.diff(p) / rate * 1000
        out["sdnn_ms"] = float(nn.std(ddof=1)) if len(nn) > 1 else np.nan
        if len(nn) > 1:
            d = np.diff(nn)
            out |= {"rmssd_ms": float(np.sqrt((d * d).mean())), "pnn50": float((np.abs(d) > 50).mean())}
    return out


def response_features(x: np.ndarray, rate: float) -> dict[str, float]:
    """Skin responses: peaks 1 s apart and their mean height over the lowest point of the 2 s before."""
    p = find_peaks(x, max(1, int(rate)))
    back = int(2 * rate)
    rises = [x[k] - x[max(0, k - back) : k + 1].min() for k in p]
    return {"scr_count": float(len(p)), "scr_amplitude": float(np.mean(rises)) if len(p) else 0.0}


def welch(x: np.ndarray, rate: float, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and power density: Hann windows that overlap by half, means removed."""
    size = min(size, len(x))
    step = max(1, size - size // 2)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    parts = np.stack([x[k : k + size] for k in range(0, len(x) - size + 1, step)])
    spectra = np.abs(np.fft.rfft((parts - parts.mean(1, keepdims=True)) * window, axis=1)) ** 2
    density = spectra.mean(0) / (rate * (window**2).sum())
    density[1 : len(density) - (size % 2 == 0)] *= 2
    return np.fft.rfftfreq(size, 1 / rate), density


def highpass(x: np.ndarray, rate: float, edge: float, order: int = 4) -> np.ndarray:
    """Zero-phase Butterworth high-pass: the squared magnitude response, on the mirrored signal."""
    n = len(x)
    mirrored = np.concatenate((2 * x[0] - x[:0:-1], x, 2 * x[-1] - x[-2::-1]))
    f = np.fft.rfftfreq(len(mirrored), 1 / rate)
    # the bilinear transform bends the frequency axis
    bent, at = np.tan(np.pi * np.minimum(f, rate / 2 * 0.999999) / rate), np.tan(np.pi * edge / rate)
    gain = np.zeros(len(f))
    gain[1:] = 1 / (1 + (at / bent[1:]) ** (2 * order))
    return np.fft.irfft(np.fft.rfft(mirrored) * gain, len(mirrored))[n - 1 : 2 * n - 1]


def noise_ratio(x: np.ndarray, rate: float) -> float:
    """Mean power density at 40-250 Hz over that at 1-40 Hz, above 1 Hz; NaN if it can't be computed."""
    if len(x) < 16 or not np.isfinite(x).all():
        return np.nan
    f, p = welch(highpass(x, rate, 1.0), rate, min(256, len(x)))
    high, low = p[(f >= 40) & (f <= 250)], p[(f >= 1) & (f < 40)]
    return float(high.mean() / low.mean()) if len(high) and len(low) and low.mean() > 0 else np.nan


BANDS = ((0.5, 4), (4, 8), (8, 13), (13, 30), (30, 100))


def band_powers(x: np.ndarray, rate: float) -> list[float]:
    """Mean power density of each of BANDS."""
    f, p = welch(x, rate, len(x))
    return [float(p[(f >= a) & (f < b)].mean()) if ((f >= a) & (f < b)).any() else 0.0 for a, b in BANDS]


def hjorth(x: np.ndarray) -> tuple[float, float]:
    """Mobility and complexity."""
    d, dd = np.diff(x), np.diff(x, 2)
    if not x.var() or not d.var():
        return np.nan, np.nan
    mobility = np.sqrt(d.var() / x.var())
    return float(mobility), float(np.sqrt(dd.var() / d.var()) / mobility)


def approximate_entropy(x: np.ndarray, m: int = 2, share: float = 0.2) -> float:
    r, n = share * x.std(), len(x)
    if not r or n <= m + 1:
        return np.nan

    def phi(k: int) -> float:
        v = np.lib.stride_tricks.sliding_window_view(x, k)
        total = 0.0
        for at in range(0, len(v), 128):
            # as many rows at once as keep the distances small
            near = np.ones((len(v[at : at + 128]), len(v)), bool)
            for j in range(k):
                near &= np.abs(v[at : at + 128, j, None] - v[None, :, j]) <= r
            total += np.log(near.mean(1)).sum()
        return total / len(v)

    return float(phi(m) - phi(m + 1))


def discriminant(x: np.ndarray, y: np.ndarray, most: int = 3) -> np.ndarray:
    """Linear discriminant scores [row, min(most, classes - 1)]; signs are fixed by each axis' largest weight."""
    classes = np.unique(y)
    k = min(most, len(classes) - 1, x.shape[1])
    mean = x.mean(0)
    within, between = np.zeros((x.shape[1],) * 2), np.zeros((x.shape[1],) * 2)
    for c in classes:
        own = x[y == c]
        d = own - own.mean(0)
        within += d.T @ d
        m = (own.mean(0) - mean)[:, None]
        between += len(own) * m @ m.T
    # whiten within, then the leading directions of between; directions without spread are left out
    values, vectors = np.linalg.eigh(within / max(len(x) - len(classes), 1))
    good = values > 1e-10 * max(values.max(), 1e-300)
    white = vectors[:, good] / np.sqrt(values[good])
    w, v = np.linalg.eigh(white.T @ between @ white)
    axes = white @ v[:, np.argsort(w)[::-1][:k]]
    axes *= np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    return (x - mean) @ axes


def standardised(x: np.ndarray) -> np.ndarray:
    """(x - mean) / population deviation of each column; columns constant but for rounding are only centred."""
    m, v = x.mean(0), x.var(0)
    e = len(x) * np.finfo(np.float64).eps
    return (x - m) / np.where(v <= e * v + (e * m) ** 2, 1.0, np.sqrt(v))


def first_centres(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++: rows drawn by their squared distance to the nearest centre, the best of 2 + log k draws each time."""
    square = lambda c: np.einsum("ij,ij->i", x - x[c], x - x[c])
    own = [int(rng.integers(len(x)))]
    near = square(own[0])
    for _ in range(1, k):
        up = near.cumsum()
        draws = np.minimum(np.searchsorted(up, rng.random(2 + int(np.log(k))) * up[-1], "right"), len(x) - 1)
        tries = [np.minimum(near, square(c)) for c in draws]
        best = int(np.argmin([t.sum() for t in tries]))
        own.append(int(draws[best]))
        near = tries[best]
    return x[own]


def kmeans(x: np.ndarray, k: int, seed: int, rounds: int = 300, tolerance: float = 1e-4) -> tuple[np.ndarray, float]:
    """Labels 0 .. k - 1 and cost (sum of squared distances) of one fit by Lloyd's rounds.

    They end once no label changes or the centres move by less than `tolerance` of the mean variance. An empty cluster
    takes the row farthest from its centre; where fewer than k rows differ, clusters stay empty.
    """
    c = first_centres(x, k, np.random.default_rng(seed))
    nearest = lambda: ((c * c).sum(1) - 2 * (x @ c.T)).argmin(1)
    least, y = tolerance * x.var(0).mean(), nearest()
    for _ in range(rounds):
        n = np.bincount(y, minlength=k)
        sums = np.stack([np.bincount(y, v, k) for v in x.T], 1)
        if (n == 0).any():
            away = ((x - c[y]) ** 2).sum(1)
            far = iter(np.argsort(-away, kind="stable"))
            for e in np.flatnonzero(n == 0):
                row = next((r for r in far if n[y[r]] > 1 and away[r] > 0), None)
                if row is None:
                    break
                n[y[row]] -= 1
                sums[y[row]] -= x[row]
                n[e], sums[e] = 1, x[row]
        moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
        shift, c, old = ((moved - c) ** 2).sum(), moved, y
        y = nearest()
        if (y == old).all() or shift <= least:
            break
    return y, float(((x - c[y]) ** 2).sum())


def silhouettes(x: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Silhouettes (labelling, row) of some rows of x among all of them, Euclidean; labels: (labelling, row of x)."""
    d = np.zeros((len(rows), len(x)))
    for v in x.T:
        t = v[rows, None] - v
        d += t * t
    np.sqrt(d, out=d)
    out, at = np.zeros((len(labels), len(rows))), np.arange(len(rows))
    for s, y in zip(out, labels, strict=True):
        own, n = y[rows], np.bincount(y)
        sums = d @ np.eye(len(n))[y]
        inside = sums[at, own] / np.maximum(n[own] - 1, 1)
        means = np.where(n > 0, sums / np.maximum(n, 1), np.inf)
        means[at, own] = np.inf
        outside = means.min(1)
        most = np.maximum(inside, outside)
        # alone, without another cluster, or among copies in both: 0
        good = (n[own] > 1) & np.isfinite(outside) & (most > 0)
        s[good] = (outside - inside)[good] / most[good]
    return out


class QualityHmm:
    """Supervised Gaussian HMM whose emission noise grows as the quality of a modality falls.

    Each modality has its own Gaussian in each state; its covariance in use is
    cov + (noise * (1 - quality) + floor) * I, with noise = max(strength * median variance, floor). Training weights
    are qualities of `least` or more; when decoding, quality goes down to 0. Labels must be 0 to states - 1, and every
    state must have training rows.
    """

    def __init__(self, smoothing: float = 1.0, floor: float = 1e-3, strength: float = 1.0, least: float = 0.01):
        self.smoothing, self.floor, self.strength, self.least = smoothing, floor, strength, least

    def fit(self, sequences: list[tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]], states: int) -> QualityHmm:
        """sequences: labels y [t], observations [modality][t, dim], qualities [modality][t]."""
        prior, trans = np.full(states, self.smoothing), np.full((states, states), self.smoothing)
        for y, xs, qs in sequences:
            if len(y) == 0 or y.min() < 0 or y.max() >= states:
                raise ValueError(f"labels must be 0 to {states - 1}")
            if any(len(x) != len(y) or np.shape(q) != np.shape(y) for x, q in zip(xs, qs, strict=True)):
                raise ValueError("observations, qualities and labels of a sequence differ in length")
        for y, _, _ in sequences:
            prior[y[0]] += 1
            np.add.at(trans, (y[:-1], y[1:]), 1)
        self.prior, self.trans = prior / prior.sum(), trans / trans.sum(1, keepdims=True)
        labels = np.concatenate([y for y, _, _ in sequences])
        self.means, self.covs, self.noise = [], [], []
        for m in range(len(sequences[0][1])):
            x = np.concatenate([s[1][m] for s in sequences])
            q = np.clip(np.concatenate([s[2][m] for s in sequences]), self.least, 1)
            dim = x.shape[1]
            mean, cov = np.zeros((states, dim)), np.zeros((states, dim, dim))
            for k in range(states):
                at = labels == k
                if not at.any():
                    raise ValueError(f"no training rows for state {k}")
                own, w = x[at], q[at]
                mean[k] = (w[:, None] * own).sum(0) / w.sum()
                d = own - mean[k]
                cov[k] = (w[:, None] * d).T @ d / w.sum() + self.floor * np.eye(dim)
            self.means.append(mean)
            self.covs.append(cov)
            self.noise.append(max(self.strength * float(np.median(np.diagonal(cov, axis1=1, axis2=2))), self.floor))
        return self

    def emissions(self, xs: list[np.ndarray], qs: list[np.ndarray]) -> np.ndarray:
        """Log-likelihood [t, state], summed over modalities."""
        total = 0.0
        for x, q, mean, cov, noise in zip(xs, qs, self.means, self.covs, self.noise, strict=True):
            dim = x.shape[1]
            more = noise * (1 - np.clip(q, 0, 1)) + self.floor
            full = cov[None] + more[:, None, None, None] * np.eye(dim)
            d = x[:, None, :] - mean[None]
            solved = np.linalg.solve(full, d[..., None])[..., 0]
            total = total - 0.5 * ((d * solved).sum(-1) + np.linalg.slogdet(full)[1] + dim * np.log(2 * np.pi))
        return total

    def decode(self, xs: list[np.ndarray], qs: list[np.ndarray]) -> np.ndarray:
        return viterbi(np.log(self.prior), np.log(self.trans), self.emissions(xs, qs))

    def posteriors(self, xs: list[np.ndarray], qs: list[np.ndarray]) -> np.ndarray:
        e, trans = self.emissions(xs, qs), np.log(self.trans)
        a, b = np.empty_like(e), np.zeros_like(e)
        a[0] = np.log(self.prior) + e[0]
        for t in range(1, len(e)):
            a[t] = e[t] + np.logaddexp.reduce(a[t - 1][:, None] + trans, 0)
        for t in range(len(e) - 2, -1, -1):
            b[t] = np.logaddexp.reduce(trans + e[t + 1] + b[t + 1], 1)
        return a + b - np.logaddexp.reduce(a + b, 1)[:, None]


def viterbi(prior: np.ndarray, trans: np.ndarray, emissions: np.ndarray) -> np.ndarray:
    """Best state sequence; all arguments are logarithms."""
    steps, states = emissions.shape
    best, back = prior + emissions[0], np.zeros((steps, states), np.int64)
    for t in range(1, steps):
        s = best[:, None] + trans
        back[t] = s.argmax(0)
        best = s.max(0) + emissions[t]
    out = np.zeros(steps, np.int64)
    out[-1] = best.argmax()
    for t in range(steps - 1, 0, -1):
        out[t - 1] = back[t][out[t]]
    return out
