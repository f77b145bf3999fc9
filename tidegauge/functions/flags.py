"""The flag lattice: rules give a quality and a problem, the worst of each wins.

Quality: BAD > NOISY > GOOD. Problem: FLAT > CLIPPING > ARTIFACT > NONE. A rule whose condition is NULL
(a metric that could not be computed) adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUALITIES = ("GOOD", "NOISY", "BAD")
PROBLEMS = ("NONE", "ARTIFACT", "CLIPPING", "FLAT")

Rule = tuple[Column, str, str]


def _worst(rules: list[Rule], names: tuple[str, ...], at: int) -> Column:
    ranks = [F.when(F.coalesce(r[0], F.lit(False)), names.index(r[at])).otherwise(0) for r in rules]
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.greatest(F.lit(0), F.lit(0), *ranks) + 1)


def flags(rules: list[Rule]) -> list[Column]:
    """quality_flag and problem_flag of a row."""
    return [_worst(rules, QUALITIES, 1).alias("quality_flag"), _worst(rules, PROBLEMS, 2).alias("problem_flag")]


def steps(value: Column, good: Column, noisy: Column, noisy_problem: str, bad_problem: str) -> list[Rule]:
    """good -> nothing, else noisy -> NOISY, else BAD; nothing if the value is NULL."""
    there = value.isNotNull()
    return [(there & ~good & noisy, "NOISY", noisy_problem), (there & ~good & ~noisy, "BAD", bad_problem)]


def at_least(value: Column, good: float, noisy: float, noisy_problem: str = "ARTIFACT", bad_problem: str = "ARTIFACT") -> list[Rule]:
    return steps(value, value >= good, value >= noisy, noisy_problem, bad_problem)


def at_most(value: Column, good: float, noisy: float, noisy_problem: str = "ARTIFACT", bad_problem: str = "ARTIFACT") -> list[Rule]:
    return steps(value, value <= good, value <= noisy, noisy_problem, bad_problem)


def acc(completeness: Column, out_ratio: Column, run: Column, flat: Column) -> list[Rule]:
    return [
        *at_least(completeness, 0.95, 0.80),
        (out_ratio != 0, "BAD", "ARTIFACT"),
        *at_most(run, 1, 2, "CLIPPING", "CLIPPING"),
        (flat, "BAD", "FLAT")
    ]


def bvp(
    completeness: Column,
    amplitude: Column,
    std: Column,
    run: Column,
    kurtosis: Column,
    low: float = 5,
    high: float = 400,
    still: float = 2,
) -> list[Rule]:
    return [
        *at_least(completeness, 0.95, 0.80),
        ((amplitude < low) & (std < still), "BAD", "FLAT"),
        ((amplitude < low) & F.coalesce(std >= still, F.lit(True)), "BAD", "ARTIFACT"),
        (amplitude > high, "BAD", "ARTIFACT"),
        *at_most(run, 1, 2, "CLIPPING", "CLIPPING"),
        (kurtosis > 3.5, "NOISY", "ARTIFACT"),
    ]


def eda(completeness: Column, out_ratio: Column, std: Column, jump: Column, still: tuple = (0.005, 0.002), jumps: tuple = (5.0, 10.0)) -> list[Rule]:
    return [
        *at_least(completeness, 0.95, 0.80),
        (out_ratio >= 0.05, "BAD", "ARTIFACT"),
        *at_least(std, *still, "NONE", "FLAT"),
        *at_most(jump, *jumps)
    ]


def hr(
    completeness: Column,
    mean: Column,
    std: Column,
    change: Column,
    inner: tuple = (40, 180),
    outer: tuple = (30, 220),
    still: tuple = (0.5, 0.1),
    changes: tuple = (3, 6),
) -> list[Rule]:
    return [
        *at_least(completeness, 0.9, 0.7),
        *steps(mean, mean.between(*inner), mean.between(*outer), "NONE", "ARTIFACT"),
        *at_least(std, *still, "NONE", "FLAT"),
        *at_most(change, *changes, "NONE", "ARTIFACT"),
    ]


def ibi(n: Column, out_ratio: Column, gap: Column, counts: tuple = (8, 5), gaps: tuple = (2.0, 4.0)) -> list[Rule]:
    return [*at_least(n, *counts), (out_ratio != 0, "BAD", "ARTIFACT"), *at_most(gap, *gaps)]


def temp(
    completeness: Column, out_ratio: Column, mean: Column, std: Column, jump: Column, warm: tuple = (25.0, 28.0), still: tuple = (0.01, 0.005), jumps: tuple = (0.2, 0.5)
) -> list[Rule]:
    return [
        *at_least(completeness, 0.95, 0.80),
        (out_ratio > 0.05, "BAD", "ARTIFACT"),
        ((mean >= warm[0]) & (mean < warm[1]), "NOISY", "NONE"),
        *at_least(std, *still, "NONE", "FLAT"),
        *at_most(jump, *jumps),
    ]


def brainwave(zero: Column, flat: Column, spike: Column) -> list[Rule]:
    return [(zero, "BAD", "ARTIFACT"), (flat, "BAD", "FLAT"), (spike, "NOISY", "ARTIFACT")]


def attention(n: Column, zeros: Column, delta: Column, clipped: Column, run: Column, expected: int, most: float = 40) -> list[Rule]:
    # Python rounds halves to even
    share = lambda x: max(1, round(x * expected))
    return [
        *at_least(n, expected, share(0.7)),
        (zeros, "BAD", "ARTIFACT"),
        (delta > most, "BAD", "ARTIFACT"),
        (clipped >= expected, "BAD", "CLIPPING"),
        (clipped >= share(0.8), "NOISY", "CLIPPING"),
        (run >= expected, "BAD", "FLAT"),
        (run >= share(0.9), "NOISY", "FLAT"),
    ]


def eeg(n: Column, expected: int, nan_present: Column, std: Column, noise: Column, z: Column, run: Column, peak_to_peak: Column) -> list[Rule]:
    over, far = F.coalesce(noise > 0.5, F.lit(False)), F.coalesce(F.abs(z) > 3, F.lit(False))
    return [
        *at_least(n, expected, round(0.8 * expected)),
        (nan_present | F.coalesce(std < 0.5, F.lit(False)), "BAD", "FLAT"),
        (over & far, "BAD", "ARTIFACT"),
        (over | far, "NOISY", "ARTIFACT"),
        (run >= 5, "BAD", "CLIPPING"),
        (peak_to_peak > 500, "BAD", "ARTIFACT"),
    ]


def audio(rms_db: Column, zero_ratio: Column, clip_ratio: Column, clip_run: Column) -> list[Rule]:
    return [((rms_db < -60) | (zero_ratio > 0.5), "BAD", "FLAT"), ((clip_ratio > 0.001) | (clip_run >= 3), "BAD", "CLIPPING")]


def video(blur: Column, clipping: Column, face: Column, blurs: tuple, clippings: tuple, faces: tuple) -> list[Rule]:
    """Blur and faces are low when below a limit, clipping is high from a limit on. Clipping hides what else is bad."""
    clipped, unclear = clipping >= clippings[1], (blur < blurs[1]) | (face < faces[1])
    return [
        (blur.isNull(), "BAD", "ARTIFACT"),
        (clipped, "BAD", "CLIPPING"),
        (~clipped & unclear, "BAD", "ARTIFACT"),
        ((blur < blurs[0]) | (clipping >= clippings[0]) | (face < faces[0]), "NOISY", "NONE"),
    ]


def majority(bad: Column, noisy: Column, n: Column) -> Column:
    """BAD if over half are bad, NOISY if over half are not good, GOOD else; NULL without votes."""
    return F.when(n == 0, None).when(bad > n / 2, "BAD").when(bad + noisy > n / 2, "NOISY").otherwise("GOOD")
