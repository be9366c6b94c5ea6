"""Harmonic distortion from sampled waveforms."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from fleetwatt.config import LIMITS, PlantLimits

HARMONICS = 40


def thd(
    waves: DataFrame,
    keys: list[str],
    n: str = "n",
    value: str = "value",
    samples: int = 128,
    harmonics: int = HARMONICS,
) -> DataFrame:
    """Total harmonic distortion per waveform over exactly one period.

    Every harmonic is a pair of sums in one grouped aggregate, so rows are not
    multiplied by the number of harmonics and partial sums merge before the
    shuffle. The angle of harmonic h at sample n depends on h*n modulo the
    number of samples only: sines and cosines come from one period of a table. A waveform with a
    missing sample or value has no result.
    """
    if 2 * harmonics >= samples:
        raise ValueError(f"{samples} samples do not tell {harmonics} harmonics apart")
    turn = [2.0 * math.pi * i / samples for i in range(samples)]
    cosine = F.lit([math.cos(a) for a in turn])
    sine = F.lit([math.sin(a) for a in turn])
    orders = range(1, harmonics + 1)
    sums = []
    for h in orders:
        at = F.pmod(F.col(n) * F.lit(h), F.lit(samples)).cast("int")
        sums.append(F.sum(F.col(value) * F.get(cosine, at)).alias(f"_c{h}"))
        sums.append(F.sum(F.col(value) * F.get(sine, at)).alias(f"_s{h}"))
    energy = lambda h: F.col(f"_c{h}") * F.col(f"_c{h}") + F.col(f"_s{h}") * F.col(f"_s{h}")
    distortion = sum((energy(h) for h in orders[2:]), energy(2))
    whole = F.col("_samples") == samples
    return (
        waves.groupBy(*keys)
        .agg(*sums, F.count(value).alias("_samples"))
        .select(
            *keys,
            F.when(whole, F.sqrt(energy(1)) * F.lit(2.0 / samples)).alias("fundamental"),
            F.when(whole, F.try_divide(F.sqrt(distortion), F.sqrt(energy(1))) * 100.0).alias("thd_pct"),
        )
    )


def thd_check(
    thds: DataFrame, keys: list[str], kind: str = "kind", limits: PlantLimits = LIMITS
) -> DataFrame:
    """Voltage and current distortion side by side, both strictly below their limits."""
    of = lambda name: F.max(F.when(F.col(kind) == name, F.col("thd_pct")))
    volts, amps = F.col("thd_voltage_pct"), F.col("thd_current_pct")
    within = (volts < limits.thd_voltage_max_pct) & (amps < limits.thd_current_max_pct)
    return (
        thds.groupBy(*keys)
        .agg(of("voltage").alias("thd_voltage_pct"), of("current").alias("thd_current_pct"))
        .withColumn("thd_passed", F.coalesce(within, F.lit(False)))
    )
