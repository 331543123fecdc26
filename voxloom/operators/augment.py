"""Sample-array augmentation: gain, Gaussian noise, background noise, each drawn from hashes of the row key."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import unit_hash
from .ordering import dense_index

# Ranges and probabilities of the training recipe.
GAIN_DB = (-2.0, 2.0)
GAIN_P = 0.1
BACKGROUND_SNR_DB = (1.0, 2.0)
BACKGROUND_P = 0.9
FLIP_P = 0.5
GAUSSIAN_AMPLITUDE = (0.005, 0.015)
GAUSSIAN_P = 0.4


def assign_noise(df: DataFrame, noise: DataFrame, key: str, seed: int = 0, noise_id: str = "noise_id") -> DataFrame:
    """Give every row one noise clip, drawn by hash; ``noise`` has an integer id and ``noise_samples``.

    Clips are numbered and joined on the number. Every clip is drawn about equally often, and whether the
    noise table is small enough to broadcast is left to its measured size. Without any clip every row is kept
    and has null noise, which ``augment`` leaves out.
    """
    numbered = dense_index(noise, noise_id, name="_pick")
    n = noise.agg(F.count("*")).scalar()
    pick = F.floor(unit_hash(F.col(key), seed, "clip") * n).cast("bigint")
    return df.withColumn("_pick", pick).join(numbered, "_pick", "left").drop("_pick")


def invert(samples: Column) -> Column:
    return F.transform(samples, lambda x: -x)


def _between(u: Column, bounds: tuple[float, float]) -> Column:
    return F.lit(bounds[0]) + u * (bounds[1] - bounds[0])


@lru_cache(maxsize=1)
def _mixer():
    @F.arrow_udf("array<float>")
    def mix(
        samples: pa.Array, noise: pa.Array, gain: pa.Array, snr: pa.Array, sign: pa.Array, sigma: pa.Array, seed: pa.Array
    ) -> pa.Array:
        def rows(a: pa.Array) -> list[np.ndarray]:
            return [v.values.to_numpy(zero_copy_only=False) if v.is_valid else None for v in a]

        out = []
        settings = zip(gain.to_pylist(), snr.to_pylist(), sign.to_pylist(), sigma.to_pylist(), seed.to_pylist())
        for x, clip, (g, db, flip, spread, start) in zip(rows(samples), rows(noise), settings):
            if x is None:
                out.append(None)
                continue
            y = x.astype(np.float64) * g
            if db is not None and clip is not None and len(clip) and len(y):
                layer = np.resize(clip.astype(np.float64), len(y))
                loud = float(np.sqrt(np.mean(layer**2)))
                if loud > 0:
                    y = y + flip * layer * (np.sqrt(np.mean(y**2)) / 10 ** (db / 20) / loud)
            if spread is not None:
                y = y + np.random.default_rng(start & 0x7FFFFFFFFFFFFFFF).normal(0.0, spread, len(y))
            out.append(y.astype(np.float32))
        return pa.array(out, pa.list_(pa.float32()))

    return mix.asNondeterministic()


def augment_settings(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Add what will be done to each row: ``gain``, ``snr_db``, ``noise_sign``, ``sigma``; null means not applied.

    One of background and Gaussian noise is picked per row, and then applied with its own probability.
    """

    def draw(what: str) -> Column:
        return unit_hash(F.col(key), seed, what)

    db = _between(draw("gain_db"), GAIN_DB)
    background = draw("one_of") < 0.5
    return (
        df.withColumn("gain", F.when(draw("gain") < GAIN_P, F.pow(F.lit(10.0), db / 20)).otherwise(1.0))
        .withColumn("snr_db", F.when(background & (draw("background") < BACKGROUND_P), _between(draw("snr"), BACKGROUND_SNR_DB)))
        .withColumn("noise_sign", F.when(draw("flip") < FLIP_P, -1.0).otherwise(1.0))
        .withColumn("sigma", F.when(~background & (draw("gaussian") < GAUSSIAN_P), _between(draw("sigma"), GAUSSIAN_AMPLITUDE)))
    )


def augment(df: DataFrame, key: str, samples: str = "samples", noise: str = "noise_samples", seed: int = 0) -> DataFrame:
    """Augmented copy of each row; needs the noise clip that ``assign_noise`` adds."""
    start = F.xxhash64(F.col(key), F.lit(seed))
    args = [F.col(c) for c in (samples, noise, "gain", "snr_db", "noise_sign", "sigma")]
    return augment_settings(df, key, seed).withColumn(samples, _mixer()(*args, start))
