"""Feature selection, capping and scaling as fit/transform pairs."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txsieve.functions.numeric import capped, standardized
from txsieve.operators.quantiles import approximate_quantiles, exact_quantiles
from txsieve.schemas import CAP_QUANTILE, FEATURES


def select_features(df: DataFrame, features: list[str] = FEATURES, *keep: str) -> DataFrame:
    """Feature columns in model order as doubles, after any columns to keep."""
    return df.select(*keep, *[F.col(name).cast("double").alias(name) for name in features])


def complete_rows(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Rows in which every feature has a value (neither NULL nor NaN).

    Written as one condition per column rather than ``dropna``, because only
    plain NULL checks are pushed into the scan.
    """
    types = dict(df.dtypes)
    for name in features:
        df = df.where(F.col(name).isNotNull())
        if types[name] in ("double", "float"):
            df = df.where(~F.isnan(name))
    return df


def feature_caps(
    df: DataFrame,
    features: list[str] = FEATURES,
    q: float = CAP_QUANTILE,
    method: str = "exact",
    rows: int | None = None,
) -> dict[str, float | None]:
    """Upper cap of each feature. ``method="approx"`` needs a single scan."""
    if method == "exact":
        return exact_quantiles(df, features, q, rows=rows)
    if method == "approx":
        return approximate_quantiles(df, features, q)
    raise ValueError(f"method must be 'exact' or 'approx', got {method!r}")


def feature_moments(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Mean and population deviation of all features in one row."""
    return df.agg(
        *[F.avg(name).alias(f"{name}_mean") for name in features],
        *[F.stddev_pop(name).alias(f"{name}_sd") for name in features],
    )


def caps_frame(df: DataFrame, caps: dict[str, float | None]) -> DataFrame:
    """Fitted caps as one row per feature."""
    rows = [(name, None if cap is None else float(cap)) for name, cap in caps.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, cap double")


def moments_long(moments: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """The moments row as one row per feature."""
    entries = [
        F.struct(
            F.lit(name).alias("feature"),
            F.col(f"{name}_mean").alias("mean"),
            F.col(f"{name}_sd").alias("sd"),
        )
        for name in features
    ]
    return moments.select(F.inline(F.array(*entries)))


def winsorize(df: DataFrame, caps: dict[str, float | None]) -> DataFrame:
    """Clip each feature from above at its cap; the lower side is left alone."""
    return df.withColumns(
        {name: capped(F.col(name).cast("double"), cap) for name, cap in caps.items()}
    )


@dataclass(frozen=True)
class Preprocessor:
    """Fitted caps, means and deviations: 3 numbers per feature.

    Being scalars, they enter later plans as literals: no join, no broadcast,
    and the whole transform stays inside one generated projection.
    """

    features: list[str]
    caps: list[float | None]
    means: list[float]
    sds: list[float]

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        features: list[str] = FEATURES,
        method: str = "exact",
        rows: int | None = None,
    ) -> Preprocessor:
        """Fit on complete rows, whose number may be passed if known.

        ``df`` is scanned several times, see ``exact_quantiles``.
        """
        clean = complete_rows(select_features(df, features), features)
        rows = clean.count() if rows is None else rows
        if rows == 0:
            raise ValueError("no complete rows to fit on")
        caps = feature_caps(clean, features, method=method, rows=rows)
        moments = feature_moments(winsorize(clean, caps), features).first()
        return cls(
            list(features),
            [caps[name] for name in features],
            [moments[f"{name}_mean"] for name in features],
            [moments[f"{name}_sd"] for name in features],
        )

    def reproducible(self) -> Preprocessor:
        """Drop the digits of means and deviations that depend on the merge order of sums.

        The same rows then scale to the same doubles however they were split.
        """

        def shorten(values: list[float]) -> list[float]:
            return [float(f"{value:.12g}") for value in values]

        return replace(self, means=shorten(self.means), sds=shorten(self.sds))

    def scaled_columns(self) -> list:
        """One expression per feature: cast, cap, standardise."""
        return [
            standardized(capped(F.col(name).cast("double"), cap), mean, sd)
            for name, cap, mean, sd in zip(self.features, self.caps, self.means, self.sds)
        ]

    def transform(self, df: DataFrame, *keep: str) -> DataFrame:
        """Scaled features of every row, after any columns to keep."""
        scaled = [
            column.alias(name) for name, column in zip(self.features, self.scaled_columns())
        ]
        return df.select(*keep, *scaled)


def maxabs_scale(df: DataFrame, features: list[str] = FEATURES, *keep: str) -> DataFrame:
    """Divide each feature by its largest absolute value over the table.

    A column that is zero throughout gives NULL. The divisors are scalar
    subqueries which Spark merges into a single aggregate.
    """
    peaks = df.agg(*[F.max(F.abs(F.col(name).cast("double"))).alias(name) for name in features])
    return df.select(
        *keep,
        *[
            F.try_divide(F.col(name).cast("double"), peaks.select(name).scalar()).alias(name)
            for name in features
        ],
    )
