"""Customer segmentation (k-means on standardised features) and dashboard export."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .analysis import EXPORT_COLUMNS

# Features, labels (ascending mean MRR), k, seed and restarts.
SEGMENT_FEATURES = ("months_since_signup", "ticket_count", "total_feature_clicks", "distinct_features_used",
                    "mrr_usd", "total_session_sec")
SEGMENT_LABELS = ("At-Risk / Low-Value", "Growth Potential", "Champions (High-Value)")
K = 3
SEED = 42
RESTARTS = 10
#: Rounds that the best fit is refined for at most.
MAX_ROUNDS = 100


@dataclass(frozen=True)
class SegmentModel:
    """A fitted segmentation: standardisation, centres (standardised, one per segment) and segment names. A small value
    that any number of frames can be assigned by, without another fit."""

    features: tuple[str, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]
    centres: tuple[tuple[float, ...], ...]
    labels: tuple[str, ...]

    def distances(self) -> list[Column]:
        """Squared standardised distance to each centre."""
        z = [(F.col(f).cast("double") - F.lit(m)) / F.lit(s or 1.0) for f, m, s in zip(self.features, self.mean, self.std)]
        return [sum(((x - F.lit(c)) * (x - F.lit(c)) for x, c in zip(z, centre)), F.lit(0.0)) for centre in self.centres]

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with missing features as 0, its rows' segment (the nearest centre, the lower one of two) and label."""
        d = F.array(*self.distances())
        label = F.element_at(F.array(*[F.lit(x) for x in self.labels]), F.col("segment") + 1)
        return df.fillna(0, subset=list(self.features)).withColumn(
            "segment", (F.array_position(d, F.array_min(d)) - 1).cast("int")).withColumn("segment_label", label)

    def centre_frame(self, spark: SparkSession) -> DataFrame:
        """The centres in original units, one row per segment."""
        rows = [(i, *[c * s + m for c, m, s in zip(centre, self.mean, self.std)], self.labels[i]) for i, centre in enumerate(self.centres)]
        return spark.createDataFrame(rows, "segment int, " + ", ".join(f"{f} double" for f in self.features) + ", segment_label string")


def profile(assigned: DataFrame) -> DataFrame:
    """Per segment: size, means and churn rate, rounded to 2 decimals."""
    return assigned.groupBy("segment", "segment_label").agg(
        F.count(F.lit(1)).alias("count"),
        F.bround(F.avg("mrr_usd"), 2).alias("avg_mrr"),
        F.bround(F.avg("total_feature_clicks"), 2).alias("avg_clicks"),
        F.bround(F.avg("distinct_features_used"), 2).alias("avg_features"),
        F.bround(F.avg(F.col("is_churned").cast("double")), 2).alias("churn_rate"))


def fit_segments(df: DataFrame, features: Sequence[str] = SEGMENT_FEATURES, k: int = K, seed: int = SEED, restarts: int = RESTARTS,
                 labels: Sequence[str] = SEGMENT_LABELS, checkpoint: bool = True, parallelism: int | None = None) -> SegmentModel:
    """K-means on standardised features: ``restarts`` fits with consecutive seeds, of which the one with the lowest cost is
    refined until no row changes its segment, so that each centre is its members' mean.

    The features are written once into the shared checkpoint folder: the fits read them many times, and a lost executor
    reads the files again. Labels follow the ascending, 2-decimal rounded mean MRR of the segments.
    """
    base = df.fillna(0, subset=list(features))
    base = cut_lineage(base) if checkpoint else base.persist(StorageLevel.MEMORY_AND_DISK)
    return fit_written(base, features, k, seed, restarts, labels, parallelism)


def fit_written(base: DataFrame, features: Sequence[str] = SEGMENT_FEATURES, k: int = K, seed: int = SEED, restarts: int = RESTARTS,
                labels: Sequence[str] = SEGMENT_LABELS, parallelism: int | None = None) -> SegmentModel:
    """``fit_segments`` on a frame that is cheap to read many times and misses no features."""
    feats = list(features)
    assembler = VectorAssembler(inputCols=feats, outputCol="_x")
    scaler = StandardScaler(inputCol="_x", outputCol="_z", withMean=True, withStd=True)
    prep = Pipeline(stages=[assembler, scaler]).fit(base)
    # the fits pass over the vectors some hundred times and read nothing else
    scaled = prep.transform(base.select(*feats)).select("_z").persist(StorageLevel.MEMORY_AND_DISK)

    def fit(i):
        model = KMeans(k=k, seed=seed + i, featuresCol="_z", predictionCol="segment").fit(scaled)
        return model.summary.trainingCost, i, model

    # restarts are independent Spark jobs: submit them concurrently (the
    # scheduler interleaves their tasks); lowest cost wins, lowest seed on ties
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism or restarts, restarts))) as pool:
        fits = list(pool.map(fit, range(restarts)))
    best = min(fits, key=lambda f: (f[0], f[1]))[2]
    scaled.unpersist()
    scaler_model = prep.stages[-1]
    mean, std = (tuple(float(x) for x in v.toArray()) for v in (scaler_model.mean, scaler_model.std))
    centres = tuple(tuple(float(x) for x in c) for c in best.clusterCenters())
    model = _settled(SegmentModel(tuple(feats), mean, std, centres, ("",) * len(centres)), base)
    # k rows: label by ascending rounded mean MRR (segment id breaks ties)
    ordered = [r["segment"] for r in profile(model.assign(base)).orderBy("avg_mrr", "segment").collect()]
    names = {s: labels[i] if i < len(labels) else f"segment_{i}" for i, s in enumerate(ordered)}
    return replace(model, labels=tuple(names.get(i, f"segment_{i}") for i in range(len(centres))))


def _settled(model: SegmentModel, base: DataFrame, rounds: int = MAX_ROUNDS) -> SegmentModel:
    """Centres moved to their members' means until they stay (k rows reach the driver per round)."""
    for _ in range(rounds):
        means = model.assign(base).groupBy("segment").agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in model.features]).collect()
        moved = {r["segment"]: tuple((r[f] - m) / (s or 1.0) for f, m, s in zip(model.features, model.mean, model.std)) for r in means}
        centres = tuple(moved.get(i, c) for i, c in enumerate(model.centres))
        if max(abs(a - b) for x, y in zip(centres, model.centres) for a, b in zip(x, y)) < 1e-12:
            break
        model = replace(model, centres=centres)
    return model


def segment_customers(df: DataFrame, features: Sequence[str] = SEGMENT_FEATURES, k: int = K, seed: int = SEED,
                      restarts: int = RESTARTS, labels: Sequence[str] = SEGMENT_LABELS, checkpoint: bool = True,
                      parallelism: int | None = None, model: SegmentModel | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Assign each customer a segment and a label.

    Returns (frame with segment/label, per-segment stats, centres in original units). A ``model`` fitted before
    is used as it is; without one it is fitted on ``df``.
    """
    model = model or fit_segments(df, features, k, seed, restarts, labels, checkpoint, parallelism)
    out = model.assign(df)
    return out, profile(out), model.centre_frame(df.sparkSession)


def centre_facts(df: DataFrame, model: SegmentModel) -> DataFrame:
    """What holds for the centres whatever their order: per segment its label, members, whether each centre is its members' mean,
    and how many members lie nearer to another centre."""
    d = F.array(*model.distances())
    own = F.element_at(d, F.col("segment") + 1)
    means = model.assign(df).groupBy("segment", "segment_label").agg(
        F.count(F.lit(1)).alias("members"), F.count_if(F.array_min(d) < own).alias("nearer_elsewhere"),
        *[F.avg(F.col(f).cast("double")).alias(f"mean_{f}") for f in model.features])
    near = [F.abs(F.col(f"mean_{f}") - F.col(f)) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(F.col(f))) for f in model.features]
    j = means.join(model.centre_frame(df.sparkSession).drop("segment_label"), "segment")
    return j.select("segment_label", (F.col("members") > 0).alias("has_members"), reduce(lambda a, b: a & b, near).alias("centre_is_mean"), "nearer_elsewhere")


def export_frame(df: DataFrame, columns: Sequence[str] = EXPORT_COLUMNS) -> DataFrame:
    """The dashboard columns that exist, in order (missing ones are skipped)."""
    return df.select(*[c for c in columns if c in df.columns])


def export_dashboard(df: DataFrame, path: str, columns: Sequence[str] = EXPORT_COLUMNS) -> None:
    """Write the dashboard CSV (header, no index) as a distributed write."""
    export_frame(df, columns).write.mode("overwrite").option("header", True).csv(path)
