"""The three segmentations from start to finish, and their comparison."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.centres import assign_centres, centre_model
from ..operators.comparison import combined_results, comparison_for_k, timed
from ..operators.features import standardize
from ..operators.hierarchy import ward_segments
from ..operators.kmeans import SEED, cluster_profile, fit_kmeans
from ..operators.ranking import quartiles
from ..operators.rfm import rfm_table
from ..operators.segments import rfm_profile, scores
from ..operators.silhouette import silhouette_euclidean
from ..schema import CLUSTER, COMPARISON_SCHEMA, LEVEL, check_k
from ..session import stage
from ..sources.comparison import read_comparison, upsert_comparison
from ..sources.results import read_results, save_model, save_results

# Names of the models in the comparison and in combined results.
RFM_MODEL = "RFM Analysis"
KMEANS_MODEL = "KMean Clustering"
WARD_MODEL = "Hierachical Clustering"
COMBINED_NAMES = {RFM_MODEL: "RFM", KMEANS_MODEL: "KMeans", WARD_MODEL: "Hierarchical"}


@dataclass
class Segmentation:
    """A model's profile, the seconds it took and its silhouette. ``fit_seconds``
    is the training part, where there is one."""

    model: str
    k: int
    profile: DataFrame
    seconds: float
    silhouette: float
    fit_seconds: float = 0.0

    def comparison_row(self, spark: SparkSession) -> DataFrame:
        row = (self.k, self.model, float(self.seconds), float(self.silhouette))
        return spark.createDataFrame([row], COMPARISON_SCHEMA)


def staged_rfm(transactions: DataFrame) -> DataFrame:
    """The RFM table of the cleaned transactions, written once: everything
    after it reads customers, not transactions."""
    return stage(rfm_table(transactions), "rfm")


def rfm_segmentation(rfm: DataFrame, k: int) -> Segmentation:
    """Quartile scores and rule table. No silhouette is computed: 0."""
    check_k(k)
    scored = scores(quartiles(rfm))
    profile, seconds = timed(lambda: rfm_profile(scored, k))
    return Segmentation(RFM_MODEL, k, profile, seconds, 0.0)


def euclidean_silhouette_of(assigned: DataFrame) -> float:
    """Silhouette of assignments on the standardised metrics."""
    return silhouette_euclidean(standardize(assigned), CLUSTER).head()["silhouette"]


def kmeans_segmentation(
    rfm: DataFrame, k: int, seeds: Sequence[int] = (SEED,), model_path: str | None = None
) -> Segmentation:
    """K-Means on the standardised metrics; ``seconds`` covers prediction."""
    check_k(k)
    started = time.perf_counter()
    model = fit_kmeans(rfm, k, seeds=seeds)
    fit_seconds = time.perf_counter() - started
    if model_path is not None:
        save_model(model, model_path)
    centres = centre_model(model)
    assigned, seconds = timed(lambda: assign_centres(centres, rfm))
    profile = stage(cluster_profile(assigned, k), "profile")
    silhouette = euclidean_silhouette_of(assigned)
    return Segmentation(KMEANS_MODEL, k, profile, seconds, silhouette, fit_seconds)


def ward_segmentation(rfm: DataFrame, k: int) -> Segmentation:
    """Ward clustering; ``seconds`` covers building the tree and assigning."""
    check_k(k)
    assigned, seconds = timed(lambda: ward_segments(rfm, k))
    profile = stage(cluster_profile(assigned, k), "profile")
    silhouette = silhouette_euclidean(assigned, CLUSTER).head()["silhouette"]
    return Segmentation(WARD_MODEL, k, profile, seconds, silhouette, seconds)


def _folder(root: str, model: str) -> str:
    return f"{root}/{COMBINED_NAMES[model].lower()}_results"


def build_project(spark: SparkSession, transactions: DataFrame, k: int, root: str) -> DataFrame:
    """Run all three models, save their profiles and update the comparison under
    ``root``; returns the comparison."""
    check_k(k)
    rfm = staged_rfm(transactions)
    comparison = None
    for segmentation in (rfm_segmentation, kmeans_segmentation, ward_segmentation):
        result = segmentation(rfm, k)
        save_results(result.profile, _folder(root, result.model))
        comparison = upsert_comparison(spark, f"{root}/comparison", result.comparison_row(spark))
    return comparison


def select_model(spark: SparkSession, k: int, root: str) -> tuple[DataFrame, DataFrame]:
    """Saved comparison and combined profiles for ``k`` clusters."""
    comparison = comparison_for_k(read_comparison(spark, f"{root}/comparison"), k)
    profiles = {
        name: read_results(
            spark, _folder(root, model), LEVEL if model == RFM_MODEL else CLUSTER
        )
        for model, name in COMBINED_NAMES.items()
    }
    return comparison, combined_results(profiles, k)
