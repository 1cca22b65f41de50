"""Scoring new transactions with a trained model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CUSTOMER, FIRST_ACCEPTED_DAY, LAST_ACCEPTED_DAY, SCORING_DAY
from ..session import stage
from .centres import CentreModel, assign_centres, centre_model, rescaled
from .clean import accepted, validate_transactions
from .rfm import rfm_table

# Fixed value: the id given to a customer entered by hand.
ENTERED_CUSTOMER = "00001"


def score(
    transactions: DataFrame,
    model: CentreModel | PipelineModel,
    as_of: str = SCORING_DAY,
    rescale: str = "trained",
) -> DataFrame:
    """Cluster of each customer in a batch of new transactions.

    Recency is measured at ``as_of``; the transactions are taken as they are.
    The scaler learned in training is used, so a customer's cluster does not
    depend on who else is in the batch; ``rescale='batch'`` fits it to the batch.
    """
    if isinstance(model, PipelineModel):
        model = centre_model(model)
    rfm = rfm_table(transactions, as_of=as_of, clean=False)
    if rescale == "batch":
        rfm = stage(rfm, "batch-rfm")  # read by the fit and by the prediction
        model = rescaled(model, rfm)
    elif rescale != "trained":
        raise ValueError(f"unknown rescale {rescale!r}")
    return assign_centres(model, rfm)


def score_single(
    entered: DataFrame,
    model: CentreModel | PipelineModel,
    as_of: str = SCORING_DAY,
    start: str = FIRST_ACCEPTED_DAY,
    end: str = LAST_ACCEPTED_DAY,
) -> DataFrame:
    """Cluster of one new customer from the transactions entered for them.

    Entries failing validation are left out; no valid entry, no row.
    """
    valid = accepted(validate_transactions(entered, start, end))
    return score(valid.withColumn(CUSTOMER, F.lit(ENTERED_CUSTOMER)), model, as_of)
