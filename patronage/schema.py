"""Column names and file layouts shared by all modules."""

from pyspark.sql import types as T

# Names of the transaction, RFM, profile and comparison columns
# as they appear in users' files.
CUSTOMER = "customer_id"
DATE = "transaction_date"
QUANTITY = "num_cds_purchased"
VALUE = "transaction_value"
TRANSACTION_COLUMNS = (CUSTOMER, DATE, QUANTITY, VALUE)

RECENCY = "Recency"
FREQUENCY = "Frequency"
MONETARY = "Monetary"
METRICS = (RECENCY, FREQUENCY, MONETARY)

LEVEL = "RFM_level"
CLUSTER = "Cluster"
PROFILE_MEANS = ("RecencyMean", "FrequencyMean", "MonetaryMean")
COUNT = "Count"
PERCENT = "Percent"
NUM_CLUSTERS = "Number of Clusters"
MODEL = "Model"
SECONDS = "Execution Time (s)"
SILHOUETTE = "Silhouette Score"

# The acceptance window for newly entered transactions and the
# day newly scored customers are measured at.
FIRST_ACCEPTED_DAY = "1997-01-01"
LAST_ACCEPTED_DAY = "1998-06-30"
SCORING_DAY = "1998-06-30"

# Supported numbers of segments.
MIN_CLUSTERS = 2
MAX_CLUSTERS = 7

MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField(CUSTOMER, T.StringType()),
        T.StructField(DATE, T.DateType()),
        T.StructField(QUANTITY, T.IntegerType()),
        T.StructField(VALUE, MONEY),
    ]
)

COMPARISON_SCHEMA = T.StructType(
    [
        T.StructField(NUM_CLUSTERS, T.IntegerType()),
        T.StructField(MODEL, T.StringType()),
        T.StructField(SECONDS, T.DoubleType()),
        T.StructField(SILHOUETTE, T.DoubleType()),
    ]
)


def profile_schema(label: str) -> T.StructType:
    """Layout of a saved segment profile whose segment column is ``label``."""
    return T.StructType(
        [T.StructField(label, T.StringType())]
        + [T.StructField(mean, T.DoubleType()) for mean in PROFILE_MEANS]
        + [
            T.StructField(COUNT, T.LongType()),
            T.StructField(PERCENT, T.DoubleType()),
            T.StructField(NUM_CLUSTERS, T.IntegerType()),
        ]
    )


def check_k(k: int) -> int:
    """Reject an unsupported number of segments before any job starts."""
    if isinstance(k, bool) or not isinstance(k, int) or not MIN_CLUSTERS <= k <= MAX_CLUSTERS:
        raise ValueError(f"number of clusters must be {MIN_CLUSTERS}..{MAX_CLUSTERS}, got {k!r}")
    return k
