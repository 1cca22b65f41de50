"""Text labels of segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import COUNT, PERCENT, PROFILE_MEANS

# Fixed value: layout of a segment's description.
SEGMENT_LABEL = "%s \n%.0f days \n%.0f orders \n%.0f $ \n%.0f customers (%s%%)"


def cluster_name(label: str) -> Column:
    """``'Cluster 3'`` for label 3."""
    return F.concat(F.lit("Cluster "), F.col(label).cast("string"))


def segment_label(name: str) -> Column:
    """Description of one profile row, whole numbers rounded half to even."""
    whole = [F.bround(F.col(c).cast("double"), 0) for c in (*PROFILE_MEANS, COUNT)]
    return F.format_string(SEGMENT_LABEL, F.col(name), *whole, F.col(PERCENT).cast("string"))
