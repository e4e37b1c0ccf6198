"""The fixed body dimension and body-list arguments."""

from pyspark.sql import DataFrame, SparkSession

from ..constants import BODIES
from ..schemas import BODY


def bodies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BODIES, BODY)


def body_ids(arg="all") -> list[str]:
    """Ids named by a body argument: ``"all"``, one id, a comma list, or id/name records."""
    if isinstance(arg, (list, tuple)):
        given = [b.get("id") if isinstance(b, dict) else b for b in arg]
    elif arg is None or str(arg).lower() == "all":
        given = [body_id for body_id, _ in BODIES]
    else:
        given = str(arg).split(",")
    return [str(b).strip() for b in given if b not in (None, "")]
