"""Edge projection for published results: DECIMAL → DOUBLE, DATE → ISO text,
TIMESTAMP → naive UTC timestamp.

Inside plans money stays DECIMAL and dates stay DATE; results handed to clients
(and to the DuckDB comparison) use types every client maps the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampType


def edge(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")  # UTC wall-clock time (session zone is UTC)
        cols.append(c.alias(f.name))
    return df.select(*cols)
