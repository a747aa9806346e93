from pyspark.sql import SparkSession

from footfall.contract import LOT_TABLES
from footfall.sources.lots import read_lot
from footfall.sources.tables import write_table


def load_lots(spark: SparkSession, paths: list[str], tables: list[str] = LOT_TABLES) -> None:
    """Load each KPI folder into its catalog table, replacing the table.

    A table has every column that any of its files has; rows of files without it are NULL there.
    """
    for path, table in zip(paths, tables, strict=True):
        write_table(read_lot(spark, path, recursive=True), table)
