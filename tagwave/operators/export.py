"""Deployment-metadata export (SRC-5, FLT-4, FN-11, PRJ-14, SNK-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwave import schemas as S
from tagwave.functions.timefmt import wall_time_to_utc
from tagwave.sources.csv import write_r_csv, write_r_csv_file

# Exported columns, in file order.
EXPORT_COLUMNS = ["piemail", "datamanageremail", "tagmanufacturer", "tagmodel", "tagserialnumber",
                  "sensors", "pttid", "argosprogramnum", "deploymentid", "deploymentstartdate",
                  "deploymentstopdate", "deploymentlatitude", "deploymentlongitude", "species",
                  "animalid"]
ACTION_INSERT = "I"
TIME_COLUMNS = ["deploymentstartdate", "deploymentstopdate"]


def export_rows(details: DataFrame, action: str = ACTION_INSERT,
                zone: str = S.EXPORT_SOURCE_ZONE) -> DataFrame:
    """Rows to share: ``action_lku = action``; the two deployment times are
    zone-less wall times in ``zone`` and are written as UTC; 15 columns in
    the fixed order.  The filter and the column list reach the scan
    (pushed filter, pruned read schema)."""
    rows = details.where(F.col("action_lku") == F.lit(action))
    rows = rows.withColumns({c: wall_time_to_utc(F.col(c), zone) for c in TIME_COLUMNS})
    return rows.select(*EXPORT_COLUMNS)


def write_export(rows: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV as R's ``write.csv`` prints it: header and texts quoted, ``NA`` for
    missing values, times plain.  The rows are written in parallel; with
    ``single_file`` the parts are then joined into ``export.csv`` in the folder
    ``path`` by the file system, else each part has the header."""
    if single_file:
        write_r_csv_file(rows, path, "export.csv")
    else:
        write_r_csv(rows, path)
