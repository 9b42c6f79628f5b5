"""tagwave: a Spark-native batch pipeline for satellite-tag telemetry.

Loads per-tag products (messages, dive histograms, timelines, locations)
with stable surrogate ids, reports the import status of every tag and
product, flags records in one pass with the QA rule set, reshapes wide
24-bin histograms into hourly timelines, cleans partner CSV files and
exports deployment metadata.  Every transform is a DataFrame -> DataFrame
function built from Spark's own expressions; reads and writes sit at the
edges (``tagwave.sources``).
"""

__all__ = ["session", "schemas"]
