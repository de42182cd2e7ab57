"""Landing posts as JSON-lines files for a file stream source."""

from __future__ import annotations

from pyspark.sql import DataFrame


def land_posts(posts: DataFrame, path: str, files: int, records: int | None = None) -> str:
    """Write posts as ``files`` JSON-lines files under ``path`` (the stream's landing folder).

    Rows are dealt round-robin, so each file holds a similar share; a reader
    with ``maxFilesPerTrigger=1`` then sees one file per micro-batch.  With
    ``records``, each of the ``files`` writers starts a new file after so many
    posts: a micro-batch of one file is at most ``records`` posts, and the
    checkpoint's file log replays the same ones.
    """
    writer = posts.repartition(files).write.mode("overwrite")
    if records:
        writer = writer.option("maxRecordsPerFile", records)
    writer.json(path)
    return path
