"""Writers: one document or model per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_documents(rows: DataFrame, folder: str, name: str = "name", value: str = "json") -> None:
    """One text file per name, in a folder of its own; executors write in parallel through Spark's committer."""
    rows.select(F.col(name).alias("name"), F.col(value).alias("value")).write.mode("overwrite").partitionBy("name").text(folder)


def write_models(rows: DataFrame, path: str) -> None:
    """Binary contents as a Parquet table of (name, content)."""
    rows.write.mode("overwrite").parquet(path)


def export_files(rows: DataFrame, folder: str, name: str = "name", content: str = "content") -> None:
    """Plain files below a folder that every executor mounts; parent folders are made, a file is replaced whole."""

    def write(part) -> None:
        import os

        for row in part:
            path = os.path.join(folder, row[name])
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path + ".part", "wb") as f:
                f.write(bytes(row[content]) if not isinstance(row[content], str) else row[content].encode())
            os.replace(path + ".part", path)

    rows.select(name, content).foreachPartition(write)


def export_pieces(rows: DataFrame, folder: str, name: str) -> None:
    """One plain file of a document in pieces (place, text), however large, below a folder that every executor mounts. All tasks sort; one writes, a batch of pieces at a time. A missing piece is an error."""
    from ..operators.documents import in_order

    def write(batches):
        import os

        def texts():
            for batch in batches:
                for text in batch.column("text"):
                    if not text.is_valid:
                        raise ValueError(f"{name} lacks a piece")
                    yield text.as_buffer()

        path = os.path.join(folder, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path + ".part", "wb") as f:
            f.writelines(in_order(texts()))
        os.replace(path + ".part", path)
        yield from ()

    rows.orderBy("place").select("text").coalesce(1).mapInArrow(write, "text string").write.format("noop").mode("overwrite").save()
