"""Scene files as rows. Proprietary scene graphs need a native decoder; Wavefront OBJ, an open format, is read here.

A comment "# child NAME" names a finer file in the same folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCENE = "file string, child_files array<string>, positions array<double>, indices array<int>"


def parse_obj(text: str) -> tuple[list[str], list[float], list[int]]:
    """Names of finer files, flat positions, triangle indices (polygons as fans). Lines that can't be read are skipped."""
    children, positions, indices = [], [], []
    for line in text.splitlines():
        words = line.split()
        try:
            if words[:2] == ["#", "child"]:
                children.append(words[2])
            elif words[:1] == ["v"]:
                positions += [float(x) for x in words[1:4]] if len(words) >= 4 else []
            elif words[:1] == ["f"]:
                at = [int(w.split("/")[0]) for w in words[1:]]
                at = [i - 1 if i > 0 else len(positions) // 3 + i for i in at]
                if all(0 <= i < len(positions) // 3 for i in at):
                    indices += [i for k in range(1, len(at) - 1) for i in (at[0], at[k], at[k + 1])]
        except (ValueError, IndexError):
            continue
    return children, positions, indices


def read_scenes(spark: SparkSession, folder: str, suffix: str = "obj") -> DataFrame:
    """file (relative to the folder), child_files (entry 0 is the file itself), positions, indices of every scene file below Data/. A file fits a task."""
    fields = pa.schema([("file", pa.string()), ("child_files", pa.list_(pa.string())), ("positions", pa.list_(pa.float64())), ("indices", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
                children, positions, indices = parse_obj(raw.as_py().decode("utf-8", "replace"))
                own = name.rsplit("/", 1)[-1]
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([[own, *children]], fields[1].type), pa.array([np.array(positions)], fields[2].type), pa.array([np.array(indices, np.int32)], fields[3].type)], schema=fields)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{suffix}").load(f"{folder}/Data")
    return files.select(F.concat(F.lit("Data/"), F.substring_index("path", "/Data/", -1)).alias("file"), "content").mapInArrow(run, SCENE)
