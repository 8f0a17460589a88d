"""Recall of op10_kd_search by size: python tests/llm/kd_recall.py FOLDER STOP ROWS [ROWS ...]

Uniform unit vectors of 64 dimensions, written to FOLDER once per size; recall at 20 of 200 of them by brute force.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import numpy as np
import pyarrow as pa
import pyarrow.dataset
from pyspark.sql import SparkSession, functions as F

from phraseloom.llm import kd_search

DIMENSION, K, QUERIES = 64, 20, 200


def unit_vectors(batches):
    for batch in batches:
        ids = batch.column("id").to_numpy()
        if len(ids):
            own = np.random.default_rng(int(ids[0])).normal(size=(len(ids), DIMENSION)).astype(np.float32)
            own /= np.sqrt((own**2).sum(1))[:, None]
            lists = pa.ListArray.from_arrays(np.arange(len(ids) + 1, dtype=np.int32) * DIMENSION, own.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists], ["vec_id", "embedding"])


def main(folder: str, stop: float, sizes: list[int]) -> None:
    conf = {"spark.sql.shuffle.partitions": "16", "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    conf |= {"spark.sql.warehouse.dir": f"{folder}/warehouse", "spark.checkpoint.dir": f"{folder}/shared"}
    spark = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    kd_search.STOP = stop
    for n in sizes:
        path = f"{folder}/vectors-{n}"
        if not Path(path).exists():
            spark.range(0, n, 1, 32).mapInArrow(unit_vectors, "vec_id bigint, embedding array<float>").write.parquet(path)
        begun = time.time()
        rows = kd_search.nearest(spark.read.parquet(path), F.col("vec_id") % (n // QUERIES) == 0, K).collect()
        took = time.time() - begun
        stored = pa.dataset.dataset(path).to_table()
        ids, vectors = stored["vec_id"].to_numpy(), stored["embedding"].combine_chunks().flatten().to_numpy().reshape(n, DIMENSION).astype(np.float64)
        got: dict[int, set] = {}
        for r in rows:
            got.setdefault(r["query_id"], set()).add(r["vec_id"])
        hit = 0
        asked = np.flatnonzero(ids % (n // QUERIES) == 0)
        for q in asked:
            scores = vectors @ vectors[q]
            scores[q] = -np.inf
            best = np.argpartition(-scores, K)[:K]
            hit += len(got.get(ids[q], set()) & set(ids[best].tolist()))
        print(f"rows {n} stop {stop} queries {len(asked)} recall {hit / (K * len(asked)):.4f} seconds {took:.0f}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], float(sys.argv[2]), [int(x) for x in sys.argv[3:]])
