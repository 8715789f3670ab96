"""The files that the contract dataset is written to."""

from pathlib import Path

import pyarrow.parquet as pq

from releaselake.sources import writers


def test_files_do_not_grow_with_providers_and_a_provider_lies_in_one(spark, tmp_path):
    rows = [(f"prov-{i:04}", f"{v}.0.0", "c") for v in (2, 1, 3) for i in range(900)]
    writers.write_dataset(spark.createDataFrame(rows, "provider_id string, vers string, cksum string").repartition(6), f"{tmp_path}/d")
    files = [[(r["provider_id"], r["vers"]) for r in pq.ParquetFile(f).read(columns=["provider_id", "vers"]).to_pylist()] for f in Path(tmp_path, "d").rglob("*.parquet")]
    assert len(files) <= 4 and all(f == sorted(f) for f in files)
    assert sum(len({p for p, _ in f}) for f in files) == 900
    read = spark.read.parquet(f"{tmp_path}/d")
    assert sorted((r.provider_id, r.vers, r.cksum) for r in read.collect()) == sorted(rows)
