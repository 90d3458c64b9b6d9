"""Near duplicates of whole tables against brute force: python tests/llm/recall_near_duplicates.py /root/testdata/sf0.1"""

import sys
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from tableforge.llm import dedup  # noqa: E402
from tests.llm.test_operators import brute_components  # noqa: E402


def main(sf_dir: str) -> None:
    spark = SparkSession.builder.master("local[8]").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    want = brute_components({r.doc_id: r.text or "" for r in docs.collect()})
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in dedup.near_duplicates(docs).collect()}
    print(f"{len(want)} documents, {sum(not k for _, _, k in want.values())} in a group of an earlier one, {sum(got[i] != w for i, w in want.items())} rows differ")


if __name__ == "__main__":
    main(sys.argv[1])
