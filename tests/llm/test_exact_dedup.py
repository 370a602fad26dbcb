import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierwright.llm.exact_dedup import exact_dedup, follow

SCHEMA = "text string, doc_id long, digest string, file string, body string, keep int"
TEXTS = ["a b", "a \t\n b", None, "", " ", "  ", " ", "A b", "a b", "x" * 200_000, "x" * 200_000 + " ", "é", "é"]


def rows_of(texts, first=0):
    """Columns whose names the operator uses itself go along."""
    return [(t, first + i, "d", "f", "b", i) for i, t in enumerate(texts)]


def brute(rows):
    normal = [re.sub(r"[\x20\x09-\x0D]+", " ", r[0] or "") for r in rows]
    ids = {}
    for n, r in zip(normal, rows):
        ids.setdefault(n, []).append(r[1])
    out = []
    for n, r in zip(normal, rows):
        known = [i for i in ids[n] if i is not None]
        keep = min(known) if known else None
        out.append((r[1], keep, len(ids[n]), hashlib.sha256(n.encode()).hexdigest()))
    return Counter(out)


def got(df):
    return Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect())


@pytest.mark.parametrize("digest", ["sha256", "first letter", "constant"])
def test_against_brute_force(spark, folder, digest):
    """Weak digests put unequal texts under one entry of the state; full texts tell them apart."""
    make = {
        "sha256": lambda c: F.sha2(c, 256),
        "first letter": lambda c: F.substring(F.sha2(c, 256), 1, 1),
        "constant": lambda c: F.lit("d"),
    }[digest]
    rows = rows_of(TEXTS) + rows_of(["a b"] * 30 + ["k"], 100) + [("a b", None, "", "", "", 0), ("n", None, "", "", "", 0)]
    rows += rows_of(["a b"], 0) * 2
    path = folder()
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(path)
    out = exact_dedup(spark, path, digest=make, files_per_batch=2)
    assert got(out) == brute(rows)
    # of each group one row is kept
    kept = Counter(r.text_sha256 for r in out.where("kept").collect())
    assert set(kept.values()) == {1} and len(kept) == len({k[3] for k in brute(rows)})
    assert out.where("kept and not (doc_id <=> keep_id)").count() == 0


def test_state_outlives_the_run(spark, folder):
    path, checkpoint = folder(), folder()
    spark.createDataFrame(rows_of(["a", "b", "b"]), SCHEMA).write.parquet(path)
    first = {r.copies for r in follow(spark, path, checkpoint).collect()}
    assert first == {1, 2}
    spark.createDataFrame(rows_of(["b", "c"], -5), SCHEMA).write.mode("append").parquet(path)
    out = exact_dedup(spark, path, checkpoint)
    assert got(out) == brute(rows_of(["a", "b", "b"]) + rows_of(["b", "c"], -5))
    # the locator finds the text that stays
    kept = out.where("doc_id = 1").first()
    texts = spark.read.parquet(path).select("text", "_metadata.file_path", "_metadata.row_index")
    assert texts.where((F.col("file_path") == kept.keep_file) & (F.col("row_index") == kept.keep_row)).first().text == "b"


def test_empty_table(spark, folder):
    path = folder()
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    assert exact_dedup(spark, path).collect() == []
