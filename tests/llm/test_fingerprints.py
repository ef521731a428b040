import hashlib

from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from waybill.llm import fingerprints as fp


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def test_small_texts_are_exact(spark):
    a, b = " ".join(f"w{k}" for k in range(60)), " ".join(f"w{k}" for k in range(30, 100))
    x, y = shingles(a), shingles(b)
    df = spark.createDataFrame([(a, b)], "a string, b string").select(fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b"))
    r = df.select(fp.resemblance(F.col("a"), F.col("b")), fp.containment(F.col("a"), F.col("b")), fp.distinct_count(F.col("a"))).first()
    assert abs(r[0] - len(x & y) / len(x | y)) < 1e-9 and abs(r[1] - len(x & y) / len(x)) < 1e-9 and r[2] == len(x)


def test_estimates_and_merge(spark):
    parts = [" ".join(f"w{k}" for k in range(s, s + 3000)) for s in (0, 2000, 4000)]
    df = spark.createDataFrame([("x", p) for p in parts] + [("y", None)], "part string, text string")
    merged = fp.merge(df.select("part", fp.sketch(F.col("text")).alias("sketch")), "part")
    row = {r.part: (r.sketch, r.n) for r in merged.select("*", fp.distinct_count(F.col("sketch")).alias("n")).collect()}
    union = sorted({h for r in df.select(fp.sketch(F.col("text"), 4000).alias("s")).collect() for h in r.s})[: fp.K]
    assert row["x"][0] == union and row["y"][0] == []
    assert abs(row["x"][1] - 6992) < 6992 * 0.35


def test_next_rows_and_edits(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    rows = {r.doc_id: r for r in fp.edited(docs).collect()}
    assert len(rows) == len(texts)
    for k, (key, text) in enumerate(texts):
        cut = len(text) // 4
        want = text[: len(text) - cut] + texts[(k + 1) % len(texts)][1][:cut]
        assert hashlib.sha256(rows[key].edited.encode()).digest() == hashlib.sha256(want.encode()).digest()
        assert rows[key].next_sketch == rows[texts[(k + 1) % len(texts)][0]].sketch


def test_odd_rows(odd, none, make):
    rows = fp.edited(odd).collect()
    assert len(rows) == len(ODD)
    assert {len(r.sketch) for r in rows if not r.text.split()} == {0}
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text, r.sketch) == r.sketch
    assert fp.edited(none).collect() == []
    alone = fp.edited(make(ODD[3:4])).first()
    assert alone.edited == "one two"[:-1] + "o"
