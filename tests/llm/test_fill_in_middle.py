import hashlib
import re

from cases import documents, odd_rows
from pyspark.sql import functions as F

from tallyframe.llm.fill_in_middle import BLOCK, fill_in_middle, restored


def plain(rows, seed=1, rate=90, spm_rate=20):
    out = []
    for i, t, *_ in rows:
        t = t or ""
        units = re.findall("[A-Za-z]+|[^A-Za-z]", t)
        digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
        h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
        a, b = sorted(x % (len(units) + 1) for x in h[:2])
        p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
        if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
            out.append((i, len(units), "plain", t, None, None))
        elif h[3] % 100 < spm_rate:
            out.append((i, len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)))
        else:
            out.append((i, len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("id", "n", "form", "output", "prefix_chars", "middle_chars").collect()), key=str)


def test_odd_rows(spark):
    docs = documents(spark, clashing=True)
    assert found(fill_in_middle(docs)) == plain([tuple(r) for r in docs.collect()])
    assert found(fill_in_middle(docs, seed=9, rate=100, spm_rate=50)) == plain(odd_rows(), 9, 100, 50)


def test_forms_blocks_and_markers(spark):
    texts = ["a", "<", "<P", "P>x<S", "a <P> b", "S>", "$1 \\2 {x}", "\r\n \x85", "日本 語x" * 9, "😀a" * 300, "<" * 40, "a<M>"]
    texts += ["ab " * k for k in (BLOCK // 2 - 1, BLOCK // 2, BLOCK // 2 + 1, BLOCK, 3 * BLOCK)] + ["z" * 9000, "." * 9000]
    rows = [(i, texts[i % len(texts)], None, None, None) for i in range(400)]
    docs = documents(spark, rows)
    out = fill_in_middle(docs)
    assert found(out) == plain(rows)
    assert {r[0] for r in out.select("form").collect()} == {"plain", "psm", "spm"}
    back = out.select("id", restored(F.col("output"), F.col("form")).alias("back"))
    assert {r["id"]: r["back"] for r in back.collect()} == {i: t for i, t, *_ in rows}


def test_millions_of_units(spark):
    docs = spark.createDataFrame([(1,)], "doc_id long").withColumn("text", F.repeat(F.lit("ab, é"), 600_000))
    out = fill_in_middle(docs).withColumn("same", restored(F.col("output"), F.col("form")) == F.repeat(F.lit("ab, é"), 600_000))
    assert out.select("n", "form", "same").collect()[0][:] == (2_400_000, "psm", True)


def test_empty_table_and_no_python(spark):
    docs = documents(spark, [])
    assert fill_in_middle(docs).collect() == []
    plan = fill_in_middle(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
