import hashlib
import random

from cases import documents

from tallyframe.llm.exact_dedup import exact_dedup, verdicts

DROP = str.maketrans("", "", " \t\n\x0b\f\r")


def brute(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault((t or "").translate(DROP), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for norm, members in groups.items():
        best, sha = min(members), hashlib.sha256(norm.encode()).hexdigest()
        kept = False
        for m in sorted(members):
            out.append((m[3], best[3], len(members), m == best and not kept, sha))
            kept = True
    return sorted(out, key=str)


def found(df):
    return sorted(((r["id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect()), key=str)


def test_odd_rows(spark):
    docs = documents(spark)
    assert found(verdicts(docs)) == brute([tuple(r) for r in docs.collect()])


def test_one_salt_or_many_hot_group(spark):
    r = random.Random(4)
    rows = [(i, r.choice(["hot text", "hot  text ", "hot\ntext"]) if i % 3 == 0 else f"text {r.randrange(40)}", "en", "s", 0) for i in range(600)]
    docs = documents(spark, rows).repartition(7)
    want = brute(rows)
    assert found(verdicts(docs, salts=1)) == want and found(verdicts(docs)) == want


def test_keeps_one_row_each_and_all_columns(spark):
    docs = documents(spark, clashing=True)
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({(r["text"] or "").translate(DROP) for r in docs.collect()})
    assert all(r["a.b"] == "x18" for r in kept.collect())


def test_empty_table(spark):
    docs = documents(spark, [])
    assert verdicts(docs).count() == 0 and exact_dedup(docs).columns == docs.columns


def test_no_python_in_the_plan(spark):
    plan = verdicts(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
