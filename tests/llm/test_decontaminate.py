import random

import duckdb

from tierflow.llm import decontaminate


def test_equals_sql_on_edge_cases(spark, docs_of):
    rng = random.Random(4)
    words = [f"word{i}" for i in range(400)]
    passages = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 3, 5, 6, 9, 30, 80, 80)]
    items = [*enumerate(passages), (8, None), (9, ""), (10, "!!! ??"), (11, passages[5]), (None, "a b c d e f")]
    texts = [None, "", "short", "$$$"]
    for p in passages:
        before, after = (" ".join(rng.choice(words) for _ in range(rng.choice([0, 5, 3000]))) for _ in range(2))
        texts.append(f"{before} {p.upper()}! {after}")
        half = p.split()
        texts.append(" ".join(half[:len(half) // 2]))
        if len(half) > 20:
            half[3] = "other"
            texts.append(f"{before}\n{' -- '.join(half)}\n{after}")
    docs, bench = docs_of(texts), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(tuple(r) for r in decontaminate.contaminated(docs, bench).collect())
    con = duckdb.connect()
    con.register("d", docs.toArrow())
    con.register("b", bench.toArrow())
    con.execute("create view documents as select * from d")
    con.execute("create view benchmark as select * from b")
    assert got == sorted(con.sql(decontaminate.ORACLE).fetchall()) and len(got) >= 10


def test_no_python_in_the_plan_and_empty_tables(spark, docs_of):
    docs, bench = docs_of(["a b c d e f g"] * 2), spark.createDataFrame([(1, "b c d e f", 9)], "item_id long, text string, h long")
    found = decontaminate.contaminated(docs, bench)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert {r.doc_id for r in found.collect()} == {0, 1}
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.without_leaks(docs, bench).count() == 0
