import re

from pyspark.sql import functions as F

from plumbline.llm import quality_rules as q

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    text = text or ""
    words = SPACE.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if SPACE.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines),
        len(lines) - len(set(lines)),
        len(covered),
        sum(w == w.upper() and w != w.lower() for w in words),
    )


def test_measurements_match_brute_force(spark, odd_docs, prose):
    texts = [prose(n, "ab") for n in (3, 4, 10, 60, 200)]
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").where("length(coalesce(text, '')) < 5000").union(more)
    expected = {r.doc_id: measured(r.text) for r in docs.collect()}
    for row in q.ledger(docs).collect():
        assert tuple(row[m] for m in q.MEASURES) == expected[row.doc_id], row


def test_long_text_and_every_row_kept(odd_docs):
    rows = {r.doc_id: r for r in q.ledger(odd_docs).collect()}
    assert len(rows) == odd_docs.count()
    assert rows[6].n_words == 8000 and rows[6].n_repeat_words == 8000


def test_policies_and_base(spark):
    docs = spark.createDataFrame(
        [(1, " ".join(f"w{i}" for i in range(60))), (2, "few words"), (3, " ".join(f"W{i}!" for i in range(60)))],
        "doc_id long, text string",
    )
    rows = {r.doc_id: r for r in q.apply_policy(q.ledger(docs)).collect()}
    assert rows[1].kept and not rows[1].base_failed
    assert rows[2].base_failed and not rows[2].kept
    assert not rows[3].base_failed and not rows[3].kept
    base = {r.doc_id: r.kept for r in q.apply_policy(q.ledger(docs), ("base", 1)).collect()}
    assert base == {1: True, 2: False, 3: True}


def test_ablations_count_what_each_rule_does(odd_docs, no_docs):
    entries = q.ledger(odd_docs)
    bits = [r.fail_bits for r in entries.collect()]
    mask = q.POLICIES[q.CURRENT]
    for row in q.ablations(entries).collect():
        own = q.BIT[row.rule]
        assert row.failed == sum(bool(b & own) for b in bits)
        assert row.failed_alone == sum(b & mask == own for b in bits)
        assert row.kept_without == sum(b & mask & ~own == 0 for b in bits)
    assert {r.failed for r in q.ablations(q.ledger(no_docs)).collect()} == {0}


def test_keep_passing_keeps_rows_whole(odd_docs, no_docs):
    kept = q.keep_passing(odd_docs)
    assert kept.schema == odd_docs.schema
    wanted = {r.doc_id for r in q.apply_policy(q.ledger(odd_docs)).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == wanted
    assert q.keep_passing(no_docs).count() == 0


def test_no_python_in_the_plan(odd_docs):
    plan = q.ledger(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert q.keep_passing(odd_docs).where(F.lit(True)).columns == odd_docs.columns
