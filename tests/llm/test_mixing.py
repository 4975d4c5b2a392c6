from __future__ import annotations

from reviewmill.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, target int"


def _mix(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return docs, mixing.mix_sources(docs, **options).collect()


def test_targets_by_weight_with_a_limit(spark):
    rows = [(i, "w " * 10, "a") for i in range(10)]
    rows += [(100 + i, "w " * 30, "b") for i in range(10)]
    rows += [(200 + i, "w " * 60, None) for i in range(10)]
    _, got = _mix(spark, rows)
    # 1000 words; a is full at 300 of its 625, the rest goes 2:1 to b and null
    want = {100: 300.0, 300: 700 * 2 / 3, 600: 700 / 3}
    taken = dict.fromkeys(want, 0)
    for row in got:
        assert row.target == want[row.source_size] or abs(row.target - want[row.source_size]) < 1e-9
        assert 0 <= row.taken <= 3 * row.size
        assert row.taken == row.repeats * row.size + row.last_words
        taken[row.source_size] += row.taken
    assert taken == {size: round(target) for size, target in want.items()}


def test_cut_is_a_prefix_of_the_hash_order_and_reruns_agree(spark):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 4}") for i in range(400)]
    docs, got = _mix(spark, rows)
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted(got) == sorted(again)
    assert sum(1 for r in got if 0 < r.last_words < r.size) <= 4
    whole = mixing.mixed_documents(docs)
    assert whole.columns == docs.columns
    assert abs(sum(len(r.text.split()) for r in whole.collect()) - sum(len(r[1].split()) for r in rows)) <= 4 * 7


def test_odd_rows(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "", ""), (2, "x\x0by z", None), (2, "x\x0by z", None), (3, "q " * 5000, "a")]
    _, got = _mix(spark, rows)
    assert len(got) == len(rows)
    assert sorted(r.size for r in got) == [0, 0, 0, 3, 3, 5000]


def test_empty_and_wordless_tables(spark):
    assert _mix(spark, [])[1] == []
    assert [r.taken for r in _mix(spark, [(1, "", "a"), (2, None, None)])[1]] == [0, 0]


def test_main_path_has_no_python(spark):
    docs = spark.createDataFrame([(1, "a b", "s")], "doc_id long, text string, source string")
    plan = mixing.mix_sources(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
