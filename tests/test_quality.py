"""Rule semantics and the gate (rows 13-15)."""

import pytest

from laketier.operators import quality as Q


def results(spark, df, rules):
    return {r.rule_id: r for r in Q.evaluate(df, rules).collect()}


def test_pass_fail_and_all_null(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "b", None), (2, "z", None)],
                               "k int, s string, n int")
    rules = [Q.Rule(1, Q.UNIQUE, "k"), Q.Rule(2, Q.IN_SET, "s", value_set=("a", "b")),
             Q.Rule(3, Q.BETWEEN, "n", min_value=0, max_value=1),
             Q.Rule(4, Q.NOT_NULL, "n"), Q.Rule(5, Q.NOT_NULL, "k"),
             Q.Rule(6, Q.REGEX, "s", regex="^[a-b]$"), Q.Rule(7, Q.UNIQUE, "n"),
             Q.Rule(8, Q.ROW_COUNT, min_value=1, max_value=2), Q.Rule(9, Q.EXISTS, "k"),
             Q.Rule(10, Q.EXISTS, "missing"), Q.Rule(11, Q.NOT_NULL, "missing")]
    r = results(spark, df, rules)
    assert (r[1].evaluated, r[1].unexpected, r[1].success) == (3, 2, False)  # both copies
    assert (r[2].unexpected, r[2].success) == (1, False)
    assert (r[3].evaluated, r[3].success) == (0, True)      # all NULL: nothing evaluated
    assert (r[4].evaluated, r[4].unexpected, r[4].success) == (3, 3, False)
    assert r[5].success
    assert (r[6].unexpected, r[6].success) == (1, False)
    assert (r[7].evaluated, r[7].success) == (0, True)
    assert (r[8].evaluated, r[8].success) == (3, False)
    assert r[9].success and not r[10].success and not r[11].success


@pytest.mark.parametrize("bad,ok", [(1, True), (2, False)])
def test_mostly(spark, bad, ok):
    vals = [(25,)] * bad + [(1,)] * (1000 - bad)
    df = spark.createDataFrame(vals, "g int")
    r = results(spark, df, [Q.Rule(1, Q.BETWEEN, "g", mostly=0.999, min_value=0, max_value=20)])
    assert r[1].success is ok


def test_gate_warning_continues_critical_stops(spark):
    df = spark.createDataFrame([(1, 3000), (1, 2024)], "k int, season int")
    warn = [Q.Rule(1, Q.BETWEEN, "season", Q.WARNING, min_value=2020, max_value=2030)]
    rows = Q.gate(Q.evaluate(df, warn))
    assert rows[0]["success"] is False
    with pytest.raises(Q.QualityGateError) as e:
        Q.gate(Q.evaluate(df, warn + [Q.Rule(2, Q.UNIQUE, "k", Q.CRITICAL)]))
    assert e.value.failed[0]["rule_id"] == 2


def test_suite_file_loads(spark, tmp_path):
    import json
    doc = {"expectations": [
        {"expectation_type": Q.NOT_NULL, "kwargs": {"column": "a", "mostly": 0.5},
         "meta": {"severity": "CRITICAL"}},
        {"expectation_type": Q.ROW_COUNT, "kwargs": {"min_value": 1, "max_value": 9}}]}
    p = tmp_path / "suite.json"
    p.write_text(json.dumps(doc))
    rules = Q.load_suite(spark, str(p))
    assert rules[0].mostly == 0.5 and rules[0].severity == "CRITICAL"
    assert rules[1].severity == "WARNING" and rules[1].max_value == 9


def test_single_pass_for_value_rules(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS m")
    rules = [Q.Rule(1, Q.NOT_NULL, "id"), Q.Rule(2, Q.BETWEEN, "m", max_value=5),
             Q.Rule(3, Q.IN_SET, "m", value_set=(1, 2))]
    plan = Q.evaluate(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 100") == 1  # one scan feeds every rule


def test_changed_partitions_give_the_full_evaluation(spark, workdir):
    from laketier.plans.gate import evaluate_changed
    from laketier.sinks import tables
    rules = [Q.Rule(1, Q.NOT_NULL, "v", Q.WARNING, mostly=0.5), Q.Rule(2, Q.UNIQUE, "id", Q.CRITICAL),
             Q.Rule(3, Q.BETWEEN, "v", Q.WARNING, min_value=0, max_value=5),
             Q.Rule(4, Q.ROW_COUNT, None, Q.WARNING, min_value=1, max_value=9),
             Q.Rule(5, Q.EXISTS, "p", Q.WARNING), Q.Rule(6, Q.NOT_NULL, "absent", Q.WARNING)]
    path, state = f"{workdir}/t", f"{workdir}/gate"

    def frame(rows):
        return spark.createDataFrame(rows, "id int, p string, v int")

    def same():
        full = [r.asDict() for r in Q.evaluate(tables.read_table(spark, path), rules).collect()]
        assert evaluate_changed(spark, path, state, rules) == full

    tables.write_table(frame([(i, "a b" if i % 2 else None, i) for i in range(8)]), path, ["p"])
    same()
    tables.upsert_table(frame([(3, "c", None), (9, "c", -1)]), path, ["id"], ["p"])
    same()
    # a copy of a key of an untouched partition is found, and stays found when left alone
    tables.replace_partitions(frame([(0, "c", 1), (9, "c", 1)]), path, ["p"], {'{"p":"c"}'})
    same()
    tables.replace_partitions(frame([(50, "d", 1)]), path, ["p"], {'{"p":"d"}'})
    same()
    tables.replace_partitions(frame([(9, "c", 1)]), path, ["p"], {'{"p":"c"}'})
    same()
    same()
