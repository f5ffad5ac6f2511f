"""Rule engine, failure report and the conservation invariant, including a
property test over arbitrary NULL patterns."""


from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators.quality import (
    Rule,
    apply_rules,
    clean,
    dq_flag_columns,
    dq_unpivot,
    failure_counts,
    quarantine,
    read_split,
    split_accounting,
    write_split,
)
from ledgerline.plans import dq_report


def _rules():
    return [
        Rule("_dq_a", F.col("a").isNotNull(), "Missing a"),
        Rule("_dq_b", F.col("b") > 0, "Bad b"),
    ]


def test_first_reason_and_flags(spark):
    df = spark.createDataFrame([(None, -1), (1, -1), (1, 2), (None, None)], "a int, b int")
    out = {(r.a, r.b): r for r in apply_rules(df, _rules()).collect()}
    assert out[(None, -1)]._dq_reason == "Missing a"
    assert out[(1, -1)]._dq_reason == "Bad b"
    assert out[(1, 2)]._is_valid and out[(1, 2)]._dq_reason is None
    assert out[(None, None)]._dq_b is False  # NULL comparison counted as failed


def test_failure_counts_pair_flags_with_first_reason(spark):
    """FIXTURES §3: flags (F,F) 'Missing customer_id' and (T,F) 'Missing
    customer_email' → three groups of one (D20)."""
    df = spark.createDataFrame(
        [(False, False, False, "Missing customer_id"), (True, False, False, "Missing customer_email")],
        "_dq_id_ok boolean, _dq_email_ok boolean, _is_valid boolean, _dq_reason string",
    )
    got = sorted((r.field_name, r.issue_type, r.failed_count) for r in failure_counts(df, "customers").collect())
    assert got == [
        ("_dq_email_ok", "missing customer_email", 1),
        ("_dq_email_ok", "missing customer_id", 1),
        ("_dq_id_ok", "missing customer_id", 1),
    ]
    own = failure_counts(df, "customers", per_rule_reason=True, reasons={"_dq_id_ok": "Missing customer_id", "_dq_email_ok": "Missing customer_email"})
    assert sorted((r.field_name, r.issue_type, r.failed_count) for r in own.collect()) == [
        ("_dq_email_ok", "missing customer_email", 2),
        ("_dq_id_ok", "missing customer_id", 1),
    ]


def test_unpivot_and_no_rule_columns(spark):
    df = apply_rules(spark.createDataFrame([(None, 1)], "a int, b int"), _rules())
    assert dq_flag_columns(df) == ["_dq_a", "_dq_b"]
    long = dq_unpivot(df, ["a", "_dq_reason"])
    assert sorted((r.dq_field, r.is_valid) for r in long.collect()) == [("_dq_a", False), ("_dq_b", True)]
    bare = spark.createDataFrame([(1,)], "a int")
    assert dq_unpivot(bare).count() == 0  # zero flag columns: empty, no parse error (D22)
    assert failure_counts(bare, "x").count() == 0


def test_write_split_one_pass(spark, scratch):
    df = apply_rules(spark.createDataFrame([(1, 1), (None, 1), (2, 0)], "a int, b int"), _rules())
    write_split(df, f"{scratch}/split")
    assert read_split(spark, f"{scratch}/split", "clean").count() == 1
    assert read_split(spark, f"{scratch}/split", "quarantine").count() == 2


def test_audit_report_with_model_hook(spark):
    """A real model plugs in per batch; malformed replies give NULL, replies
    without the key give the fixed text, a failing call gives NULL."""
    q = apply_rules(spark.createDataFrame([(None, 1), (1, 0), (None, 0)], "a int, b int"), _rules())

    def model(prompts):
        out = []
        for p in prompts:
            if "_dq_a" in p and "missing a" in p:
                out.append('{"business_impact": "Revenue cannot be attributed."}')
            elif "_dq_b" in p and "bad b" in p:
                out.append('{"other": 1}')
            else:
                out.append("not json")
        return out

    rep = dq_report.audit_report({"t": quarantine(q)}, model=model, stamp=False)
    got = {(r.field_name, r.issue_type): r.business_impact for r in rep.collect()}
    assert got[("_dq_a", "missing a")] == "Revenue cannot be attributed."
    assert got[("_dq_b", "bad b")] == "Impact could not be generated"
    assert got[("_dq_b", "missing a")] is None

    def broken(prompts):
        raise RuntimeError("endpoint down")

    rep2 = dq_report.audit_report({"t": quarantine(q)}, model=broken, stamp=True)
    assert rep2.filter(F.col("business_impact").isNull()).count() == rep2.count()
    assert "generated_at" in rep2.columns


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-2, 2)), st.one_of(st.none(), st.integers(-2, 2))), min_size=1, max_size=12))
def test_every_row_lands_exactly_once(spark, rows):
    df = apply_rules(spark.createDataFrame(rows, "a int, b int"), _rules())
    acc = split_accounting(df, "t").collect()[0]
    assert acc.input_rows == acc.clean_rows + acc.quarantine_rows and acc.unassigned_rows == 0
    assert clean(df).filter(F.col("_dq_reason").isNotNull()).count() == 0
    assert quarantine(df).filter(F.col("_dq_reason").isNull()).count() == 0
    parity = apply_rules(spark.createDataFrame(rows, "a int, b int"), _rules(), null_policy="drop")
    p = split_accounting(parity, "t").collect()[0]
    assert p.input_rows == p.clean_rows + p.quarantine_rows + p.unassigned_rows


def test_write_split_rerun_replaces_both_sides(spark, scratch):
    """A re-run with no failing rows must not leave the old quarantine behind."""
    path = f"{scratch}/split2"
    write_split(apply_rules(spark.createDataFrame([(1, 1), (None, 1)], "a int, b int"), _rules()), path)
    assert read_split(spark, path, "quarantine").count() == 1
    write_split(apply_rules(spark.createDataFrame([(1, 1)], "a int, b int"), _rules()), path)
    assert read_split(spark, path, "quarantine").count() == 0
    assert read_split(spark, path, "clean").count() == 1
