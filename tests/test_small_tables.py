"""Rows at hand become tables without Python workers."""

from shapeloom.operators import ledger
from shapeloom.plans.jobs import EMPTY_OUTPUT
from shapeloom.session import empty_table, text_table


def test_the_log_needs_no_python_worker(spark, tmp_path, plan):
    log = str(tmp_path / "log")
    assert "ExistingRDD" not in plan(ledger.read_log(spark, log)) and ledger.read_log(spark, log).isEmpty()
    entries = text_table(spark, ["path", "status", "run"], [("a", ledger.FINISHED, "r"), ("b", ledger.FAILED, None)])
    assert "ExistingRDD" not in plan(entries)
    ledger.append_log(entries, log)
    assert {(r.path, r.status, r.run, r.attempt) for r in ledger.read_log(spark, log).collect()} == {("a", "finished", "r", 1), ("b", "failed", None, 1)}
    assert text_table(spark, ["path"], []).isEmpty()
    nothing = empty_table(spark, EMPTY_OUTPUT)
    assert nothing.isEmpty() and nothing.schema.simpleString() == spark.createDataFrame([], EMPTY_OUTPUT).schema.simpleString()
