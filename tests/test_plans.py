"""Plan checks: no whole-table single-partition exchange, no row-at-a-time Python."""

import pytest

from __spark_entry__ import queries

QUERIES = queries()


def _indent(line):
    return len(line) - len(line.lstrip(" :+-"))


def _under_broadcast(lines, i):
    depth = _indent(lines[i])
    for line in reversed(lines[:i]):
        if _indent(line) < depth:
            if "BroadcastExchange" in line:
                return True
            depth = _indent(line)
    return False


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["split_exact_documents", "seeded_shuffle_documents",
                                  "make_batches_documents", "canonical_by_brand",
                                  "sentiment_macro_by_lang", "pad_batches"])
def test_no_single_partition_over_tables(spark, small_dir, name):
    plan = _plan(QUERIES[name](spark, small_dir))
    assert "BatchEvalPython" not in plan
    # a SinglePartition exchange is only allowed over the small bounded tables
    # (bucket or partition offsets), whose result is broadcast
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert _under_broadcast(lines, i), f"single-partition exchange in {name}: {line}"


def test_split_is_narrow(spark, small_dir):
    assert "Exchange" not in _plan(QUERIES["split_exact_documents"](spark, small_dir))


def test_scoring_uses_arrow(spark, small_dir):
    plan = _plan(QUERIES["score_classes"](spark, small_dir))
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_flagship_scans_are_pruned(spark, small_dir):
    import re
    plan = _plan(QUERIES["sentiment_macro_by_lang"](spark, small_dir))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert len(schemas) >= 2, plan
    joined = " ".join(schemas)
    # documents.source / n_chars and labels.toxic are never read
    assert "source" not in joined and "n_chars" not in joined and "toxic" not in joined
