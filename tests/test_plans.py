"""Physical plans as they would be on data too large to broadcast."""

import contextlib
import re

import pytest

from tokenloom.operators import lookups
from tokenloom.operators.tokenize import HashTokenizer, Tokenizer, tokenize_values
from tokenloom.plans import edges, outputs, verify
from tokenloom.plans.assemble import assemble_user_info

HASH = HashTokenizer()
OUTPUTS = {
    "user": lambda s: outputs.user_output(s, "all", HASH),
    "user_info": lambda s: outputs.user_info_output(s, "all", HASH),
    "user_bankcard": lambda s: outputs.bankcard_rows(s, "all", HASH),
    "user_product": lambda s: outputs.product_output(s),
    "application": lambda s: outputs.application_output(s, "all", HASH),
    "loan": lambda s: outputs.loan_output(s),
    "id_mapping": lambda s: outputs.id_mapping_output(s),
    "edge_rows": lambda s: edges.edge_rows(s),
    "registration_ip": lambda s: lookups.registration_ip(s["user"], s["device_ids"], s["device_network"]),
    "phases": lambda s: verify.phase_counts({"user_info": assemble_user_info(s)}),
}


@contextlib.contextmanager
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(OUTPUTS))
def test_only_equi_joins_and_no_python(spark, tables, name):
    with no_broadcast(spark):
        text = plan(OUTPUTS[name](tables[1]))
    for bad in ("NestedLoop", "Cartesian", "Python", "Pandas", "SinglePartition, REPARTITION", "BroadcastExchange"):
        assert bad not in text, bad


def test_python_runs_only_for_a_service(spark, tables):
    class Service(Tokenizer):
        pass

    values = tables[1]["vt_token_cache"]
    assert "MapInPandas" in plan(tokenize_values(values, Service()))
    assert "MapInPandas" not in plan(tokenize_values(values, HASH))


def test_loan_rows_move_once_per_join_and_not_for_their_key(spark, tables):
    """Orders, installments, installments by order number, payments twice reduced: no exchange is
    left for the keyed output."""
    with no_broadcast(spark):
        text = plan(outputs.loan_output(tables[1]))
    assert text.count("Exchange hashpartitioning") == 4


def test_application_rows_move_once_per_join_and_not_for_their_key(spark, tables):
    with no_broadcast(spark):
        text = plan(outputs.application_output(tables[1]))
    order_moves = re.findall(r"Exchange hashpartitioning\((order_id|order_no|user_id)#", text)
    # each key once for orders and once per right side: overdue; approval and payment; user, bvn, card
    assert order_moves.count("order_id") <= 2
    assert order_moves.count("order_no") == 3
    assert "Exchange hashpartitioning(user_id#" in text and not re.search(r"hashpartitioning\(user_id#\w+, order_no", text)


def test_keyed_edges_aggregate_by_hash(spark, tables):
    with no_broadcast(spark):
        text = plan(outputs.id_mapping_output(tables[1]))
    last = text[: text.index("Union")]
    assert "HashAggregate" in last and "SortAggregate" not in last


def test_scans_read_only_what_is_used(spark, tables):
    with no_broadcast(spark):
        text = plan(outputs.product_output(tables[1]))
    assert "ReadSchema: struct<id:bigint,user_id:bigint,product_id:string,amount_max:string,order_time:timestamp_ntz>" in text
    assert "IsNotNull(user_id)" in text
    with no_broadcast(spark):
        text = plan(outputs.loan_output(tables[1]))
    assert "amount_max" not in text and "EqualTo(status,2)" in text
