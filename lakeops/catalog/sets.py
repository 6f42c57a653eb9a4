"""U: set operations."""

from pyspark.sql import functions as F

from lakeops.catalog.base import query
from lakeops.operators import sets
from lakeops.operators.shape import missing_columns


@query("u1_union_all", "SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier")
def union_all(t):
    return t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).unionByName(
        t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    )


@query("u2_union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t):
    return sets.union_distinct(
        t.customer.select(F.col("c_nationkey").alias("nation")), t.supplier.select(F.col("s_nationkey").alias("nation"))
    )


@query("u3_distinct_rows", "SELECT DISTINCT text, lang, source, n_chars FROM documents")
def distinct_rows(t):
    return t.documents.drop("doc_id").distinct()


@query("u4_stack_runs", """
    SELECT 'orders' AS run, o_totalprice AS amount FROM orders UNION ALL SELECT 'lines', l_extendedprice FROM lineitem
    UNION ALL SELECT 'parts', p_retailprice FROM part""")
def stack_runs(t):
    return sets.stack_runs({
        "orders": t.orders.select(F.col("o_totalprice").alias("amount")),
        "lines": t.lineitem.select(F.col("l_extendedprice").alias("amount")),
        "parts": t.part.select(F.col("p_retailprice").alias("amount")),
    })


TOKEN_SETS = r"""(SELECT b.conv_id, b.turn, list_distinct(list_filter(regexp_split_to_array(trim(a.text), '\s+'), lambda w: w <> '')) AS x,
    list_distinct(list_filter(regexp_split_to_array(trim(b.text), '\s+'), lambda w: w <> '')) AS y
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn AND a.text IS NOT NULL AND b.text IS NOT NULL)"""


def token_rows(t):
    """Each turn's text, ``b``, and that of the turn before it, ``a``."""
    rows = t.conversations.select("conv_id", "turn", F.col("text").alias("b"))
    before = t.conversations.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("a"))
    return rows.join(before, ["conv_id", "turn"]).dropna(subset=["a", "b"])


@query("u5_shared_tokens", f"""
    SELECT conv_id, turn, array_to_string(list_sort(list_filter(x, lambda w: list_contains(y, w))), ' ') AS shared FROM {TOKEN_SETS}""")
def shared_tokens(t):
    shared = sets.shared_tokens(F.col("a"), F.col("b"))
    return token_rows(t).select("conv_id", "turn", F.array_join(shared, " ").alias("shared"))


@query("u5_unshared_tokens", f"""
    SELECT conv_id, turn, array_to_string(list_sort(list_concat(list_filter(x, lambda w: NOT list_contains(y, w)),
           list_filter(y, lambda w: NOT list_contains(x, w)))), ' ') AS unshared FROM {TOKEN_SETS}""")
def unshared_tokens(t):
    unshared = sets.unshared_tokens(F.col("a"), F.col("b"))
    return token_rows(t).select("conv_id", "turn", F.array_join(unshared, " ").alias("unshared"))


@query("u6_column_difference", "SELECT l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem")
def column_difference(t):
    other = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "o_orderkey"]
    return t.lineitem.select(missing_columns(t.lineitem.columns, other))


DATES = """(SELECT CAST(o_orderdate AS DATE) AS base, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) AS finish FROM orders)"""


@query("u7_stack_dates", f"SELECT base AS d FROM {DATES} UNION ALL SELECT finish FROM {DATES} WHERE finish <> base")
def stack_dates(t):
    base = F.col("o_orderdate").cast("date")
    rows = t.orders.select(base.alias("base"), F.date_add(base, (F.col("o_orderkey") % 20).cast("int")).alias("finish"))
    return sets.stack_dates(rows, "base", "finish")
