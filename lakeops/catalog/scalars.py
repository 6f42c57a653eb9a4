"""C: scalar functions."""

from pyspark.sql import functions as F

from lakeops.catalog.base import query
from lakeops.functions import arrays, scalars
from lakeops.operators.ordering import add_row_index

def big(column):
    return column.cast("bigint")


@query("c1_trim", "SELECT part_id, trim('  ' || p_name || ' ') AS name FROM (SELECT p_partkey AS part_id, p_name FROM part)")
def trim(t):
    return t.part.select(F.col("p_partkey").alias("part_id"), F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("name"))


@query("c2_lower", "SELECT c_custkey, lower(c_mktsegment) AS segment FROM customer")
def lower(t):
    return t.customer.select("c_custkey", F.lower("c_mktsegment").alias("segment"))


@query("c3_money_to_int", """
    SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders""")
def money_to_int(t):
    shown = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return t.orders.select("o_orderkey", scalars.money_to_int(shown).alias("cents"))


@query("c4_drop_last", "SELECT p_partkey, left(p_name, greatest(length(p_name) - 2, 0)) AS name FROM part")
def drop_last(t):
    return t.part.select("p_partkey", scalars.drop_last(F.col("p_name"), 2).alias("name"))


@query("c5_shorten", """
    SELECT conv_id, turn, CASE WHEN length(text) > 100 THEN substr(text, 1, 97) || '...' ELSE text END AS label FROM conversations""")
def shorten(t):
    return t.conversations.select("conv_id", "turn", scalars.shorten(F.col("text")).alias("label"))


@query("c6_count_character", "SELECT doc_id, length(lower(text)) - length(replace(lower(text), 'e', '')) AS n FROM documents")
def count_character(t):
    return t.documents.select("doc_id", big(scalars.count_character(F.col("text"), "E")).alias("n"))


@query("c7_split_words", r"SELECT conv_id, turn, len(regexp_split_to_array(trim(text), '\s+')) AS n FROM conversations")
def split_words(t):
    return t.conversations.select("conv_id", "turn", big(F.size(F.split(F.trim("text"), r"\s+"))).alias("n"))


@query("c8_day_first_date", """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS d FROM orders""")
def day_first_date(t):
    shown = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise("not a date")
    return t.orders.select("o_orderkey", scalars.day_first(shown).alias("d"))


@query("c9_date_label", """
    SELECT o_orderkey, strftime(o_orderdate, '%b %Y') AS month, strftime(o_orderdate, '%d %b %Y') AS day FROM orders""")
def date_label(t):
    return t.orders.select(
        "o_orderkey", scalars.month_label(F.col("o_orderdate")).alias("month"), F.date_format("o_orderdate", "dd MMM yyyy").alias("day")
    )


@query("c10_date_parts", """
    SELECT o_orderkey, year(o_orderdate) AS saleYear, month(o_orderdate) AS saleMonth, day(o_orderdate) AS saleDay,
           isodow(o_orderdate) - 1 AS saleDayofweek, dayofyear(o_orderdate) AS saleDayofyear FROM orders""")
def date_parts(t):
    parts = scalars.date_parts(F.col("o_orderdate"), "sale")
    return t.orders.select("o_orderkey", *[big(c).alias(n) for n, c in parts.items()])


@query("c11_days_between", """
    SELECT event_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS days FROM events""")
def days_between(t):
    return t.events.select("event_id", big(F.date_diff("ts", F.lit("2024-01-01").cast("date"))).alias("days"))


@query("c12_add_days_months", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) + 1 AS next_day, CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month,
           CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS last_month FROM orders""")
def add_days_months(t):
    return t.orders.select(
        "o_orderkey", F.date_add("o_orderdate", 1).alias("next_day"),
        F.add_months("o_orderdate", 1).alias("next_month"), F.add_months("o_orderdate", -1).alias("last_month"),
    )


@query("c13_month_spine", """
    WITH e AS (SELECT CAST(min(o_orderdate) - INTERVAL 1 MONTH AS DATE) AS a, CAST(max(o_orderdate) + INTERVAL 1 MONTH AS DATE) AS b FROM orders)
    SELECT CAST(m AS DATE) AS month_start FROM (
      SELECT unnest(generate_series(date_trunc('month', a)::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 MONTH)) AS m, a FROM e) WHERE m >= a""")
def month_spine(t):
    ends = t.orders.agg(
        F.add_months(F.min("o_orderdate"), -1).alias("a"), F.add_months(F.max("o_orderdate"), 1).alias("b")
    )
    return ends.select(F.explode(scalars.month_starts(F.col("a"), F.col("b"))).alias("month_start"))


@query("c14_subtract_interval", "SELECT event_id, ts - INTERVAL 1 MINUTE AS before FROM events")
def subtract_interval(t):
    return t.events.select("event_id", F.try_subtract(F.col("ts"), F.expr("INTERVAL '1' MINUTE")).alias("before"))


@query("c15_open_end", """
    SELECT c_custkey, '9999-12-31 23:59:59' AS valid_to, CAST(9999 AS BIGINT) AS valid_year FROM customer""")
def open_end(t):
    high = F.lit("9999-12-31T23:59:59").cast("timestamp")
    return t.customer.select(
        "c_custkey", F.date_format(high, "yyyy-MM-dd HH:mm:ss").alias("valid_to"), big(F.year(high)).alias("valid_year")
    )


@query("c16_first_non_null", """
    SELECT event_id, coalesce(CASE WHEN event_type = 'click' THEN value END, CASE WHEN event_type = 'view' THEN -value END, 0.0) AS v FROM events""")
def first_non_null(t):
    kind, value = F.col("event_type"), F.col("value")
    return t.events.select("event_id", F.coalesce(F.when(kind == "click", value), F.when(kind == "view", -value), F.lit(0.0)).alias("v"))


@query("c17_fill_null", """
    WITH n AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS a, CASE WHEN event_type <> 'view' THEN props END AS b FROM events)
    SELECT event_id, round(coalesce(a, (SELECT avg(a) FROM n)), 6) AS a, coalesce(b, 'missing') AS b FROM n""")
def fill_null(t):
    kind = F.col("event_type")
    rows = t.events.select(
        "event_id", F.when(kind != "error", F.col("value")).alias("a"), F.when(kind != "view", F.col("props")).alias("b")
    )
    mean = rows.agg(F.avg("a")).scalar()
    return rows.withColumn("a", F.round(F.coalesce("a", mean), 6)).fillna({"b": "missing"})


@query("c18_rag_status", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Blue' WHEN d IS NULL THEN '' WHEN d <= 7 THEN 'Green' WHEN d < 14 THEN 'Amber' ELSE 'Red' END AS rag
    FROM (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey % 20 END AS d FROM orders)""")
def rag_status(t):
    days = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey") % 20)
    return t.orders.select("o_orderkey", scalars.milestone_rag(days, F.col("o_orderstatus"), "F").alias("rag"))


@query("c19_trend_arrow", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'larrow' WHEN 'O' THEN 'rarrow' ELSE 'darrow' END AS arrow FROM orders""")
def trend_arrow(t):
    trend = F.when(F.col("o_orderstatus") == "F", "Green").when(F.col("o_orderstatus") == "O", "Red").otherwise("Amber")
    return t.orders.select("o_orderkey", scalars.trend_arrow(trend).alias("arrow"))


@query("c20_elementwise", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + l_linenumber AS plus, l_quantity - l_linenumber AS minus,
           l_quantity * l_linenumber AS times, round(l_quantity / l_linenumber, 6) AS over,
           floor(l_quantity / l_linenumber)::BIGINT AS floor_over, l_quantity % l_linenumber AS rest, power(l_quantity, 2) AS square
    FROM lineitem""")
def elementwise(t):
    q, n = F.col("l_quantity"), F.col("l_linenumber")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", (q + n).alias("plus"), (q - n).alias("minus"), (q * n).alias("times"),
        F.round(q / n, 6).alias("over"), F.floor(q / n).alias("floor_over"), (q % n).alias("rest"), F.pow(q, F.lit(2)).alias("square"),
    )


@query("c20_array_arithmetic", """
    SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: (x::DOUBLE * 2 + 1) * (x::DOUBLE * 2 + 1))), 6) AS s FROM embeddings""")
def array_arithmetic(t):
    doubled = F.transform("embedding", lambda x: x.cast("double") * 2 + 1)
    squared = F.zip_with(doubled, doubled, lambda a, b: a * b)
    return t.embeddings.select("vec_id", F.round(arrays.total(squared), 6).alias("s"))


@query("c21_exp_log_abs", """
    SELECT l_orderkey, l_linenumber, l_partkey, round(exp(l_discount), 9) AS e, round(ln(l_extendedprice), 9) AS l,
           abs(l_quantity - 25) AS a, l_quantity * l_quantity AS s, round(l_extendedprice, 0) AS r FROM lineitem""")
def exp_log_abs(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(F.exp("l_discount"), 9).alias("e"), F.round(F.ln("l_extendedprice"), 9).alias("l"),
        F.abs(F.col("l_quantity") - 25).alias("a"), (F.col("l_quantity") * F.col("l_quantity")).alias("s"),
        F.round("l_extendedprice", 0).alias("r"),
    )


@query("c22_array_positions", """
    SELECT vec_id, embedding[2]::DOUBLE AS second, list_sort(embedding)[1]::DOUBLE AS lowest,
           array_to_string(list_transform(embedding[1:2], lambda x: CASE WHEN x > 0 THEN '+' ELSE '-' END), '') AS signs,
           list_position(embedding, list_max(embedding))::BIGINT - 1 AS argmax, list_position(embedding, list_min(embedding))::BIGINT - 1 AS argmin,
           (list_grade_up(embedding)[1] - 1)::BIGINT AS argsort_first FROM embeddings""")
def array_positions(t):
    e = F.col("embedding")
    return t.embeddings.select(
        "vec_id", e[1].cast("double").alias("second"), F.array_sort(e)[0].cast("double").alias("lowest"),
        F.array_join(F.transform(F.slice(e, 1, 2), lambda x: F.when(x > 0, "+").otherwise("-")), "").alias("signs"),
        arrays.argmax(e).alias("argmax"), arrays.argmin(e).alias("argmin"), arrays.argsort(e)[0].alias("argsort_first"),
    )


@query("c23_dot_and_sum", """
    SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 6) AS dot,
           round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS total FROM embeddings""")
def dot_and_sum(t):
    e = F.col("embedding")
    return t.embeddings.select("vec_id", F.round(arrays.dot(e, e), 6).alias("dot"), F.round(arrays.total(e), 6).alias("total"))


@query("c24_activations", """
    WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: exp(x::DOUBLE - list_max(embedding)::DOUBLE)) AS e, embedding FROM embeddings)
    SELECT vec_id, round(1 / (1 + exp(-embedding[1]::DOUBLE)), 9) AS sigmoid, greatest(0.0, embedding[1]::DOUBLE) AS relu,
           round(list_max(e) / list_sum(e), 9) AS top_probability, list_position(e, list_max(e))::BIGINT - 1 AS label FROM s""")
def activations(t):
    first = F.col("embedding")[0].cast("double")
    soft = t.embeddings.select("vec_id", first.alias("x"), arrays.softmax(F.col("embedding")).alias("p"))
    return soft.select(
        "vec_id", F.round(arrays.sigmoid(F.col("x")), 9).alias("sigmoid"), arrays.relu(F.col("x")).alias("relu"),
        F.round(F.array_max("p"), 9).alias("top_probability"), arrays.argmax(F.col("p")).alias("label"),
    )


@query("c25_array_comparison", """
    SELECT vec_id, len(list_filter(embedding, lambda x: x > 0)) AS above, list_contains(list_transform(embedding, lambda x: x > 0.3), TRUE) AS any_high
    FROM embeddings""")
def array_comparison(t):
    zeros = F.transform("embedding", lambda x: F.lit(0.0).cast("float"))
    flags = arrays.compare(F.col("embedding"), zeros, lambda a, b: a > b)
    return t.embeddings.select(
        "vec_id", big(F.size(F.filter(flags, lambda f: f))).alias("above"),
        F.exists("embedding", lambda x: x > F.lit(0.3)).alias("any_high"),
    )


@query("c26_transpose_reshape", """
    WITH m AS (SELECT n_nationkey // 5 AS i, n_nationkey % 5 AS j, n_regionkey AS v FROM nation)
    SELECT CAST(j AS BIGINT) AS i, CAST(i AS BIGINT) AS j, v, CAST(j * 5 + i AS BIGINT) AS flat FROM m""")
def transpose_reshape(t):
    key = F.col("n_nationkey")
    cells = t.nation.select(F.floor(key / 5).alias("i"), big(key % 5).alias("j"), F.col("n_regionkey").alias("v"))
    turned = cells.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")
    return turned.withColumn("flat", F.col("i") * 5 + F.col("j"))


@query("c27_sequential_dates", """
    SELECT c_custkey, CAST(DATE '2024-01-01' + CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS INTEGER) AS DATE) AS d FROM customer""")
def sequential_dates(t):
    rows = add_row_index(t.customer.select("c_custkey"), ["c_custkey"], "i")
    return rows.select("c_custkey", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i").cast("int")).alias("d"))


@query("c28_concat_arrays", """
    SELECT vec_id, len(list_concat(embedding, embedding)) AS n, list_append(embedding, 1.0::FLOAT)[65]::DOUBLE AS last,
           len([embedding, embedding]) AS stacked FROM embeddings""")
def concat_arrays(t):
    e = F.col("embedding")
    return t.embeddings.select(
        "vec_id", big(F.size(F.concat(e, e))).alias("n"),
        F.element_at(F.array_append(e, F.lit(1.0).cast("float")), 65).cast("double").alias("last"),
        big(F.size(F.array(e, e))).alias("stacked"),
    )
