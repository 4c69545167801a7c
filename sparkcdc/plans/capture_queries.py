"""Capture and rendering over two versions of the orders table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkcdc.operators import capture, render
from sparkcdc.plans import fixtures as fx
from sparkcdc.plans.registry import query

OPTIONS = render.Options(pkey=["o_orderkey"])


def versions(spark, folder):
    orders = fx.table(spark, folder, "orders")
    k = F.col("o_orderkey")
    before = orders.where(k % 10 != 0)
    after = orders.where(k % 11 != 0).select(
        "o_orderkey",
        F.when(k % 7 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.when(k % 13 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
        "o_orderdate",
        F.when(k % 17 == 0, F.concat(F.col("o_orderpriority"), F.lit(" it's a 50% \\ café"))).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    return before, after


def changes(spark, folder):
    return capture.capture_diff(*versions(spark, folder), ["o_orderkey"])


COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

fx.CTE["before_t"] = ([], "SELECT * FROM orders WHERE o_orderkey % 10 <> 0")
fx.CTE["after_t"] = (
    [],
    r"""SELECT o_orderkey, o_custkey + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS o_custkey,
    CASE WHEN o_orderkey % 13 <> 0 THEN o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate,
    o_orderpriority || CASE WHEN o_orderkey % 17 = 0 THEN ' it''s a 50% \ café' ELSE '' END AS o_orderpriority FROM orders WHERE o_orderkey % 11 <> 0""",
)
fx.CTE["changes"] = (
    ["before_t", "after_t"],
    "SELECT coalesce(b.o_orderkey, a.o_orderkey) AS k, CASE WHEN b.o_orderkey IS NULL THEN 'INSERT' WHEN a.o_orderkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS op, "
    + ", ".join(f"b.{c} AS b_{c}, a.{c} AS a_{c}" for c in COLS)
    + " FROM before_t b FULL JOIN after_t a ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR "
    + " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in COLS),
)

PRICE = "regexp_replace(CAST({p}o_totalprice AS VARCHAR), '\\.0$', '')"
QUOTE = "'\"' || replace(replace({x}, '\\', '\\\\'), '\"', '\\\"') || '\"'"


def sql_json(p: str, price: str, skip: tuple = ()) -> str:
    """The JSON object of one image in DuckDB; ``p`` is the column prefix."""
    def text(c: str) -> str:
        return "coalesce(" + QUOTE.format(x=p + c) + ", 'null')"

    tokens = {
        "o_orderkey": f"CAST({p}o_orderkey AS VARCHAR)",
        "o_custkey": f"CAST({p}o_custkey AS VARCHAR)",
        "o_orderstatus": text("o_orderstatus"),
        "o_totalprice": price.format(p=p),
        "o_orderdate": f"'\"' || strftime({p}o_orderdate, '%Y-%m-%dT%H:%M:%S') || '\"'",
        "o_orderpriority": text("o_orderpriority"),
    }
    return "'{' || " + " || ',' || ".join(f"'\"{c}\":' || {t}" for c, t in tokens.items() if c not in skip) + " || '}'"


NUMBER = "CAST({p}o_totalprice AS VARCHAR)"
TEXT_PRICE = "'\"' || " + PRICE + " || '\"'"
OLD_JSON, NEW_JSON = sql_json("b_", NUMBER), sql_json("a_", NUMBER)
OLD_TEXT, NEW_TEXT = sql_json("b_", TEXT_PRICE), sql_json("a_", TEXT_PRICE)


@query(
    "capture_diff",
    f"""SELECT k AS o_orderkey, op, CASE WHEN op <> 'INSERT' THEN {OLD_JSON} END AS before, CASE WHEN op <> 'DELETE' THEN {NEW_JSON} END AS after FROM changes""",
    uses="changes",
)
def capture_diff_q(spark, folder):
    found = changes(spark, folder)
    row = found.schema["new"].dataType
    return found.select(
        "o_orderkey",
        "op",
        capture.row_json(F.col("old"), row).alias("before"),
        capture.row_json(F.col("new"), row).alias("after"),
    )


@query(
    "capture_feed",
    f"""SELECT k AS o_orderkey, op, '{{"schema":"public","table":"orders","op":"' || op || '","before":' || CASE WHEN op <> 'INSERT' THEN {OLD_JSON} ELSE 'null' END
    || ',"after":' || CASE WHEN op <> 'DELETE' THEN {NEW_JSON} ELSE 'null' END || '}}' AS body FROM changes""",
    uses="changes",
)
def capture_feed_q(spark, folder):
    return capture.capture_feed(changes(spark, folder), "public", "orders")


@query(
    "check_target",
    """SELECT * FROM (SELECT 'orders' AS "table", 0::BIGINT AS null_keys, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS duplicate_keys
      UNION ALL SELECT 'lineitem', 0, (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1))
      UNION ALL SELECT 'lines', (SELECT count(*) FROM lineitem WHERE l_orderkey % 7 = 0),
        (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem WHERE l_orderkey % 7 <> 0 GROUP BY 1 HAVING count(*) > 1))), (SELECT 1) x(one)
    """.replace("SELECT * FROM (", "SELECT \"table\", null_keys, duplicate_keys, null_keys = 0 AND duplicate_keys = 0 AS capturable FROM (", 1),
)
def check_target_q(spark, folder):
    line = fx.table(spark, folder, "lineitem")
    holes = line.select(F.when(F.col("l_orderkey") % 7 != 0, F.col("l_orderkey")).alias("l_orderkey"))
    return capture.check_target(
        {
            "orders": (fx.table(spark, folder, "orders"), ["o_orderkey"]),
            "lineitem": (line, ["l_orderkey", "l_linenumber"]),
            "lines": (holes, ["l_orderkey"]),
        }
    )


@query("oversize_changes", "SELECT doc_id, CAST(strlen(text) AS INTEGER) AS bytes FROM documents WHERE strlen(text) > 20000")
def oversize_q(spark, folder):
    found = capture.oversize(fx.table(spark, folder, "documents"), "text", 20_000)
    return found.select("doc_id", F.octet_length("text").alias("bytes"))


@query("reject_truncate", "SELECT event_id, 'TRUNCATE' AS op FROM events WHERE event_type = 'purchase' AND event_id % 11 = 0")
def reject_truncate_q(spark, folder):
    op = F.when((F.col("event_type") == "purchase") & (F.col("event_id") % 11 == 0), F.lit("TRUNCATE")).otherwise(F.lit("INSERT"))
    feed = fx.table(spark, folder, "events").select("event_id", op.alias("op"))
    return capture.truncates(feed)


@query(
    "key_moves",
    "SELECT k AS o_orderkey, op, b_o_custkey AS old_o_custkey, a_o_custkey AS new_o_custkey FROM changes WHERE op = 'UPDATE' AND a_o_custkey IS DISTINCT FROM b_o_custkey",
    uses="changes",
)
def key_moves_q(spark, folder):
    return capture.key_moves(changes(spark, folder), ["o_custkey"])


JSON_TYPE = """'{"op":"' || op || '","table":["public","orders"],"pkey":["o_orderkey"]}'"""


@query(
    "render_json",
    f"""SELECT k AS o_orderkey, op, {JSON_TYPE} AS ev_type, CASE WHEN op = 'DELETE' THEN {OLD_TEXT} ELSE {NEW_TEXT} END AS ev_data,
    'public.orders' AS ev_extra1, CASE WHEN op = 'UPDATE' THEN {OLD_TEXT} END AS ev_extra2, NULL::VARCHAR AS ev_extra3, NULL::VARCHAR AS ev_extra4 FROM changes""",
    uses="changes",
)
def render_json_q(spark, folder):
    return render.render_json(changes(spark, folder), render.Options(pkey=["o_orderkey"], backup=True))


ENCODE = (
    "list_aggregate(list_transform(string_split({x}, ''), lambda c: CASE WHEN regexp_full_match(c, '[-_.a-zA-Z0-9]') THEN c WHEN c = ' ' THEN '+'"
    " ELSE lower(regexp_replace(hex(encode(c)), '(..)', '%\\1', 'g')) END), 'string_agg', '')"
)


def sql_pairs(p: str) -> str:
    values = {
        "o_orderkey": f"CAST({p}o_orderkey AS VARCHAR)",
        "o_custkey": f"CAST({p}o_custkey AS VARCHAR)",
        "o_orderstatus": f"{p}o_orderstatus",
        "o_totalprice": PRICE.format(p=p),
        "o_orderdate": f"strftime({p}o_orderdate, '%Y-%m-%d %H:%M:%S')",
        "o_orderpriority": f"{p}o_orderpriority",
    }
    return " || '&' || ".join(f"'{c}' || coalesce('=' || {ENCODE.format(x=v)}, '')" for c, v in values.items())


@query(
    "render_urlencoded",
    f"""SELECT k AS o_orderkey, substr(op, 1, 1) || ':o_orderkey' AS ev_type,
    CASE WHEN op = 'DELETE' THEN {sql_pairs('b_')} ELSE {sql_pairs('a_')} END AS ev_data FROM changes""",
    uses="changes",
)
def render_urlencoded_q(spark, folder):
    return render.render_urlencoded(changes(spark, folder), OPTIONS).select("o_orderkey", "ev_type", "ev_data")


LITERAL = "CASE WHEN contains({x}, '\\') THEN 'E' ELSE '' END || '''' || replace(replace({x}, '\\', '\\\\'), '''', '''''') || ''''"


def sql_literals(p: str) -> dict[str, str]:
    values = {
        "o_orderkey": f"CAST({p}o_orderkey AS VARCHAR)",
        "o_custkey": f"CAST({p}o_custkey AS VARCHAR)",
        "o_orderstatus": f"{p}o_orderstatus",
        "o_totalprice": PRICE.format(p=p),
        "o_orderdate": f"strftime({p}o_orderdate, '%Y-%m-%d %H:%M:%S')",
        "o_orderpriority": f"{p}o_orderpriority",
    }
    return {c: LITERAL.format(x=v) for c, v in values.items()}


NEW_LITERALS = sql_literals("a_")
INSERT_SQL = "'(" + ",".join(COLS) + ") values (' || " + " || ',' || ".join(f"coalesce({v}, 'null')" for v in NEW_LITERALS.values()) + " || ')'"
SETS = ", ".join(
    f"CASE WHEN a_{c} IS DISTINCT FROM b_{c} THEN '{c}=' || coalesce({NEW_LITERALS[c]}, 'NULL') END" for c in COLS if c != "o_orderkey"
)


@query(
    "render_sql",
    f"""SELECT k AS o_orderkey, substr(op, 1, 1) AS ev_type, CASE op WHEN 'INSERT' THEN {INSERT_SQL} WHEN 'UPDATE' THEN
      concat_ws(',', {SETS}) || ' where o_orderkey=''' || k || '''' ELSE 'o_orderkey=''' || k || '''' END AS ev_data FROM changes""",
    uses="changes",
)
def render_sql_q(spark, folder):
    return render.render_sql(changes(spark, folder), OPTIONS).select("o_orderkey", "ev_type", "ev_data")


IGNORED = ("o_orderpriority", "o_custkey")


@query(
    "ignore_columns",
    f"""SELECT k AS o_orderkey, op, CASE WHEN op = 'DELETE' THEN {sql_json('b_', TEXT_PRICE, IGNORED)} ELSE {sql_json('a_', TEXT_PRICE, IGNORED)} END AS ev_data
    FROM changes WHERE op <> 'UPDATE' OR a_o_orderstatus IS DISTINCT FROM b_o_orderstatus""",
    uses="changes",
)
def ignore_columns_q(spark, folder):
    options = render.Options(pkey=["o_orderkey"], ignore=IGNORED)
    return render.render_json(changes(spark, folder), options).select("o_orderkey", "op", "ev_data")


@query(
    "capture_when",
    """SELECT k AS o_orderkey, op, 'p' || CASE WHEN op = 'DELETE' THEN b_o_custkey ELSE a_o_custkey END AS ev_extra3,
    CASE WHEN op = 'DELETE' THEN b_o_orderpriority ELSE a_o_orderpriority END AS ev_type FROM changes
    WHERE CASE WHEN op = 'DELETE' THEN b_o_orderstatus ELSE a_o_orderstatus END IN ('F', 'O')""",
    uses="changes",
)
def capture_when_q(spark, folder):
    options = render.Options(
        pkey=["o_orderkey"],
        when="o_orderstatus in ('F', 'O')",
        fields={"ev_extra3": "concat('p', o_custkey)", "ev_type": "o_orderpriority"},
    )
    return render.render_json(changes(spark, folder), options).select("o_orderkey", "op", "ev_extra3", "ev_type")


@query(
    "pkey_guard",
    "SELECT k AS o_orderkey, op, 'key update not allowed' AS problem FROM changes WHERE op = 'UPDATE' AND a_o_custkey IS DISTINCT FROM b_o_custkey",
    uses="changes",
)
def pkey_guard_q(spark, folder):
    # The association stands in for the key: moves of it are what the guard must name.
    guard = render.pkey_problem(render.Options(pkey=["o_orderkey", "o_custkey"]))
    return changes(spark, folder).select("o_orderkey", "op", guard.alias("problem")).where(F.col("problem").isNotNull())


@query(
    "capture_redirect",
    f"""SELECT 'event' AS kind, op, count(*) AS n, count(*) FILTER (WHERE op = 'UPDATE') AS with_backup FROM changes GROUP BY op""",
    uses="changes",
)
def capture_redirect_q(spark, folder):
    options = render.Options(pkey=["o_orderkey"], skip=True, backup=True)
    writes, events = render.redirect(changes(spark, folder), options)
    kept = writes.select(F.lit("write").alias("kind"), "op", F.lit(None).cast("string").alias("ev_extra2"))
    made = events.select(F.lit("event").alias("kind"), "op", "ev_extra2")
    return kept.unionByName(made).groupBy("kind", "op").agg(F.count("*").alias("n"), F.count("ev_extra2").alias("with_backup"))
