"""The queries over the star schema's graph, each with its SQL on the tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegraph.functions import sparql as S
from tidegraph.operators import entities as E
from tidegraph.operators import intervals as IV
from tidegraph.operators import ontology as O
from tidegraph.operators import paths as PATH
from tidegraph.operators import patterns as P
from tidegraph.operators import ranking as RANK
from tidegraph.operators import reasoning as R
from tidegraph.operators import segments as SEG
from tidegraph.operators import signals as SIG
from tidegraph.operators import temporal as T
from tidegraph.operators import timeline as TL
from tidegraph.operators import writes as WR
from tidegraph.plans.structured import Aggregate, Compare, DateTime, Request, run
from tidegraph.shared import materialise, new_folder
from tidegraph.sources import ndjson, rdf, results
from tidegraph.sources.star import Graph, edge_events, graph
from tidegraph.streaming import imports, state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name, with its SQL."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def on_graph(sql: str | None = None):
    """The same for a function of the graph."""

    def add(function: Callable[[Graph], DataFrame]) -> Callable:
        QUERIES[function.__name__] = lambda spark, sf_dir: function(graph(spark, sf_dir))
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def money(column: str):
    """A sum that does not depend on the order of addition."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


# ------------------------------------------------------------------ structured requests


@on_graph("""
SELECT r.r_name AS region, date_trunc('month', o_orderdate)::TIMESTAMP AS month, count(o_orderkey) AS n,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey
GROUP BY 1, 2 HAVING count(*) > 2""")
def flagship(g: Graph) -> DataFrame:
    return run(g, Request(
        patterns=[("?c", "PLACED", "?o"), ("?c", "IN_NATION", "?n"), ("?n", "IN_REGION", "?r")],
        properties={"o": ("ORDER", ["orderdate", "totalprice"]), "r": ("REGION", ["name"])},
        group_keys={"region": "r_name", "month": ("month", "o_orderdate")},
        aggregates=[Aggregate("count", "o", "n"), Aggregate("sum", "o_totalprice", "total")],
        having=F.col("n") > 2,
        order_by=["region", "month"],
    ))


@on_graph("SELECT 'CUSTOMER/' || o_custkey AS c, 'ORDER/' || o_orderkey AS o, 'NATION/' || c_nationkey AS n FROM orders JOIN customer ON o_custkey = c_custkey")
def bgp_two_hop(g: Graph) -> DataFrame:
    return P.match(g, [("?c", "PLACED", "?o"), ("?c", "IN_NATION", "?n")])


@on_graph("SELECT 'ORDER/' || l_orderkey AS o, 'PART/' || l_partkey AS p, 'CUSTOMER/' || o_custkey AS c, 'NATION/' || c_nationkey AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey")
def bgp_three_hop(g: Graph) -> DataFrame:
    return P.match(g, [("?o", "CONTAINS", "?p"), ("?c", "PLACED", "?o"), ("?c", "IN_NATION", "?n")])


@on_graph("SELECT 'SUPPLIER/' || s_suppkey AS s, 'NATION/' || s_nationkey AS n, count(*) AS customers FROM supplier JOIN customer ON s_nationkey = c_nationkey GROUP BY ALL")
def bgp_self_join(g: Graph) -> DataFrame:
    """The relation joined with itself: suppliers with the customers of their nation, counted."""
    own = P.with_properties(g, P.match(g, [("?s", "IN_NATION", "?n")]), "s", "SUPPLIER", [])
    per = P.with_properties(g, P.match(g, [("?c", "IN_NATION", "?n")]), "c", "CUSTOMER", []).groupBy("n").agg(F.count("*").alias("customers"))
    return own.join(per, "n").select("s", "n", "customers")


@on_graph("SELECT 'NATION/' || n_nationkey AS n FROM nation WHERE n_regionkey = 1")
def bgp_constant(g: Graph) -> DataFrame:
    return P.match(g, [("?n", "IN_REGION", "REGION/1")])


def _filtered(op: str, sql_op: str) -> None:
    def function(g: Graph) -> DataFrame:
        return run(g, Request(patterns=[("?c", "PLACED", "?o")], properties={"o": ("ORDER", ["totalprice"])}, where=[Compare("totalprice", op, 100000, "o")], select=["c", "o", "o_totalprice"]))

    function.__name__ = f"filter_{op}"
    on_graph(f"SELECT 'CUSTOMER/' || o_custkey AS c, 'ORDER/' || o_orderkey AS o, o_totalprice FROM orders WHERE o_totalprice {sql_op} 100000")(function)


for _op, _sql in (("ne", "<>"), ("lt", "<"), ("le", "<="), ("gt", ">"), ("ge", ">=")):
    _filtered(_op, _sql)


@on_graph("SELECT 'CUSTOMER/' || c_custkey AS c, 'NATION/' || c_nationkey AS n, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(g: Graph) -> DataFrame:
    return run(g, Request(patterns=[("?c", "IN_NATION", "?n")], properties={"c": ("CUSTOMER", ["mktsegment"])}, where=[Compare("mktsegment", "eq", "BUILDING")], select=["c", "n", "c_mktsegment"]))


@on_graph("SELECT 'ORDER/' || o_orderkey AS o, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderdate < TIMESTAMP '2001-01-01'")
def filter_datetime(g: Graph) -> DataFrame:
    return run(g, Request(patterns=[("?c", "PLACED", "?o")], properties={"o": ("ORDER", ["orderdate"])}, where=[Compare("orderdate", "ge", DateTime("2000-01-01"), "o"), Compare("orderdate", "lt", DateTime("2001-01-01T02:00:00+02:00"), "o")], select=["o", "o_orderdate"]))


@on_graph("SELECT 'CUSTOMER/' || c_custkey AS c, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_mktsegment <> 'MACHINERY' AND c_acctbal <= 5000.5")
def filter_by_attributes(g: Graph) -> DataFrame:
    """Raw filters first, then the list; the default variable is the first pattern's subject."""
    return run(g, Request(patterns=[("?c", "IN_NATION", "?n")], properties={"c": ("CUSTOMER", ["acctbal", "mktsegment"])}, filters=[F.col("c_acctbal") > 0], where=[Compare("mktsegment", "ne", "MACHINERY"), Compare("acctbal", "le", 5000.5)], select=["c", "c_mktsegment", "c_acctbal"]))


@on_graph("SELECT 'CUSTOMER/' || o_custkey AS c, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, min(o_totalprice) AS least, max(o_totalprice) AS most FROM orders GROUP BY 1")
def group_entity(g: Graph) -> DataFrame:
    return run(g, Request(patterns=[("?c", "PLACED", "?o")], properties={"o": ("ORDER", ["totalprice"])}, group_keys={"c": "c"}, aggregates=[Aggregate("count", "o", "n"), Aggregate("sum", "o_totalprice", "total"), Aggregate("min", "o_totalprice", "least"), Aggregate("max", "o_totalprice", "most")]))


@on_graph("SELECT c_mktsegment AS segment, o_orderpriority AS priority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def group_property(g: Graph) -> DataFrame:
    return run(g, Request(patterns=[("?c", "PLACED", "?o")], properties={"c": ("CUSTOMER", ["mktsegment"]), "o": ("ORDER", ["orderpriority"])}, group_keys={"segment": "c_mktsegment", "priority": "o_orderpriority"}, aggregates=[Aggregate("count", "o", "n")]))


def _bucketed(unit: str) -> None:
    def function(g: Graph) -> DataFrame:
        return run(g, Request(patterns=[("?u", "HAS_STATE", "?s")], keep={"HAS_STATE": ["valid_from"]}, group_keys={"start": (unit, "valid_from"), "s": "s"}, aggregates=[Aggregate("count", "u", "n")]))

    function.__name__ = f"bucket_{unit}"
    on_graph(f"SELECT date_trunc('{unit}', ts)::TIMESTAMP AS start, 'STATE/' || event_type AS s, count(*) AS n FROM events GROUP BY ALL")(function)


for _unit in ("year", "month", "week", "day", "hour"):
    _bucketed(_unit)


@on_graph("SELECT 'PART/' || l_partkey AS p, count(*) AS n, avg(l_quantity) AS mean FROM lineitem GROUP BY 1 HAVING count(*) >= 30")
def having(g: Graph) -> DataFrame:
    return run(g, Request(patterns=[("?o", "CONTAINS", "?p")], keep={"CONTAINS": ["quantity"]}, group_keys={"p": "p"}, aggregates=[Aggregate("count", "o", "n"), Aggregate("avg", "quantity", "mean")], having=F.col("n") >= 30))


@on_graph("SELECT count(*) > 0 AS answer FROM nation WHERE n_regionkey = 2")
def ask_true(g: Graph) -> DataFrame:
    return P.ask(P.match(g, [("?n", "IN_REGION", "REGION/2")]))


@on_graph("SELECT count(*) > 0 AS answer FROM nation WHERE n_regionkey = 77")
def ask_false(g: Graph) -> DataFrame:
    return P.ask(P.match(g, [("?n", "IN_REGION", "REGION/77")]))


@on_graph("SELECT 'ORDER/' || o_orderkey AS o, o_totalprice FROM orders ORDER BY o_totalprice DESC, o LIMIT 25 OFFSET 50")
def order_limit_offset(g: Graph) -> DataFrame:
    found = run(g, Request(patterns=[("?c", "PLACED", "?o")], properties={"o": ("ORDER", ["totalprice"])}, select=["o", "o_totalprice"]))
    return P.page(found, [F.desc("o_totalprice"), "o"], 25, 50)


@on_graph("SELECT count(*) AS total, least(100, count(*)) AS returned, count(*) > 100 AS has_more FROM customer")
def row_page(g: Graph) -> DataFrame:
    facts = P.page_facts(P.match(g, [("?c", "IN_NATION", "?n")]).where(F.col("c").startswith("CUSTOMER/")).count(), 100, 0)
    return g.spark.createDataFrame([(facts["total"], facts["returned"], facts["has_more"])], "total long, returned long, has_more boolean")


# ------------------------------------------------------------------ the algebra over solutions


@on_graph("SELECT 'CUSTOMER/' || c_custkey AS c, 'NATION/' || c_nationkey AS n, 'ORDER/' || o_orderkey AS o, o_totalprice FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 400000")
def sparql_optional(g: Graph) -> DataFrame:
    customers = P.with_properties(g, P.match(g, [("?c", "IN_NATION", "?n")]), "c", "CUSTOMER", [])
    orders = P.with_properties(g, P.match(g, [("?c", "PLACED", "?o")]), "o", "ORDER", ["totalprice"])
    return P.optional(customers, orders, ["c"], F.col("o_totalprice") > 400000)


@on_graph("SELECT 'CUSTOMER/' || c_custkey AS c, NULL AS s, 'NATION/' || c_nationkey AS n FROM customer UNION ALL SELECT NULL, 'SUPPLIER/' || s_suppkey, 'NATION/' || s_nationkey FROM supplier")
def sparql_union(g: Graph) -> DataFrame:
    one = P.with_properties(g, P.match(g, [("?c", "IN_NATION", "?n")]), "c", "CUSTOMER", [])
    return P.union(one, P.with_properties(g, P.match(g, [("?s", "IN_NATION", "?n")]), "s", "SUPPLIER", []))


_LATE_F = "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '2001-01-01'"


def _late(g: Graph) -> DataFrame:
    found = P.with_properties(g, P.match(g, [("?c", "PLACED", "?o")]), "o", "ORDER", ["orderstatus", "orderdate"])
    return found.where("o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP_NTZ '2001-01-01'")


def _customers(g: Graph) -> DataFrame:
    return P.with_properties(g, P.match(g, [("?c", "IN_NATION", "?n")]), "c", "CUSTOMER", [])


@on_graph(f"SELECT 'CUSTOMER/' || c_custkey AS c, 'NATION/' || c_nationkey AS n FROM customer WHERE c_custkey NOT IN ({_LATE_F})")
def sparql_minus(g: Graph) -> DataFrame:
    return P.minus(_customers(g), _late(g).select("c"))


@on_graph("SELECT 'CUSTOMER/' || c_custkey AS c, 'NATION/' || c_nationkey AS n FROM customer")
def sparql_minus_disjoint(g: Graph) -> DataFrame:
    """No shared variable: nothing goes."""
    return P.minus(_customers(g), P.match(g, [("?x", "HAS_STATE", "?y")]))


@on_graph("""WITH l AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 3 > 0 THEN n_regionkey END AS r, CASE WHEN n_nationkey % 5 > 0 THEN n_name END AS name FROM nation),
o AS (SELECT CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey END AS r, CASE WHEN n_nationkey % 7 < 3 THEN n_name END AS name FROM nation WHERE n_nationkey < 9)
SELECT 'NATION/' || k AS n, r, name FROM l WHERE NOT EXISTS (SELECT 1 FROM o WHERE coalesce(l.r = o.r, true) AND coalesce(l.name = o.name, true) AND (l.r = o.r OR l.name = o.name))""")
def sparql_minus_unbound(g: Graph) -> DataFrame:
    """Both sides leave variables unbound: a solution goes if another one is compatible and shares a bound variable."""
    k = F.col("nationkey")
    left = g.entities["NATION"].select(F.col("id").alias("n"), F.when(k % 3 > 0, F.col("regionkey")).alias("r"), F.when(k % 5 > 0, F.col("name")).alias("name"))
    right = g.entities["NATION"].where("nationkey < 9").select(F.when(k % 2 == 0, F.col("regionkey")).alias("r"), F.when(k % 7 < 3, F.col("name")).alias("name"))
    return P.minus(left, right)


@on_graph(f"SELECT 'CUSTOMER/' || c_custkey AS c, 'NATION/' || c_nationkey AS n FROM customer WHERE c_custkey IN ({_LATE_F})")
def sparql_exists(g: Graph) -> DataFrame:
    return P.exists(_customers(g), _late(g), ["c"])


@on_graph(f"SELECT 'CUSTOMER/' || c_custkey AS c, 'NATION/' || c_nationkey AS n FROM customer WHERE c_custkey NOT IN ({_LATE_F})")
def sparql_not_exists(g: Graph) -> DataFrame:
    return P.not_exists(_customers(g), _late(g), ["c"])


@on_graph("SELECT 'ORDER/' || o_orderkey AS o, round(o_totalprice * 2, 2) AS twice, upper(o_orderpriority) AS priority FROM orders")
def sparql_bind(g: Graph) -> DataFrame:
    found = P.with_properties(g, P.match(g, [("?c", "PLACED", "?o")]), "o", "ORDER", ["totalprice", "orderpriority"])
    return found.select("o", F.round(F.col("o_totalprice") * 2, 2).alias("twice"), F.upper("o_orderpriority").alias("priority"))


@on_graph("SELECT 'NATION/' || n_nationkey AS n, 'REGION/' || n_regionkey AS r, label FROM nation JOIN (VALUES ('REGION/1', 'one'), ('REGION/3', 'three')) v(r, label) ON v.r = 'REGION/' || n_regionkey")
def sparql_values(g: Graph) -> DataFrame:
    return P.match(g, [("?n", "IN_REGION", "?r")]).join(P.values(g, ["r", "label"], [("REGION/1", "one"), ("REGION/3", "three")]), "r")


@on_graph("""SELECT 'CUSTOMER/' || c_custkey AS c, 'NATION/' || c_nationkey AS n, orders FROM customer
JOIN (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE orders >= 12""")
def sparql_subquery(g: Graph) -> DataFrame:
    inner = P.match(g, [("?c", "PLACED", "?o")]).groupBy("c").agg(F.count("*").alias("orders"))
    return _customers(g).join(inner, "c").where("orders >= 12").select("c", "n", "orders")


@on_graph("SELECT 'REGION/' || n_regionkey AS r, 'STATE/' || event_type AS s FROM nation CROSS JOIN (SELECT DISTINCT event_type FROM events WHERE user_id = 7) WHERE n_nationkey = 3")
def bgp_unconnected(g: Graph) -> DataFrame:
    """Two patterns that share no variable, both pinned by a constant."""
    return P.match(g, [("NATION/3", "IN_REGION", "?r"), ("USER/7", "HAS_STATE", "?s")]).distinct()


_PARTIES = O.Ontology(types={"PARTY": None, "CUSTOMER": "PARTY", "SUPPLIER": "PARTY"})


@on_graph("SELECT 'CUSTOMER/' || c_custkey AS p, 'NATION/' || c_nationkey AS n, c_acctbal AS p_acctbal FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT 'SUPPLIER/' || s_suppkey, 'NATION/' || s_nationkey, s_acctbal FROM supplier WHERE s_acctbal > 9000")
def reason_subclasses(g: Graph) -> DataFrame:
    """A request for parties finds customers and suppliers, which the ontology puts below them."""
    return run(g, Request(patterns=[("?p", "IN_NATION", "?n")], properties={"p": ("PARTY", ["acctbal"])}, where=[Compare("acctbal", "gt", 9000)], select=["p", "n", "p_acctbal"], reason=_PARTIES))


_LOCATED = """WITH b AS (SELECT 'CUSTOMER/' || c_custkey AS x, 'NATION/' || c_nationkey AS y FROM customer UNION ALL SELECT 'SUPPLIER/' || s_suppkey, 'NATION/' || s_nationkey FROM supplier),
r AS (SELECT 'NATION/' || n_nationkey AS x, 'REGION/' || n_regionkey AS y FROM nation), br AS (SELECT b.x, r.y FROM b JOIN r ON b.y = r.x) """


@on_graph(_LOCATED + """, near AS (SELECT * FROM b UNION ALL SELECT * FROM r)
SELECT x AS src, 'LOCATED' AS relation, y AS dst, 1 AS depth FROM near UNION ALL SELECT x, 'CONNECTED', y, 2 FROM near UNION ALL SELECT y, 'HOLDS', x, 2 FROM near
UNION ALL SELECT x, 'LOCATED', y, 2 FROM br UNION ALL SELECT x, 'CONNECTED', y, 3 FROM br UNION ALL SELECT y, 'HOLDS', x, 3 FROM br
UNION ALL SELECT x, 'a', 'RESIDENT', 1 FROM b UNION ALL SELECT x, 'a', 'PARTY', 2 FROM b UNION ALL SELECT DISTINCT y, 'a', 'AREA', 1 FROM r""")
def reason_fixpoint(g: Graph) -> DataFrame:
    """All that follows from where customers, suppliers and nations are; two relations are cases of one another, and one is transitive."""
    rules = [R.subproperty("IN_NATION", "LOCATED"), R.subproperty("IN_REGION", "LOCATED"), R.subproperty("LOCATED", "CONNECTED"), R.subproperty("CONNECTED", "LOCATED"), *R.inverse("LOCATED", "HOLDS")]
    rules += [R.domain("IN_NATION", "RESIDENT"), R.subclass("RESIDENT", "PARTY"), R.range_("IN_REGION", "AREA")]
    return R.infer(g.all_edges(["IN_NATION", "IN_REGION"]), rules, transitive=["LOCATED"]).where("depth > 0")


@on_graph(_LOCATED + "SELECT x AS p, y AS place FROM b WHERE x LIKE 'SUPPLIER/%' UNION ALL SELECT x, y FROM r WHERE false")
def reason_pattern(g: Graph) -> DataFrame:
    """A pattern on a relation that no table has finds the edges of those that the ontology calls cases of it, here of what suppliers hold the other way round."""
    rules = O.Ontology(subproperties={"IN_NATION": ("LOCATED",), "IN_REGION": ("LOCATED",), "LOCATED": ("CONNECTED",), "CONNECTED": ("LOCATED",)}, inverses={"LOCATED": "HOLDS"})
    found = run(g, Request(patterns=[("?place", "HOLDS", "?p"), ("?p", "SUPPLIES", "?part")], select=["p", "place"], reason=rules))
    return found.distinct()


@on_graph("SELECT 'CUSTOMER/' || o_custkey AS c, 'ORDER/' || o_orderkey AS o FROM orders ORDER BY c, o LIMIT 7 OFFSET 5")
def request_limit_without_order(g: Graph) -> DataFrame:
    """Without an order, pages go by all columns."""
    return run(g, Request(patterns=[("?c", "PLACED", "?o")], limit=7, offset=5))


@on_graph("SELECT 'CUSTOMER/' || o_custkey AS c, 'ORDER/' || o_orderkey AS o FROM orders ORDER BY o LIMIT 100000000 OFFSET 1000")
def request_offset_alone(g: Graph) -> DataFrame:
    return run(g, Request(patterns=[("?c", "PLACED", "?o")], order_by=["o"], offset=1000))


@on_graph("SELECT 'REGION/1' AS region, 'NATION/' || n_nationkey AS n FROM nation WHERE n_regionkey = 1")
def bgp_odd_constants(g: Graph) -> DataFrame:
    """Keys that no table can have match nothing: larger than any number, written in another way, or no number."""
    keys = ["1", "99999999999999999999999", "9223372036854775808", "--1", "-", "01", "+1", "1.0", "\u0661", ""]
    found = [P.match(g, [("?n", "IN_REGION", f"REGION/{k}")]).select(F.lit(f"REGION/{k}").alias("region"), "n") for k in keys]
    return reduce(lambda a, b: a.unionByName(b), found)


@on_graph("SELECT id, name FROM (SELECT 'CUSTOMER/' || c_custkey AS id, c_name AS name FROM customer) WHERE id > 'CUSTOMER/15' ORDER BY id LIMIT 51")
def keyset_page(g: Graph) -> DataFrame:
    """The next fifty by key, and one more that tells that there are others."""
    return P.after(g.entities["CUSTOMER"].select("id", "name"), "id", "CUSTOMER/15", 50)


_TERMS = """SELECT n_nationkey AS k, CASE n_nationkey % 5 WHEN 1 THEN '_:b' || n_nationkey WHEN 2 THEN '<http://ex/' || n_nationkey || '>' WHEN 3 THEN '"' || n_nationkey || '"^^<http://www.w3.org/2001/XMLSchema#integer>' WHEN 4 THEN '"' || n_name || '"@en' END AS t FROM nation"""


def _terms(g: Graph) -> DataFrame:
    """Unbound, blank nodes, IRIs, numbers and tagged texts in one column."""
    k, key = F.col("nationkey") % 5, F.col("nationkey").cast("string")
    term = F.when(k == 1, F.concat(F.lit("_:b"), key)).when(k == 2, F.concat(F.lit("<http://ex/"), key, F.lit(">"))).when(k == 3, F.concat(F.lit('"'), key, F.lit(f'"^^<{S.XSD}integer>'))).when(k == 4, F.concat(F.lit('"'), "name", F.lit('"@en')))
    return g.entities["NATION"].select(F.col("nationkey").alias("k"), term.alias("t"))


@on_graph(f"SELECT t FROM ({_TERMS}) ORDER BY CASE k % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END, CASE WHEN k % 5 = 3 THEN k END NULLS LAST, t LIMIT 18")
def sparql_order_terms(g: Graph) -> DataFrame:
    """Unbound, then blank nodes, IRIs and literals; numbers by value, before texts."""
    return P.page(_terms(g).select("t"), S.term_order("t"), 18)


@on_graph(f"""SELECT k, k % 5 = 2 AS iri, k % 5 = 1 AS blank, k % 5 >= 3 AS literal, k % 5 = 3 AS "numeric", CASE k % 5 WHEN 3 THEN '' WHEN 4 THEN 'en' END AS lang,
CASE k % 5 WHEN 3 THEN 'http://www.w3.org/2001/XMLSchema#integer' WHEN 4 THEN 'http://www.w3.org/1999/02/22-rdf-syntax-ns#langString' END AS datatype, k % 5 <> 4 AS same FROM ({_TERMS}) WHERE t IS NOT NULL""")
def fn_term_tests(g: Graph) -> DataFrame:
    """What a term is; a text in other letters is another term."""
    terms = _terms(g).where("t IS NOT NULL")
    other = F.when(S.is_literal("t"), F.lower("t")).otherwise(F.col("t"))
    other = F.when(S.is_numeric("t"), F.col("t")).otherwise(other)
    return terms.select("k", S.is_iri("t").alias("iri"), S.is_blank("t").alias("blank"), S.is_literal("t").alias("literal"), F.coalesce(S.is_numeric("t"), F.lit(False)).alias("numeric"), S.lang("t").alias("lang"), S.datatype("t").alias("datatype"), S.same_term("t", other).alias("same"))


@on_graph("SELECT DISTINCT 'USER/' || user_id AS u, 'STATE/' || event_type AS s FROM events")
def sparql_distinct(g: Graph) -> DataFrame:
    return P.match(g, [("?u", "HAS_STATE", "?s")]).distinct()


@query("""SELECT '<http://ex/NATION/' || n_nationkey || '>' AS s, '<http://ex/REGION/' || n_regionkey || '>' AS o FROM nation""")
def sparql_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two named graphs, and a pattern on one of them."""
    g = graph(spark, sf_dir)
    one = rdf.from_edges(g.all_edges(["IN_REGION"])).withColumn("g", F.lit("<http://ex/g1>"))
    other = rdf.from_edges(g.all_edges(["DOUBLES"])).withColumn("g", F.lit("<http://ex/g2>"))
    return one.unionByName(other).where("g = '<http://ex/g1>'").select("s", "o")


@on_graph("""WITH l AS (SELECT 'NATION/' || n_nationkey AS n, CASE WHEN n_regionkey < 2 THEN 'REGION/' || n_regionkey END AS r FROM nation)
SELECT l.n, coalesce(l.r, 'REGION/' || r_regionkey) AS r, r_name FROM l JOIN region ON l.r IS NULL OR l.r = 'REGION/' || r_regionkey""")
def compatible_join(g: Graph) -> DataFrame:
    """OPTIONAL leaves ?r unbound for some nations; they are compatible with every region."""
    nations = P.match(g, [("?n", "IN_REGION", "?r")]).withColumn("r", F.when(F.col("r").isin("REGION/0", "REGION/1"), F.col("r")))
    regions = g.entities["REGION"].select(F.col("id").alias("r"), F.col("name").alias("r_name"))
    return P.compatible_join(nations, regions, ["r"])


@on_graph("SELECT 'STATE/' || event_type AS s, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def agg_count_distinct(g: Graph) -> DataFrame:
    return P.match(g, [("?u", "HAS_STATE", "?s")]).groupBy("s").agg(F.countDistinct("u").alias("users"))


@on_graph("SELECT 'REGION/' || n_regionkey AS r, string_agg(n_name, ' ' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def agg_group_concat(g: Graph) -> DataFrame:
    found = P.with_properties(g, P.match(g, [("?n", "IN_REGION", "?r")]), "n", "NATION", ["name"])
    return found.groupBy("r").agg(F.array_join(F.array_sort(F.collect_list("n_name")), " ").alias("names"))


@on_graph("SELECT 'NATION/' || c_nationkey AS n, min('CUSTOMER/' || c_custkey) AS some FROM customer GROUP BY 1")
def agg_sample_min(g: Graph) -> DataFrame:
    """SAMPLE as the least, so that reruns agree."""
    return _customers(g).groupBy("n").agg(F.min("c").alias("some"))


@on_graph("SELECT 0::BIGINT AS n, 0.0::DOUBLE AS total, 0.0::DOUBLE AS mean, NULL::DOUBLE AS least")
def agg_empty_sum_zero(g: Graph) -> DataFrame:
    none = P.with_properties(g, P.match(g, [("?c", "PLACED", "ORDER/none")]).withColumn("o", F.lit("ORDER/none")), "o", "ORDER", ["totalprice"])
    return none.agg(F.count("*").alias("n"), P.sum_or_error("o_totalprice", 0.0).alias("total"), P.average_or_error("o_totalprice").alias("mean"), F.min("o_totalprice").alias("least"))


# ------------------------------------------------------------------ paths


@on_graph("SELECT 'CUSTOMER/' || c_custkey AS src, 'REGION/' || n_regionkey AS dst FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT 'SUPPLIER/' || s_suppkey, 'REGION/' || n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def path_seq(g: Graph) -> DataFrame:
    return PATH.sequence(g.scan("IN_NATION"), g.scan("IN_REGION"))


@on_graph("SELECT 'NATION/' || n_nationkey AS src, 'REGION/' || n_regionkey AS dst FROM nation UNION ALL SELECT 'NATION/' || n_nationkey, 'NATION/' || (2 * n_nationkey % 25) FROM nation")
def path_alt(g: Graph) -> DataFrame:
    return PATH.alternative(g.scan("IN_REGION"), g.scan("DOUBLES"))


@on_graph("SELECT 'ORDER/' || o_orderkey AS src, 'CUSTOMER/' || o_custkey AS dst FROM orders")
def path_inverse(g: Graph) -> DataFrame:
    return PATH.inverse(g.scan("PLACED"))


@on_graph("""WITH e AS (SELECT 'NATION/' || n_nationkey AS src, 'NATION/' || (2 * n_nationkey % 25) AS dst FROM nation)
SELECT * FROM e UNION SELECT src, src FROM e UNION SELECT dst, dst FROM e""")
def path_opt(g: Graph) -> DataFrame:
    return PATH.zero_or_one(g.scan("DOUBLES"))


@on_graph("SELECT 'NATION/' || n_nationkey AS src, 'NATION/' || (2 * n_nationkey % 25) AS dst FROM nation")
def path_negated(g: Graph) -> DataFrame:
    return PATH.negated(g.all_edges(["IN_REGION", "DOUBLES", "IN_NATION"]), ["IN_REGION", "IN_NATION"])


_CLOSURE = "WITH RECURSIVE e AS ({e}), r AS (SELECT src, dst FROM e UNION SELECT r.src, e.dst FROM r JOIN e ON r.dst = e.src) "


@on_graph(_CLOSURE.format(e="SELECT n_nationkey AS src, 2 * n_nationkey % 25 AS dst FROM nation") + "SELECT 'NATION/' || src AS src, 'NATION/' || dst AS dst FROM r")
def path_plus_cycle(g: Graph) -> DataFrame:
    return PATH.one_or_more(g.scan("DOUBLES"))


@on_graph(_CLOSURE.format(e="SELECT n_nationkey AS src, 2 * n_nationkey % 25 AS dst FROM nation") + "SELECT 'NATION/' || src AS src, 'NATION/' || dst AS dst FROM r UNION SELECT 'NATION/' || n_nationkey, 'NATION/' || n_nationkey FROM nation")
def path_star_cycle(g: Graph) -> DataFrame:
    return PATH.zero_or_more(g.scan("DOUBLES"))


@on_graph(_CLOSURE.format(e="SELECT p_partkey AS src, p_partkey // 2 AS dst FROM part WHERE p_partkey > 0") + "SELECT 'PART/' || src AS src, 'PART/' || dst AS dst FROM r")
def path_plus_tree(g: Graph) -> DataFrame:
    return g.named("PARENT", PATH.one_or_more(g.keys("PARENT")))


@on_graph(_CLOSURE.format(e="SELECT p_partkey AS src, p_partkey + 1 AS dst FROM part WHERE p_partkey <= 160") + "SELECT 'STEP/' || src AS src, 'STEP/' || dst AS dst FROM r")
def path_plus_deep(g: Graph) -> DataFrame:
    """A chain of 160 steps."""
    return g.named("NEXT", PATH.one_or_more(g.keys("NEXT")))


@on_graph(_CLOSURE.format(e="SELECT n_nationkey AS src, 2 * n_nationkey % 25 AS dst FROM nation") + "SELECT 'NATION/' || src AS seed, 'NATION/' || dst AS dst FROM r WHERE src = 3")
def path_seeded(g: Graph) -> DataFrame:
    return PATH.reachable(g.scan("DOUBLES"), g.spark.createDataFrame([("NATION/3",)], "src string"))


# ------------------------------------------------------------------ functions


@on_graph("""SELECT 'PART/' || p_partkey AS id, length(p_name) AS strlen, substr(p_name, 2, 3) AS substr, upper(p_name) AS ucase, lower(p_type) AS lcase,
starts_with(p_name, 'a') AS strstarts, ends_with(p_name, 'e') AS strends, contains(p_type, 'ST') AS contains,
CASE WHEN instr(p_name, ' ') > 0 THEN split_part(p_name, ' ', 1) ELSE '' END AS strbefore,
CASE WHEN instr(p_name, ' ') > 0 THEN substr(p_name, instr(p_name, ' ') + 1) ELSE '' END AS strafter,
url_encode(p_type || '~*') AS encoded, p_name || '-' || p_brand AS concat FROM part""".replace("url_encode(p_type || '~*')", "replace(url_encode(p_type || '~*'), '+', '%20')"))
def fn_string(g: Graph) -> DataFrame:
    p = g.entities["PART"]
    return p.select("id", F.length("name").alias("strlen"), F.substring("name", 2, 3).alias("substr"), F.upper("name").alias("ucase"), F.lower("type").alias("lcase"), F.col("name").startswith("a").alias("strstarts"), F.col("name").endswith("e").alias("strends"), F.col("type").contains("ST").alias("contains"), S.strbefore("name", " ").alias("strbefore"), S.strafter("name", " ").alias("strafter"), S.encode_for_uri(F.concat("type", F.lit("~*"))).alias("encoded"), F.concat("name", F.lit("-"), "brand").alias("concat"))


@on_graph("""SELECT 'PART/' || p_partkey AS id, '<http://ex/part/' || p_partkey || '>' AS iri, '"' || p_name || ' \\"x\\""@en-gb' AS tagged, p_name || ' "x"' AS text, 'en-gb' AS tag,
'"' || p_size || '"^^<http://www.w3.org/2001/XMLSchema#integer>' AS typed, length(p_name) + 4 AS strlen, 'a' || chr(10) || chr(233) AS unescaped FROM part""")
def fn_terms(g: Graph) -> DataFrame:
    """Terms made from values, and taken apart again."""
    text, name = F.concat("name", F.lit(' "x"')), F.col("id")
    tagged = S.str_lang(text, "en-GB")
    terms = g.entities["PART"].select(name, S.iri(F.concat(F.lit("part/"), F.col("partkey").cast("string")), "http://ex/").alias("iri"), tagged.alias("tagged"), S.str_dt(F.col("size").cast("string"), S.XSD + "integer").alias("typed"))
    return terms.select("id", "iri", "tagged", S.lexical("tagged").alias("text"), S.lang("tagged").alias("tag"), "typed", F.length(S.lexical("tagged")).alias("strlen"), S.lexical(F.lit('"a\\n\\u00e9"')).alias("unescaped"))


@on_graph("""SELECT 'CUSTOMER/' || c_custkey AS id, abs(c_acctbal) AS abs, floor(c_acctbal + 0.5)::DOUBLE AS round, ceil(c_acctbal)::DOUBLE AS ceil, floor(c_acctbal)::DOUBLE AS floor,
CASE WHEN c_nationkey <> 0 THEN c_acctbal / c_nationkey END AS quotient FROM customer""")
def fn_numeric(g: Graph) -> DataFrame:
    c = g.entities["CUSTOMER"]
    return c.select("id", F.abs("acctbal").alias("abs"), S.round_half_up("acctbal").alias("round"), S.ceil("acctbal").alias("ceil"), S.floor("acctbal").alias("floor"), S.divide("acctbal", "nationkey").alias("quotient"))


_ODD = "CASE c_custkey % 8 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN 'Infinity'::DOUBLE WHEN 2 THEN '-Infinity'::DOUBLE WHEN 3 THEN c_acctbal * 1e20 WHEN 4 THEN 0.49999999999999994::DOUBLE WHEN 5 THEN c_custkey + 0.5 WHEN 6 THEN -c_custkey - 0.5 ELSE c_acctbal END"


@on_graph(f"""SELECT id, CASE WHEN big THEN x ELSE floor(x) END AS floor, CASE WHEN big THEN x ELSE ceil(x) END AS ceil, CASE WHEN big THEN x WHEN x - floor(x) >= 0.5 THEN floor(x) + 1 ELSE floor(x) END AS round
FROM (SELECT 'CUSTOMER/' || c_custkey AS id, {_ODD} AS x, isnan({_ODD}) OR abs({_ODD}) >= 4503599627370496 AS big FROM customer)""")
def fn_numeric_odd(g: Graph) -> DataFrame:
    """NaN, infinities and numbers too large for an integer stay as they are; what is just below a half goes down."""
    k, own = F.col("custkey") % 8, F.col("acctbal")
    nan, inf = (F.lit(float(x)) for x in ("nan", "inf"))
    x = F.when(k == 0, nan).when(k == 1, inf).when(k == 2, -inf).when(k == 3, own * 1e20).when(k == 4, 0.49999999999999994).when(k == 5, F.col("custkey") + 0.5).when(k == 6, -F.col("custkey") - 0.5).otherwise(own)
    return g.entities["CUSTOMER"].withColumn("x", x).select("id", S.floor("x").alias("floor"), S.ceil("x").alias("ceil"), S.round_half_up("x").alias("round"))


@on_graph("""SELECT 'PART/' || p_partkey AS id, '<http://ex' || CASE p_partkey % 6 WHEN 0 THEN '/a/b/part-' || p_partkey WHEN 1 THEN '/part-' || p_partkey WHEN 2 THEN '/a/part-' || p_partkey || '/' WHEN 3 THEN '/a/b/c?part=' || p_partkey WHEN 4 THEN '.org/' || p_partkey ELSE '/a/b/c?q#' || p_partkey END || '>' AS iri FROM part""")
def fn_iri_relative(g: Graph) -> DataFrame:
    """References of all kinds against a base."""
    key, k = F.col("partkey").cast("string"), F.col("partkey") % 6
    cat = lambda a, b="": F.concat(F.lit(a), key, F.lit(b))
    text = F.when(k == 0, cat("./part-")).when(k == 1, cat("../../../part-")).when(k == 2, cat("../part-", "/x/..")).when(k == 3, cat("?part=")).when(k == 4, cat("//ex.org/")).otherwise(cat("#"))
    return g.entities["PART"].select("id", S.iri(text, "http://ex/a/b/c?q").alias("iri"))


@on_graph("SELECT 'PART/' || p_partkey AS id, p_partkey % 4 <> 3 AS \"numeric\" FROM part")
def fn_numeric_types(g: Graph) -> DataFrame:
    """Types derived from integer are numbers too, and a text that is none isn't, whatever its type."""
    kinds = F.element_at(F.array(*(F.lit(x) for x in ("nonNegativeInteger", "unsignedInt", "positiveInteger", "unsignedByte"))), (F.col("partkey") % 4 + 1).cast("int"))
    text = F.when(F.col("partkey") % 4 == 3, F.lit("none")).otherwise(F.col("partkey").cast("string"))
    term = F.concat(F.lit('"'), text, F.lit(f'"^^<{S.XSD}'), kinds, F.lit(">"))
    return g.entities["PART"].select("id", S.is_numeric(term).alias("numeric"))


@query("SELECT event_id, year(ts)::INT AS year, month(ts)::INT AS month, day(ts)::INT AS day, hour(ts)::INT AS hours, minute(ts)::INT AS minutes, (epoch_us(ts) % 60000000) / 1e6 AS seconds FROM events")
def fn_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", F.year("ts").alias("year"), F.month("ts").alias("month"), F.day("ts").alias("day"), F.hour("ts").alias("hours"), F.minute("ts").alias("minutes"), S.seconds("ts").alias("seconds"))


@on_graph("SELECT 'PART/' || p_partkey AS id, md5(p_name) AS md5, sha1(p_name) AS sha1, sha256(p_name) AS sha256 FROM part")
def fn_hash(g: Graph) -> DataFrame:
    return g.entities["PART"].select("id", F.md5(F.col("name").cast("binary")).alias("md5"), F.sha1(F.col("name").cast("binary")).alias("sha1"), F.sha2(F.col("name").cast("binary"), 256).alias("sha256"))


@on_graph("SELECT 'PART/' || p_partkey AS id, regexp_matches(p_type, '(?i)^s.*l$') AS matched, regexp_replace(p_name, '([aeiou])', '<\\1>', 'g') AS replaced FROM part")
def fn_regex(g: Graph) -> DataFrame:
    return g.entities["PART"].select("id", S.regex("type", "^s.*l$", "i").alias("matched"), S.replace("name", "([aeiou])", "<$1>").alias("replaced"))


@query("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, TRY_CAST(event_type AS BIGINT) AS none, TRY_CAST(event_id::VARCHAR AS DOUBLE) AS double FROM events""")
def fn_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", S.cast(F.get_json_object("props", "$.k"), "xsd:integer").alias("k"), S.cast("event_type", "xsd:integer").alias("none"), S.cast(F.col("event_id").cast("string"), "xsd:double").alias("double"))


# ------------------------------------------------------------------ temporal reads

_EVENTS = """WITH lines AS (
  SELECT md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'), l_quantity::INT)) AS edge_id,
         'ORDER/' || l_orderkey AS src, 'PART/' || l_partkey AS dst, 1 + l_orderkey // 100 AS commit_seq, l_shipdate AS valid_from, l_returnflag, l_quantity::INT AS quantity
  FROM lineitem),
ev AS (
  SELECT edge_id, src, dst, commit_seq, valid_from, 'assert' AS op, 0 AS event_ord, quantity FROM lines
  UNION ALL SELECT edge_id, src, dst, commit_seq + (SELECT max(commit_seq) FROM lines), valid_from + INTERVAL 30 DAYS, 'retract', 1, quantity FROM lines WHERE l_returnflag = 'R'),
cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY edge_id ORDER BY commit_seq DESC, event_ord DESC) AS k FROM ev) WHERE k = 1 AND op = 'assert') """


@query(_EVENTS + "SELECT edge_id, src, dst, commit_seq FROM cur")
def state_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.fold(edge_events(spark, sf_dir)).select("edge_id", "src", "dst", "commit_seq")


@query(_EVENTS.replace("FROM ev)", "FROM ev WHERE valid_from <= TIMESTAMP '1999-06-30')") + "SELECT edge_id, src, dst FROM cur")
def state_asof_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.fold(T.snapshot(edge_events(spark, sf_dir), valid_time="1999-06-30")).select("edge_id", "src", "dst")


@query(_EVENTS.replace("FROM ev)", "FROM ev WHERE commit_seq <= 170)") + "SELECT edge_id, src, dst FROM cur")
def state_asof_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.fold(T.snapshot(edge_events(spark, sf_dir), commit_seq=170)).select("edge_id", "src", "dst")


@query(_EVENTS + "SELECT edge_id, op, commit_seq, row_number() OVER (PARTITION BY edge_id ORDER BY commit_seq, event_ord)::INT AS place FROM ev")
def edge_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.history(edge_events(spark, sf_dir)).select("edge_id", "op", "commit_seq", "place")


@on_graph("""SELECT 'USER/' || user_id AS src, 'STATE/' || event_type AS dst, ts AS valid_from, event_id,
'STATE/' || lag(event_type) OVER w AS previous, date_diff('microsecond', ts, lead(ts) OVER w) AS dwell_micros FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def transitions_dwell(g: Graph) -> DataFrame:
    return T.transitions(g.scan("HAS_STATE"), tie="event_id", bucket_unit="week").select("src", "dst", "valid_from", "event_id", "previous", "dwell_micros")


@on_graph("SELECT 'USER/' || user_id AS src, 'STATE/' || arg_max(event_type, ts) AS dst, max(ts) AS valid_from FROM events GROUP BY 1")
def state_latest(g: Graph) -> DataFrame:
    return T.latest(g.scan("HAS_STATE"))


@on_graph("SELECT 'USER/' || user_id AS src, 'STATE/' || arg_max(event_type, ts) AS dst, max(ts) AS valid_from FROM events WHERE ts <= TIMESTAMP '2024-01-15' GROUP BY 1")
def state_latest_asof(g: Graph) -> DataFrame:
    return T.latest(g.scan("HAS_STATE"), as_of="2024-01-15")


@query("""SELECT p.event_id, p.user_id, c.value AS last_click FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON p.user_id = c.user_id AND p.ts >= c.ts""")
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the value of its user's last click."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    clicks = e.where("event_type = 'click'").withColumnRenamed("value", "last_click")
    return T.as_of_join(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), clicks, "user_id", "ts", "ts", "last_click", bucket_unit="week").select("event_id", "user_id", "last_click")


@query(_EVENTS.replace("FROM ev)", "FROM ev WHERE valid_from <= TIMESTAMP '1999-06-30')") + "SELECT edge_id, src, dst FROM cur WHERE valid_from + to_days(quantity) > TIMESTAMP '1999-06-30'")
def state_valid_to(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An edge is valid for as many days as its quantity; the state at a time leaves out what has ended."""
    log = edge_events(spark, sf_dir).withColumn("valid_to", F.expr("valid_from + make_dt_interval(quantity)"))
    return T.state(log, valid_time="1999-06-30").select("edge_id", "src", "dst")


@query(_EVENTS + """SELECT edge_id, count(*) AS lineage_total, string_agg(commit_seq || ':' || op, ' ' ORDER BY commit_seq, event_ord) AS lineage, 1::BIGINT AS evidence_total, min(o_orderstatus || ' ' || o_orderpriority) AS evidence
FROM ev JOIN orders ON src = 'ORDER/' || o_orderkey GROUP BY 1""")
def why_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each edge's lineage, and the order that is the evidence for it."""
    log, orders = edge_events(spark, sf_dir), graph(spark, sf_dir).entities["ORDER"]
    evidence = log.where("op = 'assert'").select("edge_id", F.col("src").alias("episode")).join(orders.select(F.col("id").alias("episode"), F.concat_ws(" ", "orderstatus", "orderpriority").alias("text")), "episode")
    found = E.why(log, evidence)
    told = F.array_join(F.transform("lineage", lambda e: F.concat(e["commit_seq"].cast("string"), F.lit(":"), e["op"])), " ")
    return found.select("edge_id", "lineage_total", told.alias("lineage"), "evidence_total", F.col("evidence")[0]["text"].alias("evidence"))


@query("""SELECT a.event_id AS event_id, b.event_id AS r_event_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'purchase' AND b.event_type = 'view'
AND a.ts < b.ts + to_hours(b.event_id % 200) AND b.ts < a.ts + to_hours(12) AND b.event_id % 200 > 0""")
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases that count for half a day with views of the same user that last up to eight days."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", F.col("ts").alias("valid_from"))
    purchases = e.where("event_type = 'purchase'").withColumn("valid_to", F.expr("valid_from + INTERVAL 12 HOURS"))
    views = e.where("event_type = 'view'").withColumn("valid_to", F.expr("valid_from + make_dt_interval(0, event_id % 200)"))
    return IV.interval_join(purchases, views, ["user_id"]).select("event_id", "r_event_id")


@query("SELECT 'ORDER/' || o_orderkey AS o, band FROM orders JOIN (SELECT 'PART/' || p_partkey AS band, p_retailprice * 100 AS low, p_retailprice * 100 + 500 AS high FROM part) ON o_totalprice BETWEEN low AND high")
def range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the parts in whose band of prices they are."""
    g = graph(spark, sf_dir)
    bands = g.entities["PART"].select(F.col("id").alias("band"), (F.col("retailprice") * 100).alias("low"), (F.col("retailprice") * 100 + 500).alias("high"))
    orders = g.entities["ORDER"].select(F.col("id").alias("o"), "totalprice")
    return IV.range_join(orders, bands, "totalprice", "low", "high").select("o", "band")


# ------------------------------------------------------------------ valid time and intervals

_SPOKEN = """WITH ev AS (
  SELECT 'USER/' || user_id AS edge_id, event_id * 7919 % 100003 AS commit_seq, event_id AS event_ord, CASE WHEN event_type = 'error' THEN 'retract' ELSE 'assert' END AS op, ts AS f,
         CASE WHEN event_id % 4 > 0 THEN ts + to_hours((event_id % 300)::INT) ELSE TIMESTAMP '9999-12-31 23:59:59.999999' END AS t FROM events),
ok AS (SELECT * FROM ev WHERE f < t) """


def _spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What events say of their users, for some hours or for good; commits come in another order than the times that they speak of."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select(
        F.concat(F.lit("USER/"), F.col("user_id").cast("string")).alias("edge_id"), (F.col("event_id") * 7919 % 100003).alias("commit_seq"), F.col("event_id").alias("event_ord"),
        F.when(F.col("event_type") == "error", "retract").otherwise("assert").alias("op"), F.col("ts").alias("valid_from"),
        F.when(F.col("event_id") % 4 > 0, F.expr("ts + make_dt_interval(0, event_id % 300)")).alias("valid_to"),
    )


@query(_SPOKEN + """, points AS (SELECT edge_id, f AS p FROM ok UNION SELECT edge_id, t FROM ok),
seg AS (SELECT edge_id, p, lead(p) OVER (PARTITION BY edge_id ORDER BY p) AS q FROM points),
top AS (SELECT s.edge_id, s.p, s.q, arg_max(e.event_ord, {'c': e.commit_seq, 'o': e.event_ord}) AS event_ord, arg_max(e.op, {'c': e.commit_seq, 'o': e.event_ord}) AS op
        FROM seg s JOIN ok e ON e.edge_id = s.edge_id AND e.f <= s.p AND e.t > s.p WHERE s.q IS NOT NULL GROUP BY ALL),
new AS (SELECT *, coalesce(lag(event_ord) OVER w <> event_ord OR lag(q) OVER w <> p, true)::INT AS new FROM top WINDOW w AS (PARTITION BY edge_id ORDER BY p)),
runs AS (SELECT *, sum(new) OVER (PARTITION BY edge_id ORDER BY p) AS run FROM new)
SELECT edge_id, event_ord, min(p) AS holds_from, CASE WHEN max(q) < TIMESTAMP '9999-12-31' THEN max(q) END AS holds_to FROM runs WHERE op = 'assert' GROUP BY edge_id, run, event_ord""")
def timeline_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's valid time in disjoint pieces; users with more than 32 events are dealt by time."""
    return TL.timeline(_spoken(spark, sf_dir), most=32).select("edge_id", "event_ord", "holds_from", "holds_to")


@query(_SPOKEN + """, asks AS (SELECT event_id, 'USER/' || user_id AS edge_id, ts + INTERVAL 36 HOURS AS "at" FROM events WHERE event_type = 'purchase')
SELECT event_id, "at", arg_max(e.event_ord, {'c': e.commit_seq, 'o': e.event_ord}) AS decided, arg_max(e.op, {'c': e.commit_seq, 'o': e.event_ord}) AS op, count(*) AS spoken
FROM asks a JOIN ok e ON e.edge_id = a.edge_id AND e.f <= a."at" AND e.t > a."at" GROUP BY 1, 2""")
def timeline_asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What decides about each buyer a day and a half after the purchase, of how many events that speak of that time."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_type = 'purchase'")
    asks = e.select("event_id", F.concat(F.lit("USER/"), F.col("user_id").cast("string")).alias("edge_id"), F.expr("ts + INTERVAL 36 HOURS").alias("at"))
    return TL.asked(_spoken(spark, sf_dir), asks, "at").select("event_id", "at", F.col("decided.event_ord").alias("decided"), F.col("decided.op").alias("op"), "spoken")


_CORRECTED = _EVENTS.split("ev AS (")[0] + """said AS (
  SELECT edge_id, commit_seq, 'assert' AS op, valid_from AS f, valid_from + to_days(quantity) AS t, quantity FROM lines
  UNION ALL SELECT edge_id, commit_seq + 1000000, 'assert', valid_from - INTERVAL 400 DAYS, valid_from - INTERVAL 200 DAYS, quantity + 100 FROM lines WHERE quantity % 2 = 0
  UNION ALL SELECT edge_id, commit_seq + 2000000, 'assert', valid_from + INTERVAL 5 DAYS, NULL, quantity + 200 FROM lines WHERE quantity % 3 = 0
  UNION ALL SELECT edge_id, commit_seq + 3000000, 'retract', valid_from + INTERVAL 9 DAYS, valid_from + INTERVAL 20 DAYS, quantity FROM lines WHERE l_returnflag = 'R') """


def _corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that hold for as many days as their quantity, then commits that speak of earlier times, of all later ones, or take back some days."""
    log = edge_events(spark, sf_dir)
    lines = log.where("op = 'assert'").withColumn("valid_to", F.expr("valid_from + make_dt_interval(quantity)"))
    returned = log.where("op = 'retract'").select("edge_id").distinct()

    def later(rows: DataFrame, commits: int, start: int, end: int | None, more: int, op: str = "assert") -> DataFrame:
        to = F.expr(f"valid_from + make_dt_interval({end})") if end is not None else F.lit(None).cast("timestamp_ntz")
        marks = {"commit_seq": F.col("commit_seq") + commits, "valid_to": to, "valid_from": F.expr(f"valid_from + make_dt_interval({start})"), "quantity": F.col("quantity") + more, "op": F.lit(op)}
        return rows.withColumns(marks)

    back, on = later(lines.where("quantity % 2 = 0"), 1_000_000, -400, -200, 100), later(lines.where("quantity % 3 = 0"), 2_000_000, 5, None, 200)
    return lines.unionByName(back).unionByName(on).unionByName(later(lines.join(returned, "edge_id", "left_semi"), 3_000_000, 9, 20, 0, "retract"))


@query(_CORRECTED + """SELECT edge_id, quantity FROM (SELECT *, row_number() OVER (PARTITION BY edge_id ORDER BY commit_seq DESC) AS k FROM said
WHERE f <= TIMESTAMP '1999-06-30' AND (t IS NULL OR t > TIMESTAMP '1999-06-30')) WHERE k = 1 AND op = 'assert'""")
def state_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state at a time that earlier and later commits speak of, when not all of them speak of it."""
    return T.state(_corrected(spark, sf_dir), valid_time="1999-06-30").select("edge_id", "quantity")


@query(_CORRECTED + """SELECT edge_id, quantity FROM (SELECT *, row_number() OVER (PARTITION BY edge_id ORDER BY commit_seq DESC) AS k FROM said
WHERE commit_seq < 2000000 AND f <= TIMESTAMP '1998-12-01' AND (t IS NULL OR t > TIMESTAMP '1998-12-01')) WHERE k = 1 AND op = 'assert'""")
def state_corrected_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was known of a time before the later corrections came, read off the pieces."""
    at = F.lit("1998-12-01").cast("timestamp_ntz")
    said = _corrected(spark, sf_dir).select("edge_id", "commit_seq", "event_ord", "op", "valid_from", "valid_to", "quantity")
    pieces = TL.timeline(said, commit_seq=1_999_999)
    return pieces.where((F.col("holds_from") <= at) & (F.col("holds_to").isNull() | (F.col("holds_to") > at))).select("edge_id", "quantity")


@query("""WITH p AS (SELECT event_id, user_id, ts AS f, CASE WHEN event_id % 2 = 0 THEN ts + INTERVAL 12 HOURS END AS t FROM events WHERE event_type = 'purchase'),
v AS (SELECT event_id, user_id, ts AS f, CASE WHEN event_id % 2 = 0 THEN ts + to_hours((event_id % 90)::INT) END AS t FROM events WHERE event_type = 'view' UNION ALL SELECT -1, min(user_id), TIMESTAMP '1990-01-01', NULL FROM events)
SELECT p.event_id AS event_id, v.event_id AS r_event_id FROM p JOIN v ON p.user_id = v.user_id AND (v.t IS NULL OR p.f < v.t) AND (p.t IS NULL OR v.f < p.t) AND (v.t IS NULL OR v.f < v.t)""")
def interval_join_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the purchases and views have no end, and one view spans everything."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", F.col("ts").alias("valid_from"))
    even = F.col("event_id") % 2 == 0
    purchases = e.where("event_type = 'purchase'").withColumn("valid_to", F.when(even, F.expr("valid_from + INTERVAL 12 HOURS")))
    views = e.where("event_type = 'view'").withColumn("valid_to", F.when(even, F.expr("valid_from + make_dt_interval(0, event_id % 90)")))
    whole = e.agg(F.lit(-1).cast("long").alias("event_id"), F.min("user_id").alias("user_id"), F.lit("view").alias("event_type"), F.lit("1990-01-01").cast("timestamp_ntz").alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    return IV.interval_join(purchases, views.unionByName(whole), ["user_id"]).select("event_id", "r_event_id")


@query("""SELECT 'ORDER/' || o_orderkey AS o, band FROM orders JOIN (SELECT 'PART/' || p_partkey AS band, p_retailprice * 100 AS low, CASE WHEN p_partkey = 1 THEN 1e12 ELSE p_retailprice * 100 + p_partkey % 7 END AS high FROM part) ON o_totalprice BETWEEN low AND high""")
def range_join_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in bands of prices of which most are narrow and one has almost no end."""
    g = graph(spark, sf_dir)
    low = F.col("retailprice") * 100
    bands = g.entities["PART"].select(F.col("id").alias("band"), low.alias("low"), F.when(F.col("partkey") == 1, F.lit(1e12)).otherwise(low + F.col("partkey") % 7).alias("high"))
    orders = g.entities["ORDER"].select(F.col("id").alias("o"), "totalprice")
    return IV.range_join(orders, bands, "totalprice", "low", "high").select("o", "band")


# ------------------------------------------------------------------ writes


@query(_EVENTS + "SELECT edge_id, src, dst FROM cur WHERE quantity < 45")
def retract_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges with large quantities are retracted in a later commit; the state after it."""
    log = edge_events(spark, sf_dir)
    state = T.fold(log)
    log = log.unionByName(WR.retract(state, state.where("quantity >= 45"), 1 << 40).select(*log.columns))
    return T.fold(log).select("edge_id", "src", "dst")


@query(_EVENTS + "SELECT edge_id, src, dst FROM cur WHERE dst NOT IN (SELECT 'PART/' || p_partkey FROM part WHERE p_size > 25)")
def retract_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large parts are retracted with every edge that touches them."""
    log, parts = edge_events(spark, sf_dir), graph(spark, sf_dir).entities["PART"].where("size > 25")
    log = log.unionByName(WR.retract_entities(T.fold(log), parts.select("id"), 1 << 40).select(*log.columns))
    return T.fold(log).select("edge_id", "src", "dst")


_CURRENT = "(SELECT 'CUSTOMER/' || c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS name, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS segment, c_acctbal AS acctbal FROM customer)"
_RELOADED = """(SELECT 'CUSTOMER/' || c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 7 = 1 THEN c_mktsegment END AS name, CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 7 <> 1 THEN c_mktsegment END AS segment,
CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal + 1 ELSE c_acctbal END AS acctbal FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT 'SUPPLIER/' || s_suppkey, s_name, NULL, s_acctbal FROM supplier)"""


def _reloaded(g: Graph) -> tuple[DataFrame, DataFrame]:
    """Two columns of which one is null, a payload that moves the value from one to the other, and changes, additions and removals."""
    customers, by3, by7 = g.entities["CUSTOMER"], F.col("custkey") % 3, F.col("custkey") % 7
    current = customers.select("id", F.when(by3 == 0, F.col("name")).alias("name"), F.when(by3 != 0, F.col("mktsegment")).alias("segment"), "acctbal")
    changed = customers.where("acctbal >= 0").select(
        "id", F.when(by3 == 0, F.col("name")).when(by7 == 1, F.col("mktsegment")).alias("name"), F.when((by3 != 0) & (by7 != 1), F.col("mktsegment")).alias("segment"),
        F.when(F.col("mktsegment") == "MACHINERY", F.col("acctbal") + 1).otherwise(F.col("acctbal")).alias("acctbal"),
    )
    return current, changed.unionByName(g.entities["SUPPLIER"].select("id", "name", F.lit(None).cast("string").alias("segment"), "acctbal"))


@on_graph(f"""SELECT CASE WHEN c.id IS NULL THEN 'added' WHEN p.id IS NULL THEN 'removed'
WHEN c.name IS NOT DISTINCT FROM p.name AND c.segment IS NOT DISTINCT FROM p.segment AND c.acctbal IS NOT DISTINCT FROM p.acctbal THEN 'unchanged' ELSE 'changed' END AS change, count(*) AS n
FROM {_CURRENT} c FULL JOIN {_RELOADED} p USING (id) GROUP BY 1""")
def reload_diff(g: Graph) -> DataFrame:
    current, payload = _reloaded(g)
    return WR.diff(current, payload, "id", ["name", "segment", "acctbal"]).groupBy("change").agg(F.count("*").alias("n"))


_PAYLOAD = "SELECT edge_id, src, dst, CASE WHEN quantity > 40 THEN quantity + 1 ELSE quantity END AS quantity FROM lines WHERE quantity >= 10"


@query(_EVENTS + f"SELECT * FROM ({_PAYLOAD})")
def reload_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after a reload is the payload: small lines go, large ones change, returned ones come back."""
    log = edge_events(spark, sf_dir)
    events = WR.reload(log, _payload(log), ["src", "dst", "quantity"], graph_id="star", confirm="star").events
    return T.fold(log.unionByName(events).select("edge_id", "commit_seq", "event_ord", "op", "src", "dst", "quantity")).select("edge_id", "src", "dst", "quantity")


@query(_EVENTS + f"""SELECT change, count(*) AS n FROM (SELECT CASE WHEN c.edge_id IS NULL THEN 'added' WHEN p.edge_id IS NULL THEN 'removed' WHEN c.quantity = p.quantity THEN 'unchanged' ELSE 'changed' END AS change
FROM cur c FULL JOIN ({_PAYLOAD}) p USING (edge_id)) GROUP BY 1""")
def reload_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a dry run, which only counts."""
    log = edge_events(spark, sf_dir)
    found = WR.reload(log, _payload(log), ["src", "dst", "quantity"], graph_id="star", dry_run=True)
    return spark.createDataFrame(sorted(found.counts.items()), "change string, n long")


def _payload(log: DataFrame) -> DataFrame:
    lines = log.where("op = 'assert' AND quantity >= 10").drop("commit_seq", "event_ord", "op")
    return lines.withColumn("quantity", F.when(F.col("quantity") > 40, F.col("quantity") + 1).otherwise(F.col("quantity")))


def _branch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The log up to commit 100 is the trunk; what follows happens on a branch."""
    log = edge_events(spark, sf_dir)
    return log.where("commit_seq <= 100"), log.where("commit_seq > 100")


@query(_EVENTS + "SELECT edge_id, src, dst FROM cur")
def branch_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    trunk, own = _branch(spark, sf_dir)
    return T.fold(WR.branch(trunk, own, 100)).select("edge_id", "src", "dst")


@query(_EVENTS + "SELECT edge_id, src, dst, CASE WHEN commit_seq <= 100 THEN commit_seq ELSE 101 END AS commit_seq FROM cur")
def branch_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the branch did since the fork becomes one commit on the trunk."""
    trunk, own = _branch(spark, sf_dir)
    return T.fold(WR.merge(trunk, own, 100, 101)).select("edge_id", "src", "dst", "commit_seq")


_NATIONS = """SELECT 'CUSTOMER/' || c_custkey AS src, 'IN_NATION' AS relation, 'NATION/' || c_nationkey AS dst FROM customer UNION ALL SELECT 'SUPPLIER/' || s_suppkey, 'IN_NATION', 'NATION/' || s_nationkey FROM supplier
UNION ALL SELECT 'NATION/' || n_nationkey, 'IN_NATION', 'NATION/' || n_nationkey FROM nation UNION ALL SELECT 'NATION/' || n_nationkey, 'DOUBLES', 'NATION/' || (2 * n_nationkey % 25) FROM nation"""


@query(f"SELECT count(*) AS op_count, count(DISTINCT (src, relation, dst)) AS edges, 2 * (SELECT count(*) FROM nation) AS violations FROM ({_NATIONS})")
def dry_run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relation with two domains counts once; a third domain and an unknown relation are violations."""
    g = graph(spark, sf_dir)
    wrong = g.scan("IN_REGION").select("src", F.lit("IN_NATION").alias("relation"), F.col("src").alias("dst"))
    events = g.all_edges(["IN_NATION", "DOUBLES"]).unionByName(wrong).withColumn("edge_id", F.concat_ws("|", "src", "relation", "dst"))
    return WR.dry_run(events, O.as_table(spark, O.STAR))


@query(_EVENTS + "SELECT edge_id, src, dst FROM cur")
def compact_equiv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folding a compacted log gives the state again."""
    packed = materialise(WR.compact(edge_events(spark, sf_dir)), "compacted", compression="zstd")
    return T.fold(packed.select("edge_id", "commit_seq", "event_ord", "op", "src", "dst")).select("edge_id", "src", "dst")


@query(_EVENTS.replace("FROM ev)", "FROM ev WHERE commit_seq <= 170)") + "SELECT edge_id, src, dst, (SELECT count(*) FROM ev e WHERE e.edge_id = cur.edge_id) AS history FROM cur")
def compact_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read before the compaction, and the whole history of each of its edges, from a compacted log."""
    log = materialise(WR.compact(edge_events(spark, sf_dir)), "compacted")
    return T.state(log, commit_seq=170).join(log.groupBy("edge_id").agg(F.count("*").alias("history")), "edge_id").select("edge_id", "src", "dst", "history")


@query(_EVENTS + "SELECT count(*) AS events, count(DISTINCT edge_id) AS edges FROM ev WHERE commit_seq <= 150")
def idempotent_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log knows the commits up to 100; those from 50 to 150 come twice, and only what is new is added."""
    log, key = edge_events(spark, sf_dir), ["edge_id", "commit_seq", "op"]
    known, sent = log.where("commit_seq <= 100"), log.where("commit_seq BETWEEN 50 AND 150")
    again = known.unionByName(WR.new_events(sent.unionByName(sent), known, key))
    return again.agg(F.count("*").alias("events"), F.countDistinct("edge_id").alias("edges"))


@query(_EVENTS + "SELECT count(*) FILTER (c.edge_id IS NULL OR c.quantity <> l.quantity + (l.quantity > 25)::INT) AS appended, count(*) FILTER (c.edge_id IS NOT NULL AND l.quantity <= 25) AS skipped FROM lines l LEFT JOIN cur c USING (edge_id)")
def skip_unchanged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines are asserted again, the larger ones with another quantity; what the state has already is left out."""
    log = edge_events(spark, sf_dir)
    sent = log.where("op = 'assert'").withColumn("quantity", F.col("quantity") + (F.col("quantity") > 25).cast("int"))
    kept = WR.skip_current(sent, log)
    return kept.agg(F.count("*").alias("appended")).crossJoin(sent.agg(F.count("*").alias("_n"))).select("appended", (F.col("_n") - F.col("appended")).alias("skipped"))


@query(_EVENTS + "SELECT max(commit_seq) AS commit_seq, count(*) AS op_count, 0::BIGINT AS skipped_edges, false AS no_op, false AS idempotent_replay FROM ev UNION ALL SELECT max(commit_seq), 0, 0, true, true FROM ev")
def commit_ack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a commit says, and what the same commit says when it comes again."""
    path, log = new_folder(spark, "log"), edge_events(spark, sf_dir)
    first = WR.commit(log, log.limit(0), path)
    again = WR.commit(log, spark.read.parquet(path).select(*log.columns), path)
    return spark.createDataFrame([(a.commit_seq, a.op_count, a.skipped_edges, a.no_op, a.idempotent_replay) for a in (first, again)], "commit_seq long, op_count long, skipped_edges long, no_op boolean, idempotent_replay boolean")


@query(_EVENTS + """SELECT edge_id, quantity, 3 * (SELECT count(*) FROM lines) - (SELECT count(*) FROM lines WHERE quantity % 2 = 0) AS op_count, true AS replayed FROM lines WHERE quantity % 2 = 1""")
def commit_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A commit asserts every line, takes it back and, if its quantity is odd, asserts it again; sent twice, it is there once."""
    path = new_folder(spark, "log")
    lines = edge_events(spark, sf_dir).where("op = 'assert'").withColumn("commit_seq", F.lit(1).cast("long"))
    # an edge's events come one after the other, so that what is said of an edge combines before a shuffle
    told = [F.struct(F.lit(n).alias("event_ord"), F.lit(op).alias("op")) for n, op in enumerate(("assert", "retract", "assert"))]
    odd = F.col("quantity") % 2 == 1
    sent = lambda *orders: lines.drop("event_ord", "op").withColumn("_e", F.explode(F.when(odd, F.array(*(told[n] for n in orders))).otherwise(F.array(*(told[n] for n in orders if n < 2))))).select("*", "_e.*").select(*lines.columns)
    events, reversed_ = sent(0, 1, 2), sent(2, 1, 0)
    done = WR.commit(events, events.limit(0), path)
    log = spark.read.parquet(path).select(*events.columns)
    again = WR.commit(reversed_, log, path)
    last = T.fold(log.select("edge_id", "commit_seq", "event_ord", "op", "quantity"))
    return last.select("edge_id", "quantity", F.lit(done.op_count).cast("long").alias("op_count"), F.lit(again.idempotent_replay and again.no_op).alias("replayed"))


@query(_EVENTS + """SELECT edge_id, CASE quantity % 6 WHEN 1 THEN 'quantity' WHEN 2 THEN 'valid_from' WHEN 3 THEN 'dst' WHEN 4 THEN 'retracted' ELSE 'repeated' END AS change, CASE quantity % 6 WHEN 4 THEN 2 WHEN 5 THEN 2 ELSE 1 END::BIGINT AS events
FROM cur WHERE quantity % 6 > 0""")
def skip_unchanged_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state is sent again with a change in one column or another, retracted and asserted again, or with two contents; only what is wholly unchanged is left out."""
    log = edge_events(spark, sf_dir)
    now = T.fold(log).withColumns({"commit_seq": F.lit(1 << 40).cast("long"), "event_ord": F.lit(0), "op": F.lit("assert")}).select(*log.columns)
    kind = F.col("quantity") % 6
    # the state is folded once for all that is sent; a retraction comes before the assertion, a second content after it
    orders = F.when(kind == 4, F.array(F.lit(0), F.lit(-1))).when(kind == 5, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = now.drop("event_ord").withColumns({"_k": kind, "event_ord": F.explode(orders)})
    first = F.col("event_ord") == 0
    sent = rows.withColumns({
        "valid_from": F.when(first & (F.col("_k") == 2), F.expr("valid_from + INTERVAL 1 DAY")).otherwise(F.col("valid_from")),
        "dst": F.when(first & (F.col("_k") == 3), F.lit("PART/none")).otherwise(F.col("dst")),
        "quantity": F.when(first & F.col("_k").isin(1, 5), F.col("quantity") + 1).otherwise(F.col("quantity")),
        "op": F.when(F.col("event_ord") == -1, "retract").otherwise(F.col("op")),
    }).select(*log.columns)
    kept = WR.skip_current(sent, log).groupBy("edge_id").agg(F.count("*").alias("events"))
    names = F.get(F.array(*(F.lit(x) for x in ("same", "quantity", "valid_from", "dst", "retracted", "repeated"))), kind)
    return kept.join(now.select("edge_id", names.alias("change")), "edge_id").select("edge_id", "change", "events")


@query(_EVENTS + """, seqs AS (SELECT DISTINCT commit_seq FROM ev)
SELECT 'key-' || commit_seq AS commit_key, CASE WHEN commit_seq % 4 = 0 THEN 'new' WHEN commit_seq % 4 = 1 THEN 'replay' ELSE 'conflict' END AS verdict, (SELECT count(*) FROM ev e WHERE e.commit_seq = s.commit_seq) + (commit_seq % 4 = 3)::BIGINT AS op_count FROM seqs s""")
def commit_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three of four commits are in the ledger; all are sent again in other partitions, some with another quantity or with one event twice."""
    log = edge_events(spark, sf_dir)
    keyed = log.withColumn("commit_key", F.concat(F.lit("key-"), F.col("commit_seq").cast("string")))
    known = materialise(WR.digests(keyed.where("commit_seq % 4 > 0"), "commit_key"), "ledger")
    first = keyed.where("commit_seq % 4 = 3").groupBy("commit_seq").agg(F.min(F.struct(*(c for c in keyed.columns if c != "commit_seq"))).alias("_e")).select("commit_seq", "_e.*")
    changed = keyed.withColumn("quantity", F.when(F.col("commit_seq") % 4 == 2, F.col("quantity") + 1).otherwise(F.col("quantity")))
    # the ledger's rows came in other partitions and in another order
    sent = first.unionByName(changed)
    return WR.judge(WR.digests(sent, "commit_key"), known).select("commit_key", "verdict", "op_count")


@query(_EVENTS.replace("FROM ev)", "FROM ev WHERE commit_seq <= 100)") + "SELECT edge_id, quantity, (SELECT count(*) FROM ev e WHERE e.edge_id = cur.edge_id) AS history, true AS few FROM cur")
def compact_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits in a dozen batches, compacted by tiers on the way; the state at the half, with whole histories, from the few folders that are left."""
    path, log = new_folder(spark, "log"), edge_events(spark, sf_dir)
    # event_ord and the real commit are told apart from the batch's number
    named = log.withColumnsRenamed({"commit_seq": "asserted_at"})
    schema = named.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ").replace(",", ", ") + ", commit_seq bigint"
    ends = [40, 80, 100, 105, 110, 115, 120, 125, 130, 135, 1 << 40]
    # the log is read once and dealt to its batches
    batch = reduce(lambda so_far, high: F.when(F.col("asserted_at") <= high, high).otherwise(so_far), ends[-2::-1], F.lit(ends[-1]))
    dealt = new_folder(spark, "batches")
    named.withColumn("batch", batch.cast("long")).write.option("compression", "zstd").partitionBy("batch").parquet(dealt)
    batches = spark.read.schema(f"{named.schema.simpleString()[7:-1]}, batch: bigint".replace(":", " ")).parquet(dealt)
    for high in ends:
        WR.commit_once(batches.where(F.col("batch") == high).select(*named.columns), path, f"up to {high}")
        SEG.compact_tail(spark, path, schema, max_segments=6)
        SEG.sweep(spark, path)
    few = len(SEG.needed(spark, path)) <= 6 and len(SEG.needed(spark, path, commit_seq=3)) <= 3
    events = SEG.events(spark, path, schema)
    whole = events.groupBy("edge_id").agg(F.count("*").alias("history"))
    state = T.fold(SEG.events(spark, path, schema, commit_seq=3).drop("commit_seq").withColumnsRenamed({"asserted_at": "commit_seq"}))
    return state.join(whole, "edge_id").select("edge_id", "quantity", "history", F.lit(few).alias("few"))


_PARTED = _EVENTS + """, own AS (SELECT edge_id, op, quantity + (quantity % 5 = 4)::INT AS quantity FROM cur_all WHERE commit_seq > 100 AND quantity % 3 > 0),
par AS (SELECT edge_id, op, quantity FROM cur_all WHERE commit_seq > 100 AND quantity % 3 <> 1),
base AS (SELECT edge_id, op, quantity FROM (SELECT *, row_number() OVER (PARTITION BY edge_id ORDER BY commit_seq DESC, event_ord DESC) AS k FROM ev WHERE commit_seq <= 100) WHERE k = 1 AND op = 'assert'),
every AS (SELECT edge_id FROM own UNION SELECT edge_id FROM par UNION SELECT edge_id FROM base),
sides AS (SELECT e.edge_id, b.quantity AS base, CASE WHEN p.edge_id IS NULL THEN b.quantity WHEN p.op = 'assert' THEN p.quantity END AS parent, CASE WHEN o.edge_id IS NULL THEN b.quantity WHEN o.op = 'assert' THEN o.quantity END AS branch
FROM every e LEFT JOIN base b USING (edge_id) LEFT JOIN par p USING (edge_id) LEFT JOIN own o USING (edge_id)),
judged AS (SELECT *, CASE WHEN branch IS NOT DISTINCT FROM base THEN CASE WHEN parent IS DISTINCT FROM base THEN 'parent only' ELSE 'unchanged' END WHEN parent IS NOT DISTINCT FROM base THEN 'clean' WHEN parent IS NOT DISTINCT FROM branch THEN 'equal' ELSE 'conflict' END AS change FROM sides) """
_PARTED = _PARTED.replace(", own AS (", ", cur_all AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY edge_id ORDER BY commit_seq DESC, event_ord DESC) AS k FROM ev) WHERE k = 1),\nown AS (", 1)


def _parted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """After commit 100 a third of the edges changes on the parent, a third on a branch, and a third on both, some of these differently."""
    log = edge_events(spark, sf_dir)
    trunk = log.where("commit_seq <= 100 OR quantity % 3 <> 1")
    own = log.where("commit_seq > 100 AND quantity % 3 > 0").withColumn("quantity", F.col("quantity") + (F.col("quantity") % 5 == 4).cast("int"))
    return trunk, own


@query(_PARTED + "SELECT edge_id, CASE WHEN change = 'clean' THEN branch ELSE parent END AS quantity FROM judged WHERE CASE WHEN change = 'clean' THEN branch ELSE parent END IS NOT NULL")
def merge_three_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parent's state after it has taken in what only the branch changed."""
    trunk, own = _parted(spark, sf_dir)
    after = trunk.unionByName(WR.merge_three_way(trunk, own, 100).events)
    return T.fold(after.select("edge_id", "commit_seq", "event_ord", "op", "quantity")).select("edge_id", "quantity")


@query(_PARTED + "SELECT change, count(*) AS n FROM judged WHERE change <> 'unchanged' GROUP BY 1")
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many edges a merge finds changed on one side, on both alike, or on both differently."""
    trunk, own = _parted(spark, sf_dir)
    found = WR.merge_three_way(trunk, own, 100).counts
    return spark.createDataFrame(sorted((k, n) for k, n in found.items() if n), "change string, n long")


@query(_PARTED + "SELECT edge_id, base, parent, branch FROM judged WHERE change = 'conflict'")
def merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edges that a merge leaves alone, with what all three sides say."""
    trunk, own = _parted(spark, sf_dir)
    of = lambda side: F.col(f"{side}.quantity").alias(side)
    return WR.merge_three_way(trunk, own, 100).conflicts.select("edge_id", of("base"), of("parent"), of("branch"))


@query("""WITH t AS (SELECT conv_id, min(turn) AS turn, arg_min(text, turn) AS text FROM conversations GROUP BY 1)
SELECT 'EPISODE/' || conv_id AS src, 'TURN/' || length(text) AS dst, count(*) OVER () AS facts FROM t WHERE conv_id % 3 > 0""")
def observe_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact for each conversation, a third of them with evidence that is not in the text; the rest is clean and merged."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    first = turns.groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))
    src, dst = F.concat(F.lit("EPISODE/"), F.col("conv_id").cast("string")), F.concat(F.lit("TURN/"), F.length("text").cast("string"))
    facts = first.select("conv_id", F.when(F.col("conv_id") % 3 > 0, F.substring("text", 1, 20)).otherwise("nobody said so").alias("evidence"), src.alias("edge_id"), src.alias("src"), F.lit("BEGINS").alias("relation"), dst.alias("dst"))
    log = spark.createDataFrame([], "edge_id string, src string, relation string, dst string, commit_seq long, event_ord int, op string")
    rules = O.as_table(spark, O.Ontology(relations={"BEGINS": O.Relation(frozenset({"EPISODE"}), frozenset({"TURN"}))}))
    done = SIG.observe(log, facts, turns, rules)
    state = T.fold(done.log if done.merged else log)
    return state.select("src", "dst").crossJoin(F.broadcast(done.branch.agg(F.count("*").alias("facts"))))


@query(_EVENTS.replace("FROM ev)", "FROM ev WHERE commit_seq <= 120)") + "SELECT 'eventual' AS consistency, count(*) AS edges FROM cur UNION ALL SELECT 'strong', count(*) FROM (SELECT edge_id, arg_max(op, commit_seq) AS op FROM ev GROUP BY 1) WHERE op = 'assert'")
def read_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream has folded the commits up to 120: an eventual read sees these, a strong one all commits of the log."""
    source, target, checkpoint = (new_folder(spark, n) for n in ("log", "state", "stream"))
    log = edge_events(spark, sf_dir)
    log.where("commit_seq <= 120").write.parquet(source)
    imports.start_fold(spark.readStream.schema(log.schema).parquet(source), target, checkpoint).awaitTermination()
    reads = [imports.read_state(log, target, consistency=c, min_indexed_seq=imports.published(spark, target)).agg(F.lit(c).alias("consistency"), F.count("*").alias("edges")) for c in ("eventual", "strong")]
    return reads[0].unionByName(reads[1])


@query(_EVENTS + "SELECT edge_id, src, dst FROM cur")
def commit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends to a log of Parquet, and its state read with the relation's folder alone."""
    path, log = new_folder(spark, "log"), edge_events(spark, sf_dir)
    WR.append(log.where("op = 'assert'"), path)
    WR.append(log.where("op = 'retract'"), path)
    return T.fold(spark.read.parquet(path).where("relation = 'CONTAINS'")).select("edge_id", "src", "dst")


# ------------------------------------------------------------------ import and export


@query("SELECT 'NATION/' || n_nationkey AS src, 'IN_REGION' AS relation, 'REGION/' || n_regionkey AS dst FROM nation UNION ALL SELECT 'CUSTOMER/' || o_custkey, 'PLACED', 'ORDER/' || o_orderkey FROM orders")
def ndjson_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "ndjson")
    ndjson.write(graph(spark, sf_dir).all_edges(["IN_REGION", "PLACED"]), path)
    return ndjson.triplets(ndjson.read(spark, path, strict=True)).select("src", "relation", "dst")


@query("SELECT '<http://ex/CUSTOMER/' || o_custkey || '>' AS s, '<http://ex/rel/PLACED>' AS p, '<http://ex/ORDER/' || o_orderkey || '>' AS o, NULL AS g FROM orders")
def rdf_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "nquads")
    rdf.write(rdf.from_edges(graph(spark, sf_dir).all_edges(["PLACED"])), path)
    return rdf.read(spark, path, strict=True)


@query("SELECT 2 * count(*) AS statements, 2 * count(*) AS subjects, 2 * count(DISTINCT n_regionkey) AS objects FROM nation")
def rdf_blank_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same labels in two documents are different nodes, and in one document the same."""
    n = graph(spark, sf_dir).entities["NATION"]
    lines = n.select(F.concat(F.lit("_:n"), F.col("nationkey").cast("string"), F.lit(" <http://ex/in> _:r"), F.col("regionkey").cast("string"), F.lit(" .")).alias("value"))
    both = rdf.parse(lines, scope="one").unionByName(rdf.parse(lines, scope="two"))
    return both.agg(F.count("*").alias("statements"), F.countDistinct("s").alias("subjects"), F.countDistinct("o").alias("objects"))


@query("""SELECT (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM nation) AS statements, (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM nation) AS resource_triples,
0::BIGINT AS literal_triples, (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)) AS duplicates, 2::BIGINT AS predicates""")
def rdf_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rdf.counts(rdf.from_edges(graph(spark, sf_dir).all_edges(["CONTAINS", "IN_REGION"])))


@query("""SELECT 'PART/' || p_partkey || '/a b' AS src, 'MADE_BY' AS relation, 'BRAND/' || p_brand AS dst, p_name AS src_name, 'size ' || p_size AS evidence, p_size::BIGINT AS size FROM part""")
def ndjson_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with slashes, names beside keys, evidence and properties, written and read."""
    path, parts = new_folder(spark, "ndjson"), graph(spark, sf_dir).entities["PART"]
    edges = parts.select(F.concat("id", F.lit("/a b")).alias("src"), F.lit("MADE_BY").alias("relation"), F.concat(F.lit("BRAND/"), "brand").alias("dst"), F.col("name").alias("src_name"), F.concat(F.lit("size "), F.col("size").cast("string")).alias("evidence"), F.to_json(F.struct("size")).alias("properties"))
    ndjson.write(edges, path)
    found = ndjson.triplets(ndjson.read(spark, path, strict=True))
    return found.select("src", "relation", "dst", "src_name", "evidence", F.get_json_object("properties", "$.size").cast("long").alias("size"))


@query("""SELECT '<http://ex/PART/' || p_partkey || '>' AS s, '"' || p_name || ' \\"' || chr(233) || '\\""@en' AS o FROM part UNION ALL SELECT '<http://ex/PART/' || p_partkey || '>', '"' || repeat(p_name, 2000) || '"' FROM part WHERE p_partkey <= 20""")
def rdf_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literals with escapes and tags in any case come out canonical; long ones come through whole."""
    parts = graph(spark, sf_dir).entities["PART"]
    subject = F.concat(F.lit("<http://ex/"), "id", F.lit("> <http://ex/name> "))
    lines = parts.select(F.concat(subject, F.lit('"'), "name", F.lit(' \\"\\u00E9\\""@EN .')).alias("value"))
    long_ = parts.where("partkey <= 20").select(F.concat(subject, F.lit('"'), F.repeat("name", 2000), F.lit('"^^<http://www.w3.org/2001/XMLSchema#string> .')).alias("value"))
    return rdf.parse(lines.unionByName(long_), strict=True).select("s", "o")


@query("SELECT 'NATION/' || n_nationkey AS n, CASE WHEN n_regionkey < 2 THEN 'REGION/' || n_regionkey END AS r, CASE WHEN n_regionkey < 2 THEN 3 ELSE 2 END AS keys FROM nation")
def results_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as Results JSON and back; an unbound variable is no key."""
    found = P.match(graph(spark, sf_dir), [("?n", "IN_REGION", "?r")])
    terms = found.select(F.concat(F.lit("<"), "n", F.lit(">")).alias("n"), F.when(F.col("r").isin("REGION/0", "REGION/1"), S.str_lang("r", "en")).alias("r"), F.lit("_:b1").alias("x"))
    path = new_folder(spark, "results")
    results.write(terms, path)
    lines = spark.read.text(path)
    keys = F.size(F.json_object_keys("value")).alias("keys")
    return results.read(lines.select("value"), ["n", "r"]).select("n", "r", F.when(F.col("r").isNull(), 2).otherwise(3).alias("keys")).join(lines.select(F.get_json_object("value", "$.n.value").alias("n"), keys.alias("_keys")), "n").where("keys = _keys").select("n", "r", "keys")


@query("SELECT 'CUSTOMER/' || o_custkey AS src, 'PLACED' AS relation, 'ORDER/' || o_orderkey AS dst FROM orders")
def stream_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of NDJSON streamed into Parquet, and the same call again, which adds nothing."""
    source, target, checkpoint = (new_folder(spark, n) for n in ("inbox", "imported", "stream"))
    ndjson.write(graph(spark, sf_dir).all_edges(["PLACED"]), source)
    for _ in range(2):
        imports.wait(imports.start_import(spark, source, target, checkpoint))
    return imports.imported(spark, target).select("src", "relation", "dst")


@on_graph("""SELECT CASE o_orderkey % 4 WHEN 0 THEN 'statement' WHEN 1 THEN 'malformed' WHEN 2 THEN 'malformed' ELSE 'nothing' END AS kind, count(*) AS n FROM orders GROUP BY 1""")
def rdf_malformed(g: Graph) -> DataFrame:
    """Lines without an end, with a literal as subject, comments and statements: what is dropped is told."""
    quads = rdf.from_edges(g.all_edges(["PLACED"])).withColumn("k", F.regexp_extract("o", "ORDER/([0-9]+)", 1).cast("long") % 4)
    whole = rdf.statement()
    lines = quads.select(F.when(F.col("k") == 0, whole).when(F.col("k") == 1, F.rtrim(F.concat(whole, F.lit("x")))).when(F.col("k") == 2, F.concat(F.lit('"text" '), whole)).otherwise(F.concat(F.lit(" # "), whole)).alias("value"))
    kinds = {"statement": rdf.parse(lines), "malformed": rdf.malformed(lines), "nothing": lines.where(F.col("value").rlike(rdf.NOTHING))}
    found = [d.agg(F.lit(k).alias("kind"), F.count("*").alias("n")) for k, d in kinds.items()]
    return reduce(lambda a, b: a.unionByName(b), found)


@query("SELECT 'edges' AS family, count(*) AS n FROM orders UNION ALL SELECT 'entities', count(*) FROM customer UNION ALL SELECT 'malformed', count(*) FROM region UNION ALL SELECT 'unknown', count(*) FROM nation")
def stream_import_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triplets, entities, broken lines and lines of no kind in one inbox: each is kept and counted."""
    g = graph(spark, sf_dir)
    source, target, checkpoint = (new_folder(spark, n) for n in ("inbox", "imported", "stream"))
    ndjson.write(g.all_edges(["PLACED"]), source)
    customers = g.entities["CUSTOMER"]
    ndjson.write_entities(customers.select("id", "name", F.to_json(F.struct("acctbal", "mktsegment")).alias("properties")), source)
    g.entities["REGION"].select(F.concat(F.lit("{"), "name").alias("value")).write.mode("append").text(source)
    g.entities["NATION"].select(F.to_json(F.struct("name")).alias("value")).write.mode("append").text(source)
    imports.wait(imports.start_import(spark, source, target, checkpoint))
    return spark.createDataFrame(sorted(imports.counts(spark, target).items()), "family string, n long")


@query(_EVENTS + "SELECT edge_id, src, dst, commit_seq FROM cur")
def stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a stream in two batches; the state kept up equals that of a fold."""
    source, target, checkpoint = (new_folder(spark, n) for n in ("log", "state", "stream"))
    log = edge_events(spark, sf_dir)
    for part in ("assert", "retract"):
        log.where(F.col("op") == part).write.mode("append").option("compression", "zstd").parquet(source)
        imports.start_fold(spark.readStream.schema(log.schema).parquet(source), target, checkpoint).awaitTermination()
        imports.compact_folded(spark, target)
    return imports.folded(spark, target).select("edge_id", "src", "dst", "commit_seq")


# ------------------------------------------------------------------ entities, ontology


_AROUND = """WITH e AS (SELECT 'NATION/' || n_nationkey AS src, 'IN_REGION' AS relation, 'REGION/' || n_regionkey AS dst FROM nation
UNION ALL SELECT 'CUSTOMER/' || c_custkey, 'IN_NATION', 'NATION/' || c_nationkey FROM customer UNION ALL SELECT 'SUPPLIER/' || s_suppkey, 'IN_NATION', 'NATION/' || s_nationkey FROM supplier),
b AS (SELECT src AS id, 'out' AS direction, relation, dst AS other, md5(src || relation || dst) AS edge_id FROM e WHERE src LIKE 'NATION/%'
UNION ALL SELECT dst, 'in', relation, src, md5(src || relation || dst) FROM e WHERE dst LIKE 'NATION/%'),
k AS (SELECT *, row_number() OVER (PARTITION BY id, direction ORDER BY edge_id, other)::INT AS rank, count(*) OVER (PARTITION BY id, direction) AS total FROM b) """


def _around(g: Graph, most: int) -> DataFrame:
    edges = g.all_edges(["IN_REGION", "IN_NATION"])
    edges = edges.withColumn("edge_id", F.md5(F.concat("src", "relation", "dst").cast("binary")))
    return E.neighbourhood(edges, g.entities["NATION"].select("id"), most=most)


@on_graph(_AROUND + "SELECT id, direction, relation, other, edge_id, rank, total, total > 1000 AS truncated FROM k WHERE rank <= 1000")
def neighborhood(g: Graph) -> DataFrame:
    return _around(g, 1000)


@on_graph(_AROUND + "SELECT id, direction, relation, other, edge_id, rank, total, total > 5 AS truncated FROM k WHERE rank <= 5")
def neighborhood_truncated(g: Graph) -> DataFrame:
    return _around(g, 5)


_TYPES = " UNION ALL ".join(f"SELECT '{k}' AS {{name}}, count(*) AS {{n}} FROM {t}" for k, t in (("REGION", "region"), ("NATION", "nation"), ("CUSTOMER", "customer"), ("SUPPLIER", "supplier"), ("PART", "part"), ("ORDER", "orders")))


@on_graph(_TYPES.format(name="type", n="entities"))
def type_sample_count(g: Graph) -> DataFrame:
    return E.type_counts(g)


@on_graph("""SELECT 'CUSTOMER/' || c_custkey AS id, md5('CUSTOMER/' || c_custkey) AS "order" FROM customer ORDER BY 2, 1 LIMIT 20""")
def type_sample(g: Graph) -> DataFrame:
    return E.type_sample(g, "CUSTOMER", 20)


@query(_EVENTS + "SELECT id, max(commit_seq) AS last_commit, count(*) AS events FROM (SELECT src AS id, commit_seq FROM ev UNION ALL SELECT dst, commit_seq FROM ev) GROUP BY 1")
def entity_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.metadata(edge_events(spark, sf_dir))


_RELATIONS = """SELECT 'IN_REGION' AS {r}, count(*) AS {n} FROM nation UNION ALL SELECT 'IN_NATION', (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier) UNION ALL SELECT 'PLACED', count(*) FROM orders
UNION ALL SELECT 'CONTAINS', count(*) FROM lineitem UNION ALL SELECT 'SUPPLIES', count(*) FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) UNION ALL SELECT 'HAS_STATE', count(*) FROM events"""


@query(_EVENTS.replace("FROM ev)", "FROM ev WHERE commit_seq <= 170)") + """, seen AS (SELECT * FROM ev WHERE commit_seq <= 170),
n AS (SELECT dst AS id, count(*) AS in_edges_total, string_agg(src, ' ' ORDER BY src, edge_id) AS in_edges FROM cur GROUP BY 1),
h AS (SELECT dst AS id, count(*) AS history_total, string_agg(commit_seq || ':' || op || ':' || src, ' ' ORDER BY commit_seq, event_ord, edge_id) AS history, max(commit_seq) AS last_commit FROM seen GROUP BY 1)
SELECT p.id, p.name, p.size, coalesce(h.history_total, 0) AS events, h.last_commit, 0::BIGINT AS out_edges_total, coalesce(in_edges_total, 0) AS in_edges_total, in_edges, coalesce(history_total, 0) AS history_total, history
FROM (SELECT 'PART/' || p_partkey AS id, p_name AS name, p_size AS size FROM part) p LEFT JOIN n USING (id) LEFT JOIN h USING (id)""")
def entity_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as of a commit: properties, metadata, edges now, and history."""
    log = edge_events(spark, sf_dir)
    found = E.detail(log, graph(spark, sf_dir).entities["PART"].select("id", "name", "size"), commit_seq=170)
    told = F.array_join(F.transform("history", lambda e: F.concat_ws(":", e["commit_seq"].cast("string"), e["op"], e["other"])), " ")
    return found.select("id", "name", "size", "events", "last_commit", "out_edges_total", "in_edges_total", F.array_join("in_edges.other", " ").alias("in_edges"), "history_total", told.alias("history"))


@on_graph("SELECT 'type' AS family, name, NULL::BIGINT AS edge_count FROM (VALUES ('REGION'), ('NATION'), ('CUSTOMER'), ('SUPPLIER'), ('PART'), ('ORDER'), ('USER'), ('STATE')) v(name) UNION ALL SELECT 'relation', relation, edge_count FROM (" + _RELATIONS.format(r="relation", n="edge_count") + ")")
def ontology_view(g: Graph) -> DataFrame:
    return O.view(g, O.STAR, counts=True).select("family", "name", "edge_count")


@on_graph("""SELECT 'CUSTOMER/' || c_custkey AS focus, 'CUSTOMER.acctbal minInclusive' AS "constraint" FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'CUSTOMER/' || c_custkey, 'CUSTOMER.mktsegment in' FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT 'PART/' || p_partkey, 'PART.name pattern' FROM part WHERE NOT regexp_matches(p_name, '^[a-m]')""")
def conformance_shapes(g: Graph) -> DataFrame:
    """Value ranges, value lists and patterns of properties."""
    shapes = [O.Shape("CUSTOMER", "acctbal", min_value=0.0, datatype="double", min_count=1), O.Shape("CUSTOMER", "mktsegment", one_of=("BUILDING", "MACHINERY")), O.Shape("PART", "name", pattern="^[a-m]")]
    return O.check_shapes(g, shapes).select("focus", "constraint")


@on_graph(f"SELECT 'type' AS family, name, n FROM ({_TYPES.format(name='name', n='n')}) UNION ALL SELECT 'relation', name, n FROM ({_RELATIONS.format(r='name', n='n')} UNION ALL SELECT 'DOUBLES', count(*) FROM nation UNION ALL SELECT 'PARENT', count(*) FROM part WHERE p_partkey > 0 UNION ALL SELECT 'NEXT', count(*) FROM part WHERE p_partkey <= 160)")
def summary(g: Graph) -> DataFrame:
    return E.summary(g)


@on_graph(_RELATIONS.format(r="relation", n="edge_count"))
def ontology_counts(g: Graph) -> DataFrame:
    return O.edge_counts(g, O.STAR)


@on_graph("""WITH e AS (SELECT 'PARENT' AS relation, 'PART' AS domain, 'PART' AS "range", count(*) AS n FROM part WHERE p_partkey > 0 UNION ALL SELECT 'DOUBLES', 'NATION', 'NATION', count(*) FROM nation UNION ALL SELECT 'NEXT', 'STEP', 'STEP', count(*) FROM part WHERE p_partkey <= 160)
SELECT relation, domain, "range", n AS edges, 2 AS version, false AS again, 'refused' AS narrower FROM e WHERE n > 0""")
def ontology_define(g: Graph) -> DataFrame:
    """What the edges show and the ontology lacks is defined: the version rises, the same once more changes nothing, and dropping a range is refused."""
    shown = O.induce(g.all_edges(), O.as_table(g.spark, O.STAR)).collect()
    wanted = O.Ontology(relations={r["relation"]: O.Relation(frozenset({r["domain"]}), frozenset({r["range"]}), r["max_out"]) for r in shown})
    defined, _ = O.define(O.STAR, wanted)
    again = O.define(defined, wanted)[1]

    def narrower(relation: str) -> str:
        try:
            O.define(defined, O.Ontology(relations={relation: O.Relation(defined.relations[relation].domains, frozenset())}))
        except O.RestrictiveChange:
            return "refused"
        return "taken"

    told = g.spark.createDataFrame([(r["relation"], r["edges"], defined.version, again, narrower(r["relation"])) for r in shown], "relation string, edges long, version int, again boolean, narrower string")
    return O.as_table(g.spark, defined).drop("max_count").join(told, "relation")


@on_graph("SELECT 'ORDER/' || l_orderkey AS src, 'CONTAINS' AS relation, count(*) AS n, 5 AS max_count FROM lineitem GROUP BY 1 HAVING count(*) > 5")
def conformance_maxcount(g: Graph) -> DataFrame:
    return O.conformance(g.all_edges(), O.as_table(g.spark, O.STAR)).select("src", "relation", "n", "max_count")


@on_graph("""SELECT 'DOUBLES' AS relation, 'NATION' AS domain, 'NATION' AS "range", count(*) AS edges, 1 AS max_out FROM nation UNION ALL SELECT 'PARENT', 'PART', 'PART', count(*), 1 FROM part WHERE p_partkey > 0 UNION ALL SELECT 'NEXT', 'STEP', 'STEP', count(*), 1 FROM part WHERE p_partkey <= 160""")
def ontology_induce(g: Graph) -> DataFrame:
    """Relations that the ontology doesn't know yet."""
    return O.induce(g.all_edges(), O.as_table(g.spark, O.STAR))


_GRAMS = "list_distinct(list_transform(range(1, greatest(2, length(k) + 1)), lambda i: substr(' ' || k || ' ', i, 3)))"


@on_graph(f"""WITH n AS (SELECT 'CUSTOMER/' || c_custkey AS id, trim(lower(regexp_replace(trim(c_name || ' ' || c_mktsegment), '[^0-9A-Za-z]+', ' ', 'g'))) AS k FROM customer),
t AS (SELECT DISTINCT lower(c_mktsegment) || ' ' || c_custkey AS text, lower(c_mktsegment) || ' ' || c_custkey AS k FROM customer WHERE c_custkey % 50 = 0),
g AS (SELECT id, unnest({_GRAMS}) AS gram FROM n), w AS (SELECT gram, floor(ln(1 + (SELECT count(*) FROM n) / count(*)::DOUBLE) * 1000000)::BIGINT AS weight FROM g GROUP BY 1),
p AS (SELECT id, gram, weight, sum(weight) OVER (PARTITION BY id)::BIGINT AS norm FROM g JOIN w USING (gram)),
a AS (SELECT text, gram, weight, sum(weight) OVER (PARTITION BY text)::BIGINT AS own FROM (SELECT text, unnest({_GRAMS}) AS gram FROM t) JOIN w USING (gram)),
m AS (SELECT a.text, p.id, sum(p.weight)::BIGINT AS both_, max(norm) AS norm, max(own) AS own FROM a JOIN p USING (gram) GROUP BY 1, 2)
SELECT text, id, shared, k::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY shared DESC, id) AS k FROM (SELECT text, id, both_ * 1000000 // (norm + own - both_) AS shared FROM m)) WHERE k <= 5""")
def search_ranked(g: Graph) -> DataFrame:
    """The five customers whose name and segment are most like each of some texts, by runs of letters that few names have."""
    customers = g.entities["CUSTOMER"]
    names = customers.select("id", F.concat_ws(" ", "name", "mktsegment").alias("name"))
    texts = customers.where("custkey % 50 = 0").select(F.concat_ws(" ", F.lower("mktsegment"), F.col("custkey").cast("string")).alias("text"))
    return O.ranked_search(texts, O.name_index(names), most=5)


_MENTIONS = """WITH k AS (SELECT 'NATION/' || n_nationkey AS id, trim(lower(regexp_replace(trim(n_name), '[^0-9A-Za-z]+', ' ', 'g'))) AS k, n_name, n_nationkey FROM nation),
m AS (SELECT CASE n_nationkey % 4 WHEN 0 THEN upper(n_name) WHEN 1 THEN 'x' || substr(n_name, 2) WHEN 2 THEN substr(n_name, 1, 2) || substr(n_name, 4) || 'q' ELSE 'zz' || substr(n_name, 2) || 'zzz' END AS mention FROM k),
d AS (SELECT DISTINCT mention, lower(regexp_replace(trim(mention), '[^0-9A-Za-z]+', ' ', 'g')) AS mk FROM m),
c AS (SELECT mention, id, levenshtein(mk, k) AS distance FROM d CROSS JOIN k WHERE levenshtein(mk, k) <= 2)
"""


@on_graph(_MENTIONS + "SELECT mention, id, distance::INT AS distance FROM (SELECT *, row_number() OVER (PARTITION BY mention ORDER BY distance, id) AS r FROM c) WHERE r = 1")
def ontology_resolve(g: Graph) -> DataFrame:
    """Names in capitals, with a wrong first letter, with two errors, and too far from any."""
    names, name, key = g.entities["NATION"], F.col("name"), F.col("nationkey") % 4
    typed = F.when(key == 0, F.upper("name")).when(key == 1, F.concat(F.lit("x"), F.substring(name, 2, 99))).when(key == 2, F.concat(F.substring(name, 1, 2), F.substring(name, 4, 99), F.lit("q"))).otherwise(F.concat(F.lit("zz"), F.substring(name, 2, 99), F.lit("zzz")))
    return O.resolve(names.select(typed.alias("mention")), names.select("id", "name"))


@on_graph("SELECT 'PART/' || p_partkey AS id, p_name AS name FROM part WHERE contains(lower(p_name), 'an')")
def ontology_search(g: Graph) -> DataFrame:
    return O.search(g.entities["PART"].select("id", "name"), "an").select("id", "name")


# ------------------------------------------------------------------ signals, feedback, models


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SIG.signals(spark.read.parquet(f"{sf_dir}/events.parquet"))


@query("SELECT event_id AS seq, event_type AS kind, props AS payload FROM events WHERE event_id BETWEEN 100 AND 499")
def signals_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SIG.read_range(_feed(spark, sf_dir), 100, 499).select("seq", "kind", "payload")


@query("""SELECT 'suggestion_shown' AS kind, '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS payload FROM events WHERE event_type = 'view' UNION ALL
SELECT 'suggestion_adopted', '{"event_id":' || event_id || ',"user_id":' || user_id || '}' FROM events WHERE event_type = 'purchase'""")
def suggestion_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return SIG.wrap(e.where("event_type = 'view'"), "suggestion_shown", ["event_id", "user_id"]).unionByName(SIG.wrap(e.where("event_type = 'purchase'"), "suggestion_adopted", ["event_id", "user_id"]))


@query("SELECT 'external_planner_trace' AS kind, 'a' || event_id AS request_id, 't' || user_id AS snapshot_token FROM events")
def planner_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    asks = e.select(F.concat(F.lit("a"), F.col("event_id").cast("string")).alias("ask_id"), F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("snapshot_token"), "value")
    return SIG.planner_trace(asks).select("kind", "request_id", "snapshot_token")


@query("SELECT event_id AS seq FROM events")
def stream_unique_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every signal is sent twice in a stream, and kept once."""
    source, target, checkpoint = (new_folder(spark, n) for n in ("signals", "kept", "stream"))
    feed = _feed(spark, sf_dir).select("seq", F.col("ts").cast("timestamp").alias("ts"))
    for _ in range(2):
        feed.write.mode("append").parquet(source)
    stream = imports.unique_signals(spark.readStream.schema(feed.schema).parquet(source))
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(target).select("seq")


_SENT = """WITH cuts AS (SELECT max(event_id) // 3 AS third FROM events),
first AS (SELECT event_id AS seq, ts, CASE WHEN event_id % 50 = 7 THEN 2 ELSE least(event_id // third, 2) END AS batch FROM events, cuts),
sent AS (SELECT * FROM first UNION ALL SELECT * FROM first WHERE seq % 10 = 3 UNION ALL SELECT seq, ts, 2 FROM first WHERE seq % 100 = 1 AND batch < 2),
mark AS (SELECT max(ts) FILTER (batch < 1) AS one, max(ts) FILTER (batch < 2) AS two FROM sent),
told AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY batch) AS k, CASE batch WHEN 0 THEN NULL WHEN 1 THEN one - INTERVAL 10 DAYS ELSE two - INTERVAL 10 DAYS END AS behind, min(batch) OVER (PARTITION BY seq) AS met FROM sent, mark) """


@query(_SENT + """SELECT seq, CASE WHEN k = 1 THEN CASE WHEN behind IS NULL OR ts >= behind THEN 'kept' ELSE 'late' END
WHEN batch = met OR ts >= behind THEN 'repeated' WHEN date_trunc('millisecond', ts) + INTERVAL 10 DAYS <= behind THEN 'late' ELSE 'repeated' END AS verdict, count(*) AS n FROM told GROUP BY 1, 2""")
def stream_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals in three batches, some of them delayed to the last one, some sent twice at once, some again much later: each row has its verdict."""
    source, target, checkpoint = (new_folder(spark, n) for n in ("signals", "judged", "stream"))
    feed = _feed(spark, sf_dir).select("seq", "ts")
    third = feed.agg(F.max("seq")).first()[0] // 3
    first = feed.withColumn("batch", F.when(F.col("seq") % 50 == 7, 2).otherwise(F.least(F.expr(f"seq div {third}"), F.lit(2))))
    again = first.where("seq % 100 = 1 AND batch < 2").withColumn("batch", F.lit(2))
    sent = first.unionByName(first.where("seq % 10 = 3")).unionByName(again)
    for number in range(3):
        sent.where(F.col("batch") == number).drop("batch").write.mode("append").parquet(source)
        stream = spark.readStream.schema(feed.schema).option("maxFileAge", imports.ANY_AGE).parquet(source)
        state.start_sightings(stream, target, checkpoint, delay_seconds=10 * 86_400).awaitTermination()
    return state.judged(spark, target).groupBy("seq", "verdict").agg(F.count("*").alias("n"))


@query(_SPOKEN + """, sent AS (SELECT edge_id, commit_seq, event_ord, event_ord % 3 AS batch, 0 AS other FROM ev UNION ALL SELECT edge_id, commit_seq, event_ord, 2, (event_ord % 2)::INT FROM ev WHERE event_ord % 20 = 2 OR event_ord % 20 = 5),
best AS (SELECT edge_id, batch, max({'c': commit_seq, 'o': event_ord}) AS top FROM sent GROUP BY 1, 2),
judged AS (SELECT s.*, (SELECT max(b.top) FROM best b WHERE b.edge_id = s.edge_id AND b.batch < s.batch) AS before, row_number() OVER (PARTITION BY s.edge_id, s.commit_seq, s.event_ord, s.batch ORDER BY s.other) AS k FROM sent s)
SELECT edge_id, CASE WHEN k = 1 AND (before IS NULL OR {'c': commit_seq, 'o': event_ord} > before) THEN 'applied' WHEN {'c': commit_seq, 'o': event_ord} < coalesce(before, {'c': commit_seq, 'o': event_ord}) THEN 'late' ELSE 'again' END AS verdict, count(*) AS n FROM judged GROUP BY 1, 2""")
def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of edges in three batches that are not in the order of commits, some sent again as they were or with other content."""
    source, target, checkpoint = (new_folder(spark, n) for n in ("events", "judged", "stream"))
    log = _spoken(spark, sf_dir).withColumn("batch", F.col("event_ord") % 3)
    again = log.where("event_ord % 20 IN (2, 5)").withColumns({"batch": F.lit(2).cast("long"), "op": F.when(F.col("event_ord") % 2 == 1, F.lit("other")).otherwise(F.col("op"))})
    for number in range(3):
        log.unionByName(again).where(F.col("batch") == number).drop("batch").write.mode("append").parquet(source)
        stream = spark.readStream.schema(log.drop("batch").schema).option("maxFileAge", imports.ANY_AGE).parquet(source)
        state.start_ledger(stream, target, checkpoint).awaitTermination()
    verdict = F.when(F.col("verdict").isin("repeated", "refused"), "again").otherwise(F.col("verdict")).alias("verdict")
    return state.judged(spark, target).groupBy("edge_id", verdict).agg(F.count("*").alias("n"))


@query("SELECT event_type AS kind, count(*) AS accepted, CASE WHEN event_type IN ('error', 'signup') THEN 0 ELSE count(*) END AS trainable FROM events GROUP BY event_type")
def ingest_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _feed(spark, sf_dir)
    got = SIG.ingest(feed.unionByName(feed), feed.limit(0), ["error", "signup"])
    return got.groupBy("kind").agg(F.count("*").alias("accepted"), F.sum(F.col("trainable").cast("long")).alias("trainable"))


_SPLIT = "(SELECT (max(event_id) + 1) * 8 // 10 FROM events)"


def _split(feed: DataFrame) -> int:
    return int((feed.agg(F.max("seq")).first()[0] + 1) * 8 // 10)


@query(f"""WITH f AS (SELECT *, lead(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS next FROM events WHERE event_id <= {_SPLIT})
SELECT event_id AS seq, user_id, coalesce(next = 'purchase', false) AS label FROM f WHERE event_type = 'view'""")
def suggest_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _feed(spark, sf_dir)
    return SIG.suggestions(feed, "view", "purchase", _split(feed))


@query(f"""WITH f AS (SELECT *, max(CASE WHEN event_type = 'view' THEN event_id END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS rejected FROM events WHERE event_id <= {_SPLIT})
SELECT user_id, event_id AS chosen, rejected FROM f WHERE event_type = 'purchase' AND rejected IS NOT NULL""")
def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _feed(spark, sf_dir)
    return SIG.preference_pairs(feed, "purchase", "view", _split(feed))


@query("""WITH t AS (SELECT *, lead(text) OVER w AS target, lead(role) OVER w AS next FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, text AS input, target FROM t WHERE role = 'user' AND next = 'assistant'""")
def extractor_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SIG.extractor_examples(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query("SELECT 'EPISODE/' || conv_id AS id, count(*) AS turns, sha256(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS text_sha256 FROM conversations GROUP BY conv_id")
def observe_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SIG.episodes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


_GRADES = "(SELECT source AS query, 'DOCUMENT/' || doc_id AS target, CASE WHEN quality = 1 AND toxic = 0 THEN 3 WHEN quality = 1 THEN 1 ELSE 0 END AS grade FROM labels JOIN documents USING (doc_id))"


def _grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SIG.grades(*(spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels")))


@query(f"SELECT * FROM {_GRADES}")
def feedback_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grades(spark, sf_dir)


@query(f"SELECT grade, 2 * count(*) AS raw, count(DISTINCT (query, target)) AS deduplicated FROM {_GRADES} GROUP BY 1")
def feedback_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is sent twice; the summary tells raw from deduplicated."""
    got = _grades(spark, sf_dir)
    return SIG.feedback_summary(got.unionByName(got))


_RUNS = "(SELECT l_returnflag AS kind, l_shipdate AS recorded, 'm' || row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate) AS manifest FROM (SELECT DISTINCT l_returnflag, l_shipdate FROM lineitem))"


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run for each ship date of a return flag; the third of each kind was promoted, then the fifth."""
    days = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_returnflag").alias("kind"), F.col("l_shipdate").alias("recorded")).distinct()
    runs = SIG.numbered_runs(days.withColumn("manifest", F.col("recorded").cast("string")))
    promotions = runs.where("run IN (3, 5)").select("kind", "run", F.col("run").alias("at"))
    return SIG.registry(runs, promotions).select("kind", "run", "recorded", "promoted")


_LISTED = f"SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY recorded)::INT AS run, recorded, row_number() OVER (PARTITION BY kind ORDER BY recorded) = 5 AS promoted FROM {_RUNS}"


@query(_LISTED)
def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir)


@query(f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY run DESC) AS back FROM ({_LISTED})) WHERE back <= 4 OR promoted".replace("SELECT * FROM (SELECT *, row", "SELECT kind, run, recorded, promoted FROM (SELECT *, row"))
def registry_gc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SIG.registry_gc(_listed(spark, sf_dir), 4)


@query(f"SELECT max(event_id) FILTER (event_id <= {_SPLIT}) AS train_max, count(*) FILTER (event_id <= {_SPLIT}) AS train_rows, min(event_id) FILTER (event_id > {_SPLIT}) AS eval_min, count(*) FILTER (event_id > {_SPLIT}) AS eval_rows, true AS clean FROM events")
def split_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _feed(spark, sf_dir)
    at = _split(feed)
    return SIG.split_audit(feed.where(F.col("seq") <= at), feed.where(F.col("seq") > at), at)


@query("SELECT event_type AS kind, count(*) AS signals, count(*) FILTER (ts < TIMESTAMP '2024-01-14') AS signals_at_run, count(*) >= 2 * count(*) FILTER (ts < TIMESTAMP '2024-01-14') AS due FROM events GROUP BY 1")
def cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _feed(spark, sf_dir)
    trained = feed.where("ts < TIMESTAMP_NTZ '2024-01-14'").groupBy("kind").agg(F.count("*").alias("signals_at_run"))
    return SIG.cadence(feed, trained)


@query(f"SELECT event_id AS seq, event_id::VARCHAR AS request_id, props AS payload FROM events WHERE event_type = 'click' AND event_id <= {_SPLIT}")
def planner_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _feed(spark, sf_dir)
    return SIG.planner_examples(feed, "click", _split(feed))


@query("""WITH p AS (SELECT DISTINCT source, lang FROM documents WHERE doc_id % 3 > 0), t AS (SELECT DISTINCT source, lang FROM documents WHERE doc_id % 5 > 0),
c AS (SELECT lang, count(p.lang IS NOT NULL OR NULL) AS predicted FROM p GROUP BY lang), d AS (SELECT lang, count(*) AS "true" FROM t GROUP BY lang), h AS (SELECT lang, count(*) AS hits FROM p JOIN t USING (source, lang) GROUP BY lang)
SELECT lang, coalesce(predicted, 0) AS predicted, coalesce("true", 0) AS "true", coalesce(hits, 0) AS hits, round(2.0 * coalesce(hits, 0) / (coalesce(predicted, 0) + coalesce("true", 0)), 6)::DOUBLE AS f1 FROM c FULL JOIN d USING (lang) FULL JOIN h USING (lang)""")
def promote_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact F1 by language, facts being the sources that documents come from."""
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang")
    found = SIG.fact_scores(d.where("doc_id % 3 > 0"), d.where("doc_id % 5 > 0"), ["source"], ["lang"])
    return found.select("lang", "predicted", "true", "hits", F.round("f1", 6).alias("f1"))


@query("SELECT count(*) AS requests, count(*) FILTER (doc_id % 3 > 0 AND (lang = 'en') = (doc_id % 2 = 0)) AS exact FROM documents")
def slot_exactness(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", (F.col("lang") == "en").alias("slot"))
    guessed = d.where("doc_id % 3 > 0").select("doc_id", (F.col("doc_id") % 2 == 0).alias("slot"))
    return SIG.slot_exactness(guessed, d, "doc_id", ["slot"]).select("requests", "exact")


@query(f"""WITH s AS (SELECT *, event_id <= {_SPLIT} AS train, event_type = 'purchase' AS y FROM events),
k AS (SELECT t, train, avg(((value > t) = y)::INT) AS score FROM s CROSS JOIN (VALUES (10), (40), (80)) c(t) GROUP BY ALL),
b AS (SELECT t FROM k WHERE train ORDER BY score DESC, 'over_' || t LIMIT 1)
SELECT 'over_' || t AS candidate, round((SELECT score FROM k WHERE k.t = b.t AND train), 6) AS train_score, round((SELECT score FROM k WHERE k.t = b.t AND NOT train), 6) AS held_score,
round((SELECT avg((NOT y)::INT) FROM s WHERE NOT train), 6) AS champion_score, (SELECT score FROM k WHERE k.t = b.t AND NOT train) > (SELECT avg((NOT y)::INT) FROM s WHERE NOT train) AS promoted FROM b""")
def train_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three thresholds are tried on the training slice; the best is held against one that always says no."""
    feed = _feed(spark, sf_dir).withColumn("y", F.col("kind") == "purchase")
    candidates = {f"over_{t}": (lambda d, t=t: d.select((F.col("value") > t).alias("guess"), "y")) for t in (10, 40, 80)}
    tick = SIG.train_tick(feed, candidates, lambda d: d.agg(F.avg((F.col("guess") == F.col("y")).cast("int"))).first()[0], _split(feed), champion=lambda d: d.select(F.lit(False).alias("guess"), "y"))
    return spark.createDataFrame([(tick.candidate, round(tick.train_score, 6), round(tick.held_score, 6), round(tick.champion_score, 6), tick.promoted)], "candidate string, train_score double, held_score double, champion_score double, promoted boolean")


@on_graph("""WITH e AS (SELECT 'CUSTOMER/' || o_custkey AS src, 'PLACED' AS relation, 'ORDER/' || o_orderkey AS dst FROM orders), q AS (SELECT DISTINCT src, relation FROM e ORDER BY md5(src || '|' || relation) LIMIT 50)
SELECT src, relation, count(DISTINCT dst) AS answers, min(dst) AS first_answer, true AS verified FROM e JOIN q USING (src, relation) GROUP BY 1, 2""")
def synthetic_eval(g: Graph) -> DataFrame:
    return SIG.probes(g.all_edges(["PLACED"]), 50)


def _shadow(dims: str) -> str:
    return f"""SELECT q, count(*) FILTER (label = q_label) AS hits FROM (SELECT q.vec_id AS q, q.label AS q_label, v.label,
row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(v.embedding[1:{dims}]::DOUBLE[], q.embedding[1:{dims}]::DOUBLE[]), 6) DESC, v.vec_id) AS r
FROM embeddings v JOIN embeddings q ON q.vec_id < 20 AND v.vec_id <> q.vec_id) WHERE r <= 10 GROUP BY q"""


@query(f"SELECT 'champion' AS model, q AS query_id, hits FROM ({_shadow('64')}) UNION ALL SELECT 'challenger', q, hits FROM ({_shadow('32')})")
def shadow_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rankings of one snapshot for twenty queries, all dimensions against the first half; neither is promoted."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    queries = vectors.where("vec_id < 20")
    both = [SIG.retrieval(vectors, queries, dims).select(F.lit(name).alias("model"), "query_id", "hits") for name, dims in (("champion", 64), ("challenger", 32))]
    return both[0].unionByName(both[1])


def _ranked(dims: str) -> str:
    return f"""SELECT q AS query_id, count(*) FILTER (label = q_label) AS hits, round(CASE WHEN room > 0 THEN count(*) FILTER (label = q_label) / room::DOUBLE ELSE 0 END, 6) AS recall,
round(CASE WHEN room > 0 THEN sum(CASE WHEN label = q_label THEN 1 / log2(r + 1) ELSE 0 END) / list_sum(list_transform(range(1, room + 1), lambda i: 1 / log2(i + 1))) ELSE 0 END, 6) AS ndcg
FROM (SELECT q.vec_id AS q, q.label AS q_label, v.label, least((SELECT count(*) FROM embeddings s WHERE s.label = q.label) - 1, 10) AS room,
row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_dot_product(v.embedding[1:{dims}]::DOUBLE[], q.embedding[1:{dims}]::DOUBLE[]), 6) DESC, v.vec_id) AS r
FROM embeddings v JOIN embeddings q ON v.vec_id <> q.vec_id) WHERE r <= 10 GROUP BY q, q_label, room"""


def _rankings(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The measures of every vector as a query, for all dimensions and for the first half."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return [RANK.metrics(RANK.nearest(vectors, vectors, dims, block=200, part=300), vectors.select("vec_id", "label")) for dims in (64, 32)]


@query(f"SELECT 'champion' AS model, * FROM ({_ranked('64')}) UNION ALL SELECT 'challenger', * FROM ({_ranked('32')})")
def shadow_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, other = _rankings(spark, sf_dir)
    return one.select(F.lit("champion").alias("model"), "*").unionByName(other.select(F.lit("challenger").alias("model"), "*"))


@query(f"""WITH d AS (SELECT a.query_id, b.ndcg - a.ndcg AS d FROM ({_ranked('64')}) a JOIN ({_ranked('32')}) b USING (query_id)),
w AS (SELECT r, d, list_sum(list_transform([{", ".join(map(repr, RANK._POISSON))}], lambda p: (('0x' || substr(md5(query_id || ':' || r), 1, 8))::BIGINT / 4294967296.0::DOUBLE >= p)::INT)) AS t FROM d, range(1, 201) x(r)),
m AS (SELECT r, round(sum(t * d) / sum(t), 6) AS m FROM w GROUP BY r), l AS (SELECT list_sort(list(m)) AS l FROM m WHERE m IS NOT NULL)
SELECT (SELECT count(*) FROM d) AS queries, (SELECT round(avg(d), 6) FROM d) AS difference, l[1 + floor(0.025 * (len(l) - 1))::INT] AS low, l[1 + floor(0.975 * (len(l) - 1))::INT] AS high FROM l""")
def shadow_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether half of the dimensions rank worse than all of them, with the interval of 200 resamples of the queries."""
    return RANK.bootstrap(*_rankings(spark, sf_dir))
