"""Value rules, clustering, concept nodes and value links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.catalog import sql
from kinfold.functions.values import is_valid, strip
from kinfold.model import Graph, listing, props, scalar, vals
from kinfold.operators import incremental, link, resolve
from kinfold.operators.link import EdgeDefinition
from kinfold.operators.resolve import Blueprint
from kinfold.sources import tables
from kinfold.sources.tables import node_id, table


def valid_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 6
    value = (
        F.when(kind == 0, F.lit(" N/A "))
        .when(kind == 1, F.lit("None"))
        .when(kind == 2, F.lit("\t"))
        .when(kind == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" "), F.col("event_type")))
    )
    events = table(spark, sf_dir, "events").select("event_id", value.alias("val"))
    return events.filter(is_valid(F.col("val"))).select("event_id", "val", F.lower(strip(F.col("val"))).alias("clean"))


# --- clustering -------------------------------------------------------------


def grouped_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        node_id("Src_Customer", key).alias("id"),
        F.array(F.lit("Src_Customer")).alias("labels"),
        props(
            a=scalar(F.concat(F.lit("a"), F.floor(key / 3).cast("string"))),
            b=scalar(F.concat(F.lit("b"), F.floor((key + 1) / 4).cast("string"))),
        ).alias("props"),
    )


GROUP = Blueprint("GROUP", {"a": ("Src_Customer", "a"), "b": ("Src_Customer", "b")})
TEXT = Blueprint(
    "TEXT", {"whole": ("Src_Document", "text_md5"), "letters": ("Src_Document", "letters_md5")}
)


def _components(nodes: DataFrame, blueprint: Blueprint) -> DataFrame:
    return resolve.build_concepts(nodes, [blueprint]).members.select("id", "concept", "universal_id")


def entity_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _components(grouped_customers(spark, sf_dir), GROUP)


def text_entity_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _components(tables.document_nodes(spark, sf_dir), TEXT)


def component_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    concepts = resolve.build_concepts(grouped_customers(spark, sf_dir), [GROUP])
    return concepts.identifiers.select("concept_id", "key", "val")


# --- concepts ---------------------------------------------------------------


def name_number(value: Column) -> Column:
    return F.split_part(value, F.lit("#"), F.lit(2))


PARTNERS = [
    Blueprint(
        "PARTNER",
        {"customers": ("Src_Customer", "name"), "suppliers": ("Src_Supplier", "name")},
        {"customers": name_number, "suppliers": name_number},
    ),
    Blueprint("DISTRICT", {"customers": ("Src_Customer", "nationkey"), "suppliers": ("Src_Supplier", "nationkey")}),
]


def _integrated(spark: SparkSession, sf_dir: str) -> Graph:
    nodes = tables.customer_nodes(spark, sf_dir).unionByName(tables.supplier_nodes(spark, sf_dir))
    return resolve.integrate(Graph.of(nodes), PARTNERS)


def concept_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = _integrated(spark, sf_dir)
    own = graph.nodes.filter("id < 0").select(
        "id",
        F.get("labels", F.lit(0)).alias("label"),
        F.get(vals(F.col("props"), "universal_id"), F.lit(0)).alias("universal_id"),
        F.get(vals(F.col("props"), "mapped"), F.lit(0)).alias("mapped"),
    )
    return own.join(graph.node_values.select("id", "key", "val"), "id")


def concept_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _integrated(spark, sf_dir).edges.select(
        "src", F.get("src_labels", F.lit(0)).alias("src_label"), "rel", "dst", F.get("dst_labels", F.lit(0)).alias("dst_label")
    )


def concept_reruns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blueprints in two calls, the second one first and the first one twice: ids do not depend on it."""
    nodes = tables.customer_nodes(spark, sf_dir).unionByName(tables.supplier_nodes(spark, sf_dir))
    graph = Graph.of(nodes)
    for blueprint in (PARTNERS[1], PARTNERS[0], PARTNERS[0]):
        graph = resolve.integrate(graph, [blueprint])
    own = graph.nodes.filter("id < 0").select("id", F.get("labels", F.lit(0)).alias("label"))
    return own.join(graph.edges.select(F.col("dst").alias("id"), "src"), "id", "left")


def _first_digits(value: Column) -> Column:
    """Number of a customer name without its leading zeros; null for every tenth."""
    number = F.regexp_extract(value, "0*([0-9]+)$", 1)
    return F.when(~number.endswith("0"), number)


HOOKED = Blueprint(
    "HOOKED",
    {"customers": ("Src_Customer", "name"), "suppliers": ("Src_Supplier", "name")},
    standardise={"customers": lambda value: F.left(value, F.lit(2)), "suppliers": lambda value: F.left(name_number(value), F.lit(2))},
    preprocess={"customers": _first_digits},
    integrate=lambda raw: F.array(F.min(raw), F.max(raw)),
)


def hooked_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A blueprint with all three hooks, beside one without any."""
    nodes = tables.customer_nodes(spark, sf_dir).unionByName(tables.supplier_nodes(spark, sf_dir))
    concepts = resolve.build_concepts(nodes, [HOOKED, PARTNERS[1]])
    return concepts.merged_ids.select("concept", "concept_id", "val")


# The labels of the shipped blueprints; each stands for all suppliers.
SHIPPED = sorted({label for blueprint in resolve.BLUEPRINTS for label, _ in blueprint.fields.values()})


def shipped_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All shipped blueprints in one run: a record of each label per supplier, its properties shared with neighbours."""
    suppliers = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("bigint")
    nodes = []
    for place, label in enumerate(SHIPPED):
        keys = sorted({prop for blueprint in resolve.BLUEPRINTS for own, prop in blueprint.fields.values() if own == label})
        properties = {prop: scalar(F.concat(F.lit("v"), F.floor(key / (3 + nth)).cast("string"))) for nth, prop in enumerate(keys)}
        nodes.append(suppliers.select((key * 32 + place).alias("id"), F.array(F.lit(label)).alias("labels"), props(**properties).alias("props")))
    graph = resolve.integrate(Graph.of(reduce(DataFrame.unionByName, nodes)))
    return graph.edges.select("src", "dst", F.get("dst_labels", F.lit(0)).alias("concept"))


def concept_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Concepts of the suppliers first; the customers come later and are added to them."""
    suppliers, customers = tables.supplier_nodes(spark, sf_dir), tables.customer_nodes(spark, sf_dir)
    state = incremental.start(suppliers, PARTNERS)
    graph, state = incremental.integrate_more(Graph.of(suppliers.filter("false")), state, suppliers, PARTNERS)
    graph, _ = incremental.integrate_more(graph, state, customers, PARTNERS)
    mapped = graph.edges.select(F.col("dst").alias("id"), F.lit("member").alias("key"), F.col("src").cast("string").alias("val"))
    own = graph.nodes.filter("id < 0").select("id", F.get("labels", F.lit(0)).alias("label"))
    return own.join(graph.node_values.select("id", "key", "val").unionByName(mapped), "id")


def drop_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    graph = resolve.drop_label(tables.table_graph(spark, sf_dir), "Src_Part")
    nodes = graph.nodes.groupBy(F.get("labels", F.lit(0)).alias("name")).agg(F.count("*").alias("n"))
    edges = graph.edges.groupBy(F.col("rel").alias("name")).agg(F.count("*").alias("n"))
    return nodes.unionByName(edges)


# --- links ------------------------------------------------------------------


def _edge_rows(edges: DataFrame) -> DataFrame:
    return edges.select(
        "src", "dst", "rel", *[F.get(vals(F.col("props"), key), F.lit(0)).alias(key) for key in ("shared_value", "source_property", "target_property")]
    )


SAME_NUMBER = EdgeDefinition(
    "Src_Supplier", "name", "Src_Customer", "name", "SAME_NUMBER", name_number, name_number
)
SAME_NATION = EdgeDefinition("Src_Supplier", "nationkey", "Src_Customer", "nationkey", "SAME_NATION")


def _partners(spark: SparkSession, sf_dir: str) -> Graph:
    return Graph.of(tables.customer_nodes(spark, sf_dir).unionByName(tables.supplier_nodes(spark, sf_dir)))


def value_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edge_rows(link.value_links(_partners(spark, sf_dir), SAME_NUMBER))


def value_link_hubs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All links by nation key in factored form: the members of each shared key."""
    members = link.link_members(_partners(spark, sf_dir), SAME_NATION)
    return members.select("definition", "rel", "hub", "side", "id", F.get("labels", F.lit(0)).alias("label"))


def pmid_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, order = F.col("event_id"), F.col("o_orderkey")
    sources = table(spark, sf_dir, "events").select(
        (event * 16 + 13).alias("id"),
        F.array(F.lit(link.REFERENCES.source_label)).alias("labels"),
        props(pubmed_ids=scalar(F.concat(F.col("user_id").cast("string"), F.lit(".0")))).alias("props"),
    )
    targets = table(spark, sf_dir, "orders").select(
        (order * 16 + 14).alias("id"),
        F.array(F.lit(link.REFERENCES.target_label)).alias("labels"),
        props(merged_ids=listing(F.array(F.concat(F.lit("PMID:"), order.cast("string")), F.lit("n/a")))).alias("props"),
    )
    return _edge_rows(link.value_links(Graph.of(sources.unionByName(targets)), link.REFERENCES))


def ontology_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = F.col("c_custkey"), F.col("s_suppkey")

    def doid(number: Column) -> Column:
        return F.concat(F.lit("DOID:"), number.cast("string"))

    sources = table(spark, sf_dir, "customer").select(
        (customer * 16 + 15).alias("id"),
        F.array(F.lit(link.HAS_ONTOLOGY.source_label)).alias("labels"),
        props(ids=listing(F.array(doid(customer), doid(customer + 1)))).alias("props"),
    )
    targets = table(spark, sf_dir, "supplier").select(
        (supplier * 16).alias("id"),
        F.array(F.lit(link.HAS_ONTOLOGY.target_label)).alias("labels"),
        props(id=scalar(doid(supplier * 3))).alias("props"),
    )
    graph = link.link(link.link(Graph.of(sources.unionByName(targets)), link.HAS_ONTOLOGY), link.HAS_ONTOLOGY)
    return _edge_rows(graph.edges)


QUERIES = {
    "valid_values": valid_values,
    "entity_components": entity_components,
    "text_entity_components": text_entity_components,
    "component_identifiers": component_identifiers,
    "concept_nodes": concept_nodes,
    "concept_mappings": concept_mappings,
    "concept_reruns": concept_reruns,
    "concept_growth": concept_growth,
    "hooked_concepts": hooked_concepts,
    "shipped_concepts": shipped_concepts,
    "drop_label": drop_label,
    "value_links": value_links,
    "value_link_hubs": value_link_hubs,
    "pmid_links": pmid_links,
    "ontology_links": ontology_links,
}


def _reach(members: str) -> str:
    """CTEs up to ``c(id, root)``: the smallest record reachable through shared values."""
    return f"""
p AS ({members}),
e AS (SELECT DISTINCT a.id AS x, b.id AS y FROM p a JOIN p b USING (val)),
r AS (SELECT DISTINCT id AS x, id AS y FROM p UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y),
c AS (SELECT x AS id, min(y) AS root FROM r GROUP BY x)
"""


_GROUPS = (
    f"SELECT {sql.CUSTOMER} AS id, 'a' AS key, 'a' || (c_custkey // 3) AS val FROM customer "
    f"UNION ALL SELECT {sql.CUSTOMER}, 'b', 'b' || ((c_custkey + 1) // 4) FROM customer"
)
_TEXTS = (
    f"SELECT {sql.DOCUMENT} AS id, md5(text) AS val FROM documents "
    f"UNION ALL SELECT {sql.DOCUMENT}, md5('letters ' || regexp_replace(lower(text), '[^a-z]', '', 'g')) FROM documents"
)
# Concept nodes: cluster roots of the two blueprints and the raw values per cluster.
_CONCEPTS = f"""
p AS (SELECT {sql.CUSTOMER} AS id, 'Src_Customer' AS label, c_name AS name, c_nationkey AS nation FROM customer
      UNION ALL SELECT {sql.SUPPLIER}, 'Src_Supplier', s_name, s_nationkey FROM supplier),
v AS (SELECT id, label, 'PARTNER' AS concept, 0 AS ord, split_part(name, '#', 2) AS std, name AS raw FROM p
      UNION ALL SELECT id, label, 'DISTRICT', 1, CAST(nation AS VARCHAR), CAST(nation AS VARCHAR) FROM p),
g AS (SELECT *, min(id) OVER (PARTITION BY concept, std) AS root FROM v),
k AS (SELECT *, {sql.concept_id("concept || ':' || root")} AS concept_id, sha256(concept || ':' || root) AS universal_id FROM g)
"""

_SHIPPED = " UNION ALL ".join(
    f"SELECT CAST(s_suppkey AS BIGINT) * 32 + {SHIPPED.index(label)} AS id, '{blueprint.concept}' AS concept, 'v' || (s_suppkey // {3 + keys.index(prop)}) AS val FROM supplier"
    for blueprint in resolve.BLUEPRINTS
    for label, prop in blueprint.fields.values()
    for keys in [sorted({p for b in resolve.BLUEPRINTS for own, p in b.fields.values() if own == label})]
)

ORACLES = {
    "hooked_concepts": f"""
WITH {_CONCEPTS.strip()},
raws AS (SELECT {sql.CUSTOMER} AS id, CASE WHEN c_custkey % 10 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS raw FROM customer),
h AS (SELECT id, raw, substr(raw, 1, 2) AS std FROM raws WHERE raw IS NOT NULL
      UNION ALL SELECT {sql.SUPPLIER}, s_name, substr(split_part(s_name, '#', 2), 1, 2) FROM supplier),
hr AS (SELECT *, min(id) OVER (PARTITION BY std) AS root FROM h),
hm AS (SELECT {sql.concept_id("'HOOKED:' || root")} AS concept_id, min(raw) AS low, max(raw) AS high FROM hr GROUP BY root)
SELECT DISTINCT 'HOOKED' AS concept, concept_id, unnest([low, high]) AS val FROM hm
UNION ALL SELECT DISTINCT concept, concept_id, raw FROM k WHERE concept = 'DISTRICT'
""",
    "shipped_concepts": f"""
WITH RECURSIVE all_rows AS ({_SHIPPED}),
p AS (SELECT DISTINCT concept || ':' || id AS id, concept || ' ' || val AS val FROM all_rows),
vals AS (SELECT val, row_number() OVER (ORDER BY val) AS n FROM (SELECT DISTINCT val FROM p)),
near AS (SELECT DISTINCT a.n AS x, b.n AS y FROM p JOIN vals a USING (val) JOIN p q ON q.id = p.id JOIN vals b ON b.val = q.val),
reach AS (SELECT n AS x, n AS y FROM vals UNION SELECT reach.x, near.y FROM reach JOIN near ON near.x = reach.y),
least AS (SELECT x, min(y) AS component FROM reach GROUP BY x),
c AS (SELECT DISTINCT split_part(p.id, ':', 1) AS concept, CAST(split_part(p.id, ':', 2) AS BIGINT) AS id, component
      FROM p JOIN vals USING (val) JOIN least ON least.x = vals.n),
r AS (SELECT *, min(id) OVER (PARTITION BY concept, component) AS root FROM c)
SELECT id AS src, {sql.concept_id("concept || ':' || root")} AS dst, concept FROM r
""",
    "valid_values": """
WITH v AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN ' N/A ' WHEN 1 THEN 'None' WHEN 2 THEN chr(9)
                  WHEN 3 THEN NULL ELSE ' ' || event_type END AS val FROM events)
SELECT event_id, val, lower(trim(val, chr(9) || ' ')) AS clean FROM v
WHERE val IS NOT NULL AND lower(trim(val, chr(9) || ' ')) NOT IN ('none', 'null', 'unknown', 'na', 'n/a', '')
""",
    "entity_components": f"""
WITH RECURSIVE {_reach(_GROUPS)}
SELECT id, 'GROUP' AS concept, sha256('GROUP:' || root) AS universal_id FROM c
""",
    "text_entity_components": f"""
WITH RECURSIVE {_reach(_TEXTS)}
SELECT id, 'TEXT' AS concept, sha256('TEXT:' || root) AS universal_id FROM c
""",
    "component_identifiers": f"""
WITH RECURSIVE {_reach(_GROUPS)}
SELECT DISTINCT {sql.concept_id("'GROUP:' || root")} AS concept_id, key, val FROM p JOIN c USING (id)
""",
    "concept_nodes": f"""
WITH {_CONCEPTS}
SELECT DISTINCT concept_id AS id, concept AS label, universal_id, 'true' AS mapped, 'merged_ids' AS key, raw AS val FROM k
""",
    "concept_mappings": f"""
WITH {_CONCEPTS}
SELECT id AS src, label AS src_label, 'MAPPED_TO' AS rel, concept_id AS dst, concept AS dst_label FROM k
""",
    "concept_growth": f"""
WITH {_CONCEPTS}
SELECT DISTINCT concept_id AS id, concept AS label, 'merged_ids' AS key, raw AS val FROM k
UNION ALL SELECT concept_id, concept, 'member', CAST(id AS VARCHAR) FROM k
""",
    "concept_reruns": f"""
WITH {_CONCEPTS}
SELECT DISTINCT concept_id AS id, concept AS label, id AS src FROM k
""",
    "drop_label": f"""
WITH n AS ({sql.NODES}), e AS ({sql.EDGES})
SELECT label AS name, count(*) AS n FROM n WHERE label <> 'Src_Part' GROUP BY label
UNION ALL
SELECT rel, count(*) FROM e WHERE src_label <> 'Src_Part' AND dst_label <> 'Src_Part' GROUP BY rel
""",
    "value_links": f"""
SELECT {sql.SUPPLIER} AS src, {sql.CUSTOMER} AS dst, 'SAME_NUMBER' AS rel, split_part(s_name, '#', 2) AS shared_value,
       'name' AS source_property, 'name' AS target_property
FROM supplier JOIN customer ON split_part(s_name, '#', 2) = split_part(c_name, '#', 2)
""",
    "value_link_hubs": f"""
WITH both_sides AS (SELECT s_nationkey AS k FROM supplier INTERSECT SELECT c_nationkey FROM customer),
m AS (SELECT s_nationkey AS k, 'src' AS side, {sql.SUPPLIER} AS id, 'Src_Supplier' AS label FROM supplier
      UNION ALL SELECT c_nationkey, 'dst', {sql.CUSTOMER}, 'Src_Customer' FROM customer)
SELECT 'Src_Supplier|nationkey|Src_Customer|nationkey' AS definition, 'SAME_NATION' AS rel, CAST(k AS VARCHAR) AS hub,
       side, id, label FROM m JOIN both_sides USING (k)
""",
    "pmid_links": """
SELECT event_id * 16 + 13 AS src, o_orderkey * 16 + 14 AS dst, 'REFERENCES' AS rel, 'PMID:' || user_id AS shared_value,
       'pubmed_ids' AS source_property, 'merged_ids' AS target_property
FROM events JOIN orders ON o_orderkey = user_id
""",
    "ontology_links": """
SELECT c_custkey * 16 + 15 AS src, s_suppkey * 16 AS dst, 'HAS_ONTOLOGY' AS rel, 'DOID:' || s_suppkey * 3 AS shared_value,
       'ids' AS source_property, 'id' AS target_property
FROM customer JOIN supplier ON s_suppkey * 3 IN (c_custkey, c_custkey + 1)
""",
}
