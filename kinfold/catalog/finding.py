"""Look-ups, score routing, answers in text, discovery rules and the staged run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.catalog import sql
from kinfold.functions import answers
from kinfold.model import Graph, listing, property_rows, props, scalar, vals, value_rows
from kinfold.operators import discover, routing, scan
from kinfold.sources import files, tables
from kinfold.sources.tables import table

# --- look-ups ---------------------------------------------------------------


def find_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan.find(tables.customer_nodes(spark, sf_dir), "Src_Customer", segment="BUILDING", nationkey=3)
    return found.select("id", F.get(vals(F.col("props"), "name"), F.lit(0)).alias("name"))


def node_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.node_labels(tables.table_graph(spark, sf_dir).nodes)


def sample_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan.samples(tables.table_graph(spark, sf_dir).nodes, "Src_Part", 10)
    return found.select("id", F.get(vals(F.col("props"), "name"), F.lit(0)).alias("name"))


def property_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.property_examples(tables.part_nodes(spark, sf_dir), "Src_Part", "name", 5)


def property_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan.property_samples(tables.table_graph(spark, sf_dir).nodes, 5)
    return found.select("label", "key", "id", F.array_join("vals", "|").alias("val"))


def properties_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the customers that placed an urgent order."""
    ids = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(
        tables.node_id("Src_Customer", F.col("o_custkey")).alias("id")
    )
    found = scan.properties_of(tables.customer_nodes(spark, sf_dir), ids)
    return found.select("id", "label", F.explode("props").alias("key", "p")).select(
        "id", "label", "key", F.get("p.vals", F.lit(0)).alias("val")
    )


def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents neither rated nor from a source that failed."""
    documents = table(spark, sf_dir, "documents").select("doc_id")
    rated = table(spark, sf_dir, "labels").select("doc_id")
    failed = table(spark, sf_dir, "documents").filter("source = 'src3'").select("doc_id")
    return scan.pending(documents, rated, failed)


# --- scores -----------------------------------------------------------------


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    return rated.select(
        F.col("source").alias("label"),
        F.col("doc_id").cast("string").alias("key"),
        "doc_id",
        "quality",
        "toxic",
        "lang",
        (F.col("n_chars") % 13).cast("int").alias("score"),
        (F.col("doc_id") * 37 % 101).cast("double").alias("confidence"),
        F.concat(F.lit("lang "), F.col("lang")).alias("reasoning"),
    )


def score_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = _scores(spark, sf_dir).select("label", "key", "score", "confidence", "reasoning")
    return routing.checked_scores(scores)


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scores(spark, sf_dir)
    scores = routing.checked_scores(rows.select("label", "key", "score", "confidence", "reasoning")).drop("faulty")
    research = rows.filter("quality = 1").select(
        "label",
        "key",
        F.when(F.col("doc_id") % 3 > 0, (F.col("doc_id") % 11).cast("int")).alias("research_score"),
        F.when(F.col("doc_id") % 4 > 0, F.lit("researched")).alias("research_reasoning"),
    )
    verdicts = routing.checked_verdicts(
        rows.filter("lang <> 'fr'").select(
            "label",
            "key",
            (F.col("toxic") == 1).alias("justified"),
            F.when(F.col("doc_id") % 2 == 0, (F.col("doc_id") % 12).cast("int")).alias("revised"),
            F.lit("not shown").alias("correction"),
        )
    )
    sample = F.col("key").cast("bigint") % 10 == 0
    return routing.route_scores(scores, research, verdicts, sanity=sample)


def score_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).withColumn("research_score", F.col("research_score").cast("string"))


def score_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.score_export(_routed(spark, sf_dir))


# --- answers in text --------------------------------------------------------


def extract_answer_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties wrapped in text five ways; one of them is no JSON at all."""
    fence = F.lit("```")
    kind = F.col("event_id") % 5
    text = (
        F.when(kind == 0, F.col("props"))
        .when(kind == 1, F.concat(F.lit("Sure:\n"), fence, F.lit("json\n"), "props", F.lit("\n"), fence, F.lit(" {")))
        .when(kind == 2, F.concat(F.lit("random text "), "props", F.lit(" extra text")))
        .when(kind == 3, F.concat(fence, F.lit("\n{broken}\n"), fence))
        .otherwise(F.concat(F.lit("Thought: done\nFinal Answer: "), "props", F.lit("\nbye")))
    )
    found = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return found.select(
        "event_id",
        answers.extract_json(F.col("text")).alias("json"),
        F.get_json_object(answers.final_answer(F.col("text")), "$.k").alias("answer"),
    )


def tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(
        F.lit("Thought: look it up\nAction: "), "event_type", F.lit("( \"id "), F.col("user_id").cast("string"), F.lit("\" )\n")
    )
    text = F.when(F.col("event_id") % 3 == 0, F.lit("no action")).otherwise(text)
    return table(spark, sf_dir, "events").select(
        "event_id", answers.tool_name(text).alias("tool"), answers.tool_argument(text).alias("argument")
    )


# --- discovery rules --------------------------------------------------------


def concept_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("label"),
        F.when(F.col("p_type") == "SMALL", F.lit(discover.UNCLASSIFIED)).otherwise(F.col("p_type")).alias("concept"),
    )
    return discover.concept_labels(mapping)


def _typed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("_"), "event_type").alias("label")
    )


def label_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.label_suffixes(_typed_labels(spark, sf_dir))


def classify_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event labels by an example list made of the suffix groups with few users."""
    suffixes = discover.label_suffixes(_typed_labels(spark, sf_dir).filter("label NOT LIKE '%error'"))
    examples = suffixes.select(F.upper("suffix").alias("concept"), "label")
    return discover.classify(_typed_labels(spark, sf_dir).distinct(), examples)


def mapping_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = property_rows(tables.table_graph(spark, sf_dir).nodes).select(
        F.explode("labels").alias("label"), "key"
    ).distinct()
    choices = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 2 == 0, F.lit("Src_Customer")).otherwise(F.lit("Src_Other")).alias("label"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("name")).otherwise(F.lit("title")).alias("property"),
    )
    return discover.mapping_checks(choices, schema)


def decided_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = table(spark, sf_dir, "part").select(F.col("p_type").alias("concept"), F.col("p_partkey").alias("part"))
    decisions = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("concept")).agg(
        (F.min("p_size") % 2 == 1).alias("kept"), F.min("p_name").alias("reason")
    )
    kept, removed = discover.split_by_decision(candidates, decisions)
    return kept.withColumn("side", F.lit("kept")).unionByName(removed.withColumn("side", F.lit("removed")))


def pending_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of documents that are neither among the toxic nor the low quality ones."""
    rated = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    available = table(spark, sf_dir, "documents").select(F.concat_ws("/", "source", "lang").alias("source")).distinct()
    done = rated.filter("toxic = 1").select(F.concat_ws("/", "source", "lang").alias("source")).distinct()
    failed = rated.filter("quality = 0").select(F.concat_ws("/", "source", "lang").alias("source")).distinct()
    return scan.pending(available, done, failed)


def strip_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = tables.customer_nodes(spark, sf_dir).unionByName(tables.supplier_nodes(spark, sf_dir)).unionByName(
        tables.part_nodes(spark, sf_dir)
    )
    rules = {
        ("Src_Customer", "id"): ["CUST:"],
        ("Src_Customer", "name"): ["Customer", "#0", "0"],
        ("Src_Supplier", "id"): ["SUPP:", "1"],
        ("Src_Part", "words"): ["red", "e"],
    }
    return value_rows(Graph.of(discover.strip_texts(nodes, rules))).select("id", "key", "pos", "val")


def property_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover.property_overlap(tables.table_graph(spark, sf_dir)).select(
        "label_1", "key_1", "label_2", "key_2", "shared", F.round("containment", 9).alias("containment"),
        F.round("jaccard", 9).alias("jaccard"), "evidence",
    )


def likely_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of properties with at least half of the smaller one's values in the other, found by sketches."""
    return discover.likely_overlap(tables.table_graph(spark, sf_dir), 0.5).select(
        "label_1", "key_1", "label_2", "key_2", "shared", F.round("containment", 9).alias("containment"),
        F.round("jaccard", 9).alias("jaccard"), "evidence",
    )


def flatten_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.array(F.lit("Vector")).alias("labels"),
        props(
            sign=listing(F.transform("embedding", lambda x: F.when(x < 0, F.lit("-")).otherwise(F.lit("+")))),
            label=scalar(F.col("label"), "Long"),
        ).alias("props"),
    )
    return discover.flatten_lists(vectors)


QUERIES = {
    "find_nodes": find_nodes,
    "node_labels": node_labels,
    "sample_nodes": sample_nodes,
    "property_examples": property_examples,
    "property_samples": property_samples,
    "properties_of": properties_of,
    "resume_pending": resume_pending,
    "score_checks": score_checks,
    "score_routing": score_routing,
    "score_export": score_export,
    "extract_answer_json": extract_answer_json,
    "tool_calls": tool_calls,
    "concept_labels": concept_labels,
    "label_suffixes": label_suffixes,
    "classify_labels": classify_labels,
    "mapping_checks": mapping_checks,
    "decided_concepts": decided_concepts,
    "pending_sources": pending_sources,
    "strip_prefixes": strip_prefixes,
    "property_overlap": property_overlap,
    "likely_overlap": likely_overlap,
    "flatten_lists": flatten_lists,
}

_RAW_SCORES = """
d AS (SELECT source AS label, CAST(doc_id AS VARCHAR) AS key, doc_id, quality, toxic, lang, CAST(n_chars % 13 AS INTEGER) AS raw_score,
             CAST(doc_id * 37 % 101 AS DOUBLE) AS raw_confidence, 'lang ' || lang AS raw_reasoning
      FROM labels JOIN documents USING (doc_id)),
a AS (SELECT *, NOT (raw_score BETWEEN 0 AND 10 AND raw_confidence BETWEEN 0 AND 100) AS faulty FROM d),
s AS (SELECT label, key, doc_id, quality, toxic, lang, faulty,
             CASE WHEN faulty THEN 5 ELSE raw_score END AS score,
             CASE WHEN faulty THEN 50.0 ELSE raw_confidence END AS confidence,
             CASE WHEN faulty THEN 'Fallback assignment due to an unusable answer' ELSE raw_reasoning END AS reasoning
      FROM a)
"""
_ROUTED = f"""
WITH {_RAW_SCORES},
e AS (SELECT *, confidence < 75 AS escalated FROM s),
f AS (SELECT *, CASE WHEN escalated AND quality = 1 AND doc_id % 3 > 0 THEN CAST(doc_id % 11 AS INTEGER) END AS research_score,
             CASE WHEN escalated AND quality = 1 AND doc_id % 4 > 0 THEN 'researched' END AS research_reasoning FROM e),
b AS (SELECT *, coalesce(research_score, score) AS before_score,
             coalesce(research_reasoning, reasoning) AS before_reasoning FROM f),
j AS (SELECT *, before_score BETWEEN 3 AND 6 OR doc_id % 10 = 0 AS judged FROM b),
w AS (SELECT *, lang <> 'fr' AND NOT (doc_id % 2 = 0 AND doc_id % 12 > 10) AS usable FROM j),
x AS (SELECT *, CASE WHEN judged THEN CASE WHEN usable THEN toxic = 1 ELSE TRUE END END AS justified,
             CASE WHEN judged AND lang <> 'fr' THEN CASE WHEN usable THEN 'not shown'
                  ELSE 'Fallback due to an unusable verdict' END END AS correction FROM w),
z AS (SELECT label, key, score, confidence, reasoning, escalated, research_score, research_reasoning, before_score,
             before_reasoning, judged, justified, correction,
             CASE WHEN judged AND NOT justified AND doc_id % 2 = 0 THEN CAST(doc_id % 12 AS INTEGER)
                  ELSE before_score END AS final_score,
             CASE WHEN judged AND NOT justified THEN before_reasoning || ' | Corrected by Judge: not shown'
                  ELSE before_reasoning END AS final_rationale FROM x)
"""

ORACLES = {
    "find_nodes": f"SELECT {sql.CUSTOMER} AS id, c_name AS name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3",
    "node_labels": f"SELECT DISTINCT label FROM ({sql.NODES})",
    "sample_nodes": f"SELECT {sql.PART} AS id, p_name AS name FROM part ORDER BY 1 LIMIT 10",
    "property_examples": "SELECT DISTINCT p_name AS val FROM part ORDER BY 1 LIMIT 5",
    "property_samples": f"""
WITH v AS (SELECT id, label, key, string_agg(val, '|' ORDER BY pos) AS val FROM ({sql.ALL_VALUES}) GROUP BY id, label, key),
r AS (SELECT *, row_number() OVER (PARTITION BY label, key ORDER BY id) AS n FROM v)
SELECT label, key, id, val FROM r WHERE n <= 5
""",
    "properties_of": f"""
SELECT id, label, key, val FROM ({sql.CUSTOMER_VALUES})
WHERE id IN (SELECT o_custkey * 16 + 1 FROM orders WHERE o_orderpriority = '1-URGENT')
""",
    "resume_pending": """
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND source <> 'src3'
""",
    "score_checks": f"WITH {_RAW_SCORES} SELECT label, key, score, confidence, reasoning, faulty FROM s",
    "score_routing": f"{_ROUTED} SELECT * REPLACE (CAST(research_score AS VARCHAR) AS research_score) FROM z",
    "score_export": f"{_ROUTED} SELECT label, key, final_score AS importance_score, final_rationale AS rationale FROM z",
    "extract_answer_json": """
SELECT event_id, CASE WHEN event_id % 5 = 3 THEN NULL ELSE props END AS json,
       CASE WHEN event_id % 5 = 4 THEN json_extract_string(props, '$.k') END AS answer
FROM events
""",
    "tool_calls": """
SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN event_type END AS tool,
       CASE WHEN event_id % 3 <> 0 THEN 'id ' || user_id END AS argument FROM events
""",
    "concept_labels": "SELECT DISTINCT p_type AS concept, p_name AS label FROM part WHERE p_type <> 'SMALL'",
    "label_suffixes": "SELECT DISTINCT event_type AS suffix, 'U' || user_id || '_' || event_type AS label FROM events",
    "classify_labels": """
SELECT DISTINCT 'U' || user_id || '_' || event_type AS label,
       CASE WHEN event_type <> 'error' THEN upper(event_type) END AS concept FROM events
""",
    "mapping_checks": """
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Src_Customer' ELSE 'Src_Other' END AS label,
       CASE WHEN c_custkey % 3 = 0 THEN 'name' ELSE 'title' END AS property,
       CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 <> 0
            THEN 'Warning: ''title'' was not found in the schema.' END AS error
FROM customer
""",
    "decided_concepts": """
WITH d AS (SELECT p_type AS concept, min(p_size) % 2 = 1 AS kept, min(p_name) AS reason FROM part GROUP BY p_type)
SELECT concept, p_partkey AS part, reason, CASE WHEN kept THEN 'kept' ELSE 'removed' END AS side
FROM part JOIN d ON concept = p_type
""",
    "pending_sources": """
SELECT DISTINCT source || '/' || lang AS source FROM documents
WHERE source || '/' || lang NOT IN (SELECT source || '/' || lang FROM documents JOIN labels USING (doc_id)
                                    WHERE toxic = 1 OR quality = 0)
""",
    "strip_prefixes": f"""
SELECT id, key, pos, CASE label || '.' || key
    WHEN 'Src_Customer.id' THEN replace(val, 'CUST:', '')
    WHEN 'Src_Customer.name' THEN replace(replace(replace(val, 'Customer', ''), '#0', ''), '0', '')
    WHEN 'Src_Supplier.id' THEN replace(replace(val, 'SUPP:', ''), '1', '')
    WHEN 'Src_Part.words' THEN replace(replace(val, 'red', ''), 'e', '')
    ELSE val END AS val
FROM ({sql.CUSTOMER_VALUES} UNION ALL {sql.SUPPLIER_VALUES} UNION ALL {sql.PART_VALUES})
""",
    "property_overlap": f"""
WITH v AS (SELECT DISTINCT label, key, val FROM ({sql.ALL_VALUES})),
n AS (SELECT label, key, count(*) AS n FROM v GROUP BY label, key),
p AS (SELECT a.label AS label_1, a.key AS key_1, b.label AS label_2, b.key AS key_2, count(*) AS shared, min(a.val) AS evidence
      FROM v a JOIN v b ON a.val = b.val AND (a.label, a.key) < (b.label, b.key) GROUP BY ALL)
SELECT label_1, key_1, label_2, key_2, shared, round(shared / least(x.n, y.n), 9) AS containment,
       round(shared / (x.n + y.n - shared), 9) AS jaccard, evidence
FROM p JOIN n x ON x.label = label_1 AND x.key = key_1 JOIN n y ON y.label = label_2 AND y.key = key_2
""",
    "flatten_lists": """
WITH s AS (SELECT vec_id AS id, [CASE WHEN x < 0 THEN '-' ELSE '+' END FOR x IN embedding] AS sign FROM embeddings)
SELECT id, 'sign_0' AS key, sign[1] AS val FROM s
UNION ALL SELECT id, 'sign_1', sign[2] FROM s
UNION ALL SELECT id, 'sign_str', array_to_string(sign, ', ') FROM s
""",
}
ORACLES["likely_overlap"] = f"SELECT * FROM ({ORACLES['property_overlap']}) WHERE containment >= 0.5"
