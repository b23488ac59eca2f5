"""Schema summary and property profile of a graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.functions.names import column_names
from kinfold.functions.values import is_upper_label
from kinfold.model import (
    MAPPED_TO,
    Graph,
    edge_property_rows,
    graph_type,
    maybe,
    no_props,
    plus,
    property_rows,
    props,
    scalar,
)
from kinfold.operators.policy import PROPERTY_LABEL
from kinfold.operators.scan import node_labels, nodes_with_label, property_samples
from kinfold.session import ensure_checkpoint_dir

SHOWN_ELEMENTS = 5
HAS_PROPERTY = "HAS_PROPERTY"

# --- types ------------------------------------------------------------------


def node_signatures(graph: Graph) -> DataFrame:
    """Distinct (labels, key, type); key and type are null for nodes without properties. One pass over the nodes."""
    own = _shapes(graph.nodes, "labels")
    merged = maybe(
        graph.node_values, lambda t: t.select("labels", "key", F.concat("dtype", F.lit("Array")).alias("type"))
    )
    return plus(own, merged).distinct()


def edge_signatures(graph: Graph) -> DataFrame:
    """Distinct (src_labels, rel, dst_labels, key, type), as ``node_signatures``.

    The values of one combined edge are a list when they were one or when there are several.
    """
    ends = ["src_labels", "rel", "dst_labels"]
    own = _shapes(graph.edges, *ends)
    merged = maybe(
        graph.edge_values,
        lambda t: t.groupBy("src", "dst", *ends, "key", "dtype")
        .agg((F.max("is_list") | (F.count("*") > 1)).alias("is_list"))
        .select(*ends, "key", graph_type(F.col("dtype"), F.col("is_list")).alias("type")),
    )
    return plus(own, merged).distinct()


def _shapes(rows: DataFrame, *columns: str) -> DataFrame:
    each = rows.select(*columns, F.explode_outer("props").alias("key", "p"))
    return each.select(*columns, "key", graph_type(F.col("p.dtype"), F.col("p.is_list")).alias("type"))


def _node_types(signatures: DataFrame) -> DataFrame:
    return (
        signatures.filter("key IS NOT NULL")
        .select(F.explode("labels").alias("label"), "key", "type")
        .groupBy("label", "key")
        .agg(F.min("type").alias("type"), F.array_sort(F.collect_set("type")).alias("types"))
    )


def _edge_types(signatures: DataFrame) -> DataFrame:
    return (
        signatures.filter("key IS NOT NULL")
        .groupBy(F.translate("rel", "`:", "").alias("rel"), "key")
        .agg(F.min("type").alias("type"), F.array_sort(F.collect_set("type")).alias("types"))
    )


def _triples(signatures: DataFrame) -> DataFrame:
    return (
        signatures.select("src_labels", "rel", "dst_labels")
        .distinct()
        .select(F.explode("src_labels").alias("start_label"), "rel", "dst_labels")
        .select("start_label", "rel", F.explode("dst_labels").alias("end_label"))
        .distinct()
    )


def node_property_types(graph: Graph) -> DataFrame:
    """(label, key, type, types): all types seen, and the first of them as the reported one."""
    return _node_types(node_signatures(graph))


def edge_property_types(graph: Graph) -> DataFrame:
    """(rel, key, type, types)."""
    return _edge_types(edge_signatures(graph))


def schema_edges(graph: Graph) -> DataFrame:
    """Distinct (start_label, rel, end_label); the end labels sit on the edges, so no join."""
    return _triples(graph.edges)


def property_usage(graph: Graph) -> DataFrame:
    """(key, label, type): labels that use a key; the type is one per key."""
    return _usage(node_property_types(graph))


def _usage(types: DataFrame) -> DataFrame:
    used = types.select("label", "key", "type")
    first = used.groupBy("key").agg(F.min("type").alias("type"))
    return used.select("key", "label").join(first, "key")


def schema_counts(graph: Graph) -> DataFrame:
    """(what, n): node properties, edge properties, schema edges, distinct keys, labels, relations."""
    ensure_checkpoint_dir(graph.nodes.sparkSession)
    # One pass over each table; everything below reads rows as few as the schema.
    node_rows, edge_rows = node_signatures(graph).coalesce(1).checkpoint(), edge_signatures(graph).coalesce(1).checkpoint()
    nodes, edges = _node_types(node_rows), _edge_types(edge_rows)

    def count(what: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n")

    return (
        count("node_properties", nodes)
        .unionByName(count("edge_properties", edges))
        .unionByName(count("schema_edges", _triples(edge_rows)))
        .unionByName(count("property_keys", nodes.select("key").distinct()))
        .unionByName(count("labels", node_labels(node_rows)))
        .unionByName(count("relations", edge_rows.select("rel").distinct()))
    )


def schema_graph(graph: Graph) -> Graph:
    """The schema as a graph: a node per label with key → type, a node per property key.

    Ids come from the label and key texts. Edges are the schema edges with their
    relation's key → type, and ``HAS_PROPERTY`` from label to key.
    """

    def node_id(kind: str, name: Column) -> Column:
        return F.xxhash64(F.lit(kind), name)

    def types_of(rows: DataFrame, owner: str) -> DataFrame:
        """One property map key → type per owner; bounded by the owner's schema."""
        entry = F.struct("key", scalar(F.col("type")).alias("value"))
        return rows.groupBy(owner).agg(F.map_from_entries(F.collect_list(entry)).alias("props"))

    ensure_checkpoint_dir(graph.nodes.sparkSession)
    # One pass over each table; everything below reads rows as few as the schema.
    node_rows, edge_rows = node_signatures(graph).coalesce(1).checkpoint(), edge_signatures(graph).coalesce(1).checkpoint()
    labels = node_labels(node_rows)
    node_types = _node_types(node_rows)
    usage = _usage(node_types)
    label_nodes = labels.join(types_of(node_types, "label"), "label", "left").select(
        node_id("label", F.col("label")).alias("id"),
        F.array("label").alias("labels"),
        F.coalesce("props", no_props()).alias("props"),
    )
    key_nodes = (
        usage.select("key", "type")
        .distinct()
        .select(
            node_id("key", F.col("key")).alias("id"),
            F.array(F.lit(PROPERTY_LABEL)).alias("labels"),
            props(key=scalar(F.col("key")), propertyType=scalar(F.col("type"))).alias("props"),
        )
    )
    triples = _triples(edge_rows).filter("start_label <> '' AND rel <> '' AND end_label <> ''")
    rel_types = types_of(_edge_types(edge_rows), "rel")
    label_edges = (
        triples.withColumn("clean", F.translate("rel", "`:", ""))
        .join(rel_types.withColumnRenamed("rel", "clean"), "clean", "left")
        .select(
            node_id("label", F.col("start_label")).alias("src"),
            F.array("start_label").alias("src_labels"),
            node_id("label", F.col("end_label")).alias("dst"),
            F.array("end_label").alias("dst_labels"),
            "rel",
            F.coalesce("props", no_props()).alias("props"),
        )
    )
    key_edges = usage.select(
        node_id("label", F.col("label")).alias("src"),
        F.array("label").alias("src_labels"),
        node_id("key", F.col("key")).alias("dst"),
        F.array(F.lit(PROPERTY_LABEL)).alias("dst_labels"),
        F.lit(HAS_PROPERTY).alias("rel"),
        no_props().alias("props"),
    )
    # Readers look at these few rows again and again.
    return Graph.of(
        label_nodes.unionByName(key_nodes).coalesce(1).checkpoint(), label_edges.unionByName(key_edges).coalesce(1).checkpoint()
    )


# --- profile ----------------------------------------------------------------


def shown_values(graph: Graph, limit: int = 5) -> DataFrame:
    """The first ``limit`` nodes by id per (label, key), with up to one value more than is shown.

    Columns: label, key, id, n (place), dtype, is_list, vals.
    """
    own = property_samples(graph.nodes, limit).select(
        "label", "key", "id", "dtype", "is_list", F.slice("vals", 1, SHOWN_ELEMENTS + 1).alias("vals")
    )
    if graph.node_values is None:
        return own.withColumn("n", F.row_number().over(Window.partitionBy("label", "key").orderBy("id")))
    # Merged values: pick the nodes first, then the few values of those.
    holders = graph.node_values.select(F.explode("labels").alias("label"), "key", "id").distinct()
    by_id = Window.partitionBy("label", "key").orderBy("id")
    picked = holders.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= limit).drop("n")
    by_value = Window.partitionBy("id", "key").orderBy(F.coalesce("pos", F.lit(0)), "val", "dtype")
    values = (
        graph.node_values.join(picked.select("id", "key").distinct(), ["id", "key"], "left_semi")
        .select("id", "key", "dtype", "val", F.row_number().over(by_value).alias("v"))
        .filter(F.col("v") <= SHOWN_ELEMENTS + 1)
        .groupBy("id", "key")
        .agg(
            F.min("dtype").alias("dtype"),
            F.transform(F.array_sort(F.collect_list(F.struct("v", "val"))), lambda e: e["val"]).alias("vals"),
        )
    )
    merged = picked.join(values, ["id", "key"]).select(
        "label", "key", "id", "dtype", F.lit(True).alias("is_list"), "vals"
    )
    both = own.unionByName(merged)
    return both.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= limit)


def sample_text(dtype: Column, is_list: Column, values: Column) -> Column:
    """A value as shown in a profile; a list is cut to five elements and ends in ``...``."""
    quoted = F.transform(
        F.slice(values, 1, SHOWN_ELEMENTS),
        lambda v: F.when(dtype == "String", F.concat(F.lit("'"), v, F.lit("'"))).otherwise(v),
    )
    end = F.when(F.size(values) > SHOWN_ELEMENTS, F.lit(", ...]")).otherwise(F.lit("]"))
    text = F.concat(F.lit("["), F.array_join(quoted, ", "), end)
    return F.when(is_list, text).otherwise(F.get(values, F.lit(0)))


def property_profile(
    graph: Graph, limit: int = 5, concept_only: bool = False, keys: DataFrame | None = None
) -> DataFrame:
    """(label, key, type, n, sample): reported type and first samples by node id.

    ``keys`` (column ``key``) is an allow-list. A key whose values are all
    missing has one row without a sample.
    """
    types = node_property_types(graph).select("label", "key", "type")
    shown = shown_values(graph, limit).select(
        "label", "key", "n", sample_text(F.col("dtype"), F.col("is_list"), F.col("vals")).alias("sample")
    )
    profile = types.join(shown, ["label", "key"], "left")
    if concept_only:
        profile = profile.filter(is_upper_label(F.col("label")))
    if keys is not None:
        profile = profile.join(keys.select("key"), "key", "left_semi")
    return profile.select("label", "key", "type", "n", "sample")


def sample_types(graph: Graph, limit: int = 5) -> DataFrame:
    """(label, key, data_type): kind of the first sample, ``Unknown`` without one."""
    first = shown_values(graph, limit).filter("n = 1")
    # Names of the kinds.
    kind = (
        F.when(F.col("is_list"), "List")
        .when(F.col("dtype") == "Boolean", "Boolean")
        .when(F.col("dtype") == "Long", "Integer")
        .when(F.col("dtype") == "Double", "Float")
        .when(F.col("dtype") == "String", "String")
        .when(F.col("dtype") == "Map", "Map")
        .otherwise(F.col("dtype"))
    )
    known = first.select("label", "key", kind.alias("data_type"))
    keys = node_property_types(graph).select("label", "key")
    return keys.join(known, ["label", "key"], "left").select(
        "label", "key", F.coalesce("data_type", F.lit("Unknown")).alias("data_type")
    )


def local_connections(graph: Graph, limit: int = 30) -> DataFrame:
    """(label, direction, connection): up to ``limit`` distinct neighbours per label and direction."""
    edges = schema_edges(graph)
    outgoing = edges.select(
        F.col("start_label").alias("label"), F.lit("out").alias("direction"), "rel", F.col("end_label").alias("other")
    )
    incoming = edges.select(
        F.col("end_label").alias("label"), F.lit("in").alias("direction"), "rel", F.col("start_label").alias("other")
    )
    order = Window.partitionBy("label", "direction").orderBy("rel", "other")
    text = F.when(
        F.col("direction") == "out",
        F.format_string("(:`%s`)-[:`%s`]->(:`%s`)", "label", "rel", "other"),
    ).otherwise(F.format_string("(:`%s`)-[:`%s`]->(:`%s`)", "other", "rel", "label"))
    return (
        outgoing.unionByName(incoming)
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= limit)
        .select("label", "direction", text.alias("connection"))
    )


def property_metadata(graph: Graph, limit: int = 5) -> DataFrame:
    """(label, key, data_type, samples, connections): one record per property; lists are short by their limits."""
    shown = (
        shown_values(graph, limit)
        .withColumn("sample", sample_text(F.col("dtype"), F.col("is_list"), F.col("vals")))
        .groupBy("label", "key")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "sample"))), lambda e: e["sample"]).alias("samples"))
    )
    links = local_connections(graph).groupBy("label").agg(
        F.array_sort(F.collect_list("connection")).alias("connections")
    )
    return sample_types(graph, limit).join(shown, ["label", "key"], "left").join(links, "label", "left")


def unmapped_nodes(graph: Graph) -> DataFrame:
    """Nodes with no mapping edge at either end."""
    mapped = graph.edges.filter(F.col("rel") == MAPPED_TO)
    ends = mapped.select(F.col("src").alias("id")).unionByName(mapped.select(F.col("dst").alias("id"))).distinct()
    return graph.nodes.join(ends, "id", "left_anti")


def unmapped_labels(graph: Graph) -> DataFrame:
    """Distinct label sets that have unmapped nodes."""
    return unmapped_nodes(graph).select("labels").distinct()


# --- declared schema --------------------------------------------------------

# Graph type and declared Spark type; any other type stays text.
DECLARED = {
    "String": T.StringType(),
    "Long": T.LongType(),
    "Double": T.DoubleType(),
    "Boolean": T.BooleanType(),
    "Date": T.DateType(),
    "DateTime": T.TimestampType(),
    "LocalTime": T.StringType(),
    "StringArray": T.ArrayType(T.StringType()),
    "LongArray": T.ArrayType(T.LongType()),
    "DoubleArray": T.ArrayType(T.DoubleType()),
    "BooleanArray": T.ArrayType(T.BooleanType()),
}


def catalogue(graph: Graph) -> DataFrame:
    """(label, key, declared): the type when there is one only, else ``Any``."""
    known = F.col("type").isin(*DECLARED)
    return node_property_types(graph).select(
        "label", "key", F.when((F.size("types") == 1) & known, F.col("type")).otherwise("Any").alias("declared")
    )


def wide_view(graph: Graph, label: str) -> DataFrame:
    """Records of one label with a typed column per own property, under safe names.

    Only the catalogue of the label comes to the driver. ``Any`` columns hold the
    values as a string array.
    """
    known = catalogue(Graph.of(nodes_with_label(graph.nodes, label))).filter(F.col("label") == label)
    keys = known.join(column_names(known), ["label", "key"]).orderBy("key").collect()
    columns = []
    for row in keys:
        values = F.try_element_at("props", F.lit(row["key"]))["vals"]
        declared = DECLARED.get(row["declared"])
        if declared is None:
            column = values
        elif isinstance(declared, T.ArrayType):
            column = values.cast(declared)
        else:
            column = F.get(values, F.lit(0)).cast(declared)
        columns.append(column.alias(row["column"]))
    return nodes_with_label(graph.nodes, label).select("id", *columns)
