"""Rules around finding and naming what belongs together."""

from __future__ import annotations

from functools import reduce
from math import log

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.model import Graph, property_rows, value_rows
from kinfold.session import ensure_checkpoint_dir
from kinfold.skew import checked_broadcast

UNCLASSIFIED = "UNCLASSIFIED"

# Texts to remove per label and property, in this order.
STRIP_RULES = {
    ("GeneOntology_Term", "xrefs"): ["EC:", "skos:exactMatch ", "GO:"],
    ("DRUG", "ids"): ["ChEMBL:"],
    ("PROTEIN", "ids"): ["ChEMBL:"],
    ("DGIdb_Drug", "id"): ["chembl:", "CHEMBL:"],
    ("CMAUP_Ingredient", "chembl_id"): ["CHEMBL:"],
    ("ClinicalTrials.gov_Document", "url"): ["NCT:"],
    ("ClinicalTrials.gov_Trial", "id"): ["NCT:"],
    ("GeneOntology_Typedef", "xrefs"): ["RO:", "BFO:"],
    ("HPO_Typedef", "xrefs"): ["RO:", "BFO:"],
    ("DiseaseOntology_Header", "property_values"): ["IAO:"],
    ("GeneOntology_Header", "property_values"): ["GO:"],
}


def strip_texts(nodes: DataFrame, rules: dict[tuple[str, str], list[str]] = STRIP_RULES) -> DataFrame:
    """Remove texts from property values, scalars and list elements alike; a narrow rewrite.

    The texts that hold for a record and key are gathered into one array, so the
    expression grows with the number of rules and no faster.
    """
    nothing = F.array().cast("array<string>")

    def texts(name: Column) -> Column:
        parts = [
            F.when(F.array_contains("labels", label) & (name == key), F.array(*[F.lit(x) for x in removed])).otherwise(
                nothing
            )
            for (label, key), removed in rules.items()
        ]
        return F.concat(*parts)

    def cleaned(name: Column, prop: Column) -> Column:
        values = F.transform(
            prop["vals"],
            lambda value: F.aggregate(texts(name), value, lambda rest, text: F.replace(rest, text, F.lit(""))),
        )
        return F.struct(prop["dtype"].alias("dtype"), prop["is_list"].alias("is_list"), values.alias("vals"))

    labels = F.array(*[F.lit(label) for label in sorted({label for label, _ in rules})])
    ruled = F.arrays_overlap("labels", labels)
    return nodes.withColumn(
        "props", F.when(ruled, F.transform_values("props", cleaned)).otherwise(F.col("props"))
    )


SKETCH = 256  # hashes of a property's sketch
DOUBT = 1e-9  # chance that a pair above the limit is passed over by its sketches


def property_values(graph: Graph) -> DataFrame:
    """(prop, val), prop being a struct of label and key: one row per property value."""
    return value_rows(graph).select(F.explode("labels").alias("label"), "key", "val").select(F.struct("label", "key").alias("prop"), "val")


def property_sketches(values: DataFrame, size: int = SKETCH) -> DataFrame:
    """(prop, hashes): the ``size`` smallest hashes of a property's different values, ascending.

    Sketches of parts of the data merge into that of the whole by the same rule
    (``merge_sketches``). Only hashes are shuffled, each of a property once a task.
    """
    hashes = values.select("prop", F.xxhash64("val").alias("hash")).distinct()
    return _smallest(hashes, size)


def merge_sketches(*sketches: DataFrame, size: int = SKETCH) -> DataFrame:
    every = reduce(DataFrame.unionByName, sketches)
    return _smallest(every.select("prop", F.explode("hashes").alias("hash")).distinct(), size)


def _smallest(hashes: DataFrame, size: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("prop").orderBy("hash"))
    return hashes.withColumn("nth", nth).filter(F.col("nth") <= size).groupBy("prop").agg(F.array_sort(F.collect_list("hash")).alias("hashes"))


def candidate_pairs(sketches: DataFrame, limit: float, size: int = SKETCH) -> list[tuple]:
    """Pairs of properties that may hold at least ``limit`` of the smaller one's values in common.

    Below the lower of the two highest hashes both sketches are complete samples, so
    the share found there estimates the containment, off by more than Hoeffding's
    bound with chance ``DOUBT``. A pair is passed over only when even that bound lies
    below the limit; small samples rule nothing out. A sketch that is
    not full is the whole property. Rows and their size are bounded by the schema.
    """
    held = [(tuple(row.prop), np.array(row.hashes, np.int64)) for row in sketches.orderBy("prop").collect()]
    full = [len(hashes) >= size for _, hashes in held]
    low = float(-(1 << 63))
    counts = [len(h) if not whole else (size - 1) / max((float(h[-1]) - low) / 2.0**64, 1e-18) for (_, h), whole in zip(held, full)]
    found = []
    for i, (one, first) in enumerate(held):
        for j in range(i + 1, len(held)):
            two, second = held[j]
            top = min([int(h[-1]) for h, whole in ((first, full[i]), (second, full[j])) if whole], default=None)
            a, b = (first, second) if top is None else (first[first <= top], second[second <= top])
            shared = len(np.intersect1d(a, b, assume_unique=True))
            if top is None:  # both are whole
                possible = shared and shared >= limit * min(len(a), len(b))
            else:
                # Which side is the smaller one is itself an estimate, so either may be.
                sides = [own for own, n, other in ((a, counts[i], counts[j]), (b, counts[j], counts[i])) if n <= 2 * other]
                possible = any(shared / max(len(own), 1) + (log(1 / DOUBT) / (2 * max(len(own), 1))) ** 0.5 >= limit for own in sides)
            if possible:
                found.append((one, two))
    return found


def likely_overlap(graph: Graph, limit: float, size: int = SKETCH) -> DataFrame:
    """``property_overlap`` for pairs whose containment is at least ``limit``.

    Sketches name the candidates; only values of properties in a candidate pair are
    shuffled and counted exactly, so what is reported is exact.
    """
    values = property_values(graph)
    pairs = candidate_pairs(property_sketches(values, size), limit, size)
    spark = graph.nodes.sparkSession
    names = sorted({prop for pair in pairs for prop in pair})
    prop = "struct<label:string,key:string>"
    wanted = spark.createDataFrame([(name,) for name in names], f"prop {prop}")
    exact = _overlap(values.join(checked_broadcast(wanted), "prop", "left_semi"), 1)
    listed = spark.createDataFrame([(*one, *two) for one, two in pairs], "label_1 string, key_1 string, label_2 string, key_2 string")
    return exact.join(checked_broadcast(listed), listed.columns, "left_semi").filter(F.col("containment") >= limit)


def property_overlap(graph: Graph, min_shared: int = 1) -> DataFrame:
    """How far the values of two properties overlap, for every pair that shares a value.

    Each distinct value is reduced to the set of properties that hold it, which
    is the one shuffle of values; equal sets are counted, and sizes and pairs
    follow from the few distinct sets. So no pair list per value is ever made. Columns: label_1, key_1, label_2,
    key_2, shared, containment (of the smaller side), jaccard, confidence (1 to
    10) and one shared value as evidence.
    """
    return _overlap(property_values(graph), min_shared)


def _overlap(values: DataFrame, min_shared: int) -> DataFrame:
    ensure_checkpoint_dir(values.sparkSession)
    sets = (
        values.groupBy("val")
        .agg(F.array_sort(F.collect_set("prop")).alias("holders"))  # bounded by the schema
        .groupBy("holders")
        .agg(F.count("*").alias("shared"), F.min("val").alias("evidence"))
        .checkpoint()
    )
    sizes = sets.select(F.explode("holders").alias("prop"), "shared").groupBy("prop").agg(F.sum("shared").alias("n"))
    pairs = (
        sets.filter(F.size("holders") > 1)
        .select(F.posexplode("holders").alias("i", "p1"), "holders", "shared", "evidence")
        .select("p1", F.explode(F.expr("slice(holders, i + 2, size(holders))")).alias("p2"), "shared", "evidence")
        .groupBy("p1", "p2")
        .agg(F.sum("shared").alias("shared"), F.min("evidence").alias("evidence"))
        .filter(F.col("shared") >= min_shared)
    )
    one = sizes.select(F.col("prop").alias("p1"), F.col("n").alias("n1"))
    two = sizes.select(F.col("prop").alias("p2"), F.col("n").alias("n2"))
    containment = F.col("shared") / F.least("n1", "n2")
    return (
        pairs.join(one, "p1")
        .join(two, "p2")
        .select(
            F.col("p1.label").alias("label_1"),
            F.col("p1.key").alias("key_1"),
            F.col("p2.label").alias("label_2"),
            F.col("p2.key").alias("key_2"),
            "shared",
            containment.alias("containment"),
            (F.col("shared") / (F.col("n1") + F.col("n2") - F.col("shared"))).alias("jaccard"),
            F.greatest(F.lit(1), F.ceil(containment * 10)).cast("int").alias("confidence"),
            "evidence",
        )
    )


def flatten_lists(nodes: DataFrame, first: int = 2) -> DataFrame:
    """List properties as scalar ones: (id, key_0, key_1, ..., key_str) in long form (id, key, val)."""
    lists = property_rows(nodes).filter("is_list")
    elements = lists.select(
        "id", "key", F.posexplode(F.slice("vals", 1, first)).alias("pos", "val")
    ).select("id", F.concat("key", F.lit("_"), F.col("pos").cast("string")).alias("key"), "val")
    joined = lists.select(
        "id", F.concat("key", F.lit("_str")).alias("key"), F.array_join("vals", ", ").alias("val")
    )
    return elements.unionByName(joined)


def concept_labels(mapping: DataFrame) -> DataFrame:
    """(label, concept) turned to (concept, label), without unclassified labels."""
    return mapping.filter(F.col("concept") != UNCLASSIFIED).select("concept", "label").distinct()


def classify(labels: DataFrame, examples: DataFrame) -> DataFrame:
    """Concept of each label by an example table (concept, label); null when none lists it."""
    return labels.join(checked_broadcast(examples.select("label", "concept"), settle=True), "label", "left")


def mapping_checks(choices: DataFrame, schema: DataFrame) -> DataFrame:
    """Chosen identifier per label checked against the schema (label, key); faults are flagged, not dropped."""
    schema = checked_broadcast(schema.select("label", "key").distinct(), settle=True)
    known = schema.select("label", F.col("key").alias("property"), F.lit(True).alias("_known"))
    seen = schema.select("label").distinct().withColumn("_seen", F.lit(True))
    message = F.concat(
        F.lit("Warning: '"), F.col("property"), F.lit("' was not found in the schema.")
    )
    return (
        choices.join(known, ["label", "property"], "left")
        .join(seen, "label", "left")
        .withColumn("error", F.when(F.col("_seen") & F.col("_known").isNull(), message))
        .drop("_known", "_seen")
    )


def label_suffixes(labels: DataFrame) -> DataFrame:
    """(suffix, label): source labels grouped by the part after the last underscore."""
    return (
        labels.filter(F.instr("label", "_") > 0)
        .select(F.substring_index("label", "_", -1).alias("suffix"), "label")
        .distinct()
    )


def split_by_decision(candidates: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates (concept) split by decisions (concept, kept, reason) into kept and removed."""
    decided = candidates.join(checked_broadcast(decisions, settle=True), "concept")
    return decided.filter("kept").drop("kept"), decided.filter("NOT kept").drop("kept")
