"""Secrets, and weak parts of credentials that only count together (operator 8). DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.components import settled

NAMES = "password|passwd|secret|token|api_?key"
ASSIGN = rf"""((?i:{NAMES}))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Weak parts: on their own they are ordinary text.
IDENTIFIER = r"""(?i:client|access|account|user)[_-]?(?i:key[_-]?)?(?i:id|name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{4,}"""
KEY = r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/]{0,39}[0-9])(?=[a-z0-9+/]{0,39}[A-Z])(?=[A-Z0-9+/]{0,39}[a-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
ENDPOINT = r"(?i:https?|s3|postgres|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:@%/?#=&+-]+"
#: kind: pattern, role; base kinds first, in the order in which spans of one start are listed.
KINDS = {
    "assign": (ASSIGN, "secret"),
    "access": (r"AKIA[A-Z0-9]+", "identifier"),
    "hex": (r"[0-9a-f]{32,}", "secret"),
    "identifier": (IDENTIFIER, "identifier"),
    "key": (KEY, "secret"),
    "endpoint": (ENDPOINT, "endpoint"),
}
BASE = ("assign", "access", "hex")
ANY = rf"(?i:{NAMES})|AKIA[A-Z0-9]|[0-9a-f]{{32}}|://|(?i:id|name)[\"']?\x20*[:=]|(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{{40}}"
SCOPE = 256  # code points between parts that belong together
MASK = "[secret]"


def _valid() -> Column:
    """Whether a hit is long enough; a hit that fails is dropped, and what it covered is not searched again."""
    value = F.length(F.regexp_extract("hit", ASSIGN, 2))
    length = F.length("hit")
    return F.when(F.col("kind") == "assign", value >= 8).when(F.col("kind") == "access", length >= 16).otherwise(True)


def _digested(docs: DataFrame, text: str) -> DataFrame:
    """``_all`` (the row), ``_text`` and ``_digest``, the text's SHA-256 where a part may be in it, else null."""
    value = F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")
    return docs.select(F.struct("*").alias("_all"), value).withColumn(
        "_digest", F.when(F.col("_text").rlike(ANY), F.sha2("_text", 256))
    )


def _hits(kind: str, pattern: str) -> Column:
    """Every match with the length of the stretch before it."""
    gaps = F.transform(F.split("_text", pattern, -1), F.length)
    hits = F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"))
    return F.transform(zipped, lambda at: F.struct(F.lit(kind).alias("kind"), at["gap"].alias("gap"), at["hit"].alias("hit")))


def find_parts(texts: DataFrame) -> DataFrame:
    """``_digest``, ``kind``, ``start``, ``end`` (code points) of all parts, once per distinct text.

    Leftmost matches without overlap, per kind. The places come from the lengths
    of the stretches between matches, summed along the text. Copies of a text
    meet in a partial aggregate, so a text in a third of all rows costs one.
    """
    per_kind = [_hits(kind, pattern) for kind, (pattern, _) in KINDS.items()]
    rows = texts.select("_digest", F.explode(F.array(*per_kind)).alias("own")).select("_digest", F.posexplode("own").alias("nth", "at"))
    hits = rows.select("_digest", "nth", "at.*").filter("hit is not null").distinct()
    along = Window.partitionBy("_digest", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    placed = hits.withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(along))
    return placed.filter(_valid()).select("_digest", "kind", (F.col("end") - F.length("hit")).alias("start"), "end")


def link_parts(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Base parts, and both weak parts of every complementary pair within ``scope``.

    Two parts are complementary if their roles differ. A pair counts if one of
    them is a secret or a base part: a key with an endpoint or an identifier, an
    endpoint with a secret or an access key, an identifier with a secret. An
    identifier of the weak kind with an endpoint (a user name beside a web address) is
    ordinary text, and neither is reported for it.
    The interval join runs over buckets of ``scope`` code points: a part is
    looked up in each bucket that its scope touches. Parts of one kind do not
    overlap, so a bucket never holds more than a bounded number of parts.
    """
    role = F.element_at(F.create_map(*(F.lit(x) for kind, (_, role) in KINDS.items() for x in (kind, role))), F.col("kind"))
    parts = settled(parts.withColumn("role", role).withColumn("base", F.col("kind").isin(*BASE)))
    bucket = lambda place: F.floor(place / scope)
    held = parts.select(
        "_digest",
        F.explode(F.sequence(bucket(F.col("start")), bucket(F.col("end")))).alias("bucket"),
        F.col("role").alias("other_role"),
        F.col("base").alias("other_base"),
        F.col("start").alias("other_start"),
        F.col("end").alias("other_end"),
    )
    wanted = parts.filter("not base").withColumn("bucket", F.explode(F.sequence(bucket(F.col("start") - scope), bucket(F.col("end") + scope))))
    near = (F.col("other_start") <= F.col("end") + scope) & (F.col("other_end") >= F.col("start") - scope)
    counts = (F.col("role") == "secret") | (F.col("other_role") == "secret") | F.col("other_base")
    linked = wanted.join(held, ["_digest", "bucket"]).filter(near & (F.col("role") != F.col("other_role")) & counts)
    linked = linked.select("_digest", "kind", "start", "end").distinct()
    return parts.filter("base").select("_digest", "kind", "start", "end").unionByName(linked)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _per_text(marked: DataFrame, scope: int) -> DataFrame:
    """Per digest of the ``marked`` texts its spans in order."""
    parts = link_parts(find_parts(marked.select("_text", "_digest").filter("_digest is not null")), scope)
    place = F.array_position(F.lit(list(KINDS)), F.col("kind")).alias("place")
    return parts.groupBy("_digest").agg(F.sort_array(F.collect_list(F.struct("start", place, "kind", "end"))).alias("found"))


def scan(docs: DataFrame, text: str = "text", keys: tuple = ("doc_id",), scope: int = SCOPE) -> DataFrame:
    """``keys``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans`` and ``n_linked`` per row.

    A null text counts as empty; a text without spans has empty lists. Repeated
    rows stay. The spans of one text are one row, bounded by that text. Texts are
    read once: of those without a part only a hash is kept, the others go to the checkpoint folder.
    """
    own = [F.col("_all")[key].alias(key) for key in keys]
    apart = F.concat(F.lit("-"), F.xxhash64(*own, "_text").cast("string"))
    marked = _digested(docs, text).select(
        *own, F.coalesce("_digest", apart).alias("_key"), "_digest", F.when(F.col("_digest").isNotNull(), F.col("_text")).alias("_text")
    )
    marked = settled(marked)
    spans = _per_text(marked, scope)
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    known = settled(
        spans.select(
            F.col("_digest").alias("_key"),
            *(count(kind).alias(f"n_{kind}") for kind in BASE),
            F.sha2(_listed(base), 256).alias("base_sha256"),
            _listed(F.col("found")).alias("spans"),
            (F.size("found") - F.size(base)).cast("bigint").alias("n_linked"),
        )
    )
    # Texts without parts look for a key of their own, so that they stay spread out.
    rows = marked.select(*keys, "_key")
    zero = {f"n_{kind}": F.lit(0).cast("bigint") for kind in BASE} | {"n_linked": F.lit(0).cast("bigint")}
    none = zero | {"base_sha256": F.sha2(F.lit(""), 256), "spans": F.lit("")}
    columns = [*(f"n_{kind}" for kind in BASE), "base_sha256", "spans", "n_linked"]
    return rows.join(known, "_key", "left").select(*keys, *(F.coalesce(name, none[name]).alias(name) for name in columns))


def redact(docs: DataFrame, text: str = "text", scope: int = SCOPE, mask: str = MASK) -> DataFrame:
    """All rows and columns, with ``mask`` in the text in place of each span; overlapping spans are masked as one.

    Rows without spans are not shuffled. A column ``n_chars`` is counted anew
    where the text changes; a null text stays null.
    """
    marked = _digested(docs, text)
    spans = _per_text(marked, scope)
    intervals = F.transform("found", lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end")))
    start = F.struct(F.array().cast("array<struct<start:int,end:int>>").alias("done"), F.lit(-1).alias("start"), F.lit(-1).alias("end"))

    def merge(state: Column, s: Column) -> Column:
        apart = s["start"] > state["end"]
        flushed = F.when(state["start"] < 0, state["done"]).otherwise(F.concat(state["done"], F.array(F.struct(state["start"].alias("start"), state["end"].alias("end")))))
        return F.struct(
            F.when(apart, flushed).otherwise(state["done"]).alias("done"),
            F.when(apart, s["start"]).otherwise(state["start"]).alias("start"),
            F.when(apart, s["end"]).otherwise(F.greatest(state["end"], s["end"])).alias("end"),
        )

    merged = F.aggregate(intervals, start, merge, lambda state: F.concat(state["done"], F.array(F.struct(state["start"].alias("start"), state["end"].alias("end")))))
    known = settled(spans.select("_digest", merged.alias("_spans")))
    gap = lambda s, i: F.substr(
        F.col("_text"),
        F.when(i == 0, F.lit(1)).otherwise(F.get("_spans", i - 1)["end"] + 1),
        s["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get("_spans", i - 1)["end"]),
    )
    rest = F.substr(F.col("_text"), F.element_at("_spans", -1)["end"] + 1)
    masked = F.concat(F.array_join(F.transform("_spans", lambda s, i: F.concat(gap(s, i), F.lit(mask))), ""), rest)
    hit = marked.filter("_digest is not null").join(known, "_digest", "left")
    changed = F.col("_all").withField(text, masked)
    if "n_chars" in docs.columns and text != "n_chars":
        changed = changed.withField("n_chars", F.length(masked).cast(docs.schema["n_chars"].dataType))
    hit = hit.withColumn("_all", F.when(F.col("_spans").isNull(), F.col("_all")).otherwise(changed))
    return marked.filter("_digest is null").select("_all.*").unionByName(hit.select("_all.*"))
