"""URL rules whose block decisions reach aliases (operator 2)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.components import connected_components, settled

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def matched_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits, as a struct of ``text`` and ``verdict``; null without one.

    The rules are part of the plan, so their number is the size of a
    configuration. Of two equally long rules the one with the longer host wins.
    """
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda rule: (len(rule.text), len(rule.host))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def address(url: Column) -> Column:
    """What two spellings of one address share: scheme and host in lower case, no fragment. Null without ``://``."""
    bare = F.regexp_extract(url, r"(?s)^\s*([^#]*)", 1)
    front = F.regexp_extract(bare, r"(?s)^(.*?://[^/?]*)", 1)
    return F.when(front != "", F.concat(F.translate(front, UPPER, LOWER), F.substr(bare, F.length(front) + 1)))


def absolute(target: Column, base: Column) -> Column:
    """A link target in full: ``//host``, ``/path``, ``?query`` and relative targets are completed from the page's url."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"(?s)^(.*?://[^?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*((?:/[^?#]*/|/)?)", 1)
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(page, target))
        .when((target == "") | target.startswith("#"), base)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )


CANONICAL = r"""(?i)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
REFRESH = r"""(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]*)"""
REFRESH_URL = r"""(?i)\burl\s*=\s*["']?([^"'\s>]*)"""


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``a``, ``b``: addresses that the pages' canonical links and refresh redirects make one."""
    tagged = pages.select(F.col(url).alias("url"), F.col(html).alias("html")).filter(
        F.col("html").rlike(r"(?i)canonical|refresh") & F.col("url").contains("://")
    )
    targets = tagged.select(
        "url",
        F.explode(
            F.concat(
                F.transform(F.regexp_extract_all("html", F.lit(CANONICAL), F.lit(0)), lambda tag: F.regexp_extract(tag, HREF, 1)),
                F.transform(F.regexp_extract_all("html", F.lit(REFRESH), F.lit(0)), lambda tag: F.regexp_extract(tag, REFRESH_URL, 1)),
            )
        ).alias("target"),
    ).filter("target <> ''")
    target = F.replace("target", F.lit("&amp;"), F.lit("&"))
    return targets.select(
        address(F.col("url")).alias("a"), address(absolute(target, F.col("url"))).alias("b")
    ).filter("a is not null and b is not null and a <> b")


def judge(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    redirects: DataFrame | None = None,
    keys: tuple = ("page_id",),
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """``keys``, ``host``, ``path``, ``rule`` and ``verdict`` of every page.

    A page that a rule fits has that rule's verdict. Any other page takes the
    decision of its aliases: the addresses that canonical links, refresh redirects and
    ``redirects`` (``a``, ``b``, urls; optional) connect with its own, whether or
    not they are pages themselves. It is blocked if a rule blocks one of them and
    no rule allows one of them, since an explicit allow goes before blocks; else
    it is allowed. A null url, or one without ``://``, has an empty host and path, no rule and
    no aliases and is allowed. Repeated pages stay.
    """
    edges = alias_edges(pages, url, html)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(address(F.col("a")).alias("a"), address(F.col("b")).alias("b")))
    groups = connected_components(edges)
    ruled = groups.withColumn("verdict", matched_rule(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"])
    blocked = settled(
        ruled.groupBy("component")
        .agg(F.max(F.col("verdict") == "block").alias("block"), F.max(F.col("verdict") == "allow").alias("allow"))
        .filter(F.col("block") & ~F.coalesce("allow", F.lit(False)))
        .select("component")
    )
    aliases = settled(groups.join(blocked, "component", "left_semi").select(F.col("node").alias("_address"), F.lit(True).alias("_aliased")))
    judged = pages.select(
        *keys,
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        address(F.col(url)).alias("_address"),
    ).withColumn("_rule", matched_rule(F.col("host"), F.col("path"), rules))
    own = F.coalesce(F.col("_rule.verdict"), F.when(F.col("_aliased"), F.lit("block")).otherwise(F.lit("allow")))
    return judged.join(aliases, "_address", "left").select(
        *keys, "host", "path", F.col("_rule.text").alias("rule"), own.alias("verdict")
    )
