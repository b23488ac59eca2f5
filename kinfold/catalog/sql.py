"""The adapter graph once more, written in SQL for the checks."""

CUSTOMER = "c_custkey * 16 + 1"
SUPPLIER = "s_suppkey * 16 + 2"
ORDER = "o_orderkey * 16 + 3"
PART = "p_partkey * 16 + 4"
NATION = "CAST(n_nationkey AS BIGINT) * 16 + 5"
BRAND = "CAST('0x' || substr(md5(p_brand), 1, 13) AS BIGINT) * 16 + 6"
PART_TYPE = "CAST('0x' || substr(md5(p_type), 1, 13) AS BIGINT) * 16 + 7"
DOCUMENT = "doc_id * 16 + 8"


def concept_id(identity: str) -> str:
    """Node id of a concept by the text of its concept and smallest member."""
    return f"-CAST('0x' || substr(md5({identity}), 1, 15) AS BIGINT) - 1"


def value(node: str, label: str, key: str, expr: str, table: str, dtype: str = "String") -> str:
    return (
        f"SELECT {node} AS id, '{label}' AS label, '{key}' AS key, '{dtype}' AS dtype, FALSE AS is_list, "
        f"CAST(0 AS BIGINT) AS pos, CAST({expr} AS VARCHAR) AS val FROM {table}"
    )


def values(node: str, label: str, key: str, expr: str, table: str) -> str:
    return (
        f"SELECT id, '{label}' AS label, '{key}' AS key, 'String' AS dtype, TRUE AS is_list, "
        f"CAST(pos - 1 AS BIGINT) AS pos, arr[pos] AS val FROM (SELECT {node} AS id, arr, "
        f"unnest(range(1, len(arr) + 1)) AS pos FROM (SELECT *, {expr} AS arr FROM {table}))"
    )


CUSTOMER_VALUES = " UNION ALL ".join(
    [
        value(CUSTOMER, "Src_Customer", "id", "'CUST:' || c_custkey", "customer"),
        value(CUSTOMER, "Src_Customer", "name", "c_name", "customer"),
        value(CUSTOMER, "Src_Customer", "segment", "c_mktsegment", "customer"),
        value(CUSTOMER, "Src_Customer", "nationkey", "c_nationkey", "customer", "Long"),
    ]
)
SUPPLIER_VALUES = " UNION ALL ".join(
    [
        value(SUPPLIER, "Src_Supplier", "id", "'SUPP:' || s_suppkey", "supplier"),
        value(SUPPLIER, "Src_Supplier", "name", "s_name", "supplier"),
        value(SUPPLIER, "Src_Supplier", "nationkey", "s_nationkey", "supplier", "Long"),
    ]
)
ORDER_VALUES = " UNION ALL ".join(
    [
        value(ORDER, "Src_Order", "status", "o_orderstatus", "orders"),
        value(ORDER, "Src_Order", "priority", "o_orderpriority", "orders"),
    ]
)
PART_VALUES = " UNION ALL ".join(
    [
        value(PART, "Src_Part", "name", "p_name", "part"),
        values(PART, "Src_Part", "words", "string_split(p_name, ' ')", "part"),
        value(PART, "Src_Part", "size", "p_size", "part", "Long"),
    ]
)
CONCEPT_VALUES = " UNION ALL ".join(
    [
        values(NATION, "NATION", "ids", "['NATION:' || n_nationkey, 'REGION:' || n_regionkey]", "nation"),
        values(NATION, "NATION", "names", "[n_name]", "nation"),
        values(BRAND, "BRAND", "names", "[p_brand]", "(SELECT DISTINCT p_brand FROM part)"),
        values(PART_TYPE, "PART_TYPE", "names", "[p_type]", "(SELECT DISTINCT p_type FROM part)"),
    ]
)
SOURCE_VALUES = " UNION ALL ".join([CUSTOMER_VALUES, SUPPLIER_VALUES, ORDER_VALUES, PART_VALUES])
ALL_VALUES = SOURCE_VALUES + " UNION ALL " + CONCEPT_VALUES

NODES = " UNION ALL ".join(
    [
        f"SELECT {CUSTOMER} AS id, 'Src_Customer' AS label FROM customer",
        f"SELECT {SUPPLIER}, 'Src_Supplier' FROM supplier",
        f"SELECT {ORDER}, 'Src_Order' FROM orders",
        f"SELECT {PART}, 'Src_Part' FROM part",
        f"SELECT {NATION}, 'NATION' FROM nation",
        f"SELECT DISTINCT {BRAND}, 'BRAND' FROM part",
        f"SELECT DISTINCT {PART_TYPE}, 'PART_TYPE' FROM part",
    ]
)

NATION_OF_CUSTOMER = "CAST(c_nationkey AS BIGINT) * 16 + 5"
NATION_OF_SUPPLIER = "CAST(s_nationkey AS BIGINT) * 16 + 5"

MAPPED = " UNION ALL ".join(
    [
        f"SELECT {CUSTOMER} AS src, 'Src_Customer' AS src_label, {NATION_OF_CUSTOMER} AS dst, "
        "'NATION' AS dst_label FROM customer",
        f"SELECT {SUPPLIER}, 'Src_Supplier', {NATION_OF_SUPPLIER}, 'NATION' FROM supplier",
        f"SELECT {PART}, 'Src_Part', {BRAND}, 'BRAND' FROM part",
        f"SELECT {PART}, 'Src_Part', {PART_TYPE}, 'PART_TYPE' FROM part",
    ]
)

PLACED = (
    "SELECT o_custkey * 16 + 1 AS src, 'Src_Customer' AS src_label, o_orderkey * 16 + 3 AS dst, "
    "'Src_Order' AS dst_label, 'PLACED' AS rel FROM orders"
)
HAS_LINE = (
    "SELECT l_orderkey * 16 + 3 AS src, 'Src_Order' AS src_label, l_partkey * 16 + 4 AS dst, "
    "'Src_Part' AS dst_label, 'HAS_LINE' AS rel FROM lineitem"
)
SUPPLIED_BY = (
    "SELECT l_partkey * 16 + 4 AS src, 'Src_Part' AS src_label, l_suppkey * 16 + 2 AS dst, "
    "'Src_Supplier' AS dst_label, 'SUPPLIED_BY' AS rel FROM lineitem"
)
EDGES = " UNION ALL ".join(
    [f"SELECT src, src_label, dst, dst_label, 'MAPPED_TO' AS rel FROM ({MAPPED})", PLACED, HAS_LINE, SUPPLIED_BY]
)
EDGE_KEYS = (
    "SELECT DISTINCT 'HAS_LINE' AS rel, unnest(['linenumber', 'quantity']) AS key FROM (SELECT 1 FROM lineitem) "
    "UNION SELECT DISTINCT 'SUPPLIED_BY', unnest(['returnflag', 'linestatus']) FROM (SELECT 1 FROM lineitem)"
)
