"""Small hand-made graphs."""

from kinfold.model import EDGE, NODE, Graph, value_rows

TYPES = ((bool, "Boolean"), (int, "Long"), (float, "Double"), (str, "String"))


def prop(value):
    elements = value if isinstance(value, list) else [value]
    kind = next((name for python, name in TYPES if elements and isinstance(elements[0], python)), "String")
    texts = [str(x).lower() if isinstance(x, bool) else str(x) for x in elements]
    return (kind, isinstance(value, list), texts)


def props(values):
    return {key: prop(value) for key, value in values.items() if value is not None}


def graph(spark, nodes, edges=()):
    """nodes: (id, labels, values); edges: (src, rel, dst[, values])."""
    labels = {node[0]: node[1] for node in nodes}
    node_rows = [(n[0], n[1], props(n[2] if len(n) > 2 else {})) for n in nodes]
    edge_rows = [
        (e[0], labels[e[0]], e[2], labels[e[2]], e[1], props(e[3] if len(e) > 3 else {})) for e in edges
    ]
    return Graph.of(spark.createDataFrame(node_rows, NODE), spark.createDataFrame(edge_rows, EDGE))


def node_values(g):
    """{(id, key): values}, a bare value for scalars."""
    found = {}
    for row in value_rows(g).collect():
        found.setdefault((row.id, row.key), []).append((row.pos if row.pos is not None else -1, row.val, row.is_list))
    return {
        key: [v for _, v, _ in sorted(rows)] if rows[0][2] else rows[0][1] for key, rows in found.items()
    }


def edge_set(g):
    return sorted((row.src, row.rel, row.dst) for row in g.edges.collect())


def edge_props(edges):
    """{(src, rel, dst): [props, ...]}"""
    found = {}
    for row in edges.collect():
        values = {k: (p.vals if p.is_list else p.vals[0]) for k, p in row.props.items()}
        found.setdefault((row.src, row.rel, row.dst), []).append(values)
    return found


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


__all__ = ["edge_props", "edge_set", "graph", "node_values", "prop", "props", "rows"]
