"""Pipeline definitions (nodes and edges as JSON) compiled to lazy DataFrames."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame

from tributary.operators import cleansing as k

#: Which kind of node may feed which.
FLOW = {"connector": ("storage",), "storage": ("transform", "output"), "transform": ("transform", "output"), "output": ()}


def deep_merge(base: dict, other: dict) -> dict:
    """Nested settings merged, the later wins."""
    out = dict(base)
    for key, v in other.items():
        out[key] = deep_merge(out[key], v) if isinstance(v, dict) and isinstance(out.get(key), dict) else v
    return out


def topological(nodes: list[str], edges: list[tuple[str, str]]) -> list[str]:
    """Nodes after what they need; nodes of a cycle come last in their given order."""
    need = {n: 0 for n in nodes}
    after: dict[str, list[str]] = {n: [] for n in nodes}
    for a, b in edges:
        if a in need and b in need:
            need[b] += 1
            after[a].append(b)
    ready, out = deque(n for n in nodes if not need[n]), []
    while ready:
        n = ready.popleft()
        out.append(n)
        for m in after[n]:
            need[m] -= 1
            if not need[m]:
                ready.append(m)
    return out + [n for n in nodes if n not in set(out)]


def validate(definition: dict) -> list[str]:
    """What is wrong with a definition: unknown ends, kinds that may not feed each other, no output."""
    kinds = {n["id"]: n.get("type", "transform") for n in definition.get("nodes", [])}
    out = []
    for e in definition.get("edges", []):
        a, b = kinds.get(e["source"]), kinds.get(e["target"])
        if a is None or b is None:
            out.append(f"edge {e['source']} -> {e['target']} has an unknown end")
        elif b not in FLOW.get(a, ()):
            out.append(f"{a} may not feed {b}")
    if "output" not in kinds.values():
        out.append("there is no output")
    return out


#: Transform operations by name: (DataFrame, parameters) to DataFrame.
OPERATIONS: dict[str, Callable[[DataFrame, dict], DataFrame]] = {
    "rename_columns": lambda df, p: k.rename_columns(df, p["names"]),
    "select_columns": lambda df, p: k.select_columns(df, p["columns"]),
    "filter_rows": lambda df, p: k.filter_rows(df, p["condition"]),
    "sort": lambda df, p: k.sort(df, p["by"], p.get("ascending", True)),
    "aggregate": lambda df, p: k.aggregate(df, p["by"], p["measures"]),
    "group_by": lambda df, p: k.aggregate(df, p["by"], p["measures"]),
    "pivot": lambda df, p: k.pivot(df, p["by"], p["column"], p["values"], p["measure"], p.get("function", "sum")),
    "drop_nulls": lambda df, p: k.drop_nulls(df, p.get("columns")),
    "fill_nulls": lambda df, p: k.fill_nulls(df, p.get("value", ""), p.get("columns")),
    "drop_duplicates": lambda df, p: k.drop_duplicates(df, p.get("keys")),
    "normalize_dates": lambda df, p: df.withColumns({c: k.iso_date(df[c]) for c in p["columns"]}),
    "trim": lambda df, p: k.trim_strings(df, p.get("columns")),
    "cleanse": lambda df, p: k.cleanse(df, **p),
    "flatten_json": lambda df, p: k.flatten(df, p.get("sep", "."), p.get("max_depth", 10)),
    "explode_array": lambda df, p: k.explode_array(df, p.get("column"), p.get("sep", ".")),
}


def register(name: str, operation: Callable[[DataFrame, dict], DataFrame]) -> None:
    """A custom step, any DataFrame to DataFrame function."""
    OPERATIONS[name] = operation


def compile_pipeline(definition: dict, sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """A lazy DataFrame for each output node; joins take two inputs, other nodes the union of theirs."""
    wrong = validate(definition)
    if wrong:
        raise ValueError("; ".join(wrong))
    nodes = {n["id"]: n for n in definition["nodes"]}
    into: dict[str, list[str]] = {n: [] for n in nodes}
    for e in definition["edges"]:
        into[e["target"]].append(e["source"])
    made: dict[str, DataFrame] = {}
    for n in topological(list(nodes), [(e["source"], e["target"]) for e in definition["edges"]]):
        node = nodes[n]
        inputs = [made[i] for i in into[n]]
        if not inputs:
            made[n] = sources[node.get("dataset", n)]
        elif node.get("op") == "join":
            made[n] = inputs[0].join(inputs[1], node["params"]["on"], node["params"].get("how", "inner"))
        else:
            df = inputs[0]
            for other in inputs[1:]:
                df = df.unionByName(other, allowMissingColumns=True)
            made[n] = OPERATIONS[node["op"]](df, node.get("params", {})) if node.get("op") else df
    return {n: made[n] for n in nodes if nodes[n].get("type") == "output"}


def preview(df: DataFrame, op: str, params: dict, rows: int = 20) -> DataFrame:
    return OPERATIONS[op](df.limit(rows), params)
