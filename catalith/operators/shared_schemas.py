"""Counts over OpenAPI response schemas in which every referenced schema unfolds once.

``schema_docs.openapi_fields`` lists every leaf by its full name, so a chain of schemas that each use
the next one twice takes 2^n rows.  Where only counts are asked, a referenced schema is unfolded once,
and the counts travel up the references, document by document.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.durable import materialize
from catalith.layout import shuffle_join
from catalith.operators.schema_docs import (COMPOSITES, has_dynamic_properties, has_item_fields, openapi_fields, response_roots,
                                            schema_parts)
from catalith.sources.definitions import json_value

_COUNT = "decimal(38,0)"
#: What a schema yields itself: named leaves, leaves with array steps only, leaves without a name, other issues.
_ENDS = ("named", "arrays", "bare", "issues")


def count_step(nodes: DataFrame) -> DataFrame:
    """``schema_step`` where only counts are asked: (path, node, open, targets, givens, named, arrays, bare, issues).

    Of the names a place of ``nodes(path, node, schema, given)`` stands under, leaves depend on ``given`` alone: 0 none, 1 only
    array steps, 2 a name.  ``open`` are the parts to unfold next, ``targets`` and ``givens`` the references met.
    """
    s, given, none = F.col("schema"), F.col("given"), F.array().cast("array<struct<schema:variant,given:int>>")

    def part(schema: Column, names: Column) -> Column:
        return F.struct(schema.alias("schema"), names.cast("int").alias("given"))

    n = nodes.select("*", json_value(s, "$['$ref']").alias("_to"), *schema_parts(s))
    composite = F.lit(False)
    for word in COMPOSITES:
        composite = composite | F.col(f"_{word}").isNotNull()
    array_step = F.greatest(given, F.lit(1))
    is_node = F.col("_to").isNull() & F.col("_object")
    n = n.select("*", (is_node & composite).alias("_composite"), (is_node & (F.size("_props") > 0)).alias("_named"),
                 F.when(is_node & (F.size("_props") == 0), has_item_fields()).otherwise(False).alias("_deep"),
                 F.when(is_node, has_dynamic_properties()).otherwise(False).alias("_dynamic"))
    below = F.when(F.col("_named"), F.transform("_props", lambda m: part(
        m["value"], F.when(m["key"] == "[]", array_step).otherwise(2)))).when(
        F.col("_deep"), F.array(part(F.col("_items"), array_step))).otherwise(none)
    parts = [F.coalesce(F.transform(F.col(f"_{word}"), lambda v: part(v, given)), none) for word in COMPOSITES]
    below = F.when(F.col("_composite"), F.concat(*parts, below)).otherwise(below)
    below = F.when(F.col("_to").isNotNull(), F.array(part(s, given))).otherwise(below)
    leaf = is_node & ~F.col("_composite") & ~F.col("_named") & ~F.col("_deep")
    shapeless = leaf & (F.coalesce(F.col("_type") == "object", F.lit(False)) | F.col("_dynamic"))
    ends = {"named": leaf & ~shapeless & (given == 2), "arrays": leaf & ~shapeless & (given == 1), "bare": leaf & ~shapeless & (given == 0)}
    issues = (F.col("_to").isNull() & ~F.col("_object")).cast("long") + (F.col("_named") & F.col("_dynamic")).cast("long") + shapeless.cast("long")
    found = n.select("path", "node", F.transform(below, lambda k: F.struct(
        k["schema"].alias("schema"), k["given"].alias("given"), json_value(k["schema"], "$['$ref']").alias("to"))).alias("_below"),
        *[c.cast("long").alias(k) for k, c in ends.items()], issues.alias("issues"))
    used = F.filter("_below", lambda k: k["to"].isNotNull())
    return found.select("path", "node", F.transform(F.filter("_below", lambda k: k["to"].isNull()), lambda k: part(k["schema"], k["given"])).alias("open"),
                        used["to"].alias("targets"), used["given"].alias("givens"), *_ENDS)


def unfold_shared(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(roots, nodes, operations): each schema of each document unfolded once, as a graph.

    ``roots(path, operation, node)`` are response schemas.  ``nodes(path, node, targets, givens, named, arrays, bare, issues)``
    has for every root and every referenced schema what it yields itself and the references it makes, by the names they stand
    under; several rows of a node add up.  Rounds follow the nesting inside one schema, never the length of a chain of
    references.
    """
    refs, ops, found, lost = response_roots(docs)
    found = materialize(found, "schema-roots")
    root_name = F.concat_ws("|", F.lit("response"), "operation", "status", F.coalesce("media", F.lit("")), "locator")
    open_nodes = found.select("path", root_name.alias("node"), "schema").unionByName(
        refs.select("path", F.col("_ref").alias("node"), F.col("_target").alias("schema"))).withColumn("given", F.lit(0))
    nodes = []
    while not nodes or open_nodes.limit(1).count():
        step = materialize(count_step(open_nodes), "shared")
        nodes.append(step.drop("open"))
        open_nodes = step.filter(F.size("open") > 0).select("path", "node", F.inline("open"))
    ops = ops.select("path", "operation", F.upper("method").alias("method"), "route", "name")
    lost_counts = _union(lost).groupBy("path", "operation").agg(F.count(F.lit(1)).alias("lost")) if lost else None
    ops = ops.withColumn("lost", F.lit(0).cast("long")) if lost_counts is None else shuffle_join(
        ops, lost_counts, ["path", "operation"], "left").na.fill(0, ["lost"])
    return found.select("path", "operation", root_name.alias("node")), _union(nodes), ops


def graph_counts(parts: Iterable[tuple]) -> dict[str, tuple[int, int, int]] | None:
    """operation -> (roots, fields, issues) of one document's graph; None when a root reaches a cycle of references."""
    roots, uses, ends = [], [], []
    for operation, node, target, given, times, *own in parts:
        if operation is not None:
            roots.append((operation, node))
        elif target is not None:
            uses.append((node, target, given, times))
        else:
            ends.append((node, *own))
    return _graph_counts(roots, uses, ends)


def _graph_counts(roots: Iterable[tuple], uses: Iterable[tuple], ends: Iterable[tuple]) -> dict[str, tuple[int, int, int]] | None:
    """``graph_counts`` of (operation, node), (node, target, given, times) and (node, named, arrays, bare, issues)."""
    own: dict = {}
    for node, *counts in ends:
        own[node] = tuple(map(int.__add__, own[node], counts)) if node in own else tuple(counts)
    below: dict = {}
    for node, *use in uses:
        below.setdefault(node, []).append(use)
    done: dict[tuple, tuple[int, int] | None] = {}
    out: dict[str, tuple[int, int, int]] = {}
    for operation, root in roots:
        todo = [(root, 0)]
        while todo:
            node, given = at = todo[-1]
            if at not in done:
                done[at] = None  # open until what it uses is counted
                for target, g, _ in below.get(node, ()):
                    k = target, max(g, given)
                    if k not in done:
                        if target in own:
                            todo.append(k)
                    elif done[k] is None:
                        return None
                continue
            todo.pop()
            if done[at] is not None:
                continue
            named, arrays, bare, issues = own[node]
            fields, issues = (named + arrays + bare, issues) if given == 2 else (named, issues + (bare if given == 0 else 0))
            for target, g, n in below.get(node, ()):
                f, i = done[target, max(g, given)] if target in own else (0, 1)  # a reference to nothing is an issue of its user
                fields, issues = fields + n * f, issues + n * i
            done[at] = fields, issues
        seen, fields, issues = out.get(operation, (0, 0, 0))
        out[operation] = seen + 1, fields + done[root, 0][0], issues + done[root, 0][1]
    return out


def _count(n: int) -> Decimal:
    if n >= 10**38:
        raise OverflowError("a count beyond decimal(38,0)")
    return Decimal(n)


def document_counts(roots: DataFrame, nodes: DataFrame) -> DataFrame:
    """(path, operation, response_schemas_observed, output_fields, unresolved_schema_parts) of each operation with a response schema.

    A document whose operations reach a cycle has one row, without an operation.  Each document's graph meets in one
    row, which is no larger than the document.
    """
    own = [c for c in nodes.columns if c != "path"]
    rows = roots.select("path", F.struct("operation", "node").alias("root"), F.lit(None).cast(nodes.select(F.struct(*own).alias("n")).schema["n"].dataType).alias("part"))
    rows = rows.unionByName(nodes.select("path", F.lit(None).cast("struct<operation:string,node:string>").alias("root"), F.struct(*own).alias("part")))
    graphs = rows.groupBy("path").agg(F.collect_list("root").alias("roots"), F.collect_list("part").alias("parts"))

    def offsets(c: pa.ListArray) -> list[int]:
        return (c.offsets.to_numpy() - c.offsets[0].as_py()).tolist()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # Names become numbers for the batch, and columns plain lists, before rows are looked at one by one.
            operation, root = b.column("roots").flatten().flatten()
            node, targets, givens, *ends = b.column("parts").flatten().flatten()
            names = pa.concat_arrays([root, node, targets.flatten()]).dictionary_encode().indices.to_numpy().tolist()
            n, m = len(root), len(root) + len(node)
            roots = list(zip(operation.to_pylist(), names[:n]))
            ends = list(zip(names[n:m], *[c.to_numpy().tolist() for c in ends]))
            by = offsets(targets)
            users = [k for k, i, j in zip(names[n:m], by, by[1:]) for _ in range(j - i)]
            uses = list(zip(users, names[m:], givens.flatten().to_numpy().tolist(), repeat(1)))
            of_roots, of_parts, out = offsets(b.column("roots")), offsets(b.column("parts")), []
            for path, r, r_end, p, p_end in zip(b.column("path").to_pylist(), of_roots, of_roots[1:], of_parts, of_parts[1:]):
                found = _graph_counts(roots[r:r_end], uses[by[p]:by[p_end]], ends[p:p_end])
                out += [(path, None, None, None, None)] if found is None else [
                    (path, op, n, _count(f), _count(x)) for op, (n, f, x) in found.items()]
            types = (b.schema.field("path").type, pa.string(), pa.int64(), pa.decimal128(38, 0), pa.decimal128(38, 0))
            columns = list(zip(*out)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, types)], names=[
                "path", "operation", "response_schemas_observed", "output_fields", "unresolved_schema_parts"])

    return graphs.mapInArrow(counted, f"path string, operation string, response_schemas_observed long, output_fields {_COUNT}, "
                                      f"unresolved_schema_parts {_COUNT}")


def openapi_counts(docs: DataFrame) -> DataFrame:
    """The operations of ``openapi_fields`` with their counts, without listing the fields.

    Counts are ``decimal(38,0)`` and an error beyond that.  What a recursive schema yields depends on the chain that
    leads to it, so documents with an operation that reaches a cycle of references are unfolded chain by chain.
    """
    docs = materialize(docs, "api-docs")
    roots, nodes, ops = unfold_shared(docs)
    counts = materialize(document_counts(roots, nodes), "schema-counts")
    cyclic = counts.filter("operation is null").select("path")
    out = shuffle_join(shuffle_join(ops, cyclic, ["path"], "left_anti"), counts.filter("operation is not null"), ["path", "operation"], "left").select(
        "path", "operation", "method", "route", "name", F.coalesce("response_schemas_observed", F.lit(0).cast("long")).alias("response_schemas_observed"),
        F.coalesce("output_fields", F.lit(0)).cast(_COUNT).alias("output_fields"),
        (F.coalesce("unresolved_schema_parts", F.lit(0)) + F.col("lost")).cast(_COUNT).alias("unresolved_schema_parts"))
    if cyclic.limit(1).count():
        _, _, listed = openapi_fields(materialize(shuffle_join(docs, cyclic, ["path"], "left_semi"), "cyclic-docs"))
        out = out.unionByName(listed.select(*[F.col(c).cast(_COUNT).alias(c) if c in ("output_fields", "unresolved_schema_parts")
                                              else F.col(c) for c in out.columns]))
    return out.withColumn("status", F.when(F.col("output_fields") > 0, F.lit("definition_observed")).otherwise(F.lit("definition_unresolved")))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
