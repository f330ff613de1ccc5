"""The 25-node, 31-relation discovery example used by the expansion tests."""

from hashlib import sha256

# The example graph.
CONCEPTS = ["migration", "employment", "housing", "education"]
INDICATORS = [("in", "migration", False), ("out", "migration", False), ("net", "migration", False),
              ("unemployment", "employment", False), ("employment", "employment", False),
              ("house", "housing", False), ("rent", "housing", False),
              ("graduate", "education", True), ("neet", "education", True)]
DATASETS = [("kosis-flows", "mods", ["kosis-migration", "kosis-table-access"]),
            ("kosis-net", "mods", ["kosis-migration", "kosis-table-access"]),
            ("wb-unemployment", "wb", ["wb-unemployment"]), ("wb-employment", "wb", ["wb-employment"]),
            ("oecd-unemployment", "oecd", ["oecd-unemployment-web"]), ("oecd-housing", "oecd", ["oecd-housing-web"])]
AVAILABLE = [("in", "kosis-flows", "candidate"), ("out", "kosis-flows", "candidate"), ("net", "kosis-net", "documented"),
             ("unemployment", "wb-unemployment", "documented"), ("unemployment", "oecd-unemployment", "candidate"),
             ("employment", "wb-employment", "documented"), ("house", "oecd-housing", "documented"),
             ("rent", "oecd-housing", "candidate")]


def _edge(a, p, b, status, evidence, cost=0, priority=10, role="structural"):
    return ("r-" + sha256(f"{a}|{p}|{b}".encode()).hexdigest()[:12], a, p, b, status, role, cost, priority, evidence)


def discovery_graph(spark):
    user = ["user-requirements"]
    nodes = [(f"q-{q}", "query", False, None, []) for q in CONCEPTS[:3]]
    nodes += [(f"c-{c}", "concept", False, None, []) for c in CONCEPTS]
    nodes += [(f"i-{i}", "indicator", gap, None, []) for i, _, gap in INDICATORS]
    nodes += [(f"d-{d}", "dataset", False, f"https://data.example/{d}", ["not verified"]) for d, _, _ in DATASETS]
    nodes += [(f"provider-{p}", "provider", False, None, []) for p in ("mods", "oecd", "wb")]
    edges = [_edge(f"q-{q}", "interpretedAs", f"c-{q}", "curated", user, 1, 0, "query_interpretation")
             for q in CONCEPTS[:3]]
    hyp = "explorationHypothesis"
    edges += [_edge("c-migration", hyp, f"c-{t}", "candidate", user, 1, 20, "context_hypothesis")
              for t in CONCEPTS[1:]]
    edges += [_edge(f"c-{a}", hyp, f"c-{b}", "candidate", user, 1, 25, "context_hypothesis")
              for a, b in (("employment", "education"), ("education", "employment"))]
    edges += [_edge(f"c-{c}", "hasIndicator", f"i-{i}", "curated", user, 0, 5, "indicator_definition")
              for i, c, _ in INDICATORS]
    ev = {d: e for d, _, e in DATASETS}
    edges += [_edge(f"i-{i}", "availableFrom", f"d-{d}", s, ev[d], 0, 8, "metadata_mapping") for i, d, s in AVAILABLE]
    edges += [_edge(f"d-{d}", "providedBy", f"provider-{p}", "documented", e, 0, 5, "source_provenance")
              for d, p, e in DATASETS]
    n = spark.createDataFrame(
        nodes, "id string, type string, data_gap boolean, source_url string, limitations array<string>")
    e = spark.createDataFrame(
        edges, "id string, source string, predicate string, target string, status string, role string, "
               "semantic_cost int, priority int, evidence_ids array<string>")
    return n, e
