"""Claims as statement triples; only gated claims become plain facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reified(claims: DataFrame) -> DataFrame:
    """Six statement triples per claim: (s, p, o).

    ``claims(id, s, p, o, status, evidence_id)``.
    """
    parts = (("rdf:type", F.lit("RelationshipClaim")), ("rdf:subject", F.col("s")), ("rdf:predicate", F.col("p")),
             ("rdf:object", F.col("o")), ("claimStatus", F.col("status")), ("evidence", F.col("evidence_id")))
    rows = F.array(*[F.struct(F.col("id").alias("s"), F.lit(n).alias("p"), v.alias("o")) for n, v in parts])
    return claims.select(F.inline(rows)).filter("o is not null")


def facts(claims: DataFrame, gate: Sequence[str] = ("documented",)) -> DataFrame:
    """Distinct (s, p, o) of the claims whose status passes the gate."""
    return claims.filter(F.col("status").isin(*gate)).select("s", "p", "o").distinct()


def label_triples(nodes: DataFrame) -> DataFrame:
    """Preferred and alternative labels and themes of concepts.

    ``nodes(id, label, aliases, topics)``.
    """
    pref = nodes.select(F.col("id").alias("s"), F.lit("skos:prefLabel").alias("p"), F.col("label").alias("o"))
    alt = nodes.select(F.col("id").alias("s"), F.lit("skos:altLabel").alias("p"), F.explode("aliases").alias("o")).filter("o <> ''")
    theme = nodes.select(F.col("id").alias("s"), F.lit("dcat:theme").alias("p"), F.explode("topics").alias("o"))
    return pref.unionAll(alt).unionAll(theme)


def claims_to_triples(claims: DataFrame, gate: Sequence[str] = ("documented",)) -> DataFrame:
    """All statement triples plus the gated facts."""
    return reified(claims).unionAll(facts(claims, gate))


# Namespaces of the prefixes, and the predicates whose objects are texts.
NAMESPACES = {"rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "skos": "http://www.w3.org/2004/02/skos/core#",
              "dcat": "http://www.w3.org/ns/dcat#"}
LITERAL_PREDICATES = ("skos:prefLabel", "skos:altLabel", "claimStatus")


def names_resource(p: Column) -> Column:
    """Whether the object of predicate ``p`` names a resource; every predicate outside ``LITERAL_PREDICATES`` does."""
    return ~p.isin(*LITERAL_PREDICATES)


def nt_line(s: Column, p: Column, o: Column, base: str, resource: Column | None = None) -> Column:
    """One N-Triples line; the object is a literal except where ``resource`` holds.

    Names of a known prefix stand in its namespace, all others under ``base``.  A null in any part gives null.
    """
    def iri(c: Column) -> Column:
        whole = F.concat(F.lit(base), F.url_encode(c))
        for prefix, space in NAMESPACES.items():
            whole = F.when(c.startswith(f"{prefix}:"), F.concat(
                F.lit(space), F.url_encode(F.substring(c, len(prefix) + 2, 1 << 30)))).otherwise(whole)
        return F.concat(F.lit("<"), whole, F.lit(">"))

    esc = F.replace(F.replace(F.replace(F.replace(o, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')),
                              F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    text = F.concat(F.lit('"'), esc, F.lit('"'))
    thing = text if resource is None else F.when(resource, iri(o)).otherwise(text)
    return F.concat(iri(s), F.lit(" "), iri(p), F.lit(" "), thing, F.lit(" ."))


def write_ntriples(triples: DataFrame, path: str, base: str) -> None:
    s, p, o = F.col("s"), F.col("p"), F.col("o")
    triples.select(nt_line(s, p, o, base, names_resource(p)).alias("value")).write.mode("errorifexists").text(path)
