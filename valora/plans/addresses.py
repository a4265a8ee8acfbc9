"""Registered query of the address match."""

from __future__ import annotations

from pyspark.sql import functions as F

from valora.functions.address import parse_address, street_key, suffix_key
from valora.operators.address import match_addresses
from valora.plans.landed import QUERIES, query, table

#: A street as sales and as audits write it; whether the two are the same once normalised.
STREETS = [
    ("Rue Haute", "r. HAUTE", True), ("Avenue de la Gare", "Av de la Gare", True),
    ("Boulevard Saint-Michel", "Bd St Michel", True), ("Place du Marché", "pl. du Marche", True),
    ("Chemin des Vignes", "CHEMIN des VIGNES", True), ("Allée des Tilleuls", "all. des Tilleuls", True),
    ("Impasse Molière", "imp Moliere", True), ("Quai Sud", "Quay Sud", False), ("Route de Lyon", "rte de Lyon", True),
    ("Rue du Docteur Roux", "r Dr Roux", False), ("Square Émile Zola", "Sq. Emile Zolla", False),
    ("Cours Gambetta", "crs Gambeta", False),
]
_SIMILAR = ", ".join(str(i) for i, (*_, same) in enumerate(STREETS) if not same)


@query("audit_address_join", f"""
WITH s AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_nationkey END AS commune, c_custkey % 9 + 1 AS number,
                  c_custkey % 5 = 0 AS bis, c_custkey % {len(STREETS)} AS i FROM customer),
a AS (SELECT o_custkey % 25 AS commune, o_orderkey % 9 + 1 AS number, o_orderkey % 4 = 0 AS bis,
             o_orderkey % {len(STREETS)} AS i, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS audit FROM orders GROUP BY ALL)
SELECT c_custkey, audit, CASE WHEN audit IS NULL THEN NULL WHEN i IN ({_SIMILAR}) THEN 'similar' ELSE 'exact' END AS address_match
FROM s LEFT JOIN a USING (commune, number, bis, i)
""")
def q_audit_address_join(spark, d):
    """Customers as sales, orders as audits whose address is one text, written
    differently; a third of the sales is in one commune."""
    k, o = F.col("c_custkey"), F.col("o_orderkey")
    written = lambda c, side: F.element_at(F.array(*[F.lit(x[side]) for x in STREETS]), (c % len(STREETS) + 1).cast("int"))
    sales = table(spark, d, "customer").select(
        "c_custkey", F.when(k % 3 == 0, 0).otherwise(F.col("c_nationkey")).cast("string").alias("code_commune"),
        (k % 9 + 1).alias("numero"), F.when(k % 5 == 0, "B").alias("suffixe"), written(k, 0).alias("voie"))
    text = F.concat((o % 9 + 1).cast("string"), F.when(o % 4 == 0, " bis").otherwise(""), F.lit(", "), written(o, 1),
                    F.lit(" 72000 VILLE"))
    audits = table(spark, d, "orders").select(o.alias("audit"), "o_orderdate", parse_address(text).alias("raw"),
                                              (F.col("o_custkey") % 25).cast("string").alias("code_insee"))
    return match_addresses(
        sales, audits, {"commune": F.col("code_commune"), "number": F.col("numero"), "suffix": suffix_key(F.col("suffixe")),
                        "street": street_key(F.col("voie"))},
        {"commune": F.col("code_insee"), "number": F.col("raw.number"), "suffix": F.col("raw.suffix"), "street": F.col("raw.street")},
        [F.desc_nulls_last("o_orderdate"), F.desc("audit")], ["audit"]).select("c_custkey", "audit", "address_match")
