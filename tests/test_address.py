"""Address parsing and matching."""

from pyspark.sql import functions as F

from valora.functions.address import parse_address, street_key, suffix_key
from valora.operators.address import match_addresses


def test_parse(spark):
    cases = {"12, r. Hâute 72000 LE MANS": (12, "", "rue haute"), "3 bis av de la Gare": (3, "bis", "avenue de la gare"),
             "7 B bd St-Michel": (7, "bis", "boulevard saint michel"), "5 all. des Tilleuls": (5, "", "allee des tilleuls"),
             "Lieu dit Le Bourg 72100 X": (None, "", "lieu dit le bourg"), "": (None, "", None), None: (None, None, None),
             "12": (12, "", None), "99999999999999999999 rue x": (None, "", "rue x")}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    got = {r.t: r.a for r in df.select("t", parse_address(F.col("t")).alias("a")).collect()}
    for text, (number, suffix, street) in cases.items():
        assert (got[text].number, got[text].street) == (number, street), text
        assert text is None or got[text].suffix == suffix, text


def test_match_keeps_every_row_once(spark):
    S = spark.createDataFrame([(1, "c", 1, None, "Rue Haute"), (2, "c", 1, None, "Rue Hautte"), (3, "c", 1, "B", "Rue Haute"),
                               (4, "d", 1, None, "Rue Haute"), (5, None, 1, None, "Rue Haute"), (6, "c", 2, None, None)]
                              + [(10 + k, "c", 1, None, "RUE haute") for k in range(50)],
                              "id int, com string, num long, suf string, voie string")
    A = spark.createDataFrame([(100, "c", "1 rue haute", 1), (101, "c", "1 r. Haute", 2), (102, "c", "1 bis rue haute", 1),
                               (103, "c", "1 rue basse", 9), (104, None, "1 rue haute", 9)], "audit int, insee string, txt string, day int")
    key = lambda c: {"commune": F.col(c), "number": F.col("num"), "suffix": suffix_key(F.col("suf")), "street": street_key(F.col("voie"))}
    raw = A.select("*", parse_address(F.col("txt")).alias("raw"))
    got = match_addresses(S, raw, key("com"), {"commune": F.col("insee"), **{k: F.col(f"raw.{k}") for k in ("number", "suffix", "street")}},
                          [F.desc("day")], ["audit"]).collect()
    out = {r.id: (r.audit, r.address_match) for r in got}
    assert len(got) == 56 and out[1] == (101, "exact") and out[2] == (101, "similar") and out[3] == (102, "exact")
    assert out[4] == out[5] == out[6] == (None, None) and all(out[10 + k] == (101, "exact") for k in range(50))
