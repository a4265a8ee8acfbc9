import json
import os

from valora import schemas
from valora.streaming.audit_stream import start_latest_versions


def test_latest_versions_stream(spark, tmp):
    land = f"{tmp}/landing"
    os.makedirs(land)

    def page(name, recs):
        with open(f"{land}/{name}.json", "w") as f:
            json.dump({"total": len(recs), "results": recs, "next": None}, f)

    page("p0", [{"numero_dpe": "D1", "date_derniere_modification_dpe": "2024-01-01", "etiquette_dpe": " c "},
                {"numero_dpe": "D2", "date_derniere_modification_dpe": None, "etiquette_dpe": "A"}])
    q = start_latest_versions(spark, land, schemas.AUDIT_API_TEXT, f"{tmp}/ckpt", query_name="latest_t")
    q.processAllAvailable()
    page("p1", [{"numero_dpe": "D1", "date_derniere_modification_dpe": "2025-03-01", "etiquette_dpe": "b"},
                {"numero_dpe": "D1", "date_derniere_modification_dpe": "2023-01-01", "etiquette_dpe": "g"},
                {"numero_dpe": "D2", "date_derniere_modification_dpe": "2024-06-01", "etiquette_dpe": "E"},
                {"numero_dpe": "", "date_derniere_modification_dpe": "2024-06-01", "etiquette_dpe": "E"}])
    q.processAllAvailable()
    rows = {r.numero_dpe: (str(r.date_derniere_modification_dpe), r.etiquette_dpe)
            for r in spark.sql("SELECT * FROM latest_t").collect()}
    q.stop()
    assert rows == {"D1": ("2025-03-01", "B"), "D2": ("2024-06-01", "E")}
