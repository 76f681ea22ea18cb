import json
import os
import uuid

from lastmile import fixed
from lastmile.plans import pipeline
from lastmile.sources import layers


def test_spanish_feed_end_to_end(spark, scratch_dir):
    root = os.path.join(scratch_dir, f"es-{uuid.uuid4().hex[:8]}")
    layout = pipeline.Layout(root)
    os.makedirs(layout.landing_shipments)
    os.makedirs(layout.landing_couriers)
    header = ("tracking_id,fecha_recogida,fecha_entrega,ciudad,codigo_postal,peso_kg,estado,"
              "repartidor_id,cliente_tipo,importe_envio\n")
    lines = []
    for i in range(12):
        status = "ENTREGADO" if i < 9 else ("INCIDENCIA" if i < 11 else "DEVUELTO")
        delivered = "2024-03-02 09:00:00" if status == "ENTREGADO" and i < 6 else (
            "2024-03-03 12:00:00" if status == "ENTREGADO" else "")
        pickup = "01/03/2024 10:00:00" if i % 2 else "2024-03-01 10:00:00"
        weight = '"2,5"' if i == 0 else ("" if i == 1 else "3.0")
        lines.append(f"RPX-2024-{i:06d},{pickup},{delivered},  madrid ,8045,{weight},{status},REP-001,EMPRESA,5.5\n")
    lines.append("RPX-2024-000099,2024-03-01 10:00:00,,Bilbao,48001,3.0,DEVUELTO,REP-999,EMPRESA,5.5\n")
    with open(os.path.join(layout.landing_shipments, "envios.csv"), "w", encoding="utf-8") as fh:
        fh.write(header + "".join(lines))
    couriers = [{"repartidor_id": "REP-001", "nombre": " Ana ", "apellido": "Ruiz", "fecha_alta": "2021-05-01",
                 "tipo_contrato": "emp", "ciudad_asignada": "Madrid", "vehiculo": "MOTO", "telefono": None}] * 2
    with open(os.path.join(layout.landing_couriers, "repartidores.json"), "w", encoding="utf-8") as fh:
        fh.write("".join(json.dumps(c) + "\n" for c in couriers))

    result = pipeline.run_layers(spark, root, "exact", fixed.SPANISH)
    assert result["bronze"] == {"shipments": 13, "couriers": 2}
    assert result["silver"]["silver_rows"] == 12 and result["silver"]["orphan_shipments"] == 1
    assert result["silver"]["median_weight"] == 3.0
    silver_couriers = layers.read_layer(spark, layout.path("silver", "couriers")).collect()
    assert len(silver_couriers) == 1 and silver_couriers[0].contract == "EMPLEADO"
    assert silver_couriers[0].first_name == "Ana"
    gold = layers.read_layer(spark, layout.path("gold", "kpi_courier")).first()
    assert (gold.shipments, gold.delivered, gold.incidents) == (12, 9, 2)
    assert gold.sla_pct == 50.0 and gold.volume_rank == 1 and gold.score == 1.0
    summary = layers.read_layer(spark, layout.path("gold", "executive_summary")).first()
    assert (summary.delivered, summary.incidents, summary.returned) == (9, 2, 1)
    daily = layers.read_layer(spark, layout.path("gold", "kpi_daily_city")).collect()
    assert [(r.city, r.total_shipments) for r in daily] == [("Madrid", 12)]
