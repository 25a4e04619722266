"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import PLANS
from checks.tables import model_tables
from tianguis.session import local_session

HEADLINE = [
    "V02_ventas_diarias_articulo",
    "V03_ventas_cliente_mes",
    "V04_clientes_resumen",
    "V05_margen_linea_mes",
    "V06_inventario_actual",
    "V07_inventario_mensual",
    "V08_compras_proveedor_mes",
    "V09_ultimo_costo_articulo",
    "V11_articulo_claves",
    "V13_iscam_ventas_mensual",
    "V14_iscam_inventario_mensual",
    "P1_sellout_todos",
    "R1_ventas_formato",
    "R2_inventario",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus)
    # One small run first, so the figures do not hold the start of the JVM.
    PLANS[names[0]](model_tables(spark, sf_dir)).limit(1).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        # Every row of every column is computed and thrown away.
        PLANS[name](model_tables(spark, sf_dir)).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    line = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}
    print(json.dumps(line))


if __name__ == "__main__":
    main()
