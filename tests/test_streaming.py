"""Incremental panel: two extract files arriving in two runs, panel rows of touched months only."""

import os
import tempfile

from pyspark.sql import functions as F

from realty_spark.streaming.incremental import start_incremental_panel

COLS = ["Date mutation", "Code departement", "Valeur fonciere", "Surface reelle bati", "Nombre pieces principales"]


def _write(d, name, lines):
    with open(os.path.join(d, name), "w") as f:
        f.write("|".join(COLS) + "\n" + "\n".join(lines) + "\n")


def test_incremental_panel(spark):
    root = tempfile.mkdtemp(prefix="realty-stream-", dir="/tmp")
    inp, out, ck = (os.path.join(root, x) for x in ("in", "out", "ck"))
    os.makedirs(inp)
    _write(inp, "a.txt", ["15/01/2025|75|300000,00|50|2", "20/01/2025|75|200000,00|50|2", "03/02/2025|77|90000|30|1"])
    q = start_incremental_panel(spark, inp, out, ck, COLS)
    q.awaitTermination()
    _write(inp, "b.txt", ["25/01/2025|75|250000,00|50|2", "10/02/2025|13|90000|30|1"])
    q = start_incremental_panel(spark, inp, out, ck, COLS)
    q.awaitTermination()
    p = spark.read.parquet(os.path.join(out, "panel"))
    jan = p.where((F.col("zone") == "Dept 75") & (F.col("annee_mois") == "2025-01-01")).first()
    assert jan.nb_transactions == 3 and jan.prix_median_m2 == 5000.0
    assert p.where(F.col("zone") == "Dept 13").count() == 0
    assert p.where(F.col("zone") == "Dept 77").first().nb_transactions == 1
