"""Text ingest of both registry dialects from files written by the test itself."""

import datetime as dt
import os
import tempfile

from realty_spark.plans import build_dataset as B
from realty_spark.sources import readers


def test_geo_csv_and_raw_txt(spark):
    d = tempfile.mkdtemp(prefix="realty-src-", dir="/tmp")
    with open(os.path.join(d, "DVF_2024.csv"), "w") as f:
        f.write("date_mutation,code_departement,valeur_fonciere,surface_reelle_bati,nombre_pieces_principales,"
                "code_postal,nom_commune,numero_volume\n")
        f.write('2024-03-01,75,"250000,50",50,2,75005,Paris,x\n')
        f.write("2024-03-02,13,100000,40,2,13001,Marseille,x\n")
    with open(os.path.join(d, "DVF_2025.csv"), "w") as f:
        f.write("date_mutation,code_departement,valeur_fonciere,surface_reelle_bati,nombre_pieces_principales,"
                "nom_commune,code_postal\n")
        f.write("bad-date,92,300000,60,3,Boulogne,92100\n")
    columns = ["date_mutation", "code_departement", "valeur_fonciere", "surface_reelle_bati", "nombre_pieces_principales",
               "code_postal", "nom_commune", "numero_volume"]
    geo = readers.read_geo_csv(spark, [d + "/DVF_202*.csv"], columns)
    out = B.build_dataset(geo).collect()
    assert len(out) == 2                                  # Marseille is outside the department list
    paris = [r for r in out if r.code_departement == "75"][0]
    assert paris.valeur_fonciere == 250000.5 and paris.quartier_detaille == "Paris 05e"
    assert "numero_volume" not in out[0].asDict()
    boulogne = [r for r in out if r.code_departement == "92"][0]
    assert boulogne.quartier_detaille == "Boulogne (92100)" and boulogne.date_mutation is None and boulogne.annee_trimestre is None

    with open(os.path.join(d, "ValeursFoncieres-2025-S1.txt"), "w") as f:
        f.write("Date mutation|Code departement|Valeur fonciere|Surface reelle bati|Nombre pieces principales\n")
        f.write("31/01/2025|77|180000,00|45|2\n")
    raw = readers.canonical_raw(readers.read_raw_txt(spark, [os.path.join(d, "ValeursFoncieres-2025-S1.txt")], "test"))
    r = B.prepare_sales(raw, date_format="yyyy-MM-dd").first()
    assert r.date_mutation == dt.date(2025, 1, 31) and r.valeur_fonciere == 180000.0 and r.prix_m2 == 4000.0


def test_missing_metrics_is_empty(spark):
    df = readers.read_metrics(spark, "/tmp/realty-no-such-metrics-dir", "sarima")
    assert df.count() == 0 and "mape" in df.columns


def test_writing_one_model_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for model, zones in (("sarima", ["a", "b"]), ("gbt", ["a"]), ("gbt", ["c"])):
        readers.write_metrics(spark.createDataFrame([(model, "price", z, 1.0) for z in zones], "model string, dataset string, zone string, mape double"), path)
    assert sorted(r.zone for r in readers.read_metrics(spark, path, "sarima").collect()) == ["a", "b"]
    assert [r.zone for r in readers.read_metrics(spark, path, "gbt").collect()] == ["c"]


def test_dataset_write_spreads_a_busy_date(spark, tmp_path):
    path = str(tmp_path / "dataset")
    df = spark.range(4000).selectExpr("2024 AS annee", "DATE'2024-05-01' AS date_mutation", "id AS v")
    B.write_dataset(df, path, partitions=4)
    back = readers.read_dataset(spark, path)
    assert back.count() == 4000 and len(os.listdir(os.path.join(path, "annee=2024"))) >= 6


def test_headers_of_many_files_take_as_many_jobs_as_of_few(spark, tmp_path):
    jobs = {}
    for n in (4, 200):
        d = tmp_path / f"files {n}"
        d.mkdir()
        for i in range(n):
            names = [["a", "b", "c"], ["c", "a"]][i % 2]
            (d / f"part {i:03d}.csv").write_text(",".join(names) + "\n" + ",".join(f"{x}{i}" for x in names) + "\n")
        spark.sparkContext.setJobGroup(f"headers {n}", "")
        df = readers.read_geo_csv(spark, [str(d)], ["a", "b", "c"])
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers {n}"))
        got = {(r.a, r.b, r.c) for r in df.collect()}
        assert got == {(f"a{i}", None if i % 2 else f"b{i}", f"c{i}") for i in range(n)}
    spark.sparkContext._jsc.clearJobGroup()
    assert jobs[200] <= jobs[4] + 2  # a longer list of files is listed by a job of its own


def test_headers_with_quotes_marks_and_long_bodies(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\ufeffx,\"y, z\"\n" + "1,2\n" * 30_000)
    (tmp_path / "b.csv").write_text("\"y, z\",x\n4,3\n")
    (tmp_path / "empty.csv").write_text("")
    got = readers.read_geo_csv(spark, [str(tmp_path)], ["x", "y, z"]).groupBy("x", "y, z").count().collect()
    assert {tuple(r) for r in got} == {("1", "2", 30_000), ("3", "4", 1)}


def test_headers_are_found_without_sorting_lines(spark, tmp_path):
    """The lines are streamed to their file's first before any aggregate, which would sort strings."""
    for i in range(3):
        (tmp_path / f"{i}.txt").write_text(f"a|b{i}\n" + f"{i}|x\n" * 25_000)
    found = readers.header_catalogue(spark, [str(tmp_path), str(tmp_path / "1.txt")])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("MapInArrow") and plan.count("Aggregate") == 1
    got = {os.path.basename(r.path): r.header for r in found.collect()}
    assert got == {f"{i}.txt": f"a|b{i}" for i in range(3)}
